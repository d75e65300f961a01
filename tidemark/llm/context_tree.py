"""Context-tree weighting over byte contexts.

Text model: a document is its lower-cased words joined by single spaces and an end
byte. Every byte is eight binary decisions. For each decision and every context of 0
to ``depth`` preceding bytes the corpus gives counts of zeros and ones; a node's
Krichevsky-Trofimov estimate and the product of its children are mixed with equal
prior weight, from the deepest contexts up to the empty one (one tree for each of the
255 partial bytes). The trained tree predicts with the posterior weights.

Spark counts byte runs of length depth+1 (whose marginals give all shallower contexts),
then builds subtrees of contexts that end with the same two bytes as groups; the two top
levels are combined from their sums. A byte never seen after a context takes the mass that
the context's seen bytes leave, shared out as the next shorter context would.

Size: ``depth`` and the counts are the same for any corpus, and the trees stay in Spark. The
log probabilities of the ``max_runs`` commonest runs are broadcast as a shortcut. Other runs
leave the scoring pass as (document, run, count); each different one is valued once, in
the group of its context, and joined back.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.texts import raw_texts
from tidemark.sources.scratch import store

END = b"\0"
#: The end's entry among the words; a word holds no space.
END_TOKEN = b" "
DEPTH = 5
#: Contexts of this many bytes are the roots of the subtrees that are built as groups.
TOP = 2
GROUP_RUNS = 50_000
#: What a counting or scoring task holds in memory: rows of a slice, runs and words before they are sent on.
SLICE_ROWS = 250
WAITING_RUNS = 1_000_000
WAITING_WORDS = 500_000


def tokens_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space."""
    return (text or b"").lower().split()


def packed_runs(texts: Sequence[list[bytes]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of the texts with its context, and where each text starts.

    Layout, from the highest byte: the previous byte, the one before, ... and lowest
    the byte itself; so a context's extensions are neighbours in sorted order.
    Before a text there are zero bytes.
    """
    pad = bytes(depth)
    joined = [b" ".join(t) + END for t in texts]
    data = np.frombuffer(b"".join([pad + j for j in joined]), np.uint8).astype(np.uint64)
    n = len(data) - depth if len(joined) else 0
    runs = data[depth:].copy() if n else np.empty(0, np.uint64)
    for back in range(1, depth + 1):
        runs |= data[depth - back:depth - back + n] << np.uint64(8 * (depth + 1 - back))
    sizes = np.array([len(j) for j in joined], np.int64)
    # Bytes of padding between texts are no events.
    keep = np.ones(n, bool)
    at = np.cumsum(sizes + depth)[:-1] - depth
    for k in range(depth):
        keep[at + k] = False
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else np.empty(0, np.int64)
    return runs[keep], starts


# Counting


def corpus_counts(training: DataFrame, depth: int) -> DataFrame:
    """(word, run, n): counts of words (``run`` NULL) and of byte runs (``word`` NULL) in column ``body``."""
    fields = [("word", pa.binary()), ("run", pa.int64()), ("n", pa.int64())]

    def rows(words: Counter, runs: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        a = [pa.array(list(words), pa.binary()), pa.nulls(len(words), pa.int64()), pa.array(list(words.values()), pa.int64())]
        b = [pa.nulls(len(runs), pa.binary()), pa.array(runs.astype(np.int64)), pa.array(n.astype(np.int64))]
        for arrays in (a, b):
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, parts, waiting = Counter(), [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                texts = [tokens_of(t) for t in raw_texts(batch.column("body").slice(at, SLICE_ROWS))]
                for t in texts:
                    words.update(t)
                words[END_TOKEN] += len(texts)
                parts.append(np.unique(packed_runs(texts, depth)[0], return_counts=True))
                waiting += len(parts[-1][0])
                if waiting > WAITING_RUNS:
                    parts = [_merged(parts)]
                    waiting = 0
            if len(words) > WAITING_WORDS or parts and len(parts[0][0]) > WAITING_RUNS:
                yield from rows(words, *_merged(parts))
                words, parts, waiting = Counter(), [], 0
        if parts:
            yield from rows(words, *_merged(parts))

    made = training.select("body").mapInArrow(run, "word binary, run long, n long")
    return made.groupBy("word", "run").agg(F.sum("n").alias("n"))


def _merged(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts over parts that are each sorted by key."""
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[heads], np.add.reduceat(n, heads) if len(heads) else n


# The tree


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of the counts."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - math.log(math.pi) - _lgamma(zeros + ones + 1.0)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after moving the argument up to at least 8."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    low = x < 8
    if low.any():
        y = x[low]
        for k in range(8):
            shift[low] += np.log(y + k)
        x = np.where(low, x + 8, x)
    inverse = 1 / x
    series = inverse / 12 - inverse**3 / 360 + inverse**5 / 1260 - inverse**7 / 1680
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series - shift


@dataclass
class Level:
    """Nodes of one context length for one bit: their mixed log probability, stop weight and estimate of a one."""

    weighted: np.ndarray
    stop: np.ndarray
    one: np.ndarray
    of_run: np.ndarray


def _node_keys(runs: np.ndarray, depth: int, length: int, bit: int) -> np.ndarray:
    """Context of ``length`` bytes and the byte's bits before ``bit``, for every run."""
    context = runs >> np.uint64(8 * (depth + 1 - length)) if length else np.zeros_like(runs)
    partial = (np.uint64(1) << np.uint64(bit)) | ((runs & np.uint64(255)) >> np.uint64(8 - bit))
    return context << np.uint64(8) | partial


def tree_levels(runs: np.ndarray, n: np.ndarray, depth: int, bit: int, top: int) -> list[Level]:
    """Levels ``top`` to ``depth`` of the tree for one bit, from the counts of sorted runs."""
    is_one = (runs >> np.uint64(7 - bit)) & np.uint64(1)
    levels: list[Level] = []
    for length in range(depth, top - 1, -1):
        keys, of_run = np.unique(_node_keys(runs, depth, length, bit), return_inverse=True)
        total = np.bincount(of_run, n, len(keys))
        ones = np.bincount(of_run, n * is_one, len(keys))
        own = log_kt(total - ones, ones)
        if levels:
            child = levels[0]
            parent = np.zeros(len(child.weighted), np.int64)
            parent[child.of_run] = of_run
            split = np.bincount(parent, child.weighted, len(keys))
            weighted, stop = mixed(own, split)
        else:
            weighted, stop = own, np.ones(len(keys))
        levels.insert(0, Level(weighted, stop, (ones + 0.5) / (total + 1), of_run))
    return levels


def mixed(own: np.ndarray, split: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half the node's estimate and half its children's product; the posterior weight of the former."""
    weighted = np.logaddexp(own, split) - math.log(2)
    return weighted, np.exp(own - math.log(2) - weighted)


def predicted(levels: Sequence[Level], is_one: np.ndarray) -> list[np.ndarray]:
    """Probability of every run's bit when the path ends at each level: index k ends at level k of ``levels``."""
    bits = [np.where(is_one, x.one[x.of_run], 1 - x.one[x.of_run]) for x in levels]
    out = []
    for last in range(len(levels)):
        p = bits[last]
        for k in range(last - 1, -1, -1):
            w = levels[k].stop[levels[k].of_run]
            p = w * bits[k] + (1 - w) * p
        out.append(p)
    return out


@dataclass
class Top:
    """Stop weights and estimates of the empty context (256 partial bytes) and of one-byte contexts (256 x 256)."""

    stop: list[np.ndarray]
    one: list[np.ndarray]


def _subtree_roots(depth: int):
    """Mixed log probability and counts of the nodes at level TOP, for runs in the same group."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        runs, n = rows["run"].to_numpy().view(np.uint64), rows["n"].to_numpy()
        order = np.argsort(runs)
        runs, n = runs[order], n[order]
        out = []
        for bit in range(8):
            root = tree_levels(runs, n, depth, bit, min(TOP, depth))[0]
            keys = np.zeros(len(root.weighted), np.uint64)
            keys[root.of_run] = _node_keys(runs, depth, min(TOP, depth), bit)
            ones = np.bincount(root.of_run, n * ((runs >> np.uint64(7 - bit)) & np.uint64(1)), len(keys))
            total = np.bincount(root.of_run, n, len(keys))
            out.append(pd.DataFrame({"node": keys.view(np.int64), "weighted": root.weighted, "zeros": total - ones, "ones": ones}))
        return pd.concat(out)

    return run


def top_of(groups: DataFrame, depth: int) -> Top:
    """The two top levels: at most 256 x 256 rows reach the driver."""
    nodes = groups.groupBy("stem").applyInPandas(_subtree_roots(depth), "node long, weighted double, zeros double, ones double")
    previous = F.shiftright("node", 16)
    sums = nodes.groupBy(previous.alias("previous"), F.col("node").bitwiseAND(F.lit(255)).alias("partial")).agg(
        F.sum("weighted").alias("split"), F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"),
    ).toPandas()
    zeros, ones, split = (np.zeros((256, 256)) for _ in range(3))
    for into, name in ((zeros, "zeros"), (ones, "ones"), (split, "split")):
        into[sums["previous"].to_numpy(np.int64), sums["partial"].to_numpy(np.int64)] = sums[name]
    weighted, stop = mixed(log_kt(zeros, ones), split)
    weighted = np.where(zeros + ones > 0, weighted, 0.0)
    _, stop_all = mixed(log_kt(zeros.sum(0), ones.sum(0)), weighted.sum(0))
    return Top([stop_all, stop], [(ones.sum(0) + 0.5) / (zeros.sum(0) + ones.sum(0) + 1), (ones + 0.5) / (zeros + ones + 1)])


def run_probabilities(runs: np.ndarray, n: np.ndarray, depth: int, top: Top) -> list[np.ndarray]:
    """Probability of every run's last byte when its context is cut to TOP..depth bytes."""
    out = [np.ones(len(runs)) for _ in range(depth - TOP + 1)]
    last, previous = (runs & np.uint64(255)).astype(np.int64), (runs >> np.uint64(8 * depth)).astype(np.int64)
    for bit in range(8):
        partial = (1 << bit) | (last >> (8 - bit))
        is_one = (last >> (7 - bit) & 1).astype(bool)
        levels = tree_levels(runs, n, depth, bit, TOP)
        above = [
            (top.stop[0][partial], top.one[0][partial]), (top.stop[1][previous, partial], top.one[1][previous, partial]),
        ]
        for k, p in enumerate(predicted(levels, is_one)):
            for stop, one in reversed(above):
                p = stop * np.where(is_one, one, 1 - one) + (1 - stop) * p
            out[k] *= p
    return out


def _group_tables(depth: int, top):
    """Log10 probabilities of seen runs at every context length from TOP, and the rest mass of every context.

    Rows: length, key, value. ``key`` is the context and the byte; for the rest mass, the
    context alone with ``length`` negated.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        runs, n = rows["run"].to_numpy().view(np.uint64), rows["n"].to_numpy()
        order = np.argsort(runs)
        runs, n = runs[order], n[order]
        chances = run_probabilities(runs, n, depth, top.value)
        lower_keys = lower = None
        out = []
        for length, p in zip(range(TOP, depth + 1), chances, strict=True):
            keys = (runs >> np.uint64(8 * (depth + 1 - length))) << np.uint64(8) | (runs & np.uint64(255))
            keys, first = np.unique(keys, return_index=True)
            p = p[first]
            out.append(_rows(length, keys, np.log10(p)))
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            left = np.maximum(1 - np.bincount(of, p), 1e-12)
            if lower is None:
                # Below TOP the table of one-byte contexts is dense: see dense_rows().
                shorter = one_byte_chances(top.value)[(keys >> np.uint64(16)).astype(np.int64), (keys & np.uint64(255)).astype(np.int64)]
            else:
                drop = (keys >> np.uint64(16)) << np.uint64(8) | (keys & np.uint64(255))
                shorter = lower[np.searchsorted(lower_keys, drop)]
            rest = np.maximum(1 - np.bincount(of, shorter), 1e-12)
            out.append(_rows(-length, contexts, np.log10(left / rest)))
            lower_keys, lower = keys, p
        return pd.concat(out)

    return run


def _rows(length: int, keys: np.ndarray, values: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"length": np.full(len(keys), length, np.int32), "key": keys.view(np.int64), "value": values})


def one_byte_chances(top: Top) -> np.ndarray:
    """(previous byte, byte): probability with contexts of at most one byte; every row sums to 1."""
    byte, out = np.arange(256), np.ones((256, 256))
    for bit in range(8):
        partial, is_one = (1 << bit) | (byte >> (8 - bit)), (byte >> (7 - bit) & 1).astype(bool)
        p = np.where(is_one, top.one[1][:, partial], 1 - top.one[1][:, partial])
        stop, one = top.stop[0][partial], top.one[0][partial]
        out *= stop * np.where(is_one, one, 1 - one) + (1 - stop) * p
    return out


# Scoring


class HashTable:
    """Open addressing from 64-bit keys to floats, looked up in bulk."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 1.4).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.values = np.zeros(1 << self.bits, np.float32)
        todo, at = np.arange(len(keys)), self._place(keys)
        while len(todo):
            free = self.keys[at] == np.uint64(0xFFFFFFFFFFFFFFFF)
            self.keys[at[free]] = keys[todo[free]]
            # Of several that wanted one place, the last has it.
            done = self.keys[at] == keys[todo]
            self.values[at[done]] = values[todo[done]]
            todo, at = todo[~done], (at[~done] + 1) & ((1 << self.bits) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and which keys are there."""
        at = self._place(keys)
        there = self.keys[at] == keys
        out = self.values[at]
        todo = np.flatnonzero(~there)
        at = at[todo]
        while len(todo):
            more = self.keys[at] != np.uint64(0xFFFFFFFFFFFFFFFF)
            todo, at = todo[more], (at[more] + 1) & ((1 << self.bits) - 1)
            hit = self.keys[at] == keys[todo]
            there[todo[hit]] = True
            out[todo[hit]] = self.values[at[hit]]
            todo, at = todo[~hit], at[~hit]
        out[~there] = 0
        return out, there


class Model:
    """Log10 probabilities of bytes after their contexts."""

    def __init__(self, depth: int, tables: dict[int, tuple[np.ndarray, np.ndarray]], one_byte: np.ndarray):
        self.depth = depth
        self.tables = {length: HashTable(*t) for length, t in tables.items()}
        self.one_byte = np.log10(one_byte).ravel()

    def logs(self, runs: np.ndarray) -> np.ndarray:
        """For every packed run the log10 probability of its byte."""
        out = np.zeros(len(runs))
        todo, keys = np.arange(len(runs)), runs
        for length in range(self.depth, TOP - 1, -1):
            values, there = self.tables[length].get(keys)
            out[todo[there]] += values[there]
            todo, keys = todo[~there], keys[~there]
            # An unseen byte shares the rest of a seen context; an unseen context says nothing.
            out[todo] += self.tables[-length].get(keys >> np.uint64(8))[0]
            keys = (keys >> np.uint64(16)) << np.uint64(8) | (keys & np.uint64(255))
        out[todo] += self.one_byte[keys.astype(np.int64)]
        return out


def group_of(depth: int, groups: int) -> Column:
    """Runs whose contexts end alike meet in one group; a group holds several such stems."""
    return F.pmod(F.xxhash64(F.shiftrightunsigned("run", 8 * (depth + 1 - TOP))), F.lit(groups))


def _common_values(depth: int, top, least: int):
    """(run, value): log10 probabilities of a group's runs that occur at least ``least`` times."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        if not (rows["n"] >= least).any():
            return pd.DataFrame({"run": np.empty(0, np.int64), "value": np.empty(0)})
        runs, n = rows["run"].to_numpy().view(np.uint64), rows["n"].to_numpy()
        order = np.argsort(runs)
        runs, n = runs[order], n[order]
        value = np.log10(run_probabilities(runs, n, depth, top.value)[-1])
        return pd.DataFrame({"run": runs[n >= least].view(np.int64), "value": value[n >= least]})

    return run


def _wanted_values(depth: int, top):
    """(run, value): log10 probabilities of the wanted runs, seen or not, by the runs seen in their group."""
    tables_of = _group_tables(depth, top)

    def run(seen: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        runs = wanted["run"].to_numpy(np.int64)
        if not len(runs):
            return pd.DataFrame({"run": runs, "value": np.empty(0)})
        rows = tables_of(seen) if len(seen) else _rows(0, np.empty(0, np.uint64), np.empty(0))
        model = Model(depth, tables_by_length(depth, *(rows[c].to_numpy() for c in ("length", "key", "value"))), one_byte_chances(top.value))
        return pd.DataFrame({"run": runs, "value": model.logs(runs.view(np.uint64))})

    return run


def tables_by_length(depth: int, length: np.ndarray, keys: np.ndarray, values: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    keys, values = keys.view(np.uint64), values.astype(np.float32)
    return {k: (keys[length == k], values[length == k]) for k in (*range(TOP, depth + 1), *range(-depth, -TOP + 1))}


def train(counts: DataFrame, depth: int, max_runs: int) -> Model:
    """The model of the stored counts (run, n) for one process; at most about 1.5 ``max_runs`` table rows reach the driver.

    It drops context bytes until it fits; score() does not use it.
    """
    while depth > TOP and counts.count() > max_runs:
        # Drop the oldest byte of the context.
        shorter = F.shiftleft(F.shiftrightunsigned("run", 16), 8).bitwiseOR(F.col("run").bitwiseAND(F.lit(255)))
        counts = store(counts.groupBy(shorter.alias("run")).agg(F.sum("n").alias("n")), "byte-runs")
        depth -= 1
    group = group_of(depth, max(1, max_runs // GROUP_RUNS))
    groups = store(counts.select(group.alias("stem"), "run", "n"), "context-groups")
    top = top_of(groups, depth)
    sent = counts.sparkSession.sparkContext.broadcast(top)
    made = groups.groupBy("stem").applyInPandas(_group_tables(depth, sent), "length int, key long, value double")
    rows = store(made, "context-tables").toArrow()
    length = rows.column("length").to_numpy()
    tables = tables_by_length(depth, length, rows.column("key").to_numpy(), rows.column("value").to_numpy())
    return Model(depth, tables, one_byte_chances(top))


def grouped_runs(counts: DataFrame, depth: int) -> tuple[DataFrame, Column, object]:
    """The counts (stem, run, n) by group, about GROUP_RUNS runs in each; a run's group; the broadcast top levels."""
    group = group_of(depth, max(1, counts.count() // GROUP_RUNS))
    groups = store(counts.select(group.alias("stem"), "run", "n"), "context-groups")
    return groups, group, counts.sparkSession.sparkContext.broadcast(top_of(groups, depth))


SCORED = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("n_known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("rest", T.ArrayType(T.StructType([
        T.StructField("word", T.BinaryType()), T.StructField("times", T.LongType()),
    ]))), T.StructField("rest_runs", T.ArrayType(T.StructType([
        T.StructField("run", T.LongType()), T.StructField("times", T.LongType()),
    ]))),
])

_REST = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))


def _counted_by_text(runs: np.ndarray, owner: np.ndarray, texts: int) -> pa.Array:
    """For every text the list of its different runs and how often each occurs."""
    order = np.lexsort((runs, owner))
    runs, owner = runs[order], owner[order]
    new = (runs[1:] != runs[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(np.concatenate(([True], new))) if len(runs) else np.empty(0, np.int64)
    times = np.diff(np.append(heads, len(runs)))
    offsets = np.searchsorted(owner[heads], np.arange(texts + 1)).astype(np.int32)
    items = pa.StructArray.from_arrays([pa.array(runs[heads].view(np.int64)), pa.array(times.astype(np.int64))], ["run", "times"])
    return pa.ListArray.from_arrays(pa.array(offsets), items)


def _scoring(sent, depth: int, names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common_runs, common = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                texts = [tokens_of(t) for t in raw_texts(batch.column("body"))]
                runs, starts = packed_runs(texts, depth)
                sizes = np.diff(np.append(starts, len(runs)))
                values, there = common_runs.get(runs)
                score = np.add.reduceat(values.astype(np.float64), starts)
                left = np.flatnonzero(~there)
                rest_runs = _counted_by_text(runs[left], np.searchsorted(starts, left, "right") - 1, len(texts))
                known, base, rest = [], [], []
                for t in texts:
                    values = list(map(common.get, t))
                    values.append(common.get(END_TOKEN))
                    seen = [v for v in values if v is not None]
                    known.append(len(seen))
                    base.append(math.fsum(seen))
                    left = Counter(w for w, v in zip([*t, END_TOKEN], values, strict=True) if v is None)
                    rest.append([{"word": w, "times": k} for w, k in left.items()])
                yield pa.RecordBatch.from_arrays([
                    batch.column("kept"), pa.array([len(t) + 1 for t in texts], pa.int64()), pa.array(sizes), pa.array(score),
                    pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(rest, _REST), rest_runs,
                ], names=names)

    return run


def common_words(words: DataFrame, most: int) -> int:
    """Smallest count from which at most ``most`` words remain; decided from the counts' frequencies."""
    steps = sorted(((r.n, r.words) for r in words.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    taken, least = 0, (steps[0][0] + 1 if steps else 1)
    for n, k in steps:
        if taken + k > most:
            break
        taken, least = taken + k, n
    return least


def score(
    documents: DataFrame,
    learn_from: Column,
    carry: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    depth: int = DEPTH,
    max_runs: int = 4_000_000,
    common: int = 250_000,
) -> DataFrame:
    """Scores of all rows by a model learnt from the rows where ``learn_from`` holds.

    Adds n_tokens (words and one end), n_bytes, score (log10 probability of the text),
    bits_per_byte, and the word baseline: n_known, train_tokens, base_score with 0.1
    added to every count. Words are looked up in a broadcast of the ``common`` most
    frequent ones, runs in one of the ``max_runs`` most frequent ones; the rest are joined
    with the stored counts and values, so neither bound changes a score. NULL counts as empty,
    whose only token is the end; repeated rows each give a row; with nothing to
    learn from all counts are zero; an empty table gives no rows. Other columns
    are not read.
    """
    spark = documents.sparkSession
    training = documents.where(learn_from).select(F.col(text_col).alias("body"))
    counts = store(corpus_counts(training, depth), "corpus-counts")
    words = counts.where("word is not null").select("word", "n")
    totals = words.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct")).first()
    total, distinct = totals.total or 0, totals.distinct
    under = math.log10(total + 0.1 * (distinct + 1))
    least = common_words(words, common)
    head = words.where(F.col("n") >= least).toArrow()
    logs = np.log10(head.column("n").to_numpy() + 0.1) - under
    table = dict(zip(head.column("word").to_pylist(), logs.tolist(), strict=True))
    groups, group, top = grouped_runs(counts.where("run is not null").select("run", "n"), depth)
    often = common_words(groups, max_runs)
    seen = groups.groupBy("stem").applyInPandas(_common_values(depth, top, often), "run long, value double")
    seen = store(seen, "common-runs").toArrow()
    shortcut = HashTable(seen.column("run").to_numpy().view(np.uint64), seen.column("value").to_numpy())
    sent = spark.sparkContext.broadcast((shortcut, table))
    picked = documents.select(F.struct(*carry).alias("kept"), F.col(text_col).alias("body"))
    schema = T.StructType([picked.schema["kept"], *SCORED])
    made = picked.mapInArrow(_scoring(sent, depth, schema.names), schema)
    rows = store(made.withColumn("place", F.monotonically_increasing_id()), "scored")
    tail = rows.select("place", F.explode("rest").alias("r")).select("place", "r.*")
    rare = words.where(F.col("n") < least)
    value = F.log10(F.coalesce("n", F.lit(0)) + 0.1) - F.lit(under)
    summed = tail.join(rare, "word", "left").groupBy("place").agg(
        F.sum(F.col("times") * value).alias("more"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
    )
    tail_runs = rows.select("place", F.explode("rest_runs").alias("r")).select("place", "r.*")
    wanted = tail_runs.select("run").distinct().select(group.alias("stem"), "run")
    valued = groups.groupBy("stem").cogroup(wanted.groupBy("stem")).applyInPandas(_wanted_values(depth, top), "run long, value double")
    summed_runs = tail_runs.join(valued, "run").groupBy("place").agg(F.sum(F.col("times") * F.col("value")).alias("more_score"))
    zero = F.lit(0)
    rows = rows.join(summed_runs, "place", "left").withColumn("score", F.col("score") + F.coalesce("more_score", F.lit(0.0)))
    return rows.join(summed, "place", "left").select(
        "kept.*", "n_tokens", "n_bytes", (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score",
        (F.col("score") * F.lit(-math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
