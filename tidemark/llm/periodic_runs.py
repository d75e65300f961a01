"""Periodic runs of words: a suffix automaton whose link tree keeps last occurrences by link-cut access.

For each word in turn, the path from the state of the text so far to the root of
the link tree holds all its suffixes, the longest first. The path falls into segments whose
suffixes last ended at the same place ``e``; appending word ``i`` recolours the path
to ``i``. If the longest suffix of a segment has ``length`` words, those words end
both at ``e`` and at ``i``: with the distance ``d = i - e`` <= ``length`` this is a
square, and the stretch of ``length + d`` words up to ``i`` has period ``d``. No
shorter period fits, else the suffix would have ended later than ``e``; no word in front
fits, else the suffix would be longer. The same start and period are met again for
every word the stretch extends by, so the last meeting gives the whole run.

Segments are the preferred paths of a link-cut tree, one splay tree each, so a long path
of one colour costs few steps. The tree is complete before the first access; neither
link nor cut is needed after that.

Before that, a sieve without loss: in a run of exponent k every word occurs at least
k times, hence a word that is rarer splits the text into parts that no run crosses, and
what is rare within such a part splits it again. Most texts vanish here.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.texts import raw_texts

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType()),
])
_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in RUN.names]))


class LinkTree:
    """Suffix automaton of a word sequence: longest lengths, suffix links and the state of every prefix."""

    def __init__(self, words: Sequence[int]):
        length, link, moves = [0], [-1], [{}]
        self.prefixes = []
        last = 0
        for word in words:
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            moves.append({})
            state = last
            while state >= 0 and word not in moves[state]:
                moves[state][word] = new
                state = link[state]
            if state >= 0:
                target = moves[state][word]
                if length[target] == length[state] + 1:
                    link[new] = target
                else:
                    clone = len(length)
                    length.append(length[state] + 1)
                    link.append(link[target])
                    moves.append(moves[target].copy())
                    while state >= 0 and moves[state].get(word) == target:
                        moves[state][word] = clone
                        state = link[state]
                    link[target] = link[new] = clone
            last = new
            self.prefixes.append(new)
        self.length, self.link = length, link


class LastOccurrences:
    """Link-cut tree over a link tree. Every preferred path is a splay tree ordered by depth; its root holds the path's colour."""

    def __init__(self, tree: LinkTree):
        n = len(tree.length)
        self.length = tree.length
        #: Parent in the splay tree, or, for a root, the link-tree parent of the path's top.
        self.up = list(tree.link)
        self.left, self.right, self.colour = [-1] * n, [-1] * n, [-1] * n

    def _splay(self, x: int) -> None:
        """Make ``x`` the root of its path; the colour moves there."""
        up, left, right = self.up, self.left, self.right
        top = x
        while (p := up[top]) >= 0 and (left[p] == top or right[p] == top):
            top = p
        self.colour[x] = self.colour[top]
        while top != x:
            p = up[x]
            if p == top:
                self._rotate(x, p)
                return
            g = up[p]
            self._rotate(*((p, g) if (left[p] == x) == (left[g] == p) else (x, p)))
            self._rotate(x, up[x])
            if g == top:
                return

    def _rotate(self, x: int, p: int) -> None:
        up, left, right = self.up, self.left, self.right
        g = up[p]
        if left[p] == x:
            inner = right[x]
            left[p], right[x] = inner, p
        else:
            inner = left[x]
            right[p], left[x] = inner, p
        if inner >= 0:
            up[inner] = p
        up[p], up[x] = x, g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def access(self, state: int, end: int) -> list[tuple[int, int]]:
        """Recolour the path from ``state`` to the root to ``end``; its former segments as (last end, longest length), deepest first."""
        up, right, colour = self.up, self.right, self.colour
        segments, x, below = [], state, -1
        while x >= 0:
            self._splay(x)
            segments.append((colour[x], self.length[x]))
            cut = right[x]
            if cut >= 0:
                colour[cut] = colour[x]
            right[x] = below
            below, x = x, up[x]
        colour[below] = end
        return segments


def runs_of(words: Sequence[int], min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """All maximal runs of a sequence as (start, length, smallest period), sorted."""
    tree = LinkTree(words)
    occurrences = LastOccurrences(tree)
    ends: dict[tuple[int, int], int] = {}
    repeats = min_exponent - 1
    for i, state in enumerate(tree.prefixes):
        for end, length in occurrences.access(state, i):
            period = i - end
            if end >= 0 and length >= repeats * period:
                ends[i - period - length + 1, period] = i
    return sorted((s, e - s + 1, p) for (s, p), e in ends.items() if e - s + 1 >= min_length)


def repetitive_parts(words: np.ndarray, text_of: np.ndarray, min_length: int, min_exponent: int, rounds: int = 20) -> list[np.ndarray]:
    """Positions of the parts that may hold a run: stretches of one text in which every word occurs often enough.

    Stopping after ``rounds`` leaves parts larger, which costs time only.
    """
    at, part = np.arange(len(words)), text_of.astype(np.int64)
    size = int(words.max(initial=0)) + 1
    for _ in range(rounds):
        _, which, counts = np.unique(part * size + words[at], return_inverse=True, return_counts=True)
        frequent = counts[which] >= min_exponent
        at, before = at[frequent], part[frequent]
        part = np.cumsum(np.concatenate(([0], (np.diff(at) != 1) | (np.diff(before) != 0)))) if len(at) else at
        long_enough = np.bincount(part, minlength=1)[part] >= max(min_length, min_exponent)
        done = bool(frequent.all()) and bool(long_enough.all())
        at, part = at[long_enough], part[long_enough]
        if done or not len(at):
            break
    return np.split(at, np.flatnonzero(np.diff(part)) + 1) if len(at) else []


def _text_runs(texts: list[list[bytes]], min_length: int, min_exponent: int) -> list[list[tuple[int, int, int]]]:
    numbers: dict[bytes, int] = {}
    lengths = np.array([len(t) for t in texts], np.int64)
    flat = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, int(lengths.sum()))
    text_of, first = np.repeat(np.arange(len(texts)), lengths), np.cumsum(lengths) - lengths
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for positions in repetitive_parts(flat, text_of, min_length, min_exponent):
        text = int(text_of[positions[0]])
        offset = int(positions[0] - first[text])
        part = flat[positions].tolist()
        found[text] += [(offset + s, n, p) for s, n, p in runs_of(part, min_length, min_exponent)]
    return [sorted(runs) for runs in found]


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Drop every word that a run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[k] for k in np.flatnonzero(keep).tolist()]


def _slices(texts: list[bytes | None], rows: int = 500, size: int = 4_000_000) -> Iterator[list[bytes | None]]:
    """Neighbouring texts, so many that their word lists stay small; a longer text comes alone."""
    held, total = [], 0
    for text in texts:
        if held and (len(held) == rows or total + len(text or b"") > size):
            yield held
            held, total = [], 0
        held.append(text)
        total += len(text or b"")
    if held:
        yield held


def periodic_runs(
    documents: DataFrame, carry: Sequence[str] = ("doc_id",), text_col: str = "text", min_length: int = 6, min_exponent: int = 4,
) -> DataFrame:
    """The ``carry`` columns of every document with a struct ``found``: number of words, runs and the collapsed text.

    Words are stretches without ASCII white space. A run is a stretch of consecutive words with
    smallest period p and at least ``min_length`` and ``min_exponent`` * p words (an
    exponent of 2 or more) that no neighbouring word extends; runs come by start, then period. The
    collapsed text keeps the first period of every run and what no run holds, joined
    by one space. NULL and empty texts have no words, no runs and an empty collapsed text.
    Rows stand alone: repeated rows each give a row, nothing is shuffled. Memory
    follows the longest repetitive part of one text. Other columns are not read.
    """
    if min_exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    picked = documents.select(F.struct(*carry).alias("kept"), F.col(text_col).alias("body"))
    schema = T.StructType([picked.schema["kept"], T.StructField("found", FOUND)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _slices(raw_texts(batch.column("body"))):
                words = [(t or b"").split() for t in texts]
                runs = _text_runs(words, min_length, min_exponent)
                collapsed = [b" ".join(without_repeats(w, r)) for w, r in zip(words, runs, strict=True)]
                found = pa.StructArray.from_arrays([
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([[dict(zip(RUN.names, r, strict=True)) for r in rs] for rs in runs], _RUNS),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ], names=FOUND.names)
                yield pa.RecordBatch.from_arrays([batch.column("kept").slice(at, len(texts)), found], names=["kept", "found"])
                at += len(texts)

    return picked.mapInArrow(scan, schema).select("kept.*", "found")


def with_planted_runs(doc_id: Column, text: Column) -> Column:
    """The text, in which one id in ten has its tail replaced by repetitions of the tail's first words.

    With h the crc32 of the decimal id, g = floor(h/10) and n > 0 words: if h % 10 = 0,
    words from a = g % n on repeat the p = 1 + floor((n-a)/(3+g%8)) words at a. Other texts, and those
    without id, stay as they are.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    block = F.slice(words, a + 1, p)
    repeated = F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))
    planted = F.concat(F.slice(words, F.lit(1), a), F.slice(repeated, F.lit(1), n - a))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(planted, " ")).otherwise(text)
