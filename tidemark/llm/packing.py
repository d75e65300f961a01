"""Best-fit packing: locally, then of all leftovers by their lengths.

Every task packs the pieces of its own documents by best fit (longest first). Bins that
are nearly full are final. All pieces in underfull bins are packed again together, however
many they are: best fit over the counts of their lengths, of which there are at most
``capacity``, gives segments (length, ranks, bins, offset), and a piece finds its segment
by its length and its rank among the leftover pieces of that length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.texts import raw_texts, word_ids
from tidemark.sources.scratch import store

LEAF_PIECES = 100_000
_LEAF_BITS, _BIN_BITS, _RANK_BITS = 36, 24, 40
#: Bins of the pieces that are packed again are numbered from here, above those of any partition.
_AGAIN = 1 << 61


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class BestFit:
    """Open bins by residual; a bit mask of residuals finds the tightest fit at once."""

    def __init__(self, capacity: int):
        self.capacity, self.open, self.mask = capacity, {}, 0

    def put(self, bin_id: int, residual: int) -> None:
        if residual:
            self.open.setdefault(residual, []).append(bin_id)
            self.mask |= 1 << residual

    def take(self, length: int) -> tuple[int, int] | None:
        """The fullest bin with room for ``length``, and its residual."""
        above = self.mask >> length
        if not above:
            return None
        residual = length + (above & -above).bit_length() - 1
        bins = self.open[residual]
        found = bins.pop()
        if not bins:
            del self.open[residual]
            self.mask &= ~(1 << residual)
        return found, residual


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, and the fill of every bin; longest items first."""
    bins, offsets, fill = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    space = BestFit(capacity)
    for k in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[k])
        where, residual = space.take(length) or (len(fill), capacity)
        if where == len(fill):
            fill.append(0)
        bins[k], offsets[k] = where, capacity - residual
        fill[where] += length
        space.put(where, residual - length)
    return bins, offsets, np.array(fill, np.int64)


def climbing(bins: np.ndarray, fill: np.ndarray, capacity: int, slack: int, climb: int) -> np.ndarray:
    """Which items are packed again: those of the emptiest bins that are not nearly full, at most ``climb``."""
    under = np.flatnonzero(fill < capacity - slack)
    under = under[np.argsort(fill[under], kind="stable")]
    chosen = under[np.cumsum(np.bincount(bins, minlength=len(fill))[under]) <= climb]
    return np.isin(bins, chosen)


PIECES = T.StructType([
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("bin", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("fill", T.LongType()), T.StructField("climbs", T.BooleanType()), T.StructField("nth", T.LongType()),
])


def pieces_of(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's packed ids."""
    step = 4 * capacity
    for k, at in enumerate(range(0, len(ids), step)):
        part = ids[at:at + step]
        yield k, at // 4, len(part) // 4, zlib.crc32(part)


def packed_pieces(
    documents: DataFrame, carry: Sequence[str], text_col: str, capacity: int, tokenizer: str, slack: int,
) -> DataFrame:
    """Tokenise, cut and pack locally; a leaf is at most about LEAF_PIECES pieces of a partition."""
    picked = documents.select(F.struct(*carry).alias("kept"), F.col(text_col).alias("body"))
    schema = T.StructType([picked.schema["kept"], *PIECES])
    end = np.zeros(1, "<u4").tobytes()

    def leaf(kept: list[pa.Array], pieces: list[tuple], owners: list[int], number: int) -> pa.RecordBatch:
        piece, start, length, crc = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
        bins, offsets, fill = best_fit(length, capacity)
        climbs = climbing(bins, fill, capacity, slack, len(length))
        # Items that climb leave their bin and are one of their own.
        fill = np.where(climbs, length, fill[bins])
        bins = np.where(climbs, bins.max() + 1 + np.arange(len(bins)), bins)
        offsets = np.where(climbs, 0, offsets)
        part = TaskContext.get().partitionId()
        base = (part << _LEAF_BITS) + (number << _BIN_BITS)
        arrays = [pa.concat_arrays(kept).take(pa.array(owners)), pa.array(piece.astype(np.int32))]
        arrays += [pa.array(x) for x in (start, length, crc, bins + base, offsets, fill, climbs, nth_of_length(length, climbs))]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(tokenizer)
        kept, pieces, owners, rows, number = [], [], [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append(batch.column("kept"))
            for k, ids in enumerate(known.of_all(raw_texts(batch.column("body")))):
                cut = list(pieces_of(ids + end, capacity))
                pieces += cut
                owners += [rows + k] * len(cut)
            rows += batch.num_rows
            if len(pieces) >= LEAF_PIECES:
                yield leaf(kept, pieces, owners, number)
                kept, pieces, owners, rows, number = [], [], [], 0, number + 1
        if pieces:
            yield leaf(kept, pieces, owners, number)

    return picked.mapInArrow(run, schema).select("kept.*", *PIECES.names)


_ROUND = "bin long, fill long, climbs boolean, node int, host long, base long"


def merge_round(bins: DataFrame, capacity: int, slack: int, climb: int, last: bool) -> DataFrame:
    """One best-fit round per node over the bins that climbed to it; pack() has no rounds.

    Returns them with their ``host`` (the bin they ended in, or themselves) and place in it, and
    whether they climb on, unmerged. In the ``last`` round none does.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bin", ignore_index=True)
        own = rows["bin"].to_numpy()
        into, base, fill = best_fit(rows["fill"].to_numpy(), capacity)
        climbs = climbing(into, fill, capacity, slack, 0 if last else climb)
        opened = np.empty(len(fill), np.int64)
        opened[into[base == 0]] = own[base == 0]
        return pd.DataFrame({
            "bin": own, "fill": rows["fill"], "climbs": climbs, "node": rows["node"],
            "host": np.where(climbs, own, opened[into]), "base": np.where(climbs, 0, base),
        })

    return bins.groupBy("node").applyInPandas(run, _ROUND)


def nth_of_length(length: np.ndarray, climbs: np.ndarray) -> np.ndarray:
    """Number of every climbing item among the climbing ones of its length, from 0; 0 for the others."""
    nth, at = np.zeros(len(length), np.int64), np.flatnonzero(climbs)
    order = at[np.argsort(length[at], kind="stable")]
    _, heads, sizes = np.unique(length[order], return_index=True, return_counts=True)
    nth[order] = np.arange(len(order)) - np.repeat(heads, sizes)
    return nth


def best_fit_counts(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best fit, longest first, of ``counts[length]`` items of every length.

    Rows (length, first rank, first bin, offset): items from this rank on go to the
    bins from there on, one each, up to the length's next row. Bins that are alike are
    kept as intervals, so the work depends on the number of lengths, not of items.
    """
    space: dict[int, list[tuple[int, int]]] = {}
    mask, bins, rows = 0, 0, []

    def put(residual: int, first: int, k: int) -> None:
        nonlocal mask
        if residual and k:
            space.setdefault(residual, []).append((first, k))
            mask |= 1 << residual

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            above = mask >> length
            if above:
                residual = length + (above & -above).bit_length() - 1
                first, k = space[residual].pop()
                if not space[residual]:
                    del space[residual]
                    mask &= ~(1 << residual)
            else:
                residual = capacity
                first, k = bins, -(-left // (capacity // length))
                bins += k
            # A bin just used is the tightest as long as another item fits, so it takes ``each``; one may take fewer.
            each = residual // length
            whole = min(k, left // each)
            part = left - whole * each if whole < k else 0
            for into, n, items in ((first, whole, each), (first + whole, 1, part)):
                if n and items:
                    for j in range(items):
                        rows.append((length, rank, into, capacity - residual + j * length))
                        rank += n
                    left -= n * items
                    put(residual - items * length, into, n)
            taken = whole + (part > 0)
            put(residual, first + taken, k - taken)
    return np.array(rows, np.int64).reshape(-1, 4)


def packed_again(pieces: DataFrame, capacity: int) -> DataFrame:
    """The climbing pieces in bins of all tables' leftovers; at most ``capacity`` counts reach the driver."""
    climbing_pieces = pieces.where("climbs").withColumn("leaf", F.shiftright("bin", _BIN_BITS))
    before = Window.partitionBy("length").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    counts = climbing_pieces.groupBy("leaf", "length").agg(F.count(F.lit(1)).alias("n"))
    starts = store(counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))), "packing-counts")
    lengths = {r.length: r.n for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    sent = pieces.sparkSession.sparkContext.broadcast(best_fit_counts(lengths, capacity))
    ranked = climbing_pieces.join(starts.select("leaf", "length", "first"), ["leaf", "length"])
    ranked = ranked.select(*pieces.columns, (F.col("first") + F.col("nth")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sent.value
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        keys = rows[:, 0] << _RANK_BITS | rows[:, 1]
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, batch.column("length").to_numpy() << _RANK_BITS | rank, "right") - 1
            found = {"bin": _AGAIN + rows[at, 2] + rank - rows[at, 1], "offset": rows[at, 3]}
            arrays = [pa.array(found[c]) if c in found else batch.column(c) for c in pieces_names]
            yield pa.RecordBatch.from_arrays(arrays, names=pieces_names)

    pieces_names = pieces.columns
    return ranked.mapInArrow(run, pieces.schema)


def pack(
    documents: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    capacity: int = 2048,
    tokenizer: str | None = None,
    slack: int = 16,
) -> DataFrame:
    """One row per piece: the ``carry`` columns, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and a closing id 0; only longer ones than ``capacity``
    are cut. NULL text counts as empty and is one token; repeated rows are packed each;
    an empty table gives no rows. Other columns are not read. The first stage is
    stored, so a repeated task cannot renumber bins under its readers.
    """
    picked = documents.select(F.struct(*carry).alias("kept"), F.col(text_col).alias("body"))
    pieces = store(packed_pieces(picked, ("kept",), "body", capacity, tokenizer or default_tokenizer(), slack), "pieces")
    placed = pieces.where("not climbs").unionByName(packed_again(pieces, capacity))
    return placed.select(
        "kept.*", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset",
    )
