"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprint: every bit is the majority of that bit over the XXH64 values of all word
shingles. Copies collapse first, so the search sees distinct fingerprints only.

Search: two fingerprints that differ in at most k bits agree on one of k+1 parts of the
64 bits. Each fingerprint therefore goes once to every part's bucket (part, hash of its bits there). A
bucket is one task-sized index: fingerprints sorted by Gray rank, runs of neighbours
joined under nodes that hold the bits all members share, each node only those its
parent does not hold already. A search walks down, adds up the differences on shared
bits, and drops a whole node as soon as they exceed k. Values that too many
fingerprints share are parted again on their remaining bits until they fit; as
fingerprints are distinct, that ends.

Buckets return a spanning forest of their links instead of all pairs. Links join to
components by alternating large-star and small-star rounds, each stored in the shared
folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.texts import raw_texts, word_edges
from tidemark.sources.scratch import store

FAN = 16
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


# Fingerprints


def shingle_hashes(text: bytes | None, shingle: int) -> np.ndarray:
    import xxhash

    joined = b" ".join((text or b"").lower().split())  # bytes: A-Z and ASCII white space only
    if not joined:
        return np.empty(0, np.uint64)
    starts, ends = word_edges(joined)
    if len(starts) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    of = xxhash.xxh64_intdigest
    pairs = zip(starts[:len(starts) - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)
    return np.array([of(joined[a:b], 42) for a, b in pairs], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes, as an unsigned number; 0 without hashes."""
    if not len(hashes):
        return 0
    votes = np.zeros(64, np.int64)
    for part in np.split(hashes, range(65_536, len(hashes), 65_536)):
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame, carry: Sequence[str], text_col: str, shingle: int) -> DataFrame:
    """The ``carry`` columns and ``fp``, the fingerprint as a signed long."""
    picked = documents.select(F.struct(*carry).alias("kept"), F.col(text_col).alias("body"))
    schema = T.StructType([picked.schema["kept"], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([majority(shingle_hashes(t, shingle)) for t in raw_texts(batch.column("body"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(fps.view(np.int64))], names=["kept", "fp"])

    return picked.mapInArrow(run, schema).select("kept.*", "fp")


# The index


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of a bit pattern in the Gray sequence, where neighbours differ in one bit."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


class GrayIndex:
    """Levels of nodes over distinct fingerprints; the last level are the fingerprints."""

    def __init__(self, fps: np.ndarray, turn: int):
        turned = (fps << np.uint64(turn)) | (fps >> np.uint64(64 - turn)) if turn else fps
        self.fps = fps[np.argsort(gray_rank(turned), kind="stable")]
        shared, bits = [np.full(len(fps), ALL)], [self.fps]
        while len(bits[0]) > FAN:
            heads = np.arange(0, len(bits[0]), FAN)
            ones = np.bitwise_and.reduceat(bits[0] | ~shared[0], heads)
            zeros = np.bitwise_or.reduceat(bits[0] & shared[0], heads)
            common = np.bitwise_and.reduceat(shared[0], heads) & ~(ones ^ zeros)
            shared.insert(0, common)
            bits.insert(0, zeros & common)
        self.bits = bits
        # A node keeps only the shared bits that its parent has not compared yet.
        self.own = [shared[0]] + [
            low & ~np.repeat(up, FAN)[:len(low)] for up, low in zip(shared, shared[1:], strict=False)
        ]

    def search(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, fingerprint number) of all pairs within ``most`` bits."""
        q = np.repeat(np.arange(len(queries)), len(self.bits[0]))
        node = np.tile(np.arange(len(self.bits[0])), len(queries))
        seen = np.zeros(len(q), np.uint8)
        for level, (bits, own) in enumerate(zip(self.bits, self.own, strict=True)):
            if level:
                q, seen = np.repeat(q, FAN), np.repeat(seen, FAN)
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                there = node < len(bits)
                q, seen, node = q[there], seen[there], node[there]
            seen = seen + np.bitwise_count((queries[q] ^ bits[node]) & own[node])
            near = seen <= most
            q, node, seen = q[near], node[near], seen[near]
        return q, node


def joined_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union the links (a, b) into labels that point at the smallest member."""
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (deeper := label[label]).tobytes() != label.tobytes():
            label = deeper
        if (before == label).all():
            return label


def forest(fps: np.ndarray, turn: int, most: int, at_once: int = 4_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what pairs within ``most`` bits connect: (member, its root)."""
    index = GrayIndex(fps, turn)
    label = np.arange(len(fps))
    step = max(1, at_once // max(1, len(fps)))
    for start in range(0, len(fps), step):
        q, found = index.search(index.fps[start:start + step], most)
        q = q + start
        new = (found > q) & (label[found] != label[q])
        if new.any():
            label = joined_labels(label, q[new], found[new])
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return index.fps[moved], index.fps[label[moved]]


# Buckets


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def parts_of(free: int, parts: int) -> list[int]:
    """The set bits of ``free`` in ``parts`` runs of about equal size, as masks."""
    places = [i for i in range(63, -1, -1) if free >> i & 1]
    cuts = [round(len(places) * k / parts) for k in range(parts + 1)]
    return [sum(1 << p for p in places[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def links(distinct: DataFrame, most: int, bucket: int = 2_048, fits: int = 20_000) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints in column ``fp``.

    ``bucket`` is the aimed size of an index; values held by more than ``fits``
    fingerprints are parted again on their other bits.
    """
    total = distinct.count()
    out: DataFrame | None = None
    rows = distinct.select("fp", F.lit(0).cast("long").alias("mask"))
    masks = [0]
    while True:
        finer = {m: parts_of(~m & (1 << 64) - 1, most + 1) for m in masks}
        choices: Column | None = None
        for m, subs in finer.items():
            options = F.array(*[
                F.struct(F.lit(_signed(m | s)).alias("mask"), F.lit((63 - s.bit_length() + 1) % 64).alias("turn"))
                for s in subs
            ])
            here = F.col("mask") == F.lit(_signed(m))
            choices = F.when(here, options) if choices is None else choices.when(here, options)
        rows = rows.select("fp", F.explode(choices).alias("c")).select("fp", "c.*")
        rows = rows.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        counts = rows.groupBy("mask", "value").count().where(F.col("count") > fits).select("mask", "value")
        hot = store(counts, "simhash-hot")
        any_hot = not hot.isEmpty()
        cool = rows.join(hot, ["mask", "value"], "left_anti") if any_hot else rows
        n = max(1, -(-total // bucket))
        dealt = cool.withColumn("bucket", F.pmod(F.xxhash64("mask", "value"), F.lit(n)))
        found = dealt.groupBy("mask", "bucket").applyInPandas(_bucket_links(most), "a long, b long")
        out = found if out is None else out.unionByName(found)
        if not any_hot:
            return out.distinct()
        # A fingerprint that arrives by two parts with the same bits is parted once.
        rows = store(rows.join(hot, ["mask", "value"], "left_semi").select("fp", "mask").distinct(), "simhash-rest")
        masks = sorted({m | s for m, subs in finer.items() for s in subs})
        masks = [m for m in masks if m != (1 << 64) - 1]


def _bucket_links(most: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        fps = np.unique(rows["fp"].to_numpy().view(np.uint64))
        a, b = forest(fps, int(rows["turn"].iloc[0]), most)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return run


# Components


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the links (a, b) with the smallest node it reaches."""
    edges = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        # Large star: neighbours above a node move to the smallest of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of those.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = store(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        # Finished with a star forest: every node has one root, and no root has another.
        roots = small.select(F.col("b").alias("a"))
        several = small.groupBy("a").count().where("count > 1")
        if small.join(roots, "a", "left_semi").isEmpty() and several.isEmpty():
            return small.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = small


def near_duplicates(
    documents: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    most: int = 4,
) -> DataFrame:
    """The ``carry`` columns, ``fp`` and ``component_id``, the smallest id reachable over links.

    NULL, empty and white-space texts have fingerprint zero and link like any other;
    texts of fewer than ``shingle`` words are one shingle. Repeated rows and ids each
    give a row; NULL ids never become a component's id unless it has no other. An
    empty table gives an empty result. Other columns are not read.
    """
    source = documents.select(F.struct(*carry).alias("kept"), F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    rows = store(fingerprints(source, ("kept", "id"), "body", shingle), "fingerprints")
    labels = component_labels(rows, most)
    return rows.join(labels, "fp").select("kept.*", "fp", F.col("first.id").alias("component_id"))


def component_labels(rows: DataFrame, most: int, tie: str | None = None) -> DataFrame:
    """(fp, first): of every fingerprint in ``rows`` (id, fp, tie) the smallest id, then tie, of its component."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", *([tie] if tie else [])))
    distinct = store(rows.groupBy("fp").agg(first.alias("first")), "distinct-fingerprints")
    stars = components(links(distinct.select("fp"), most))
    rooted = distinct.join(stars, distinct["fp"] == stars["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"),
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return rooted.join(firsts, "root").select("fp", firsts["first"])


def first_of_each_group(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, most: int = 4,
) -> DataFrame:
    """The rows of ``documents``, one for each group of near duplicates: that with the smallest id.

    Of rows that repeat this id one stays. All columns are returned as they are.
    """
    source = documents.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    made = fingerprints(source, ("row", "id"), "body", shingle)
    rows = store(made.withColumn("place", F.monotonically_increasing_id()), "fingerprints")
    labels = component_labels(rows.select("id", "fp", "place"), most, "place")
    stay = labels.select(F.col("first.place").alias("place")).distinct()
    return rows.join(stay, "place", "left_semi").select("row.*")
