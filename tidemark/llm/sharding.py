"""Shards of near equal bytes: minimax contiguous partition of ordered atomic groups.

Equal texts are one group and stay together. Groups are ordered by the 64-bit hash of
their text, so a shard is a range of hashes and a document finds its shard from its
own text: no group is joined back and no hot group meets in one task.

The smallest feasible capacity is found by binary search; a capacity is feasible when
cutting greedily, each shard as full as it may be, needs no more than the given number
of shards. The driver knows the order only as sums over hash ranges. Where a cut could
fall inside a range that holds several groups, that range is split by the next bits of
the hash and summed again, a bounded number of ranges a round, until every range that
matters is one group. Then the search is exact.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import store

#: Bits of the hash that one round of splitting looks at.
STEP_BITS = 10
_SIGN = 1 << 63


@dataclass(frozen=True)
class Range:
    """Groups whose order key starts with ``prefix`` (``bits`` long): their number, bytes and largest."""

    prefix: int
    bits: int
    groups: int
    size: int
    largest: int

    @property
    def first_key(self) -> int:
        return self.prefix << (64 - self.bits)


def group_key(text: Column) -> Column:
    """Order key of a text; NULL counts as empty. Different texts with one hash are one group."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus one; NULL has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def greedy(ranges: Sequence[Range], capacity: int, shards: int, whole: bool) -> list[int] | None:
    """Ranges at which the next shard starts, or None if ``shards`` do not suffice.

    With ``whole`` a range is never split, as if it were one group: what is feasible
    then is feasible. Otherwise a range may be split anywhere its groups allow: what is
    infeasible then is infeasible.
    """
    cuts, filled = [], 0
    for k, r in enumerate(ranges):
        if (r.size if whole else r.largest) > capacity:
            return None
        if filled + r.size <= capacity:
            filled += r.size
            continue
        if whole or r.groups == 1:
            cuts.append(k)
            filled = r.size
            continue
        left = filled + r.size
        while left > capacity:
            cuts.append(k)
            left -= capacity
        filled = left
    return cuts if len(cuts) < shards else None


def smallest_capacity(ranges: Sequence[Range], shards: int, whole: bool) -> int:
    low = max((r.size if whole else r.largest for r in ranges), default=0)
    high = max(low, sum(r.size for r in ranges))
    while low < high:
        middle = (low + high) // 2
        if greedy(ranges, middle, shards, whole) is None:
            low = middle + 1
        else:
            high = middle
    return low


def _sums(groups: DataFrame, parents: Sequence[Range]) -> list[Range]:
    """The parents' ranges split by the next STEP_BITS bits (the root when there are no parents)."""
    bits = min((parents[0].bits if parents else 0) + STEP_BITS, 64)
    unsigned = F.col("key").bitwiseXOR(F.lit(-_SIGN))  # order of signed keys as order of bit patterns
    here = groups.withColumn("prefix", F.shiftrightunsigned(unsigned, 64 - bits))
    if parents:
        step = bits - parents[0].bits
        here = here.where(F.shiftrightunsigned("prefix", step).isin([p.prefix for p in parents]))
    rows = here.groupBy("prefix").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("size").alias("size"), F.max("size").alias("largest"),
    ).collect()
    return [Range(r.prefix & 2 * _SIGN - 1, bits, r.groups, r["size"], r.largest) for r in rows]


def _ends(ranges: Sequence[Range]) -> list[int]:
    return [0, *accumulate(r.size for r in ranges)]


def _doubtful(ranges: Sequence[Range], shards: int) -> list[int]:
    """Ranges of several groups in which a greedy cut can fall for a capacity that may be the smallest."""
    low, high = smallest_capacity(ranges, shards, False), smallest_capacity(ranges, shards, True)
    if low == high:
        return []
    ends, doubtful, lowest = _ends(ranges), set(), 0
    for cut in range(1, shards):
        # Cut number ``cut`` lies between what the lower capacity reaches over known borders and the upper's full reach.
        lowest = ends[bisect_right(ends, lowest + low) - 1]
        first, last = bisect_right(ends, lowest) - 1, bisect_left(ends, cut * high)
        doubtful |= {k for k in range(first, min(last, len(ranges))) if ranges[k].groups > 1}
    return sorted(doubtful)


def level_cuts(ranges: Sequence[Range], capacity: int, shards: int) -> list[int]:
    """Ranges at which shards 1.. start: each as near to an equal share of the rest as the capacity allows."""
    ends, start, cuts = _ends(ranges), 0, []
    for left in range(shards, 1, -1):
        share = ends[start] + (ends[-1] - ends[start]) / left
        full = bisect_right(ends, ends[start] + capacity) - 1
        over = min(bisect_left(ends, share), full)
        choices = sorted({over, max(start, over - 1)}, key=lambda k: abs(ends[k] - share))
        # The fullest shard the capacity allows always leaves a feasible rest.
        start = next((k for k in choices if greedy(ranges[k:], capacity, left - 1, True) is not None), full)
        cuts.append(start)
    return [k for k in cuts if k < len(ranges)]


def cut_keys(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """First order keys (signed) of shards 1.. and the smallest capacity. ``groups``: key, size."""
    ranges = sorted(_sums(groups, []), key=lambda r: r.first_key)
    while doubtful := _doubtful(ranges, shards):
        # A round splits ranges of one depth; those of another wait for theirs.
        depth = min(ranges[k].bits for k in doubtful)
        parents = [ranges[k] for k in doubtful if ranges[k].bits == depth]
        kept = [r for r in ranges if r not in set(parents)]
        ranges = sorted([*kept, *_sums(groups, parents)], key=lambda r: r.first_key)
    capacity = smallest_capacity(ranges, shards, True)
    return [ranges[k].first_key - _SIGN for k in level_cuts(ranges, capacity, shards)], capacity


def shard(
    documents: DataFrame, shards: int = 8, carry: Sequence[str] = ("doc_id",), text_col: str = "text",
) -> DataFrame:
    """The ``carry`` columns with size, text_crc32, shard (from 0) and slot (gapless from 0 in each shard).

    Equal texts share a shard; NULL and empty text are one group of size 1 a row. With
    fewer groups than shards some shards stay empty, an empty table gives no rows, and
    repeated rows each get a slot. Other columns are not read.
    """
    text = F.col(text_col)
    rows = store(documents.select(
        F.struct(*carry).alias("kept"), group_key(text).alias("key"), text_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
    ), "shard-rows")
    groups = store(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    cuts, _ = cut_keys(groups, shards)
    number = sum(((F.col("key") >= F.lit(c)).cast("int") for c in cuts), F.lit(0))
    dealt = rows.withColumn("shard", number)
    # Slots: those of earlier partitions first, then the order within the partition.
    counts = dealt.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("part", "shard", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("part", "shard").orderBy("place")) - 1
    return dealt.withColumn("within", within).join(offsets, ["part", "shard"]).select(
        "kept.*", "size", "text_crc32", "shard", (F.col("before") + F.col("within")).alias("slot"),
    )
