"""Ranks, running sums and previous values over an order of any size.

A Spark window without PARTITION BY moves all rows to one task, and a window
partitioned by a hot key moves all rows of that key to one task. The scan here
does neither: rows are range partitioned on the complete order (which ends in a
unique column, so equal leading keys are split too), stored once, and each slice
is numbered on its own. Only per-slice totals, one row per slice, are combined
serially.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import share
from tidemark.operators.selection import countable, selected_quantiles
from tidemark.sources.scratch import store

Order = Sequence[tuple[str, bool]]  # (column, ascending); NULLs sort lowest
SLICE = "_slice"


def sort_columns(order: Order) -> list[Column]:
    return [F.col(c).asc_nulls_first() if up else F.col(c).desc_nulls_last() for c, up in order]


def ordered_scan(
    df: DataFrame,
    order: Order,
    group: Sequence[str] = (),
    sums: dict[str, str] | None = None,
    previous: dict[str, str] | None = None,
) -> DataFrame:
    """Add ``position`` (1..n), inclusive running ``sums`` and ``previous`` values.

    ``order`` must be unique within ``group``. ``sums`` maps new column to summed
    column, ``previous`` maps new column to the column whose preceding value is
    wanted (ascending order only). Without ``group`` the result also carries
    ``position_total`` and ``<sum>_total``.
    """
    sums = dict(sums or {})
    previous = dict(previous or {})
    group = list(group)
    if previous and not all(up for _, up in order):
        raise ValueError("previous values need an ascending order")
    ranged = df.repartitionByRange(*[F.col(g).asc_nulls_first() for g in group], *sort_columns(order))
    stored = store(ranged.withColumn(SLICE, F.spark_partition_id()), "ordered")
    counted = {"position": F.count(F.lit(1))} | {n: F.sum(c) for n, c in sums.items()}
    if group:
        offsets = _edge_offsets(stored, order, group, counted, previous)
        keys = [SLICE, *group]
        match = [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
        condition = match[0]
        for extra in match[1:]:
            condition = condition & extra
        based = stored.alias("r").join(F.broadcast(offsets).alias("o"), condition, "left")
    else:
        offsets = _slice_offsets(stored, order, counted, previous)
        based = stored.alias("r").join(F.broadcast(offsets).alias("o"), SLICE)
    within = Window.partitionBy(SLICE, *group).orderBy(*sort_columns(order))
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = based.select(
        *[F.col(f"r.{c}").alias(c) for c in stored.columns],
        *[F.col(f"o.{c}").alias(c) for c in offsets.columns if c not in (SLICE, *group)],
    )
    zero = F.lit(0)
    result = {"position": F.row_number().over(within).cast("long") + F.coalesce(F.col("_before_position"), zero)}
    for name, source in sums.items():
        local = F.sum(source).over(running)
        result[name] = F.coalesce(local, zero) + F.coalesce(F.col(f"_before_{name}"), zero)
    for name, source in previous.items():
        first_here = F.row_number().over(within) == 1
        result[name] = F.when(first_here, F.col(f"_last_{name}")).otherwise(F.lag(source).over(within))
    totals = [] if group else [f"{n}_total" for n in counted]
    return rows.withColumns(result).select(*df.columns, *result, *totals)


def _slice_offsets(
    stored: DataFrame, order: Order, counted: dict[str, Column], previous: dict[str, str]
) -> DataFrame:
    """One row per slice: what all earlier slices add up to."""
    latest = F.struct(*[c for c, _ in order])
    per_slice = stored.groupBy(SLICE).agg(
        *[c.alias(n) for n, c in counted.items()],
        *[F.max_by(c, latest).alias(f"tail_{n}") for n, c in previous.items()],
    )
    slices = Window.orderBy(SLICE)
    earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
    everything = slices.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return per_slice.select(
        SLICE,
        *[F.sum(n).over(earlier).alias(f"_before_{n}") for n in counted],
        *[F.lag(f"tail_{n}").over(slices).alias(f"_last_{n}") for n in previous],
        *[F.sum(n).over(everything).alias(f"{n}_total") for n in counted],
    )


def _edge_offsets(
    stored: DataFrame, order: Order, group: list[str], counted: dict[str, Column], previous: dict[str, str]
) -> DataFrame:
    """What earlier slices hold of a group that continues into a slice.

    Only the first and last group of a slice can continue across its edge, so
    this touches at most two groups per slice.
    """
    whole = F.struct(*group)
    edges = stored.groupBy(SLICE).agg(F.min(whole).alias("first"), F.max(whole).alias("last"))
    edge_groups = (
        edges.select(F.explode(F.array("first", "last")).alias("g"))
        .select(*[F.col(f"g.{c}").alias(c) for c in group])
        .distinct()
    )
    condition = None
    for c in group:
        same = F.col(f"s.{c}").eqNullSafe(F.col(f"e.{c}"))
        condition = same if condition is None else condition & same
    latest = F.struct(*[c for c, _ in order])
    per_edge = (
        stored.alias("s")
        .join(F.broadcast(edge_groups).alias("e"), condition, "left_semi")
        .groupBy(SLICE, *group)
        .agg(
            *[c.alias(n) for n, c in counted.items()],
            *[F.max_by(c, latest).alias(f"tail_{n}") for n, c in previous.items()],
        )
    )
    by_slice = Window.partitionBy(*group).orderBy(SLICE)
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    return per_edge.select(
        SLICE,
        *group,
        *[F.sum(n).over(earlier).alias(f"_before_{n}") for n in counted],
        *[F.lag(f"tail_{n}").over(by_slice).alias(f"_last_{n}") for n in previous],
    )


def value_ranks(df: DataFrame, key: str, bounded: bool = False) -> DataFrame:
    """One row per distinct ``key``: its ties, rank, percent rank and average-tie percentile.

    Ties collapse in the partial aggregation, so a value held by a third of all
    rows costs one row per task. ``bounded`` marks keys with a small fixed domain
    (days, scores) whose few distinct values fit one plain window.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("ties"))
    if bounded:
        upward = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        all_rows = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        scanned = counts.withColumns(
            {"through": F.sum("ties").over(upward), "through_total": F.sum("ties").over(all_rows)}
        )
    else:
        scanned = ordered_scan(counts, [(key, True)], sums={"through": "ties"})
    rank = F.col("through") - F.col("ties") + 1
    total = F.col("through_total")
    return scanned.select(
        key,
        "ties",
        rank.cast("long").alias("rank"),
        total.cast("long").alias("rows"),
        F.coalesce(share(rank - 1, total - 1), F.lit(0.0)).alias("percent_rank"),
        share(rank + (F.col("ties") - 1) / 2, total).alias("pct_rank"),
    )


def attach(df: DataFrame, ranks: DataFrame, key: str, bounded: bool = False, hot_share: int = 200, **columns: str) -> DataFrame:
    """Join rank columns back to the rows.

    ``bounded``: the key's domain is a handful of values, so their ranks are broadcast. Otherwise the join is
    split by the measured ties: values with more than 1/``hot_share`` of the rows, fewer than ``hot_share`` of them, are
    broadcast; only the others are shuffled to meet their ranks. Rows of a broadcast value are dealt evenly by
    a salt that matches nothing, so no task holds a value's rows, with or without adaptive execution.
    """
    if bounded:
        picked = ranks.select(F.col(key).alias("_key"), *[F.col(c).alias(n) for n, c in columns.items()])
        return df.join(F.broadcast(picked), F.col(key) == F.col("_key"), "left").drop("_key")
    is_hot = F.col("ties") * hot_share > F.col("rows")
    values = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
    hot = ranks.where(is_hot).select(F.col(key).alias("_hot_key"), values.alias("_hot"))
    # Not a literal, which the planner would take out of the join keys.
    no_salt = F.when(F.col("ties") < 0, 1).otherwise(0).alias("_no_salt")
    rest = ranks.where(~is_hot).select(F.col(key).alias("_key"), no_salt, values.alias("_rest"))
    met = df.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    alone = F.col("_hot_key").isNotNull() | F.col(key).isNull()
    salted = met.withColumn("_salt", F.when(alone, 1 + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20))).otherwise(0).cast("int"))
    joined = salted.join(rest, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_no_salt")), "left")
    found = [F.coalesce(F.col(f"_hot.{n}"), F.col(f"_rest.{n}")).alias(n) for n in columns]
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *found)


def quantiles(df: DataFrame, key: str, points: dict[str, float]) -> DataFrame:
    """One row of exact, linearly interpolated quantiles: by counting where values are whole units, else by ranks."""
    if countable(df.schema[key].dataType):
        return selected_quantiles(df, key, points)
    ranks = value_ranks(df, key)
    picks = []
    for name, q in points.items():
        target = F.lit(q) * (F.col("rows") - 1) + 1
        low, high = F.floor(target), F.ceil(target)
        for side, at in (("lo", low), ("hi", high)):
            here = (F.col("rank") <= at) & (at < F.col("rank") + F.col("ties"))
            picks.append(F.max(F.when(here, F.col(key).cast("double"))).alias(f"{name}_{side}"))
        picks.append(F.max(target - low).alias(f"{name}_frac"))
    row = ranks.agg(*picks)
    return row.select(
        *[
            (F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * F.col(f"{n}_frac")).alias(n)
            for n in points
        ]
    )
