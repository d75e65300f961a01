"""Order statistics by counting: values at given ranks without a sort or a range exchange.

A key is a whole number (days, cents). Its range is cut into at most 4,096 buckets, one partial
aggregate counts the rows of each, and only the buckets that hold a wanted rank are cut again. The
key column is stored once, alone; a round reads it and returns at most 4,096 counts a wanted rank,
however many rows or distinct values there are, and a number of b bits takes b / 12 rounds. A value
held by a third of all rows costs one count a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.scratch import store

DIGIT_BITS = 12
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def countable(kind: T.DataType) -> bool:
    """Whether values of this type are whole numbers of some unit that can be computed without rounding."""
    if isinstance(kind, T.DecimalType):
        return kind.precision + kind.scale + 2 <= 38
    return isinstance(kind, (*_WHOLE, T.DateType))


def as_units(key: Column, kind: T.DataType) -> Column:
    """The key as a number of its smallest units; more than a long holds is an error."""
    if isinstance(kind, T.DateType):
        return F.unix_date(key).cast("long")
    if isinstance(kind, T.DecimalType):
        return (key * F.lit(10**kind.scale).cast(T.DecimalType(kind.scale + 1, 0))).cast("long")
    return key.cast("long")


def of_units(units: int | None, kind: T.DataType) -> Column:
    """A literal of the key's type."""
    if units is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.lit(units).cast("int"))
    if isinstance(kind, T.DecimalType):
        return F.lit(str(Decimal(units).scaleb(-kind.scale))).cast(kind)
    return F.lit(units).cast(kind)


class Selection:
    """The non-NULL values of one key column, ready to be asked for ranks."""

    def __init__(self, rows: DataFrame, key: str):
        self.kind = rows.schema[key].dataType
        if not countable(self.kind):
            raise TypeError(f"{key}: {self.kind.simpleString()} is not a whole number of units")
        units = as_units(F.col(key), self.kind).alias("units")
        self.stored = store(rows.select(units), "selection")
        ends = self.stored.agg(F.count("units"), F.count(F.lit(1)), F.min("units"), F.max("units")).first()
        self.values, self.rows, self.low, self.high = ends

    def at(self, ranks: Sequence[int]) -> dict[int, int]:
        """The value at every rank, from 0 for the smallest; ranks outside the values have none."""
        inside = sorted({r for r in ranks if 0 <= r < self.values})
        if not inside:
            return {}
        rounds = max(1, -(-(self.high - self.low).bit_length() // DIGIT_BITS))
        above = F.col("units") - F.lit(self.low)
        # Wanted rank: the bucket that holds it, and its rank among the rows of that bucket.
        place = {r: (0, r) for r in inside}
        for k in range(rounds - 1, -1, -1):
            shift = DIGIT_BITS * k
            rows = self.stored.where("units is not null")
            if k < rounds - 1:
                rows = rows.where(F.shiftright(above, shift + DIGIT_BITS).isin(sorted({b for b, _ in place.values()})))
            counted = rows.groupBy(F.shiftright(above, shift).alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()
            counts = sorted((r.bucket, r.n) for r in counted)
            for rank, (parent, left) in place.items():
                for bucket, n in counts:
                    if k < rounds - 1 and bucket >> DIGIT_BITS != parent:
                        continue
                    if left < n:
                        place[rank] = (bucket, left)
                        break
                    left -= n
        return {r: self.low + bucket for r, (bucket, _) in place.items()}

    def next_after(self, values: Sequence[int]) -> dict[int, int | None]:
        """The smallest value above each of the given ones."""
        if not values:
            return {}
        row = self.stored.agg(*[F.min(F.when(F.col("units") > v, F.col("units"))) for v in values]).first()
        return dict(zip(values, row, strict=True))

    def one_row(self, **units: int | None) -> DataFrame:
        """A row of values in the key's own type."""
        return self.stored.sparkSession.range(1).select(*[of_units(v, self.kind).alias(n) for n, v in units.items()])


def score_cut_values(rows: DataFrame, key: str, name: str, scores: int = 5) -> DataFrame:
    """One row: the smallest key of every score above 1, where percent ranks fall into equal parts.

    The percent rank of a value is the number of smaller rows over all rows but one. So a score
    starts at the first value above the one at rank ceil((score - 1)(n - 1) / scores) - 1.
    """
    picked = Selection(rows, key)
    n = picked.values
    last = {s: -(-(s - 1) * (n - 1) // scores) - 1 for s in range(2, scores + 1)}
    below = picked.at(list(last.values()))
    starts = picked.next_after(sorted(set(below.values())))
    return picked.one_row(**{f"{name}_cut{s}": starts.get(below.get(r)) for s, r in last.items()})


def selected_quantiles(rows: DataFrame, key: str, points: dict[str, float]) -> DataFrame:
    """One row of exact, linearly interpolated quantiles; NULL where there are no values."""
    picked = Selection(rows, key)
    targets = {n: q * (picked.values - 1) for n, q in points.items()} if picked.values else {}
    found = picked.at([r for t in targets.values() for r in (int(t), -int(-t // 1))])
    out = []
    for name in points:
        if name not in targets:
            out.append(F.lit(None).cast("double").alias(name))
            continue
        t = targets[name]
        low, high = (of_units(found[r], picked.kind) for r in (int(t), -int(-t // 1)))
        if isinstance(picked.kind, T.DateType):
            low, high = F.unix_date(low), F.unix_date(high)
        low, high = low.cast("double"), high.cast("double")
        out.append((low + (high - low) * F.lit(t - int(t))).alias(name))
    return rows.sparkSession.range(1).select(*out)


def top_share(rows: DataFrame, key: str, fraction: float) -> DataFrame:
    """Share of the sum of ``key`` that its largest values hold, floor(``fraction`` of all rows) of them.

    NULL values come last. NULL when no row is taken or the sum is 0.
    """
    picked = Selection(rows, key)
    taken = int(picked.rows * fraction)
    if not taken or not picked.values:
        return picked.stored.sparkSession.range(1).select(F.lit(None).cast("double").alias("share"))
    edge = picked.at([max(0, picked.values - taken)])[max(0, picked.values - taken)]
    above = F.col("units") > edge
    # Wide sums, as cents of all customers together may pass a long.
    units = F.col("units").cast("decimal(38,0)")
    sums = picked.stored.agg(
        F.coalesce(F.sum(F.when(above, units)), F.lit(0)).alias("above"), F.count_if(above).alias("n"), F.sum(units).alias("total"),
    )
    at_edge = F.least(F.lit(taken), F.lit(picked.values)) - F.col("n")
    held = F.col("above").cast("double") + at_edge.cast("double") * F.lit(float(edge))
    return sums.select(F.try_divide(held, F.col("total").cast("double")).alias("share"))
