"""Column helpers whose exact rounding, calendar or NULL rules matter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
TOTAL = "decimal(28,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even(c: str | Column, places: int) -> Column:
    """Array-library rounding: scale, round to the nearest even integer, scale back."""
    factor = float(10**places)
    return F.rint(col(c) * factor) / factor


def exact_ratio(numerator: str | Column, denominator: str | Column, places: int) -> Column:
    """SQL rounding (half up) of an exact decimal quotient; NULL when the divisor is 0."""
    divisor = F.nullif(col(denominator).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(col(numerator).cast(TOTAL) / divisor, places)


def sum_of_lines(c: str | Column) -> Column:
    """Exact sum of line amounts with two decimals and at most ten digits.

    Adding whole cents as longs is cheaper than adding decimals too wide for one
    machine word, which is what Spark makes of such a sum.
    """
    cents = F.round(col(c).cast("double") * 100).cast("long")
    return (F.sum(cents).cast("decimal(20,0)") / 100).cast(MONEY)


def share(numerator: str | Column, denominator: str | Column) -> Column:
    """Unrounded double quotient; NULL when the divisor is 0."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def month_start(c: str | Column) -> Column:
    return F.trunc(col(c), "MM")


def months_between_starts(later: str | Column, earlier: str | Column) -> Column:
    """Number of calendar-month boundaries crossed (Jan 31 to Feb 1 is one)."""
    late, early = col(later), col(earlier)
    return (F.year(late) - F.year(early)) * 12 + (F.month(late) - F.month(early))


def elapsed_seconds(later: str | Column, earlier: str | Column) -> Column:
    return F.timestamp_diff("SECOND", col(earlier), col(later))


def elapsed_days(later: str | Column, earlier: str | Column) -> Column:
    """Fractional elapsed days, not calendar days."""
    return elapsed_seconds(later, earlier) / F.lit(86400.0)


def whole_elapsed_days(later: str | Column, earlier: str | Column) -> Column:
    return F.floor(elapsed_seconds(later, earlier) / F.lit(86400.0)).cast("int")


def matches_whole(c: str | Column, pattern: str) -> Column:
    """Regular expression that has to cover the entire value."""
    return col(c).rlike(f"^(?:{pattern})$")


def zip_code(c: str | Column) -> Column:
    """Five characters: shorter codes are padded with zeros, longer ones cut (a fixed rule of the models)."""
    return F.lpad(F.trim(col(c)), 5, "0")


def lower_trim(c: str | Column) -> Column:
    return F.lower(F.trim(col(c)))


def upper_trim(c: str | Column) -> Column:
    return F.upper(F.trim(col(c)))


def dashed_key(left: str | Column, right: str | Column) -> Column:
    """Composite text key; NULL if either part is NULL."""
    return F.concat(col(left).cast("string"), F.lit("-"), col(right).cast("string"))


def lookup(c: str | Column, mapping: dict, cast: str) -> Column:
    """CASE chain over a small constant mapping; unmapped values give NULL."""
    chain = None
    for key, value in mapping.items():
        hit = col(c) == F.lit(key)
        literal = F.lit(value).cast(cast)
        chain = F.when(hit, literal) if chain is None else chain.when(hit, literal)
    return chain


def right_closed_bin(c: str | Column, edges: list[float], labels: list[str]) -> Column:
    """Label of the bin (low, high]; values at or below the first edge or above the last give NULL."""
    value = col(c)
    chain = F.when(value <= edges[0], F.lit(None).cast("string"))
    for high, label in zip(edges[1:], labels, strict=True):
        chain = chain.when(value <= high, F.lit(label))
    return chain
