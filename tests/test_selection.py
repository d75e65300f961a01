"""Selection by counting against plain windows and percentiles, and the plans without a range exchange."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import customers, explore
from tidemark.operators.ordered import quantiles, value_ranks
from tidemark.operators.selection import Selection, countable, top_share


def amounts(kind: str, n: int) -> list[Decimal | None]:
    rng = random.Random(n)
    cents = {
        "spread": lambda i: rng.randint(-10**9, 10**11), "ties": lambda i: rng.randint(0, 4), "equal": lambda i: 700,
        "hot": lambda i: 12_345 if i % 3 == 0 else rng.randint(0, 10**6), "nulls": lambda i: None if i % 4 == 0 else rng.randint(0, 999),
    }[kind]
    return [None if (c := cents(i)) is None else Decimal(c).scaleb(-2) for i in range(n)]


def frame(spark, kind, n):
    return spark.createDataFrame([(i, a) for i, a in enumerate(amounts(kind, n))], "id int, a decimal(28,2)").repartition(3)


@pytest.mark.parametrize("kind", ["spread", "ties", "equal", "hot", "nulls"])
@pytest.mark.parametrize("n", [0, 1, 11, 500])
def test_cuts_equal_those_of_ranks(spark, kind, n):
    df = frame(spark, kind, n)
    scored = value_ranks(df, "a").select("a", customers.fifths(F.col("percent_rank")).alias("score"))
    want = scored.agg(*[F.min(F.when(F.col("score") >= s, F.col("a"))) for s in (2, 3, 4, 5)]).first()
    got = customers.score_cuts(df, F.col("a"), "m", bounded=False)
    assert got.columns == ["m_cut2", "m_cut3", "m_cut4", "m_cut5"] and got.schema[0].dataType.simpleString() == "decimal(28,2)"
    assert tuple(got.first()) == tuple(want)


@pytest.mark.parametrize("kind", ["spread", "ties", "hot", "nulls"])
@pytest.mark.parametrize("n", [1, 500])
def test_every_rank(spark, kind, n):
    picked = Selection(frame(spark, kind, n), "a")
    want = sorted(int(a * 100) for a in amounts(kind, n) if a is not None)
    assert picked.at(range(-1, n + 1)) == dict(enumerate(want))


@pytest.mark.parametrize("kind", ["spread", "hot", "nulls"])
def test_quantiles_equal_percentiles(spark, kind):
    df = frame(spark, kind, 301)
    want = df.agg(F.percentile(F.col("a").cast("double"), F.lit(0.5)), F.percentile(F.col("a").cast("double"), F.lit(0.93))).first()
    assert tuple(quantiles(df, "a", {"x": 0.5, "y": 0.93}).first()) == pytest.approx(tuple(want))
    assert tuple(quantiles(df.where("false"), "a", {"x": 0.5}).first()) == (None,)


def test_dates_and_the_ends_of_long(spark):
    days = [date(1965, 1, 1) + timedelta(days=37 * i) for i in range(50)]
    picked = Selection(spark.createDataFrame([(d,) for d in reversed(days)], "d date"), "d")
    found = picked.at([0, 20, 49])
    assert tuple(picked.one_row(**{f"r{r}": v for r, v in found.items()}).first()) == (days[0], days[20], days[49])
    top = 2**63 - 1
    picked = Selection(spark.createDataFrame([(top,), (top - 1,), (5,)], "n long"), "n")
    assert picked.at([0, 1, 2]) == {0: 5, 1: top - 1, 2: top}
    assert picked.next_after([5, top]) == {5: top - 1, top: None}
    assert not countable(spark.createDataFrame([], "x double").schema["x"].dataType)
    with pytest.raises(TypeError):
        Selection(spark.createDataFrame([], "x double"), "x")


@pytest.mark.parametrize("kind", ["spread", "ties", "equal", "hot", "nulls"])
@pytest.mark.parametrize("n", [3, 9, 500])
@pytest.mark.parametrize("fraction", [0.2, 0.9])
def test_share_of_the_top(spark, kind, n, fraction):
    values = sorted((a for a in amounts(kind, n) if a is not None), reverse=True)
    k = int(n * fraction)
    want = float(sum(values[:k]) / sum(values)) if k and sum(values) else None
    assert top_share(frame(spark, kind, n), "a", fraction).first().share == (want if want is None else pytest.approx(want))


def test_no_range_exchange(spark, workspace):
    for result in (workspace.customer_rfm, customers.rfm_scores(workspace.dim_customers), explore.top_fifth_share(workspace.current)):
        assert "rangepartitioning" not in result._jdf.queryExecution().toString().lower()
