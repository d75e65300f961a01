"""The ordered scan and everything built on it against plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import attach, ordered_scan, quantiles, value_ranks


def sample(kind: str, n: int = 400):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        k = {"ties": rng.randint(0, 6), "equal": 1, "spread": rng.randint(0, 10**6)}[kind]
        hot = i % 3 == 0
        rows.append((("hot" if hot else f"g{rng.randint(0, 40)}"), k, rng.random(), i, rng.randint(0, 900) / 4))
    return [(g, None if i % 11 == 0 and kind == "ties" else k, v, i, f"{a:.2f}") for g, k, v, i, a in rows]


def frame(spark, kind, n=400):
    rows = spark.createDataFrame(sample(kind, n), "g string, k int, v double, id int, amount string")
    return rows.withColumn("amount", F.col("amount").cast("decimal(10,2)"))


def test_inputs_really_span_several_slices(spark):
    ranged = frame(spark, "equal").repartitionByRange("k", "id").select(F.spark_partition_id().alias("s"))
    assert ranged.distinct().count() == 4


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("kind", ["ties", "equal", "spread"])
def test_whole_table_scan_equals_plain_window(spark, kind):
    df = frame(spark, kind)
    w = Window.orderBy(F.col("k").desc_nulls_last(), "id")
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select("id", F.row_number().over(w).alias("position"), F.sum("amount").over(running).alias("total"))
    scanned = ordered_scan(df, [("k", False), ("id", True)], sums={"total": "amount"})
    assert rows(scanned, "id", "position", "total") == rows(plain, "id", "position", "total")
    assert {r[0] for r in scanned.select("position_total").collect()} == {df.count()}


@pytest.mark.parametrize("kind", ["ties", "equal", "spread"])
def test_grouped_scan_equals_plain_window_with_a_hot_group(spark, kind):
    df = frame(spark, kind)
    w = Window.partitionBy("g").orderBy(F.col("k").asc_nulls_first(), "id")
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select(
        "id", F.row_number().over(w).alias("position"), F.sum("amount").over(running).alias("total"),
        F.coalesce(F.lag("v").over(w), F.lit(-1.0)).alias("before"))
    scanned = ordered_scan(df, [("k", True), ("id", True)], group=["g"], sums={"total": "amount"}, previous={"before": "v"})
    scanned = scanned.withColumn("before", F.coalesce("before", F.lit(-1.0)))
    assert rows(scanned, "id", "position", "total", "before") == rows(plain, "id", "position", "total", "before")


def test_whole_table_previous_value(spark):
    df = frame(spark, "spread")
    w = Window.orderBy("k", "id")
    plain = df.select("id", F.coalesce(F.lag("v").over(w), F.lit(-1.0)).alias("before"))
    scanned = ordered_scan(df, [("k", True), ("id", True)], previous={"before": "v"})
    assert rows(scanned.withColumn("before", F.coalesce("before", F.lit(-1.0))), "id", "before") == rows(plain, "id", "before")


def test_previous_needs_ascending_order(spark):
    with pytest.raises(ValueError):
        ordered_scan(frame(spark, "ties"), [("id", False)], previous={"x": "v"})


@pytest.mark.parametrize("n", [0, 1])
def test_tiny_inputs(spark, n):
    scanned = ordered_scan(frame(spark, "spread", n), [("k", True), ("id", True)], sums={"total": "amount"})
    assert [r["position"] for r in scanned.collect()] == [1] * n
    grouped = ordered_scan(frame(spark, "spread", n), [("k", True), ("id", True)], group=["g"])
    assert [r["position"] for r in grouped.collect()] == [1] * n


@pytest.mark.parametrize("kind", ["ties", "equal", "spread"])
@pytest.mark.parametrize("bounded", [True, False])
def test_value_ranks_equal_plain_ranks(spark, kind, bounded):
    df = frame(spark, kind).where("k is not null")
    w, n = Window.orderBy("k"), df.count()
    plain = df.select(
        "id", F.rank().over(w).cast("long").alias("rank"), F.percent_rank().over(w).alias("percent_rank"),
        ((F.rank().over(w) + (F.count("*").over(Window.partitionBy("k")) - 1) / 2) / n).alias("pct_rank"))
    ranked = attach(df, value_ranks(df, "k", bounded), "k", bounded, rank="rank", percent_rank="percent_rank", pct_rank="pct_rank")
    assert rows(ranked, "id", "rank", "percent_rank", "pct_rank") == rows(plain, "id", "rank", "percent_rank", "pct_rank")


def test_null_keys_get_no_rank(spark):
    df = frame(spark, "ties")
    ranked = attach(df, value_ranks(df, "k"), "k", rank="rank")
    assert ranked.where("k is null and rank is not null").count() == 0
    assert ranked.count() == df.count()


@pytest.mark.parametrize("n", [1, 2, 7, 400])
def test_exact_quantiles(spark, n):
    df = frame(spark, "spread", n)
    want = df.agg(F.percentile("v", F.lit(0.5)), F.percentile("v", F.lit(0.9))).first()
    got = quantiles(df, "v", {"a": 0.5, "b": 0.9}).first()
    assert tuple(got) == pytest.approx(tuple(want))


@pytest.mark.parametrize("hot_share", [1, 3, 200])
def test_split_join_equals_a_plain_join(spark, hot_share):
    df = frame(spark, "ties").withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(77)).otherwise(F.col("k")))
    ranks = value_ranks(df, "k")
    found = attach(df, ranks, "k", hot_share=hot_share, p="pct_rank", n="ties")
    plain = df.join(ranks.select("k", F.col("pct_rank").alias("p"), F.col("ties").alias("n")), "k", "left")
    assert found.columns == [*df.columns, "p", "n"]
    assert sorted(map(repr, rows(found, "id", "k", "p", "n"))) == sorted(map(repr, rows(plain, "id", "k", "p", "n")))


def test_a_hot_value_is_dealt_evenly_without_adaptive_execution(spark):
    df = spark.range(40_000).select("id", F.when(F.col("id") % 10 < 3, F.lit(5.0)).otherwise(F.rand(3)).alias("v")).repartition(6)
    ranks = value_ranks(df, "v")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sizes = sorted(r["count"] for r in attach(df, ranks, "v", p="pct_rank").groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 40_000 and len(sizes) == 8 and sizes[-1] < 2 * sizes[4]
