"""Exploratory measures: frequency, repeat gaps, concentration and return rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import half_even, right_closed_bin, share, whole_elapsed_days
from tidemark.operators.ordered import ordered_scan, quantiles
from tidemark.operators.selection import top_share

# Day bins for the return-rate chart.
RECENCY_EDGES = [0, 90, 180, 365, float("inf")]
RECENCY_LABELS = ["0-90", "91-180", "181-365", "365+"]
GAP_LIMIT, GAP_WIDTH = 600, 15


def purchase_frequency(current: DataFrame) -> DataFrame:
    """Share of customers with 1, 2, 3 and 4+ purchase days; missing counts give 0."""
    tally = current.groupBy(F.least(F.col("purchase_days"), F.lit(4)).cast("int").alias("purchase_days")).agg(
        F.count(F.lit(1)).alias("n")
    )
    slots = current.sparkSession.range(1, 5).select(F.col("id").cast("int").alias("purchase_days"))
    everyone = F.sum("n").over(Window.partitionBy())
    filled = slots.join(F.broadcast(tally), "purchase_days", "left").withColumn("total", everyone)
    return filled.select("purchase_days", F.coalesce(share("n", "total"), F.lit(0.0)).alias("share_of_customers"))


def repeat_gaps(history: DataFrame) -> DataFrame:
    """Whole elapsed days since the person's previous purchase, for every repeat purchase."""
    order = [("purchased_at", True), ("order_id", True)]
    narrow = history.where("customer_unique_id is not null").select("customer_unique_id", "purchased_at", "order_id")
    chained = ordered_scan(narrow, order, group=["customer_unique_id"], previous={"previous_at": "purchased_at"})
    gap = whole_elapsed_days("purchased_at", "previous_at")
    return chained.select("customer_unique_id", "order_id", gap.alias("gap_days")).where("gap_days is not null")


def repeat_gap_stats(gaps: DataFrame) -> DataFrame:
    """Gaps are whole days, so the exact median has a small domain."""
    later = F.when(F.col("gap_days") > 0, F.col("gap_days"))
    positive = F.count(later)
    near = {d: F.count_if(F.col("gap_days").between(1, d)) for d in (90, 180, 365)}
    return gaps.agg(
        share(F.count_if(F.col("gap_days") == 0), F.count(F.lit(1))).alias("same_day_share"),
        *[share(c, positive).alias(f"within_{d}d") for d, c in near.items()],
        F.median(later).alias("median_days"),
    )


def repeat_gap_histogram(gaps: DataFrame) -> DataFrame:
    """Fifteen-day bins up to 600; longer gaps fall in the last, closed bin."""
    clipped = F.least(F.col("gap_days"), F.lit(GAP_LIMIT))
    slot = F.least(F.floor(clipped / GAP_WIDTH), F.lit(GAP_LIMIT // GAP_WIDTH - 1))
    return (
        gaps.where("gap_days > 0")
        .groupBy((slot * GAP_WIDTH).cast("int").alias("bin_start"))
        .agg(F.count(F.lit(1)).alias("repeats"))
    )


def lorenz_curve(current: DataFrame) -> DataFrame:
    """Customers from highest to lowest spend with both cumulative shares."""
    spend = current.select("customer_unique_id", F.col("monetary").cast("decimal(28,2)").alias("monetary"))
    order = [("monetary", False), ("customer_unique_id", True)]
    scanned = ordered_scan(spend, order, sums={"spent": "monetary"})
    return scanned.select(
        "customer_unique_id",
        F.col("position").alias("spend_rank"),
        share("position", "position_total").alias("share_of_customers"),
        share("spent", "spent_total").alias("share_of_revenue"),
        F.col("position_total").alias("customers"),
    )


def top_fifth_share(current: DataFrame) -> DataFrame:
    """Revenue share of the customers ranked up to floor(0.2 N) by spend; their order is not needed."""
    spend = current.select(F.col("monetary").cast("decimal(28,2)").alias("monetary"))
    return top_share(spend, "monetary", 0.2).select(F.col("share").alias("top20_revenue_share"))


def return_rate_by_recency(test: DataFrame) -> DataFrame:
    slot = right_closed_bin("recency_days", RECENCY_EDGES, RECENCY_LABELS)
    return (
        test.withColumn("recency_bucket", slot)
        .where("recency_bucket is not null")
        .groupBy("recency_bucket")
        .agg(F.avg("returned").alias("return_rate"))
    )


def return_rate_by_review(test: DataFrame) -> DataFrame:
    return (
        test.where("has_review = 1")
        .groupBy(half_even("avg_review_score_observed", 0).cast("int").alias("review_bucket"))
        .agg(F.avg("returned").alias("return_rate"))
    )


def return_rate_by_lateness(test: DataFrame) -> DataFrame:
    return test.groupBy("had_late_delivery").agg(F.avg("returned").alias("return_rate"))


def base_description(current: DataFrame) -> DataFrame:
    """Customer count and exact medians; the medians are selected by counting, doubles by value ranks."""
    size = current.agg(F.count(F.lit(1)).alias("customers"))
    row = size
    for key in ("recency_days", "monetary", "avg_order_value"):
        row = row.crossJoin(F.broadcast(quantiles(current.select(key), key, {f"median_{key}": 0.5})))
    return row


def review_by_lateness(joined: DataFrame) -> DataFrame:
    delivered = joined.where("is_valid_purchase and is_late_delivery is not null")
    everything = Window.partitionBy()
    return delivered.groupBy("is_late_delivery").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.avg("review_score_avg"), 2).alias("avg_review_score")
    ).withColumn("share_of_deliveries", share("orders", F.sum("orders").over(everything)))


def second_purchase_within(history: DataFrame, days: int = 180) -> DataFrame:
    """Share of people whose second purchase came within some days of the first."""
    order = [("purchased_at", True), ("order_id", True)]
    narrow = history.where("customer_unique_id is not null").select("customer_unique_id", "purchased_at", "order_id")
    chained = ordered_scan(narrow, order, group=["customer_unique_id"], previous={"previous_at": "purchased_at"})
    soon = F.col("purchased_at") <= F.col("previous_at") + F.make_dt_interval(F.lit(days))
    return chained.agg(
        F.count_if(F.col("position") == 1).alias("customers"),
        F.count_if((F.col("position") == 2) & soon).alias("bought_again"),
    ).select("customers", "bought_again", share("bought_again", "customers").alias("share_bought_again"))
