"""Customer dimension and RFM segmentation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import RetentionConfig
from tidemark.functions.scalars import TOTAL, exact_ratio, month_start
from tidemark.operators.ordered import value_ranks
from tidemark.operators.selection import countable, score_cut_values

#: Measures and columns that the keys and scores of people and their months come from.
KEYED_MEASURES = ("first_purchase_date", "last_purchase_date", "order_count", "total_revenue")
KEYED_COLUMNS = (
    "customer_unique_id", "acquisition_month", "order_count", "is_repeat_customer", "total_revenue", "days_since_last_purchase", "as_of_date",
)


def customer_rollup(joined: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """Valid purchases per person in one aggregation, including the latest location.

    Taking the location as the maximum of a struct replaces a window plus a join. ``only`` names the measures that
    are read, for orders that hold no other columns.
    """
    latest = F.max(
        F.struct("purchased_at", "order_id", "customer_state", "customer_city", "customer_zip_code_prefix")
    )
    measures = {
        "latest": latest,
        "first_purchase_date": F.min("purchase_date"),
        "last_purchase_date": F.max("purchase_date"),
        "order_count": F.count(F.lit(1)),
        "total_revenue": F.sum("order_revenue").cast(TOTAL),
        "total_items": F.sum("item_count"),
        "review_mean": F.avg("review_score_avg"),
        "late_delivery_count": F.count_if("is_late_delivery"),
        "delivered_order_count": F.count("delivered_at"),
    }
    return (
        joined.where("is_valid_purchase")
        .groupBy("customer_unique_id")
        .agg(*[c.alias(n) for n, c in measures.items() if only is None or n in only])
    )


def dim_customers(rollup: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """One row per identified person; recency counts from the last purchase in the data.

    ``only`` names the columns that are read, for a roll-up without the others' measures.
    """
    today = rollup.agg(F.max("last_purchase_date").alias("as_of_date"))
    tenure = F.datediff("last_purchase_date", "first_purchase_date")
    gaps = F.nullif(F.col("order_count") - 1, F.lit(0))
    columns = {
        "customer_unique_id": F.col("customer_unique_id"),
        "customer_state": F.col("latest.customer_state"),
        "customer_city": F.col("latest.customer_city"),
        "customer_zip_code_prefix": F.col("latest.customer_zip_code_prefix"),
        "first_purchase_date": F.col("first_purchase_date"),
        "acquisition_month": month_start("first_purchase_date"),
        "last_purchase_date": F.col("last_purchase_date"),
        "order_count": F.col("order_count"),
        "is_repeat_customer": F.col("order_count") >= 2,
        "total_revenue": F.col("total_revenue"),
        "avg_order_value": exact_ratio("total_revenue", "order_count", 2),
        "total_items": F.col("total_items"),
        "items_per_order": exact_ratio("total_items", "order_count", 2),
        "avg_review_score": F.round("review_mean", 2),
        "late_delivery_count": F.col("late_delivery_count"),
        "delivered_order_count": F.col("delivered_order_count"),
        "days_since_last_purchase": F.datediff("as_of_date", "last_purchase_date"),
        "customer_tenure_days": tenure,
        "avg_days_between_purchases": exact_ratio(tenure, gaps, 1),
        "as_of_date": F.col("as_of_date"),
    }
    return (
        rollup.where(F.col("customer_unique_id").isNotNull())
        .crossJoin(F.broadcast(today))
        .select(*[c.alias(n) for n, c in columns.items() if only is None or n in only])
    )


def fifths(percent_rank: Column) -> Column:
    return F.least(F.lit(5), F.floor(percent_rank * 5) + 1).cast("int")


def score_cuts(customers: DataFrame, key: Column, name: str, bounded: bool) -> DataFrame:
    """One row holding the smallest key of scores 2, 3, 4 and 5.

    A fifth is a step function of the ranked value, so four cut values are all the
    rows need: they are broadcast, and no rank has to be joined back. Keys of an
    unbounded domain are selected by counting where they are whole units; few values are ranked in one window.
    """
    keys = customers.select(key.alias("key"))
    if not bounded and countable(keys.schema["key"].dataType):
        return score_cut_values(keys, "key", name)
    ranks = value_ranks(keys, "key", bounded=bounded)
    scored = ranks.select("key", fifths(F.col("percent_rank")).alias("score"))
    return scored.agg(*[F.min(F.when(F.col("score") >= s, F.col("key"))).alias(f"{name}_cut{s}") for s in (2, 3, 4, 5)])


def from_cuts(key: Column, name: str) -> Column:
    reached = [F.coalesce((key >= F.col(f"{name}_cut{s}")).cast("int"), F.lit(0)) for s in (2, 3, 4, 5)]
    return F.lit(1) + reached[0] + reached[1] + reached[2] + reached[3]


def f_score(order_count: str = "order_count") -> Column:
    """Purchases capped at five; no fewer than one."""
    return F.greatest(F.least(F.col(order_count), F.lit(5)), F.lit(1)).cast("int")


def rfm_segment() -> Column:
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    repeat = f >= 2
    return (
        F.when(repeat & (r >= 4) & (m >= 4), "Champions")
        .when(repeat & (r >= 3), "Loyal Customers")
        .when(repeat, "At-Risk Repeat Customers")
        .when((m == 5) & (r >= 3), "High-Value Recent")
        .when(m == 5, "High-Value Lapsing")
        .when(r >= 4, "Recent One-Time Buyers")
        .when(r == 3, "Needs Attention")
        .when(r == 2, "Hibernating")
        .otherwise("Lost")
    )


def is_high_value() -> Column:
    return (F.col("m_score") == 5) | ((F.col("f_score") >= 2) & (F.col("m_score") >= 4))


def activity_status(cfg: RetentionConfig, days: str = "days_since_last_purchase") -> Column:
    return (
        F.when(F.col(days) <= cfg.active_days, "Active")
        .when(F.col(days) <= cfg.inactive_days, "Cooling")
        .otherwise("Inactive")
    )


def retention_priority() -> Column:
    high, repeat, status = F.col("is_high_value"), F.col("is_repeat_customer"), F.col("activity_status")
    return (
        F.when(high & (status == "Cooling"), 1)
        .when(high & (status == "Inactive"), 2)
        .when(repeat & status.isin("Cooling", "Inactive"), 2)
        .when(high & (status == "Active"), 3)
        .otherwise(4)
    )


def rfm_scores(customers: DataFrame) -> DataFrame:
    """customers + r_score, f_score, m_score."""
    freshness = -F.col("days_since_last_purchase")
    r_cuts = score_cuts(customers, freshness, "r", bounded=True)
    m_cuts = score_cuts(customers, F.col("total_revenue"), "m", bounded=False)
    return (
        customers.crossJoin(F.broadcast(r_cuts))
        .crossJoin(F.broadcast(m_cuts))
        .select(
            *customers.columns,
            from_cuts(freshness, "r").alias("r_score"),
            from_cuts(F.col("total_revenue"), "m").alias("m_score"),
            f_score().alias("f_score"),
        )
    )


def customer_rfm(customers: DataFrame, cfg: RetentionConfig) -> DataFrame:
    scores = [F.col(c) for c in ("r_score", "f_score", "m_score")]
    return (
        rfm_scores(customers)
        .withColumn("rfm_cell", F.concat(*[s.cast("string") for s in scores]))
        .withColumn("rfm_total_score", scores[0] + scores[1] + scores[2])
        .withColumn("rfm_segment", rfm_segment())
        .withColumn("is_high_value", is_high_value())
        .withColumn("activity_status", activity_status(cfg))
        .withColumn("retention_priority", retention_priority())
    )


def rfm_segment_summary(rfm: DataFrame) -> DataFrame:
    everyone = F.sum("customers").over(Window.partitionBy())
    grouped = rfm.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("total_revenue").alias("revenue_sum"),
        F.sum("days_since_last_purchase").alias("days_sum"),
        F.sum("order_count").alias("orders_sum"),
    )
    return grouped.select(
        "rfm_segment",
        "customers",
        exact_ratio(F.col("customers") * 100, everyone, 1).alias("pct_customers"),
        F.round("revenue_sum", 0).cast(TOTAL).alias("revenue"),
        exact_ratio("days_sum", "customers", 0).alias("avg_days_since_last_purchase"),
        exact_ratio("orders_sum", "customers", 2).alias("avg_orders"),
    )


def repeat_gap_percentiles(customers: DataFrame) -> DataFrame:
    """Exact quartile-style points of the mean gap; gaps have one decimal, so their domain is small."""
    gap = F.col("avg_days_between_purchases").cast("double")
    return customers.where("is_repeat_customer").agg(
        F.count(F.lit(1)).alias("repeat_customers"),
        F.percentile(gap, F.lit(0.5)).alias("p50_gap_days"),
        F.percentile(gap, F.lit(0.75)).alias("p75_gap_days"),
        F.percentile(gap, F.lit(0.9)).alias("p90_gap_days"),
    )


def top_high_value_customers(rfm: DataFrame, n: int = 10) -> DataFrame:
    return (
        rfm.where("is_high_value")
        .select(
            "customer_unique_id", "customer_state", "order_count", "total_revenue",
            "days_since_last_purchase", "rfm_cell", "rfm_segment", "activity_status", "retention_priority",
        )
        .orderBy("retention_priority", F.desc("total_revenue"), "customer_unique_id")
        .limit(n)
    )
