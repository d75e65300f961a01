"""Aggregates behind the dashboards, over the customer extract and the metric marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import TOTAL, exact_ratio, month_start, share

MILLION = 1_000_000.0


def customers_extract(scores: DataFrame, rfm: DataFrame) -> DataFrame:
    extra = rfm.select("customer_unique_id", "avg_review_score", "late_delivery_count")
    return scores.withColumn("acquisition_month", month_start("first_purchase_date")).join(extra, "customer_unique_id")


def lifecycle_stage() -> Column:
    group = F.col("customer_group")
    return (
        F.when(group == "Loyal Customer", "Loyal")
        .when(group == "New Customer", "New")
        .when(F.col("risk_tier") == "High", "At-risk")
        .otherwise("Other one-time")
    )


def revenue_band() -> Column:
    """Spend bands with fixed upper limits; labels sort in order."""
    spent = F.col("total_revenue")
    return (
        F.when(spent < 50, "1: < R$50")
        .when(spent < 100, "2: R$50-99")
        .when(spent < 200, "3: R$100-199")
        .when(spent < 500, "4: R$200-499")
        .when(spent < 1000, "5: R$500-999")
        .otherwise("6: R$1,000+")
    )


def _people() -> Column:
    return F.count(F.lit(1)).alias("customers")


def _revenue_m() -> Column:
    return (F.sum("total_revenue").cast(TOTAL).cast("double") / MILLION).alias("revenue_m")


def _return_pct() -> Column:
    return F.round(F.lit(100.0) * F.avg("return_probability"), 2).alias("avg_return_pct")


def kpi_tiles(extract: DataFrame) -> DataFrame:
    high = F.col("value_tier") == "High"
    zero = F.lit(0).cast(TOTAL)
    sums = extract.agg(
        F.sum("total_revenue").cast(TOTAL).alias("revenue"),
        F.sum("order_count").alias("orders"),
        F.count("customer_unique_id").alias("customers"),
        F.count_if(F.col("order_count") >= 2).alias("repeaters"),
        F.count_if(high).alias("high_value_customers"),
        F.sum(F.when(high, F.col("total_revenue")).otherwise(zero)).cast(TOTAL).alias("high_revenue"),
    )
    return sums.select(
        exact_ratio("revenue", F.lit(1_000_000), 2).alias("revenue_m"),
        "orders",
        "customers",
        exact_ratio("revenue", "orders", 2).alias("avg_order_value"),
        exact_ratio(F.col("repeaters") * 100, "customers", 2).alias("repeat_rate_pct"),
        "high_value_customers",
        F.round(F.lit(100.0) * share("high_revenue", "revenue"), 1).alias("high_value_revenue_pct"),
    )


def monthly_trend(monthly: DataFrame) -> DataFrame:
    return monthly.where(~F.col("is_low_volume_month")).select(
        "purchase_month",
        (F.col("revenue").cast("double") / 1000.0).alias("revenue_k"),
        "new_customers",
        (F.col("returning_customer_share").cast("double") * 100).alias("returning_share_pct"),
    )


def segment_bars(extract: DataFrame, state: str | None = None) -> DataFrame:
    rows = extract if state is None else extract.where(F.col("customer_state") == state)
    return rows.groupBy("rfm_segment").agg(_revenue_m(), _people()).orderBy(F.desc("revenue_m"))


def recency_monetary_matrix(extract: DataFrame) -> DataFrame:
    """Rows are monetary scores; one pair of columns (customers, revenue) per recency score."""
    cells = []
    for r in range(1, 6):
        here = F.col("r_score") == r
        cells.append(F.count_if(here).alias(f"r{r}_customers"))
        cells.append(F.coalesce(F.sum(F.when(here, F.col("total_revenue"))), F.lit(0)).cast(TOTAL).alias(f"r{r}_revenue"))
    return extract.groupBy("m_score").agg(*cells)


def value_distribution(extract: DataFrame) -> DataFrame:
    return extract.groupBy(revenue_band().alias("revenue_band")).agg(
        _people(), F.sum("total_revenue").cast(TOTAL).alias("revenue")
    )


def lifecycle_mix(extract: DataFrame) -> DataFrame:
    grouped = extract.groupBy(lifecycle_stage().alias("lifecycle_stage")).agg(
        _people(), F.sum("total_revenue").cast(TOTAL).alias("revenue")
    )
    return grouped.withColumn("revenue_share", share("revenue", F.sum("revenue").over(Window.partitionBy())))


def risk_distribution(extract: DataFrame) -> DataFrame:
    return extract.groupBy("risk_tier").agg(_people(), _return_pct())


def value_risk_matrix(extract: DataFrame) -> DataFrame:
    return extract.groupBy("value_tier", "risk_tier").agg(_people(), _revenue_m())


def activity_by_value(extract: DataFrame) -> DataFrame:
    grouped = extract.groupBy("value_tier", "activity_status").agg(_people())
    tier = F.sum("customers").over(Window.partitionBy("value_tier"))
    return grouped.withColumn("share_of_tier", share("customers", tier))


def cohort_heatmap(cohorts: DataFrame) -> DataFrame:
    """Cohorts as rows, retention percent of months 1 to 12 as columns; small cohorts hidden."""
    pct = F.round(F.col("retention_rate") * 100, 2)
    cells = [
        F.max(F.when(F.col("months_since_acquisition") == k, pct)).alias(f"month_{k}") for k in range(1, 13)
    ]
    shown = cohorts.where(~F.col("is_small_cohort") & F.col("months_since_acquisition").between(1, 12))
    return shown.groupBy("acquisition_month").agg(*cells)


def opportunity_map(extract: DataFrame) -> DataFrame:
    return extract.groupBy("customer_group").agg(_revenue_m(), _return_pct(), _people())


def action_bars(extract: DataFrame) -> DataFrame:
    return (
        extract.groupBy("next_best_action")
        .agg(_people(), F.sum("action_cost_brl").cast(TOTAL).alias("total_cost"))
        .orderBy(F.desc("customers"))
    )


def group_action_detail(extract: DataFrame) -> DataFrame:
    return extract.groupBy("customer_group", "next_best_action", "action_reason").agg(
        _people(),
        F.sum("total_revenue").cast(TOTAL).alias("revenue"),
        F.sum("expected_revenue_180d").alias("expected_revenue_180d"),
    )


def category_bars(categories: DataFrame, n: int = 15) -> DataFrame:
    return (
        categories.where(F.col("revenue_rank").between(1, n))
        .select(
            "product_category",
            (F.col("item_revenue").cast("double") / 1000.0).alias("item_revenue_k"),
            "avg_review_score",
        )
        .orderBy(F.desc("item_revenue_k"))
    )


def top_categories(categories: DataFrame, n: int = 15) -> DataFrame:
    return categories.orderBy("revenue_rank", "product_category").limit(n)


def budget_tiles(extract: DataFrame, budget: float) -> DataFrame:
    inside = F.col("cumulative_action_cost_brl") <= budget
    zero = F.lit(0).cast(TOTAL)
    sums = extract.agg(
        F.count_if(inside).alias("customers_in_budget"),
        F.sum(F.when(inside, F.col("action_cost_brl")).otherwise(zero)).cast(TOTAL).alias("spend"),
        F.count_if(inside & (F.col("value_tier") == "High")).alias("high_value_in_budget"),
        F.sum(F.when(inside, F.col("total_revenue")).otherwise(zero)).cast(TOTAL).alias("revenue"),
        F.sum("total_revenue").cast(TOTAL).alias("all_revenue"),
    )
    return sums.select(
        "customers_in_budget",
        F.round("spend", 0).alias("budget_spend"),
        "high_value_in_budget",
        F.round(F.lit(100.0) * share("revenue", "all_revenue"), 1).alias("revenue_share_pct"),
    )


def budget_curve(extract: DataFrame, budget: float, ranks: int | None = None) -> DataFrame:
    """Cost over the ranks; ``ranks`` shows the first so many only."""
    shown = extract if ranks is None else extract.where(F.col("priority_rank") <= ranks)
    return shown.select(
        "priority_rank", "cumulative_action_cost_brl",
        (F.col("cumulative_action_cost_brl") <= budget).alias("within_budget"),
    )


def actions_in_budget(extract: DataFrame, budget: float) -> DataFrame:
    inside = extract.where(F.col("cumulative_action_cost_brl") <= budget)
    return inside.groupBy("next_best_action").agg(_people()).orderBy(F.desc("customers"))


def priority_table(extract: DataFrame, budget: float, ranks: int = 100) -> DataFrame:
    shown = (F.col("cumulative_action_cost_brl") <= budget) & F.col("priority_rank").between(1, ranks)
    return extract.where(shown).select(
        "priority_rank",
        F.substring("customer_unique_id", 1, 8).alias("customer"),
        "customer_state", "customer_group", "next_best_action",
        F.round(F.col("return_probability") * 100, 2).alias("return_probability_pct"),
        "priority_score", "total_revenue", "recency_days", "action_cost_brl",
    ).orderBy("priority_rank")


def lift_chart(deciles: DataFrame) -> DataFrame:
    return deciles.select("decile", "lift").orderBy("decile")


def model_vs_rules(evaluation: DataFrame) -> DataFrame:
    return evaluation.select(
        "model",
        F.round("roc_auc", 3).alias("roc_auc"),
        F.round("pr_auc", 3).alias("pr_auc"),
        F.round("lift_top_10pct", 2).alias("lift_top_10pct"),
        F.round("capture_top_20pct", 3).alias("capture_top_20pct"),
    ).orderBy(F.desc("roc_auc"))


def driver_table(coefficients: DataFrame) -> DataFrame:
    return coefficients.select("feature", "odds_ratio_per_sd", "stable_direction")


# ---------------------------------------------------------------- all tiles of a run from one scan

#: Tiles that group the extract, with the columns they group by.
TILES: dict[str, tuple[str, ...]] = {
    "segment_bars": ("rfm_segment",),
    "segment_bars_by_state": ("rfm_segment", "customer_state"),
    "recency_monetary_matrix": ("m_score", "r_score"),
    "value_distribution": ("revenue_band",),
    "lifecycle_mix": ("lifecycle_stage",),
    "risk_distribution": ("risk_tier",),
    "value_risk_matrix": ("value_tier", "risk_tier"),
    "activity_by_value": ("value_tier", "activity_status"),
    "opportunity_map": ("customer_group",),
    "action_bars": ("next_best_action",),
    "group_action_detail": ("customer_group", "next_best_action", "action_reason"),
}
TILE_KEYS = tuple(dict.fromkeys(k for keys in TILES.values() for k in keys))


def tile_measures(extract: DataFrame) -> DataFrame:
    """Every tile's groups with their sums, from one aggregate over grouping sets; ``tile`` tells them apart.

    The extract is read once for all tiles. Columns that a tile does not group by are NULL.
    """
    rows = extract.withColumns({"revenue_band": revenue_band(), "lifecycle_stage": lifecycle_stage()})
    grouped = rows.groupingSets([[F.col(k) for k in keys] for keys in TILES.values()], *TILE_KEYS).agg(
        F.grouping_id(*TILE_KEYS).alias("set"), F.count(F.lit(1)).alias("customers"), F.sum("total_revenue").cast(TOTAL).alias("revenue"),
        F.avg("return_probability").alias("return_rate"), F.sum("action_cost_brl").cast(TOTAL).alias("total_cost"),
        F.sum("expected_revenue_180d").alias("expected_revenue_180d"))
    # The id of a set has a one for each column that the set leaves out, the first column's bit highest.
    ids = {
        name: sum(1 << (len(TILE_KEYS) - 1 - i) for i, key in enumerate(TILE_KEYS) if key not in keys) for name, keys in TILES.items()}
    tile = F.lit(None).cast("string")
    for name, number in ids.items():
        tile = F.when(F.col("set") == number, name).otherwise(tile)
    return grouped.select(tile.alias("tile"), *TILE_KEYS, "customers", "revenue", "return_rate", "total_cost", "expected_revenue_180d")


def tiles_of(measures: DataFrame, state: str) -> dict[str, DataFrame]:
    """The tiles as their own functions return them, from the stored measures. ``state`` is the one shown by state."""

    def groups(name: str) -> DataFrame:
        return measures.where(F.col("tile") == name)

    million = (F.col("revenue").cast("double") / MILLION).alias("revenue_m")
    pct = F.round(F.lit(100.0) * F.col("return_rate"), 2).alias("avg_return_pct")
    cells = []
    for r in range(1, 6):
        here = F.col("r_score") == r
        cells.append(F.coalesce(F.sum(F.when(here, F.col("customers"))), F.lit(0)).alias(f"r{r}_customers"))
        cells.append(F.coalesce(F.sum(F.when(here, F.col("revenue"))), F.lit(0)).cast(TOTAL).alias(f"r{r}_revenue"))
    everyone, tier = Window.partitionBy(), Window.partitionBy("value_tier")
    return {
        "segment_bars": groups("segment_bars").select("rfm_segment", million, "customers"),
        "segment_bars_by_state": groups("segment_bars_by_state").where(F.col("customer_state") == state).select("rfm_segment", million, "customers"),
        "recency_monetary_matrix": groups("recency_monetary_matrix").groupBy("m_score").agg(*cells),
        "value_distribution": groups("value_distribution").select("revenue_band", "customers", "revenue"),
        "lifecycle_mix": groups("lifecycle_mix").select(
            "lifecycle_stage", "customers", "revenue", share("revenue", F.sum("revenue").over(everyone)).alias("revenue_share")),
        "risk_distribution": groups("risk_distribution").select("risk_tier", "customers", pct),
        "value_risk_matrix": groups("value_risk_matrix").select("value_tier", "risk_tier", "customers", million),
        "activity_by_value": groups("activity_by_value").select(
            "value_tier", "activity_status", "customers", share("customers", F.sum("customers").over(tier)).alias("share_of_tier")),
        "opportunity_map": groups("opportunity_map").select("customer_group", million, pct, "customers"),
        "action_bars": groups("action_bars").select("next_best_action", "customers", "total_cost"),
        "group_action_detail": groups("group_action_detail").select(
            "customer_group", "next_best_action", "action_reason", "customers", "revenue", "expected_revenue_180d"),
    }
