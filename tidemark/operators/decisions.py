"""From scores to decisions: tiers, groups, next best action, priority and budget plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import (
    ACTIONS, GROUP_PLAYBOOK, RECOVERY_ACTION, RECOVERY_REASON, URGENCY, RetentionConfig,
)
from tidemark.functions.scalars import MONEY, TOTAL, half_even, lookup, share
from tidemark.operators.ordered import attach, ordered_scan, value_ranks
from tidemark.sources.scratch import store

RFM_COLUMNS = [
    "customer_unique_id", "total_revenue", "first_purchase_date", "last_purchase_date",
    "days_since_last_purchase", "r_score", "f_score", "m_score", "rfm_segment", "is_high_value",
    "activity_status",
]
# Names both inputs carry; the mart's version is kept under a suffix.
CLASHING = ["order_count", "avg_order_value", "customer_state"]
MART_SUFFIX = "_mart"


def scored_with_rfm(scored: DataFrame, rfm: DataFrame) -> DataFrame:
    mart = rfm.select(*RFM_COLUMNS, *[F.col(c).alias(c + MART_SUFFIX) for c in CLASHING])
    return scored.join(mart, "customer_unique_id").withColumn(
        "expected_revenue_180d", F.col("return_probability") * F.col("avg_order_value")
    )


def value_tier() -> Column:
    high = F.coalesce("is_high_value", F.lit(False))
    return F.when(high, "High").when(F.col("m_score") >= 3, "Medium").otherwise("Low")


def risk_tier(likelihood: Column, cfg: RetentionConfig) -> Column:
    return (
        F.when(likelihood <= cfg.risk_high_max_pct, "High")
        .when(likelihood > cfg.risk_low_min_pct, "Low")
        .otherwise("Medium")
    )


def customer_group(cfg: RetentionConfig) -> Column:
    days, tier = F.col("purchase_days"), F.col("value_tier")
    at_risk = F.col("risk_tier") == "High"
    newcomer = (days == 1) & (F.col("days_since_first_purchase") <= cfg.new_customer_days)
    chain = F.when((days >= 2) & (F.col("activity_status") != "Inactive"), "Loyal Customer")
    chain = chain.when(newcomer, "New Customer")
    chain = chain.when((tier == "High") & at_risk, "High Value - High Risk").when(tier == "High", "High Value - Lower Risk")
    chain = chain.when((tier == "Medium") & at_risk, "Medium Value - High Risk").when(tier == "Medium", "Medium Value - Lower Risk")
    return chain.otherwise("Low Value")


def next_best_action(df: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Group playbook, overridden by service recovery for valuable unhappy customers."""
    unhappy = F.coalesce(
        (F.col("avg_review_score_observed") <= cfg.poor_review) & F.col("value_tier").isin("High", "Medium"),
        F.lit(False),
    )
    usual_action = lookup("customer_group", {g: a for g, (a, _) in GROUP_PLAYBOOK.items()}, "string")
    usual_reason = lookup("customer_group", {g: r for g, (_, r) in GROUP_PLAYBOOK.items()}, "string")
    return (
        df.withColumn("next_best_action", F.when(unhappy, RECOVERY_ACTION).otherwise(usual_action))
        .withColumn("action_reason", F.when(unhappy, RECOVERY_REASON).otherwise(usual_reason))
        .withColumn("action_cost_brl", lookup("next_best_action", ACTIONS, MONEY))
    )


def percentiles(df: DataFrame) -> DataFrame:
    """customer_unique_id with average-tie percentiles of spend and likelihood, joined back by value."""
    value = value_ranks(df.select("total_revenue"), "total_revenue")
    likelihood = value_ranks(df.select("return_probability"), "return_probability")
    ranked = attach(df, value, "total_revenue", value_pct="pct_rank")
    attached = attach(ranked, likelihood, "return_probability", likelihood_pct="pct_rank")
    return attached.select("customer_unique_id", "value_pct", "likelihood_pct")


def priority_score(cfg: RetentionConfig) -> Column:
    mix = (
        F.lit(cfg.weight_value) * F.col("value_pct")
        + F.lit(cfg.weight_likelihood) * F.col("likelihood_pct")
        + F.lit(cfg.weight_urgency) * lookup("activity_status", URGENCY, "double")
    )
    return half_even(F.lit(100.0) * mix, 1)


def tiered(scored: DataFrame, rfm: DataFrame, cfg: RetentionConfig) -> DataFrame:
    """Everything a single row can decide once its percentiles are known. Both inputs have one row a customer.

    Three columns are stored for the two rankings and meet their percentiles by value; the percentiles are stored,
    as the rows are read twice, for the contact order and for the result. The wide rows are not stored: they move
    once, by customer, where scores, mart and percentiles join.
    """
    keys = scored.select("customer_unique_id", "return_probability").join(
        rfm.select("customer_unique_id", "total_revenue"), "customer_unique_id")
    ranked = store(percentiles(store(keys, "scored")), "scored-percentiles")
    rows = scored_with_rfm(scored, rfm).join(ranked, "customer_unique_id")
    rows = rows.withColumn("value_tier", value_tier())
    rows = rows.withColumn("risk_tier", risk_tier(F.col("likelihood_pct"), cfg))
    rows = rows.withColumn("customer_group", customer_group(cfg))
    return next_best_action(rows, cfg).withColumn("priority_score", priority_score(cfg))


def add_budget_columns(df: DataFrame) -> DataFrame:
    """Contact order and running cost: by priority, then spend, then customer id.

    Only four narrow columns are stored and sorted; the unique id brings the result back to the rows, which
    are a plan over stored tables and join it where they join by customer.
    """
    order = [("priority_score", False), ("total_revenue", False), ("customer_unique_id", True)]
    narrow = store(df.select("customer_unique_id", "priority_score", "total_revenue", "action_cost_brl"), "tiered")
    scanned = ordered_scan(narrow, order, sums={"cumulative_action_cost_brl": "action_cost_brl"})
    placed = scanned.select(
        "customer_unique_id", F.col("position").alias("priority_rank"),
        F.col("cumulative_action_cost_brl").cast(TOTAL).alias("cumulative_action_cost_brl"),
    )
    return df.join(placed, "customer_unique_id").select(*df.columns, "priority_rank", "cumulative_action_cost_brl")


def decide(scored: DataFrame, rfm: DataFrame, cfg: RetentionConfig) -> DataFrame:
    return add_budget_columns(tiered(scored, rfm, cfg))


def action_slug(action: str) -> str:
    return "n_" + action.lower().replace(" ", "_").replace("-", "_")


def budget_scenarios(decided: DataFrame, budgets: tuple[int, ...]) -> DataFrame:
    """One pass: tag each customer with the smallest budget that reaches it, then accumulate the tags."""
    ladder = sorted(budgets)
    tag = None
    for step in ladder:
        hit = F.col("cumulative_action_cost_brl") <= step
        tag = F.when(hit, F.lit(step)) if tag is None else tag.when(hit, F.lit(step))
    action_counts = {
        action_slug(a): F.count_if(F.coalesce(F.col("next_best_action") == a, F.lit(False))) for a in ACTIONS
    }
    bands = decided.withColumn("budget_brl", tag).groupBy("budget_brl").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("action_cost_brl").cast(TOTAL).alias("spend"),
        F.sum("total_revenue").cast(TOTAL).alias("revenue"),
        F.count_if(F.col("value_tier") == "High").alias("high"),
        F.sum("expected_revenue_180d").alias("expected"),
        F.min("priority_score").alias("lowest"),
        *[c.alias(n) for n, c in action_counts.items()],
    )
    everything = Window.partitionBy()
    totals = bands.withColumn("all_n", F.sum("n").over(everything)).withColumn(
        "all_revenue", F.sum("revenue").over(everything)
    )
    spark = decided.sparkSession
    steps = spark.createDataFrame([(b,) for b in ladder], "step int")
    inside = F.col("budget_brl") <= F.col("step")
    summed = {"customers_reached": "n", "high_value_customers_reached": "high"} | {c: c for c in action_counts}
    money = {"spend_brl": "spend", "historical_revenue_of_reached": "revenue"}

    def within(c: str, zero) -> Column:
        return F.coalesce(F.sum(F.when(inside, F.col(c))), zero)

    return (
        totals.crossJoin(F.broadcast(steps))
        .groupBy("step")
        .agg(
            F.max("all_n").alias("all_n"),
            F.max("all_revenue").alias("all_revenue"),
            *[within(c, F.lit(0)).alias(n) for n, c in summed.items()],
            *[within(c, F.lit(0).cast(TOTAL)).cast(TOTAL).alias(n) for n, c in money.items()],
            within("expected", F.lit(0.0)).alias("expected_baseline_revenue_180d"),
            F.min(F.when(inside, F.col("lowest"))).alias("lowest_priority_score_included"),
        )
        .select(
            F.col("step").alias("budget_brl"),
            "customers_reached",
            share("customers_reached", "all_n").alias("share_of_customers"),
            "spend_brl",
            "historical_revenue_of_reached",
            share("historical_revenue_of_reached", "all_revenue").alias("share_of_historical_revenue"),
            "high_value_customers_reached",
            "expected_baseline_revenue_180d",
            "lowest_priority_score_included",
            *action_counts,
        )
    )


def retention_scores(decided: DataFrame, cfg: RetentionConfig, scored_as_of: Column | None = None) -> DataFrame:
    """The published score table: 30 columns plus scoring date and model version."""
    as_of = scored_as_of if scored_as_of is not None else F.lit(cfg.scoring_date)
    return decided.select(
        "customer_unique_id", "customer_state", "first_purchase_date", "last_purchase_date",
        half_even("recency_days", 1).alias("recency_days"),
        "order_count", "purchase_days", "total_revenue", "avg_order_value",
        half_even("tenure_days", 1).alias("tenure_days"),
        "items_per_order", "avg_review_score_observed", "had_late_delivery", "is_repeat_customer",
        "rfm_segment", "r_score", "f_score", "m_score", "activity_status", "value_tier",
        half_even("return_probability", 5).alias("return_probability"),
        half_even("expected_revenue_180d", 2).alias("expected_revenue_180d"),
        "risk_tier", "customer_group", "next_best_action", "action_reason", "action_cost_brl",
        "priority_score", "priority_rank", "cumulative_action_cost_brl",
        as_of.alias("scored_as_of"),
        F.lit(cfg.model_version).alias("model_version"),
    )


def group_summary(decided: DataFrame) -> DataFrame:
    return (
        decided.groupBy("customer_group")
        .agg(
            F.count("customer_unique_id").alias("customers"),
            F.sum("total_revenue").cast(TOTAL).alias("revenue"),
            F.avg("priority_score").alias("avg_priority"),
        )
        .orderBy(F.desc("avg_priority"))
    )


def action_counts(decided: DataFrame) -> DataFrame:
    return decided.groupBy("next_best_action").agg(F.count(F.lit(1)).alias("customers"))


def group_action_summary(scores: DataFrame) -> DataFrame:
    grouped = scores.groupBy("customer_group", "next_best_action").agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(F.sum("total_revenue").cast(TOTAL), 0).alias("historical_revenue"),
        F.round(F.avg("return_probability") * 100, 2).alias("avg_return_probability_pct"),
        F.round(F.avg("priority_score"), 1).alias("avg_priority"),
    )
    return grouped.orderBy(F.desc("avg_priority"))


def within_budget(scores: DataFrame, budget: float) -> DataFrame:
    return scores.where(F.col("cumulative_action_cost_brl") <= budget)


def priority_list(scores: DataFrame, budget: float, n: int = 50) -> DataFrame:
    return (
        within_budget(scores, budget)
        .select(
            "priority_rank", "customer_unique_id", "customer_group", "next_best_action", "action_cost_brl",
            "total_revenue", "recency_days",
            F.round(F.col("return_probability") * 100, 2).alias("return_probability_pct"),
            "priority_score", "cumulative_action_cost_brl",
        )
        .orderBy("priority_rank")
        .limit(n)
    )


def filtered_running_cost(scores: DataFrame, condition: Column) -> DataFrame:
    """Running cost along the contact order of a filtered list."""
    kept = scores.where(condition).select("customer_unique_id", "priority_rank", "action_cost_brl")
    scanned = ordered_scan(kept, [("priority_rank", True)], sums={"running_cost": "action_cost_brl"})
    return scanned.select(
        "customer_unique_id", "priority_rank", "action_cost_brl", F.col("running_cost").cast(TOTAL).alias("running_cost")
    )
