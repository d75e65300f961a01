"""Ranking metrics for several models at once, from one ordered scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import share
from tidemark.operators.ordered import ordered_scan


def long_scores(scored: dict[str, DataFrame], probability_of: str | None = None) -> DataFrame:
    """Stack (model, customer, y, score, proba); proba only for the probabilistic model."""
    out = None
    for name, df in scored.items():
        proba = F.col("score") if name == probability_of else F.lit(None).cast("double")
        part = df.select(
            F.lit(name).alias("model"), "customer_unique_id",
            F.col("returned").cast("long").alias("y"),
            F.col("score").cast("double").alias("score"), proba.alias("proba"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def ranked_scores(long: DataFrame) -> DataFrame:
    """Best score first within each model, equal scores by customer; with running positives."""
    order = [("score", False), ("customer_unique_id", True)]
    return ordered_scan(long, order, group=["model"], sums={"positives": "y"})


def score_steps(ranked: DataFrame) -> DataFrame:
    """One row per distinct (model, score): size, positives, and both counted from the top."""
    return ranked.groupBy("model", "score").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("y").alias("pos"),
        F.max("position").alias("n_through"),
        F.max("positives").alias("pos_through"),
    )


def model_sizes(long: DataFrame) -> DataFrame:
    return long.groupBy("model").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("y").alias("returned"),
        F.avg(F.pow(F.col("y") - F.col("proba"), F.lit(2))).alias("brier_score"),
        F.count("proba").alias("with_proba"),
    )


def auc_and_precision(steps: DataFrame, sizes: DataFrame) -> DataFrame:
    """Tie-aware ROC AUC and step-wise average precision per model.

    A positive beats every negative ranked after its tie and half of those in it.
    """
    negatives = F.col("customers") - F.col("returned")
    neg_here = F.col("n") - F.col("pos")
    neg_after = negatives - (F.col("n_through") - F.col("pos_through"))
    won = F.col("pos") * (neg_after + neg_here / 2)
    step = F.col("pos") * F.col("pos_through") / F.col("n_through")
    return (
        steps.join(F.broadcast(sizes), "model")
        .groupBy("model")
        .agg(
            share(F.sum(won), F.max(F.col("returned") * negatives)).alias("roc_auc"),
            share(F.sum(step), F.max("returned")).alias("pr_auc"),
        )
    )


def top_share(ranked: DataFrame, sizes: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Lift and capture when contacting the best-scored share of customers."""
    rows = ranked.join(F.broadcast(sizes.select("model", "customers", "returned")), "model")
    picks = []
    for name, portion in shares.items():
        quota = F.greatest(F.rint(F.col("customers") * portion), F.lit(1.0))
        hit = F.col("position") <= quota
        picks += [F.count_if(hit).alias(f"{name}_n"), F.sum(F.when(hit, F.col("y"))).alias(f"{name}_y")]
    base = rows.groupBy("model").agg(F.max("customers").alias("c"), F.max("returned").alias("r"), *picks)
    out = []
    for name in shares:
        rate = share(f"{name}_y", f"{name}_n")
        out.append(share(rate, share("r", "c")).alias(f"lift_top_{name}"))
        out.append(share(f"{name}_y", "r").alias(f"capture_top_{name}"))
    return base.select("model", *out)


def evaluate(long: DataFrame, ranked: DataFrame | None = None) -> DataFrame:
    ranked = ranked if ranked is not None else ranked_scores(long)
    # The scan stored its rows, so every metric below reads those instead of the models.
    sizes = model_sizes(ranked)
    curves = auc_and_precision(score_steps(ranked), sizes)
    tops = top_share(ranked, sizes, {"10pct": 0.10, "20pct": 0.20})
    base = share("returned", "customers")
    has_proba = F.col("with_proba") > 0
    return sizes.join(curves, "model").join(tops, "model").select(
        "model", "customers", "returned", base.alias("base_rate"),
        "roc_auc", "pr_auc", "lift_top_10pct", "capture_top_10pct", "lift_top_20pct", "capture_top_20pct",
        "brier_score", F.when(has_proba, base * (1 - base)).alias("brier_score_baseline"),
    )


def deciles(scored: DataFrame, score: str = "score") -> DataFrame:
    """Ten equal groups by descending score; edges as for interpolated quantile cuts of 1..N."""
    ranked = ordered_scan(scored, [(score, False), ("customer_unique_id", True)])
    spread = F.ceil(F.lit(10) * (F.col("position") - 1) / F.nullif(F.col("position_total") - 1, F.lit(0)))
    bounded = F.least(F.lit(10), F.greatest(F.lit(1), F.coalesce(spread, F.lit(1))))
    return ranked.withColumn("decile", bounded.cast("int"))


def decile_table(scored: DataFrame, score: str = "score", label: str = "returned") -> DataFrame:
    table = deciles(scored, score).groupBy("decile").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(label).alias("returned"),
        F.avg(score).alias("predicted_rate"),
    )
    so_far = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    all_y, all_n = F.sum("returned").over(everything), F.sum("customers").over(everything)
    rate = share("returned", "customers")
    return table.select(
        "decile", "customers", "returned", "predicted_rate", rate.alias("actual_rate"),
        share(rate, share(all_y, all_n)).alias("lift"),
        share(F.sum("returned").over(so_far), all_y).alias("cumulative_capture"),
    )
