"""Return-likelihood model: standardised, L2-regularised logistic regression and simple rules."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import MODEL_FEATURES
from tidemark.operators.ordered import attach, value_ranks
from tidemark.sources.scratch import store


@dataclass(frozen=True)
class ReturnModel:
    """A fitted model is a few dozen numbers, so scoring is one codegen expression."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def standardised(self) -> list[Column]:
        return [
            ((F.col(f) - F.lit(m)) / F.lit(s)).alias(f)
            for f, m, s in zip(self.features, self.means, self.scales, strict=True)
        ]

    def margin(self) -> Column:
        total = F.lit(self.intercept)
        for weight, value in zip(self.coefficients, self.standardised(), strict=True):
            total = total + F.lit(weight) * value
        return total

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))


class FitError(ValueError):
    """Nothing to fit: no rows, or the loss does not fall any further although it is not flat."""


def moment_sums(rows: DataFrame, shell: ReturnModel, label: str = "label") -> dict[str, float]:
    """Loss, gradient and normal matrix at the model's weights: sums of one aggregate, whatever the rows.

    Index 0 is the intercept; ``h_i_j`` (j <= i) are the entries of X'WX and ``g_i`` those of X'(y - p).
    """
    margin, inputs = shell.margin(), [F.lit(1.0), *shell.standardised()]
    names = [f"x{i}" for i in range(len(inputs))]
    at = rows.select(F.col(label).alias("y"), margin.alias("m"), *[x.alias(n) for n, x in zip(names, inputs, strict=True)])
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("m")))
    at = at.select("*", p.alias("p")).select("*", (F.col("p") * (1 - F.col("p"))).alias("w"), (F.col("y") - F.col("p")).alias("r"))
    # log(1 + e^m) - y m, written so that neither sign of m overflows.
    loss = F.log1p(F.exp(-F.abs("m"))) + F.greatest("m", F.lit(0.0)) - F.col("y") * F.col("m")
    sums = [F.sum(loss).alias("loss"), F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives")]
    for i, x in enumerate(names):
        sums.append(F.sum(F.col("r") * F.col(x)).alias(f"g_{i}"))
        sums += [F.sum(F.col("w") * F.col(x) * F.col(names[j])).alias(f"h_{i}_{j}") for j in range(i + 1)]
    return at.agg(*sums).first().asDict()


def newton_step(sums: dict[str, float], weights: list[float], penalty: float) -> list[float]:
    """Solve (X'WX + penalty) d = X'(y - p) - penalty w by Cholesky; the intercept bears no penalty."""
    size = len(weights)
    below = np.array([[sums[f"h_{max(i, j)}_{min(i, j)}"] for j in range(size)] for i in range(size)])
    ridge = np.full(size, penalty)
    ridge[0] = 0.0
    gradient = np.array([sums[f"g_{i}"] for i in range(size)]) - ridge * weights
    root = np.linalg.cholesky(below + np.diag(ridge))
    return np.linalg.solve(root.T, np.linalg.solve(root, gradient)).tolist()


def fit_return_model(
    train: DataFrame, label: str = "returned", c: float = 1.0, max_iter: int = 50, features: tuple[str, ...] = MODEL_FEATURES,
) -> ReturnModel:
    """Minimise summed log loss + |w|^2 / (2c) on inputs scaled by the population deviation.

    Newton's method, one aggregate over the stored rows per step; the number of steps does not
    depend on the rows. A step that does not lower the loss is halved. When everybody
    or nobody returned, the weights are 0 and the probability is 1 or 0. NULL features are
    not allowed, a feature without variation gets scale 1.
    """
    rows = store(train.select(*features, F.col(label).cast("double").alias("label")), "train")
    stats = rows.agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"),
        *[F.avg(f).alias(f"mean_{f}") for f in features],
        *[F.stddev_pop(f).alias(f"std_{f}") for f in features],
    ).first()
    if not stats["n"]:
        raise FitError("no rows to fit")
    means = tuple(float(stats[f"mean_{f}"]) for f in features)
    scales = tuple(float(stats[f"std_{f}"]) or 1.0 for f in features)

    def model_of(weights: list[float]) -> ReturnModel:
        return ReturnModel(features, means, scales, tuple(weights[1:]), weights[0])

    def total(sums: dict[str, float], weights: list[float]) -> float:
        return sums["loss"] + sum(w * w for w in weights[1:]) / (2 * c)

    weights = [0.0] * (len(features) + 1)
    if stats["positives"] in (0, stats["n"]):
        return model_of([math.inf if stats["positives"] else -math.inf, *weights[1:]])
    sums = moment_sums(rows, model_of(weights))
    for _ in range(max_iter):
        step = newton_step(sums, weights, 1.0 / c)
        if max(map(abs, step)) < 1e-11:
            break
        for halving in range(40):
            tried = [w + d / 2**halving for w, d in zip(weights, step, strict=True)]
            found = moment_sums(rows, model_of(tried))
            if total(found, tried) <= total(sums, weights) * (1 + 1e-12):
                break
        else:
            raise FitError("the loss does not fall along the step")
        weights, sums = tried, found
    return model_of(weights)


def predict_return(model: ReturnModel, features: DataFrame) -> DataFrame:
    return features.withColumn("return_probability", model.probability())


def coefficient_table(spark: SparkSession, model: ReturnModel) -> DataFrame:
    rows = [
        (f, w, s, math.exp(w), "more likely to return" if w > 0 else "less likely to return")
        for f, w, s in zip(model.features, model.coefficients, model.scales, strict=True)
    ]
    rows.sort(key=lambda r: -abs(r[1]))
    return spark.createDataFrame(
        rows,
        "feature string, coefficient double, feature_std double, odds_ratio_per_sd double, direction string",
    )


def coefficient_stability(final: DataFrame, earlier: DataFrame) -> DataFrame:
    """Does each effect point the same way in the fit on the earlier snapshots alone?"""
    before = earlier.select("feature", F.col("odds_ratio_per_sd").alias("odds_ratio_train_only"))
    same = (F.col("odds_ratio_per_sd") - 1) * (F.col("odds_ratio_train_only") - 1) > 0
    return final.join(F.broadcast(before), "feature").withColumn("stable_direction", same)


def rule_recency(features: DataFrame) -> DataFrame:
    return features.withColumn("score", -F.col("recency_days"))


def rule_rfm(features: DataFrame) -> DataFrame:
    """Mean of three average-tie percentiles; purchase days have five values, the others many."""
    fresh = features.withColumn("_freshness", -F.col("recency_days"))
    out = fresh
    for key, name, bounded in (("_freshness", "_r", False), ("purchase_days", "_f", True), ("monetary", "_m", False)):
        out = attach(out, value_ranks(fresh.select(key), key, bounded=bounded), key, bounded, **{name: "pct_rank"})
    score = (F.col("_r") + F.col("_f") + F.col("_m")) / 3
    return out.withColumn("score", score).select(*features.columns, "score")


def rule_random(features: DataFrame, seed: int = 0) -> DataFrame:
    """Uniform in [0, 1) from a hash of the person, the same under any partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("customer_unique_id")).cast("binary"))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return features.withColumn("score", number / F.lit(4294967296.0))
