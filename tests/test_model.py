"""The logistic fit: Newton's steps against another solver, edge cases and a planted signal."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import evaluation, model

FEATURES = ("a", "b", "c")


def frame(spark, x, y):
    rows = [(f"u{i:04}", *map(float, row), int(label)) for i, (row, label) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "customer_unique_id string, a double, b double, c double, returned int")


@pytest.fixture(scope="module")
def signal(spark):
    """Returning depends on the first two features."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(900, 3)) * [3.0, 0.5, 10.0] + [5.0, 0.0, -20.0]
    p = 1 / (1 + np.exp(-(-2.0 + 0.5 * (x[:, 0] - 5) - 2.0 * x[:, 1])))
    return frame(spark, x, rng.random(900) < p).repartition(5)


def test_same_minimum_as_the_library_solver(signal):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    fitted = model.fit_return_model(signal, c=2.0, features=FEATURES)
    scaled = signal.select(F.col("returned").cast("double").alias("label"), *fitted.standardised())
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(scaled)
    other = LogisticRegression(regParam=1 / (2.0 * 900), maxIter=500, tol=1e-12, standardization=False).fit(vectors)
    assert np.allclose(other.coefficients.toArray(), fitted.coefficients, atol=1e-5)
    assert abs(other.intercept - fitted.intercept) < 1e-5


def test_partitioning_does_not_matter(signal):
    one, two = (model.fit_return_model(signal.repartition(n), features=FEATURES) for n in (1, 7))
    assert np.allclose([one.intercept, *one.coefficients], [two.intercept, *two.coefficients], atol=1e-11)


def test_loss_is_flat_at_the_fit(signal):
    fitted = model.fit_return_model(signal, features=FEATURES)
    rows = signal.select(F.col("returned").alias("label"), *FEATURES)
    sums = model.moment_sums(rows, fitted)
    assert abs(sums["g_0"]) < 1e-9
    assert all(abs(sums[f"g_{i}"] - w) < 1e-9 for i, w in enumerate(fitted.coefficients, 1))


def test_a_planted_signal_beats_chance(signal):
    scored = model.predict_return(model.fit_return_model(signal, features=FEATURES), signal).withColumnRenamed("return_probability", "score")
    found = evaluation.evaluate(evaluation.long_scores({"fitted": scored, "random": model.rule_random(signal)}, "fitted"))
    auc = {r.model: r.roc_auc for r in found.collect()}
    assert auc["fitted"] > 0.75 and auc["fitted"] > auc["random"] + 0.15


def test_separable_rows_and_far_outliers_still_converge(spark):
    x = np.array([[k, k % 2, 0.0] for k in range(40)], float)
    x[0, 0] = -1e6
    fitted = model.fit_return_model(frame(spark, x, x[:, 0] >= 20), c=100.0, features=FEATURES)
    rows = frame(spark, x, x[:, 0] >= 20).select(F.col("returned").alias("label"), *FEATURES)
    sums = model.moment_sums(rows, fitted)
    assert all(abs(sums[f"g_{i}"] - w / 100) < 1e-8 for i, w in enumerate(fitted.coefficients, 1))
    # The feature without variation has scale 1 and no weight.
    assert fitted.scales[2] == 1.0 and fitted.coefficients[2] == 0.0


@pytest.mark.parametrize(("label", "probability"), [(0, 0.0), (1, 1.0)])
def test_one_class_only(spark, label, probability):
    rows = frame(spark, np.arange(12.0).reshape(4, 3), [label] * 4)
    fitted = model.fit_return_model(rows, features=FEATURES)
    assert fitted.coefficients == (0.0, 0.0, 0.0) and math.isinf(fitted.intercept)
    assert {r.return_probability for r in model.predict_return(fitted, rows).collect()} == {probability}


def test_nothing_to_fit(spark):
    with pytest.raises(model.FitError, match="no rows"):
        model.fit_return_model(frame(spark, np.zeros((1, 3)), [1]).where("a > 0"), features=FEATURES)
