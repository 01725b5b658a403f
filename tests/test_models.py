"""Models over a feature table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.operators import regression
from terrace.plans import model_queries  # noqa: F401  (registers its queries)
from terrace.plans.registry import QUERIES


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    rows = []
    for yr in (2024, 2025):
        for i in range(200):
            a, b = float(rng.normal(50, 15)), float(rng.normal(0, 1))
            rows.append((yr, i, a + 4 * b + float(rng.normal(0, 3)), a, b))
    rows.append((2024, 999, None, 1.0, 1.0))
    rows.append((2025, 999, 1.0, None, 1.0))
    return spark.createDataFrame(rows, "yr int, id int, label double, a double, b double").cache()


@pytest.fixture(scope="module")
def split(data):
    return regression.temporal_split(data, "label", ["a", "b"], 2024, 2025)


def test_split_drops_incomplete_rows(split):
    train, test = split
    assert (train.count(), test.count()) == (200, 200)


@pytest.mark.parametrize("alpha", [1.0, 500.0])
def test_ridge_equals_closed_form(split, alpha):
    train, _ = split
    model = regression.fit_ridge(train, "label", ["a", "b"], alpha).stages[-1]
    p = train.toPandas()
    x, y = p[["a", "b"]].to_numpy(), p["label"].to_numpy()
    xc = x - x.mean(axis=0)
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(2), xc.T @ (y - y.mean()))
    assert model.coefficients.toArray() == pytest.approx(w, rel=1e-6)
    assert model.intercept == pytest.approx(y.mean() - x.mean(axis=0) @ w, rel=1e-6)


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0), (None, 1.0)], "y double, p double")
    row = regression.regression_metrics(df, "y", "p").head()
    y, p = np.array([1.0, 2.0, 4.0]), np.array([1.5, 2.0, 3.0])
    assert row["rows"] == 3 and row.mae == 0.5
    assert row.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-6)


def test_comparison_and_importances(split):
    train, test = split
    trees = regression.fit_gbt(train, "label", ["a", "b"], trees=15, rate=0.3)
    scored = {"trees": trees.transform(test), "lag": test.withColumn("prediction", F.col("a")),
              "ridge": regression.fit_ridge(train, "label", ["a", "b"]).transform(test)}
    rows = {r.model: r for r in regression.model_comparison(scored, "label").collect()}
    assert rows["ridge"].r2 > rows["lag"].r2 and rows["trees"].r2 > 0.7
    top = regression.importance_frame(train, trees, ["a", "b"]).collect()
    assert top[0].feature == "a" and sum(r.importance for r in top) == pytest.approx(1.0)


def test_what_if(spark):
    df = spark.createDataFrame(
        [(2024, i, float(i), 100, 40) for i in range(9)] + [(2024, 9, None, 7, 7)],
        "yr int, entity_id long, context double, assessed long, shortfall long")
    row = regression.what_if(df, "context", "assessed", "shortfall", 3.3, "entity_id", ["yr"]).head()
    # the interpolated first quartile of 0..8 is 2.0
    assert (row.entities, row.assessed, row.shortfall, row.gain) == (3, 300, 120, 9.9)


def test_registered_models_fit_all_trees(spark, sf_dir, monkeypatch):
    fit, seen = regression._assembled, []

    def short(features, estimator):
        if estimator.hasParam("maxIter") and estimator.hasParam("stepSize"):
            seen.append(estimator.getMaxIter())
            estimator.setMaxIter(1)
        return fit(features, estimator)

    monkeypatch.setattr(regression, "_assembled", short)
    for name in ("model_comparison", "importances", "leaky_model"):
        QUERIES[name](spark, sf_dir)
    assert seen == [300, 300, 300]
