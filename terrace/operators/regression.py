"""Regression models over a feature table (M01-M10), on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.operators.quantiles import interpolated
from terrace.sources.staging import stage


def temporal_split(
    df: DataFrame, label: str, features: Sequence[str], train_year: int, test_year: int,
    year: str = "yr",
) -> tuple[DataFrame, DataFrame]:
    """Complete rows only, trained on one year and tested on a later one."""
    complete = df.dropna(subset=[label, *features])
    return complete.where(F.col(year) == train_year), complete.where(F.col(year) == test_year)


def _assembled(features: Sequence[str], estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"),
                            estimator])


def fit_ridge(train: DataFrame, label: str, features: Sequence[str], alpha: float = 1.0) -> PipelineModel:
    """Ridge with penalty ``alpha`` on the summed squared error.

    Spark ML minimises the halved mean squared error of a label scaled by its
    standard deviation, hence ``alpha * sd / n``; the normal-equation solver
    needs one pass over the data.
    """
    n, sd = train.agg(F.count(F.lit(1)), F.stddev_pop(label)).head()
    lr = LinearRegression(
        labelCol=label, regParam=alpha * (sd or 0.0) / max(n, 1), elasticNetParam=0.0,
        standardization=False, solver="normal")
    return _assembled(features, lr).fit(train)


def fit_gbt(
    train: DataFrame, label: str, features: Sequence[str], trees: int = 300, depth: int = 3,
    rate: float = 0.05, seed: int = 42,
) -> PipelineModel:
    """Gradient-boosted trees; lineage is cut every ten trees in the shared folder."""
    gbt = GBTRegressor(
        labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed,
        checkpointInterval=10)
    return _assembled(features, gbt).fit(train)


def regression_metrics(df: DataFrame, label: str, prediction: str, digits: int = 6) -> DataFrame:
    """Rows, R2 and mean absolute error in one aggregate."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    total = F.var_pop(y) * F.count(y)
    return df.where(y.isNotNull() & p.isNotNull()).agg(
        F.count(y).alias("rows"),
        F.round(F.lit(1.0) - F.try_divide(F.sum((y - p) * (y - p)), total), digits).alias("r2"),
        F.round(F.avg(F.abs(y - p)), digits).alias("mae"))


def model_comparison(scored: dict[str, DataFrame], label: str, prediction: str = "prediction") -> DataFrame:
    """One metric row per model."""
    rows = [
        regression_metrics(df, label, prediction).select(F.lit(name).alias("model"), "*")
        for name, df in scored.items()
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def importance_frame(df: DataFrame, model: PipelineModel, features: Sequence[str], top: int = 12) -> DataFrame:
    """The largest feature importances (one row per feature, a fixed-size result)."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature").limit(top)


def what_if(
    df: DataFrame, context: str, volume: str, shortfall: str, points: float, entity: str,
    by: Sequence[str],
) -> DataFrame:
    """Per period, the rows at or under the interpolated first quartile of
    ``context``, and what they would gain from ``points`` percentage points."""
    known = df.where(F.col(context).isNotNull())
    cut = interpolated(known, {"cut": (context, 0.25)}, by)
    cut = stage(cut.select(*[F.col(b).alias(f"__{b}") for b in by], "cut"), "cuts")
    low = known.join(cut, [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by]).where(
        F.col(context) <= F.col("cut"))
    return low.groupBy(*by).agg(
        F.count(F.lit(1)).alias("entities"),
        F.sum(volume).alias(volume),
        F.sum(shortfall).alias(shortfall),
        F.round(F.sum(volume) * F.lit(float(points)) / 100.0, 1).alias("gain"))
