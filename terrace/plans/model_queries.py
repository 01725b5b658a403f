"""Queries on regression models over the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.operators import regression
from terrace.plans import retail_products as products
from terrace.plans.gold_queries import facts
from terrace.plans.registry import query, with_model
from terrace.sources.staging import stage

FEATURES = ["indicator_lag1", "agreed_target", "context", "assessed_lag1"]
TRAIN_YEAR, TEST_YEAR = 2000, 2001


def split(spark, sf_dir):
    features = stage(products.features(facts(spark, sf_dir)[0]), "features")
    return regression.temporal_split(features, "label", FEATURES, TRAIN_YEAR, TEST_YEAR)


_FEATURES_SQL = """
f as (
  select yr, entity_id, indicator as label, lag(indicator) over w as indicator_lag1,
         target as agreed_target, context, lag(assessed) over w as assessed_lag1
  from view0 window w as (partition by entity_id order by yr)),
ok as (
  select * from f where label is not null and indicator_lag1 is not null
    and agreed_target is not null and context is not null and assessed_lag1 is not null)
"""


def _metrics_sql(label: str, prediction: str, source: str) -> str:
    return f"""select count(*) as rows,
      round(1 - sum(({label} - {prediction}) * ({label} - {prediction}))
                / (var_pop({label}) * count(*)), 6) as r2,
      round(avg(abs({label} - {prediction})), 6) as mae from {source}"""


@query("model_metrics", with_model(
    _metrics_sql("label", "indicator_lag1", "ok where yr = 2001"), _FEATURES_SQL))
def model_metrics(spark, sf_dir):
    """Last year's value as the prediction."""
    _, test = split(spark, sf_dir)
    return regression.regression_metrics(test, "label", "indicator_lag1")


# Ridge on two features solved by its 2x2 normal equations.
_RIDGE = """
tr as (select label as y, indicator_lag1 as a, context as b from f
       where yr = 2000 and label is not null and indicator_lag1 is not null and context is not null),
m as (select avg(y) as my, avg(a) as ma, avg(b) as mb from tr),
s as (select sum((a - ma) * (a - ma)) + 1.0 as saa, sum((b - mb) * (b - mb)) + 1.0 as sbb,
             sum((a - ma) * (b - mb)) as sab, sum((a - ma) * (y - my)) as say,
             sum((b - mb) * (y - my)) as sby, max(my) as my, max(ma) as ma, max(mb) as mb
      from tr, m),
co as (select (say * sbb - sby * sab) / (saa * sbb - sab * sab) as wa,
              (sby * saa - say * sab) / (saa * sbb - sab * sab) as wb, my, ma, mb from s),
pr as (select label as y, my + wa * (indicator_lag1 - ma) + wb * (context - mb) as p
       from f, co where yr = 2001 and label is not null and indicator_lag1 is not null
       and context is not null)
"""


@query("ridge", with_model(_metrics_sql("y", "p", "pr"), _FEATURES_SQL + "," + _RIDGE))
def ridge(spark, sf_dir):
    """Ridge on the lag and the context, trained a year before the test."""
    features = stage(products.features(facts(spark, sf_dir)[0]), "features")
    columns = ["indicator_lag1", "context"]
    train, test = regression.temporal_split(features, "label", columns, TRAIN_YEAR, TEST_YEAR)
    model = regression.fit_ridge(train, "label", columns)
    return regression.regression_metrics(model.transform(test), "label", "prediction")


@query("model_comparison")
def model_comparison(spark, sf_dir):
    """Ridge, boosted trees and the lag baseline on the same test year."""
    train, test = split(spark, sf_dir)
    scored = {
        "ridge": regression.fit_ridge(train, "label", FEATURES).transform(test),
        "boosted_trees": regression.fit_gbt(train, "label", FEATURES).transform(test),
        "lag_baseline": test.withColumn("prediction", F.col("indicator_lag1")),
    }
    return regression.model_comparison(scored, "label")


@query("importances")
def importances(spark, sf_dir):
    """M08, T08."""
    train, _ = split(spark, sf_dir)
    model = regression.fit_gbt(train, "label", FEATURES)
    return regression.importance_frame(train, model, FEATURES)


@query("leaky_model")
def leaky_model(spark, sf_dir):
    """Fitted and scored on the columns its label is computed from."""
    rows = stage(facts(spark, sf_dir)[0].where(F.col("yr") == TRAIN_YEAR).select(
        F.col("indicator").alias("label"), "successes", "assessed"), "leaky")
    model = regression.fit_gbt(rows, "label", ["successes", "assessed"])
    return regression.regression_metrics(model.transform(rows), "label", "prediction")
