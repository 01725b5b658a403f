"""Products on small literal tables."""

import pytest
from pyspark.sql import functions as F

from terrace.functions.columns import LeakageError
from terrace.operators import products as parts
from terrace.plans import retail_products as products

DIM = [
    (1, "Ana", 10, "N1", "R1", 0.9), (2, "Bia", 10, "N1", "R1", 0.1),
    (3, "Caio", 20, "N2", "R1", 0.5), (4, "Dora", 20, "N2", "R2", None)]
FACT = [
    (2023, 1, 10, 7, 70.0, 65.0), (2023, 2, 10, 6, 65.2, 65.0), (2023, 3, 10, 6, 60.0, 65.0),
    (2023, 4, 10, None, None, 65.0), (2024, 1, 10, 8, 80.0, None), (2024, 3, 20, 16, 80.0, 70.0),
    (2024, 99, 5, 5, 100.0, 70.0), (2026, 1, 10, 9, 90.0, 70.0)]


@pytest.fixture(scope="module")
def view(spark):
    dim = spark.createDataFrame(
        DIM, "entity_id long, entity_name string, group_id long, group_name string, region string, "
             "context double")
    dim = dim.withColumns({
        "size_class": F.lit("SMALL"), "context_available": F.col("context").isNotNull()})
    fact = spark.createDataFrame(
        FACT, "yr long, entity_id long, assessed long, successes long, indicator double, "
              "target double")
    fact = fact.withColumn("gap", F.round(F.col("indicator") - F.col("target"), 1))
    return products.ranked_view(products.entity_facts(fact, dim)).cache()


def test_entity_view(view):
    rows = {(r.yr, r.entity_id): r for r in view.collect()}
    assert (2024, 99) not in rows and len(rows) == 7
    assert [rows[2023, i].status for i in (1, 2, 3, 4)] == ["ABOVE", "ON", "BELOW", "BELOW"]
    assert [rows[2023, i].band for i in (1, 2, 3, 4)] == ["ADEQUATE"] * 3 + ["ADVANCED"]
    assert [rows[2023, i].rank_all for i in (1, 2, 3, 4)] == [1, 2, 3, 4]
    assert [rows[2023, i].rank_group for i in (1, 2, 3, 4)] == [1, 2, 1, 2]
    assert rows[2024, 1].rank_all == 1 and rows[2024, 3].rank_all == 2
    assert rows[2023, 1].shortfall == 3 and rows[2023, 4].shortfall is None


def test_target_vs_actual(spark, view):
    published = spark.createDataFrame(
        [(2023, 10, 66.0, 65.0), (2023, 20, None, 65.0), (2024, 10, None, None)],
        "yr long, group_id long, published double, target double")
    rows = {(r.yr, r.group_id): r for r in products.target_vs_actual(view, published).collect()
            if (r.yr, r.group_id) != (2023, 20) or r.region == "R1"}
    first = rows[2023, 10]
    assert (first.assessed, first.successes, first.computed) == (20, 13, 65.0)
    assert (first.divergence, first.indicator, first.gap, first.status) == (-1.0, 66.0, 1.0, "ABOVE")
    assert first.entities == 2 and first.entities_below == 0 and first.context_mean == 0.5
    assert rows[2023, 20].indicator == rows[2023, 20].computed == 60.0
    # no published row at all: kept, without target, and the null gap reads BELOW
    assert rows[2024, 20].target is None and rows[2024, 20].status == "BELOW"


def test_time_evolution_keeps_future_years(spark, view):
    national = spark.createDataFrame(
        [(2023, 60.0, 64.0), (2024, 65.0, None), (2030, 80.0, None)],
        "yr long, target double, published double")
    rows = {r.yr: r for r in products.national_evolution(national, view).collect()}
    assert rows[2023].entities == 4 and rows[2023].change is None
    assert rows[2024].computed == 80.0 and rows[2024].change == 16.0
    assert rows[2024].distance_to_goal == 0.0 and rows[2024].gap == 15.0
    assert rows[2030].assessed is None and rows[2030].indicator is None


def test_panel_leaves_out_missing_context(view):
    rows = products.inequality_panel(view).collect()
    assert sum(r.entities for r in rows) == 6
    first = {r.quartile: r for r in rows if r.yr == 2023}
    assert [first[q].context_mean for q in (1, 2, 3)] == [0.1, 0.5, 0.9]
    assert first[1].quartile_label == "1 - lowest" and 4 not in first


def test_lag_features(view):
    rows = {(r.yr, r.entity_id): r for r in products.features(view).collect()}
    assert rows[2023, 1].indicator_lag1 is None
    assert rows[2024, 1].indicator_lag1 == 70.0 and rows[2024, 1].change_lag1 is None
    assert rows[2026, 1].indicator_lag1 == 80.0 and rows[2026, 1].change_lag1 == 10.0
    aware = {(r.yr, r.entity_id): r for r in products.features(view, gap_aware=True).collect()}
    assert aware[2026, 1].indicator_lag1 is None and aware[2024, 1].assessed_lag1 == 10


def test_lag_features_refuse_leaks(view):
    with pytest.raises(LeakageError):
        products.features(view, context=["context", "assessed"])


def test_ranking_product(view):
    out = products.ranking(view, 1).collect()
    assert {(r.yr, r.side, r.entity_id) for r in out} == {
        (2023, "BEST", 1), (2023, "WORST", 4), (2024, "BEST", 1), (2024, "WORST", 3),
        (2026, "BEST", 1)}


def test_means_are_of_the_values_as_they_are(spark):
    df = spark.createDataFrame([(1, 0.785), (1, 0.784), (1, 0.004), (2, 1e17), (2, 3e17), (3, None), (4, -0.25)], "k int, x double")
    rows = {r.k: r.m for r in parts.totals(df, ["k"], means={"m": ("x", 3)}).collect()}
    assert rows == {1: 0.524, 2: 2e17, 3: None, 4: -0.25}


def test_medians_are_exact(spark):
    df = spark.range(30001).select((F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("x"))
    for r in parts.totals(df, ["k"], medians={"m": ("x", 1)}).collect():
        values = [v for v in range(30001) if v % 7 == r.k]
        assert r.m == values[(len(values) - 1) // 2]


def test_banned_columns_follow_from_the_derivations():
    derived = {"y": ("a", "b"), "z": ("y", "c"), "w": ("z",), "u": ("a", "b"), "v": ("c",), "q": ("a", "c")}
    assert parts.known_with("y", derived) == {"a", "b", "z", "u", "w"}
