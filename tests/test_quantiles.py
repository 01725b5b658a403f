"""Quantiles and quantile groups by distributed selection, against Spark's own aggregates and windows."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrace.operators import quantiles as q
from terrace.operators.profile import describe
from terrace.plans import retail_products
from terrace.sources.staging import stage

SMALL = dict(grid=8, accuracy=20, inside=3)       # coarse brackets, many rounds
ROUGH = dict(grid=64, accuracy=2, inside=5)       # a sketch too rough for its grid: brackets that miss


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    data = []
    for k in range(2000):
        g = None if k % 7 == 0 else "hot" if k % 3 else f"g{k % 40}"   # a hot group and a null one
        v = rng.choice([None, 7.0, 7.0, 7.0, rng.gauss(0, 100), float(rng.randrange(5)), rng.random() * 1e-9])
        data.append((g, k, v, rng.randrange(1000)))
    data += [("one", 10_000, 5.0, 1), ("nulls", 10_001, None, None), ("nan", 10_002, float("nan"), 2), ("nan", 10_003, 1.0, 3)]
    return stage(spark.createDataFrame(data, "g string, k long, v double, w long").repartition(5), "rows")


@pytest.mark.parametrize("options", [{}, SMALL, ROUGH])
def test_interpolated(rows, options):
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}
    got = {r.g: r for r in q.interpolated(rows, {n: ("v", p) for n, p in shares.items()}, ["g"], **options).collect()}
    want = {r.g: r for r in rows.groupBy("g").agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in shares.items()]).collect()}
    assert set(got) == set(want) and got["nulls"].c is None
    for g in want.keys() - {"nan"}:
        for n in shares:
            assert got[g][n] == pytest.approx(want[g][n], rel=1e-12) if want[g][n] is not None else got[g][n] is None
    assert got["nan"].a == 1.0 and math.isnan(got["nan"].e)


@pytest.mark.parametrize("options", [{}, SMALL])
def test_of_the_whole_table_and_of_mixed_types(rows, options):
    got = q.interpolated(rows, {"a": ("w", 0.3), "b": ("k", 0.7), "c": ("v", 0.1)}, **options).first()
    want = rows.agg(F.percentile("w", F.lit(0.3)).alias("a"), F.percentile("k", F.lit(0.7)).alias("b"),
                    F.percentile("v", F.lit(0.1)).alias("c")).first()
    assert list(got) == pytest.approx(list(want))
    empty = q.interpolated(rows.limit(0), {"a": ("w", 0.3)}, **options).collect()
    assert [r.a for r in empty] == [None] and q.interpolated(rows.limit(0), {"a": ("w", 0.3)}, ["g"], **options).count() == 0


@pytest.mark.parametrize("options", [{}, SMALL])
def test_discrete(rows, options):
    got = {r.g: (r.m, r.n) for r in q.discrete(rows, {"m": ("w", 0.5), "n": ("w", 0.9)}, ["g"], **options).collect()}
    disc = lambda p: F.expr(f"percentile_disc({p}) within group (order by w)")
    want = {r.g: (r.m, r.n) for r in rows.groupBy("g").agg(disc(0.5).alias("m"), disc(0.9).alias("n")).collect()}
    assert got == want


def test_ranks_and_counts(rows):
    got = q.select_ranks(rows, ["g"], {"x": q.Pick("w", "n div 3")}, **SMALL).where("g = 'hot'").first()
    values = sorted(r.w for r in rows.where("g = 'hot'").collect())
    assert got.x_known == len(values) and got.x_rank == len(values) // 3 and got.x == values[got.x_rank - 1]
    assert got.x_below == sum(v < got.x for v in values) and got.x_rows == values.count(got.x)


@pytest.mark.parametrize("options,count,within", [({}, 1, ["g"]), ({}, 4, ["g"]), (SMALL, 3, ["g"]), ({}, 7, [])])
def test_tiles(rows, options, count, within):
    some = rows.where("v is not null and not isnan(v)")
    got = q.tiles(some, within, "v", "k", count, "t", **options).collect()
    want = {r.k: r.t for r in some.withColumn("t", F.ntile(count).over(Window.partitionBy(*within).orderBy("v", "k"))).collect()}
    assert {r.k: r.t for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("n", [1, 3, 9])
def test_tiles_of_few_equal_rows(spark, n):
    df = spark.range(n).select(F.col("id").alias("k"), F.lit(1).alias("g"), F.lit(2.5).alias("v"))
    got = {r.k: r.t for r in q.tiles(df, ["g"], "v", "k", 4, "t").collect()}
    assert got == {r.k: r.t for r in df.withColumn("t", F.ntile(4).over(Window.orderBy("k"))).collect()}


def test_no_value_is_lost_to_extra_columns(rows):
    clash = rows.withColumns({"rank": F.lit(1), "rows": F.lit(2), "pick": F.lit("p"), "value": F.lit(3), "known": F.lit(4), "end": F.lit(5)})
    assert q.interpolated(clash, {"m": ("v", 0.5)}, ["g"]).orderBy("g").collect()[1:3] == \
        q.interpolated(rows, {"m": ("v", 0.5)}, ["g"]).orderBy("g").collect()[1:3]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_plans_rank_nothing_as_a_whole(rows, spark):
    facts = rows.select(F.lit(2000).alias("yr"), F.coalesce("g", F.lit("r")).alias("region"), F.col("k").alias("entity_id"),
                        F.col("v").alias("context"), F.col("w").cast("double").alias("indicator"),
                        F.lit(1).alias("assessed"), F.lit(0).alias("shortfall"))
    panel = retail_products.inequality_panel(stage(facts, "facts"))
    for df in (panel, describe(rows, ["v", "w"]), q.interpolated(rows, {"m": ("v", 0.5)}, ["g"])):
        assert "percentile(" not in plan_of(df) and "percentile_disc" not in plan_of(df)
    # the only window left runs over the values inside the brackets
    assert plan_of(q.interpolated(rows, {"m": ("v", 0.5)}, ["g"])).count("Window [") == 1


def test_a_hot_group_leaves_few_rows_inside(spark):
    df = stage(spark.range(400_000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 50).alias("g"),
                                           F.rand(3).alias("v")), "hot")
    picks = {"x": q.Pick("v", "n div 2")}
    brackets = q._brackets(df, ["g"], picks, q.GRID, q.ACCURACY)
    split = q._split(df, ["g"], picks, brackets)
    assert split.where("g = 1").count() < 266_667 * 4 / q.GRID
    want = {r.g: r.x for r in df.groupBy("g").agg(F.sort_array(F.collect_list("v")).alias("l")).selectExpr(
        "g", "l[cast(floor(size(l) / 2) as int) - 1] as x").collect()}
    assert {r.g: r.x for r in q.select_ranks(df, ["g"], picks).collect()} == want
