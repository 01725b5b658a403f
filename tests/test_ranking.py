"""Ranks, quantile groups and extremes."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrace.operators.ranking import rank_extremes, rank_within
from terrace.sources.staging import stage


@pytest.fixture(scope="module")
def skewed(spark):
    """Most rows in one group, a third of them with one value, some nulls, one null group."""
    i = F.col("id")
    value = (
        F.when(i % 3 == 0, 50.0)
        .when(i % 17 == 0, None)
        .when(i % 5 == 0, F.round(F.pmod(F.xxhash64("id"), F.lit(7)).cast("double"), 0))
        .otherwise(F.round(F.pmod(F.xxhash64("id"), F.lit(100000)) / 1000.0, 2))
    )
    group = F.when(i % 50 == 1, 2).when(i % 50 == 2, None).otherwise(1)
    df = spark.range(6000).select(
        group.alias("g"), F.lit(1).alias("h"), value.alias("v"), (i * 7 % 6000).alias("k"))
    return stage(df, "skewed")


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("above", [40, 700, 10_000])
def test_rank_equals_window(skewed, descending, above):
    got = rank_within(skewed, ["g", "h"], "v", "k", "r", descending, "n", split_above=above)
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    w = Window.partitionBy("g", "h").orderBy(order, "k")
    want = skewed.withColumns({
        "r": F.row_number().over(w).cast("long"),
        "n": F.count("*").over(Window.partitionBy("g", "h"))})
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_no_cell_holds_a_hot_group(skewed):
    """The final window runs over cells, not over the group."""
    ranked = rank_within(skewed, ["g"], "v", "k", "r", split_above=100)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "__tc" in plan and "__vc" in plan


def test_extremes_overlap_when_few(spark):
    df = spark.createDataFrame([(2000, i) for i in range(1, 6)] + [(2001, i) for i in range(1, 9)],
                               "yr int, rank_all long")
    out = {(r.yr, r.rank_all): r.side for r in rank_extremes(df, 3).collect()}
    # five rows, k = 3: ranks up to 3 are BEST, the others WORST
    assert [out.get((2000, i)) for i in range(1, 6)] == ["BEST"] * 3 + ["WORST"] * 2
    assert [out.get((2001, i)) for i in (1, 3, 4, 5, 6, 8)] == [
        "BEST", "BEST", None, None, "WORST", "WORST"]
