"""Deduplication, lineage, joins and set operators (W01, P01, P02, J*, U*)."""

import hashlib
from datetime import datetime

from pyspark.sql import functions as F

from terrace.operators import dedup, enrich, lineage


def test_dedup_keeps_latest(spark):
    df = spark.createDataFrame(
        [(7, "v2", datetime(2025, 6, 2)), (7, "v1", datetime(2025, 6, 1)),
         (7, "v3", datetime(2025, 6, 3)), (8, "v1", datetime(2025, 5, 1))], "id int, v string, arrived timestamp")
    once = dedup.dedup_latest(df, ["id"])
    assert {(r.id, r.v) for r in once.collect()} == {(7, "v3"), (8, "v1")}
    assert dedup.dedup_latest(once, ["id"]).exceptAll(once).isEmpty()


def test_dedup_ties_are_decided(spark):
    rows = [(1, "b", 1), (1, "a", 1), (None, "c", 1), (None, "d", 2)]
    for n in (1, 4):
        df = spark.createDataFrame(rows, "id int, v string, t int").repartition(n)
        got = {(r.id, r.v) for r in dedup.dedup_latest(df, ["id"], "t", ["v"]).collect()}
        assert got == {(1, "a"), (None, "d")}


def test_dedup_limits_hot_keys_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = dedup.dedup_latest(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")


def test_lineage(spark):
    rows = [(1, None, "x"), (1, "", "x"), (1, "~", "x"), (11, ":x", None), (1, "1:x", ""), (1, "é", "x")]
    df = spark.createDataFrame(rows, "a int, b string, `c.d` string").withColumn("_own", F.lit(1))
    out = lineage.with_lineage(df, "e", "e.csv", "S", "r1", datetime(2026, 1, 2, 3))
    first = out.head()
    assert first._origin.row_hash == hashlib.sha256(b"1:1~1:x").hexdigest()
    assert first["_ingestion_date"] == "2026-01-02" and first._origin.entity == "e" and first._origin.at == datetime(2026, 1, 2, 3)
    # values that would read alike in a row have hashes of their own
    assert len({r._origin.row_hash for r in out.collect()}) == len(rows)
    assert lineage.drop_technical(lineage.processed(out, "r2", datetime(2026, 1, 3)), "_own").columns == ["a", "b", "c.d"]


def test_enrich_by_derived_key(spark):
    fact = spark.createDataFrame([(5512,), (6633,), (None,)], "id long")
    dim = spark.createDataFrame([(551, 0.7)], "id6 long, score double")
    out = enrich.enrich_by_expression(fact, dim, F.floor(F.col("id") / 10), "id6", ["score"])
    assert out.columns == ["id", "score"]
    assert {(r.id, r.score) for r in out.collect()} == {(5512, 0.7), (6633, None), (None, None)}


def test_foreign_key_marker(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (99, "c"), (None, "d"), (None, "d")],
                               "k int, v string")
    ref = spark.createDataFrame([(1,), (1,), (2,), (None,)], "r int")
    marked = enrich.mark_known(df, ref, "k", "r", "ok")
    assert marked.columns == ["k", "v", "ok"]
    assert sorted((r.v, r.ok) for r in marked.collect()) == [
        ("a", True), ("b", True), ("c", False), ("d", False), ("d", False)]
    assert enrich.orphans(df, ref, "k", "r").count() == 3


def test_large_reference_gives_the_same_markers(spark):
    df = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None)
        .otherwise(F.col("id") % 40).alias("k"), "id")
    ref = spark.range(30).select((F.col("id") + 5).alias("r"))
    want = enrich.mark_known(df, ref, "k", "r", "ok")
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    assert enrich.fits_broadcast(ref)
    spark.conf.set(name, "-1")
    try:
        assert not enrich.fits_broadcast(ref)
        got = enrich.mark_known(df, ref, "k", "r", "ok")
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert enrich.orphans(df, ref, "k", "r").count() == df.where(
            "k is null or k < 5 or k > 34").count()
    finally:
        spark.conf.set(name, before)


def test_null_keys_are_spread(spark):
    df = spark.range(2000).select(F.col("id"), F.lit(None).cast("long").alias("k"))
    spread = df.select(enrich.null_spread(F.col("k"), df.columns).alias("s"))
    assert spread.distinct().count() > 32


def test_compare_versions(spark):
    a = spark.createDataFrame([(1, "A", 1), (2, None, 1), (3, "C", 1), (4, None, 1)], "id int, n string, x int")
    b = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "C", 1), (4, None, 1)], "id int, n string, x int")
    out = enrich.compare_versions(a, b, ["id"], ["n"])
    assert {(r.id, r.n_before, r.n_after) for r in out.collect()} == {(1, "A", "a"), (2, None, "b")}


def test_union_and_years(spark):
    a = spark.createDataFrame([(2023, 1)], "yr int, a int")
    b = spark.createDataFrame([(2025, 2), (2023, 3)], "yr int, b int")
    assert dedup.union_parts(a, b).columns == ["yr", "a", "b"]
    assert [r.yr for r in dedup.merged_years(a, b).collect()] == [2023, 2025]
    out = dedup.drop_repeats(b.unionByName(b), "yr", [F.asc("b")])
    assert out.count() == 2


def test_current_versions_spare_single_rows_the_window(spark, tmp_path):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    single = [(k, k % 3, f"h{k}") for k in range(200)]
    repeated = [(7, 5, "a"), (7, 5, "b"), (9, 0, "z"), (None, 1, "x"), (None, 4, "y")]
    try:
        for rows, bound in ((single, "2000b"), (single + repeated, "2000b"), (single * 2, "1b"), (single, before)):
            path = f"{tmp_path}/{len(rows)}-{bound}"
            spark.createDataFrame(rows, "id long, t long, h string").write.parquet(path)
            df = spark.read.parquet(path)
            spark.conf.set(limit, bound)
            out = dedup.current_versions(df, ["id"], "t", ["h"])
            if rows is single and bound != before:
                assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
            want = dedup.dedup_latest(df, ["id"], "t", ["h"])
            assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set(limit, before)
