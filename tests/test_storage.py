"""Sources, sinks and catalog."""

import re

import pytest
from pyspark.sql import functions as F

from terrace import session
from terrace.sources import staging, tables
from terrace.sources.schemas import SCHEMAS, schema


def test_csv_scan(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,name,v\n1,São Paulo,2.5\nx,b,oops\n")
    s = schema(id="int", name="string", v="double")
    rows = tables.scan_csv(spark, str(path), s).collect()
    assert [tuple(r) for r in rows] == [(1, "São Paulo", 2.5), (None, "b", None)]


def test_reordered_header_raises(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("name,id\nx,1\n")
    s = schema(id="int", name="string")
    with pytest.raises(Exception, match="header"):
        tables.scan_csv(spark, str(path), s).collect()


def test_missing_source(spark, tmp_path):
    with pytest.raises(tables.MissingSourceError, match="run the download"):
        tables.scan_csv(spark, f"{tmp_path}/none.csv", SCHEMAS["region"], "run the download")


def test_external_csv_drops_the_byte_order_mark(spark, tmp_path):
    path = tmp_path / "states.csv"
    path.write_bytes("﻿code,uf,extra\n12,AC,1\n11,RO,2\n".encode())
    out = tables.read_external_csv(spark, str(path), {"code": "id", "uf": "code"},
                                   {"id": "int", "code": "string"}, "OFFICE", "id")
    assert [tuple(r) for r in out.collect()] == [(11, "RO", "OFFICE"), (12, "AC", "OFFICE")]


def test_dynamic_and_static_overwrite(spark, tmp_path):
    day1 = spark.createDataFrame([(1, "2026-01-01"), (2, "2026-01-02")], "id int, d string")
    day2 = spark.createDataFrame([(3, "2026-01-02")], "id int, d string")
    path = f"{tmp_path}/t"
    tables.write_table(day1, path, partition_by=["d"])
    tables.write_table(day2, path, partition_by=["d"])
    back = tables.read_table(spark, path)
    assert sorted(r.id for r in back.collect()) == [1, 3] and dict(back.dtypes)["d"] == "date"
    tables.write_table(day2, path, partition_by=["d"], overwrite="static")
    assert [r.id for r in tables.read_table(spark, path).collect()] == [3]
    tables.write_table(day2, path, mode="append", partition_by=["d"])
    assert tables.count_rows(spark, path) == 2


def test_count_exists_drop(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert not tables.exists(spark, path) and tables.count_rows(spark, path) == 0
    assert tables.table_bytes(spark, path) == 0 and not tables.drop_table_dir(spark, path)
    (tmp_path / "empty").mkdir()
    assert tables.count_rows(spark, f"{tmp_path}/empty") == 0
    tables.write_table(spark.range(5), path)
    assert tables.count_rows(spark, path) == 5 and tables.table_bytes(spark, path) > 0
    assert tables.drop_table_dir(spark, path) and not tables.exists(spark, path)


def test_empty_like(spark):
    out = tables.empty_like(spark.range(3), why="string")
    assert out.columns == ["id", "why"] and out.isEmpty()


def test_compaction_clusters(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("a"), F.col("id").alias("b"))
    path = tables.compact(df, f"{tmp_path}/c", ["a"], 3)
    back = tables.read_table(spark, path)
    ranges = back.groupBy(F.input_file_name()).agg(F.min("a").alias("x"), F.max("a").alias("y"))
    spans = sorted((r.x, r.y) for r in ranges.collect())
    assert len(spans) == 3 and all(p[1] < q[0] for p, q in zip(spans, spans[1:]))
    assert back.count() == 1000


def test_catalog(spark, tmp_path):
    path = tables.write_table(spark.range(7), f"{tmp_path}/t")
    tables.register_table(spark, "shelf.numbers", path)
    tables.register_table(spark, "shelf.numbers", path)
    tables.analyze_table(spark, "shelf.numbers")
    tables.comment_table(spark, "shelf.numbers", "it's a table")
    assert spark.table("shelf.numbers").count() == 7
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED shelf.numbers").collect()}
    assert "7 rows" in info["Statistics"] and info["Comment"] == "it's a table"
    spark.sql("DROP TABLE shelf.numbers")
    spark.sql("DROP SCHEMA shelf")
    assert tables.exists(spark, path)


def test_staging(spark):
    df = spark.range(10).withColumn("t", F.lit(None).cast("timestamp_ntz"))
    out = staging.stage(df)
    assert out.dtypes == df.dtypes and out.count() == 10
    assert "LogicalRDD" not in out._jdf.queryExecution().analyzed().toString()


def test_shared_folder_is_required_on_a_cluster(spark):
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})

    assert staging.shared_dir(Session(spark_checkpoint_dir="s3a://b/c/")) == "s3a://b/c"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_dir(Session(spark_master="yarn"))


def test_session(spark):
    again, fmt = session.get_session(fmt="delta")
    assert fmt == "parquet" and again is not None
    assert session.effective_format(spark, "ORC") == "orc"
    assert not session.has_kafka(spark)
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_staged_tables_are_dropped_by_application(spark):
    out = staging.stage(spark.range(3))
    folder = staging._app_dir(spark)
    assert tables.exists(spark, folder) and out.count() == 3
    other = f"{staging.shared_dir(spark)}/other"
    tables.write_table(spark.range(1), other)
    staging.drop_staged(spark)
    assert not tables.exists(spark, folder) and tables.exists(spark, other)


def test_clustering_prunes_on_every_column(spark, tmp_path):
    df = spark.range(20000).select(
        (F.col("id") * 7919 % 20011).alias("a"), (F.col("id") * 104729 % 20021).alias("b"))
    path = tables.compact(df, f"{tmp_path}/z", ["a", "b"], 16)
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        *[(F.max(c) - F.min(c)).alias(c) for c in "ab"]).collect()
    assert len(files) == 16 and spark.read.parquet(path).count() == 20000
    for c in "ab":
        assert sum(r[c] for r in files) / len(files) < 0.5 * 20000
    assert [tables.files_for(n, 10) for n in (0, 10, 11)] == [1, 1, 2]


def test_statistics_change_the_order_of_joins(spark, tmp_path):
    """Without statistics the tables are joined as they are written; with them the selective one comes first."""
    big = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 100).alias("m"), (F.col("id") % 1000).alias("s"))
    parts = {"big": big, "mid": spark.range(5000).select((F.col("id") % 100).alias("m"), F.lit("x" * 50).alias("pad")),
             "small": spark.range(3).select((F.col("id") * 7).alias("s"))}
    query = "select big.k from shelf_big big join shelf_mid mid on big.m = mid.m join shelf_small small on big.s = small.s"
    for name, df in parts.items():
        tables.register_table(spark, f"shelf_{name}", tables.write_table(df, f"{tmp_path}/{name}"))
    wanted = {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.joinReorder.enabled": "true"}
    before = {k: spark.conf.get(k) for k in wanted}

    def order():
        plan = spark.sql(query)._jdf.queryExecution().optimizedPlan().toString()
        return [name for name in re.findall(r"shelf_(big|mid|small)", plan)]

    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        written = order()
        rows = spark.sql(query).count()
        for name in parts:
            tables.analyze_table(spark, f"shelf_{name}")
        known = order()
        assert written[:2] == ["big", "mid"] and set(known[:2]) == {"big", "small"}
        assert spark.sql(query).count() == rows > 0
        about = tables.column_statistics(spark, "shelf_big", ["s"]).first()
        assert (about.rows, about.nulls, about.low, about.high) == (20_000, 0, "0", "999")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        for name in parts:
            spark.sql(f"DROP TABLE shelf_{name}")


def test_swapping_in_replaces_whole_partitions(spark, tmp_path):
    first = spark.createDataFrame([(k, d, y) for k, (d, y) in enumerate([("a", 1), ("a", 2), ("b", 1)])], "k int, d string, y int")
    second = spark.createDataFrame([(9, "a", 2), (8, "c", 1)], "k int, d string, y int")
    for k, df in enumerate((first, second)):
        df.write.partitionBy("d", "y").parquet(f"{tmp_path}/s{k}")
        tables.swap_in(spark, f"{tmp_path}/s{k}", f"{tmp_path}/t", ["d", "y"], "dynamic")
    assert {(r.k, r.d, r.y) for r in tables.read_table(spark, f"{tmp_path}/t").collect()} == {(0, "a", 1), (9, "a", 2), (2, "b", 1), (8, "c", 1)}
    plan = tables.read_table(spark, f"{tmp_path}/t").where("d = 'a' and y = 2")
    assert len(plan.inputFiles()) == 4 and "PartitionFilters: [isnotnull" in plan._jdf.queryExecution().executedPlan().toString()
    tables.replace_dir(spark, tables.write_table(spark.range(2), f"{tmp_path}/n"), f"{tmp_path}/t")
    assert tables.read_table(spark, f"{tmp_path}/t").count() == 2
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_old")]
    with pytest.raises(FileNotFoundError, match="missing"):
        tables.replace_dir(spark, f"{tmp_path}/missing", f"{tmp_path}/t")
    tables.write_table(spark.range(5), f"{tmp_path}/n")
    with pytest.MonkeyPatch.context() as patch:
        rename, calls = tables._rename, []

        def breaks(fs, source, target):
            calls.append(1)
            if len(calls) == 2:
                raise OSError("lost")
            rename(fs, source, target)

        patch.setattr(tables, "_rename", breaks)
        with pytest.raises(OSError, match="lost"):
            tables.replace_dir(spark, f"{tmp_path}/n", f"{tmp_path}/t")
    assert tables.read_table(spark, f"{tmp_path}/t").count() == 2
