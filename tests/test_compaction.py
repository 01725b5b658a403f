"""Incremental compaction."""

import pytest
from pyspark.sql import functions as F

from terrace.sources import compaction as co
from terrace.sources import tables


def files(spark, path):
    return {r.file for r in co.live_files(spark, path).collect()}


def rows(df):
    return sorted(tuple(r) for r in df.select("k", "v").collect())


@pytest.fixture
def grown(spark, tmp_path):
    """Two large files, side by side in k, and five small ones over all of it."""
    path = f"{tmp_path}/t able"
    big = spark.range(40_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    tables.compact(big, path, ["k"], 2)
    small = spark.range(500).select((F.col("id") * 80).alias("k"), F.lit("late").alias("v"))
    small.repartition(5).write.mode("append").parquet(path)
    return path, co.CompactionRules(target_bytes=tables.table_bytes(spark, path) // 2)


def test_only_small_files_are_rewritten(spark, grown):
    path, rules = grown
    before, want = files(spark, path), rows(co.read_live(spark, path))
    done = co.compact_files(spark, path, ["k"], rules)
    after = files(spark, path)
    assert (done.replaced, done.written) == (5, 1) and len(before & after) == 2 and len(after) == 3
    assert rows(co.read_live(spark, path)) == want and len(want) == 40_500
    assert co.compact_files(spark, path, ["k"], rules) == co.Compaction(None)


def test_a_begun_reader_keeps_its_files_until_they_expire(spark, grown):
    path, rules = grown
    begun = co.read_live(spark, path)
    co.compact_files(spark, path, ["k"], rules)
    assert begun.count() == 40_500 and co.expire(spark, path) == 0
    assert co.expire(spark, path, age_hours=0) == 5
    assert tables.read_table(spark, path).count() == co.read_live(spark, path).count() == 40_500
    spark.range(3).select(F.col("id").alias("k"), F.lit("new").alias("v")).coalesce(1).write.mode("append").parquet(path)
    assert co.read_live(spark, path).count() == 40_503


def test_a_run_that_dies_changes_nothing(spark, grown, monkeypatch):
    path, rules = grown
    want = files(spark, path)
    with monkeypatch.context() as m:
        m.setattr(co, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            co.compact_files(spark, path, ["k"], rules)
    assert files(spark, path) == want and co.read_live(spark, path).count() == 40_500
    assert co.compact_files(spark, path, ["k"], rules).replaced == 5 and co.read_live(spark, path).count() == 40_500


def test_two_runs_over_the_same_files(spark, grown):
    path, rules = grown
    picked = co.pick(spark, path, ["k"], rules).select("file")
    co.compact_files(spark, path, ["k"], rules)
    with pytest.raises(RuntimeError, match="another run"):
        co.publish(spark, path, "0" * 32, picked)
    assert co.read_live(spark, path).count() == 40_500


def test_overlapping_files_are_sorted_anew_and_prune(spark, tmp_path):
    path = f"{tmp_path}/t"
    apart = spark.range(50_000, 60_000, 1, 1).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    mixed = spark.range(50_000).select(F.col("id").alias("k"), F.lit("y").alias("v")).repartition(6)
    apart.write.parquet(path)
    mixed.write.mode("append").parquet(path)
    before = files(spark, path)
    rules = co.CompactionRules(target_bytes=tables.table_bytes(spark, path) // 7, small=0.0, depth=3)
    done = co.compact_files(spark, path, ["k"], rules)
    assert done.replaced == 6 and len(before & files(spark, path)) == 1
    ranges = co.file_ranges(spark, path, co.live_files(spark, path), ["k"])
    assert co.crowded(ranges, 1).isEmpty()
    hit = co.read_live(spark, path).where("k = 7").select("_metadata.file_name").distinct().count()
    assert hit == 1 and ranges.where("low <= 7 and high >= 7").count() == 1
    assert co.compact_files(spark, path, ["k"], rules).run is None


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_crowded_places_against_brute_force(spark, depth):
    ends = [("a", 0, 100), ("b", 10, 20), ("c", 12, 30), ("d", 20, 40), ("e", 50, 50), ("f", 30, 60), ("g", 100, 120),
            ("h", None, None), ("p=1/i", 0, 100), ("p=1/j", 5, 6), ("k", 10, 20)]
    want = set()
    for name, low, high in ends:
        beside = [(a, b) for n, a, b in ends if a is not None and a < b and n.rpartition("/")[0] == name.rpartition("/")[0]]
        if low is not None and low < high and any(
                sum(a <= at < b for a, b in beside) > depth for at, _ in beside if low <= at < high):
            want.add(name)
    got = co.crowded(spark.createDataFrame(ends, "file string, low int, high int"), depth)
    assert {r.file for r in got.collect()} == want


def test_partitions_null_keys_and_empty_tables(spark, tmp_path):
    path = f"{tmp_path}/p"
    df = spark.range(400).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").cast("string").alias("v"),
                                 F.timestamp_seconds(F.col("id") * 50).cast("timestamp").alias("at"),
                                 F.when(F.col("id") % 2 == 0, "a:b/=%c").alias("day"))
    for n in range(3):
        df.where(F.col("id") % 3 == n).repartition(2).write.mode("append").partitionBy("day").parquet(path)
    want = sorted(map(str, co.read_live(spark, path).select(*df.columns).collect()))
    done = co.compact_files(spark, path, ["k", "at"], co.CompactionRules(depth=None))
    assert done.written == 2 < done.replaced and len(files(spark, path)) == 2
    assert sorted(map(str, co.read_live(spark, path).select(*df.columns).collect())) == want
    tables.make_dir(spark, f"{tmp_path}/none")
    assert co.compact_files(spark, f"{tmp_path}/none", ["k"]) == co.Compaction(None)
    assert co.expire(spark, f"{tmp_path}/none") == 0
