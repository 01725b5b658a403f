"""Layered runs: ingest, publish, fail-fast, log."""

from datetime import datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from terrace.operators.contracts import Contract, ContractViolation
from terrace.operators.runlog import failed_checks, latest_run, run_summary
from terrace.plans import retail_layers
from terrace.plans.layers import Lakehouse
from terrace.plans.storage_queries import land
from terrace.sources.schemas import SCHEMAS, schema
from terrace.sources.staging import shared_dir
from terrace.sources.tables import write_table

PEOPLE = schema(id="int", name="string")


def lake(spark, root, *checks, **options):
    return Lakehouse(spark, str(root), {"bronze": {"people": Contract.of(*checks)}}, **options)


def staged(spark):
    root = Path(shared_dir(spark)) / "terrace" / spark.conf.get("spark.app.id")
    return sorted(p.name for p in root.iterdir()) if root.exists() else []


def csv(tmp_path, text):
    path = tmp_path / "people.csv"
    path.write_text("id,name\n" + text)
    return str(path)


def test_ingest_keeps_earlier_dates(spark, tmp_path):
    house = lake(spark, tmp_path / "lake")
    source = csv(tmp_path, "1,Ana\n2,Bia\n")
    house.ingest("people", source, PEOPLE, "TEST", datetime(2026, 1, 1))
    house.ingest("people", source, PEOPLE, "TEST", datetime(2026, 1, 2))
    out = house.ingest("people", source, PEOPLE, "TEST", datetime(2026, 1, 2, 9))
    assert out.count() == 4 and out.select("_ingestion_date").distinct().count() == 2
    assert [s.rows_out for s in house.log.steps] == [2, 2, 2]
    house.reset()
    with pytest.raises(Exception):
        house.read("bronze", "people").count()


def test_quarantine_beside_valid_rows(spark, tmp_path):
    house = lake(spark, tmp_path / "lake",
                 {"rule": "not_null", "column": "name", "tolerance_pct": 50})
    out = house.ingest("people", csv(tmp_path, "1,Ana\n2,\n3,Caio\n"), PEOPLE, "TEST")
    assert out.count() == 2
    bad = spark.read.parquet(f"{tmp_path}/lake/_quarantine/bronze/people")
    assert [(r.id, r._quarantine_reason) for r in bad.collect()] == [(2, "not_null:name")]
    step = house.log.steps[0]
    assert (step.rows_in, step.rows_out, step.rows_quarantined, step.quality_score) == (3, 2, 1, 100.0)
    assert step.bytes_written > 0


def test_reasons_too_long_for_a_path(spark, tmp_path):
    checks = [{"rule": "regex", "column": "name", "value": f"^[^{c}]*$", "tolerance_pct": 100} for c in "abcdefghijklmnopqrst"]
    house = lake(spark, tmp_path / "lake", *checks, {"rule": "range", "column": "id", "value": [2, 9], "tolerance_pct": 100})
    out = house.ingest("people", csv(tmp_path, "1,abcdefghijklmnopqrst\n2,tb\n3,xyz\n1,xyz\n"), PEOPLE, "TEST")
    assert [r.id for r in out.collect()] == [3] and "_quarantine_reason" not in out.columns
    bad = spark.read.parquet(f"{tmp_path}/lake/_quarantine/bronze/people").collect()
    assert sorted((r.id, r.name, r._quarantine_reason) for r in bad) == [
        (1, "abcdefghijklmnopqrst", "|".join(["regex:name"] * 20 + ["range:id"])), (1, "xyz", "range:id"),
        (2, "tb", "regex:name|regex:name")]


def test_a_clean_run_leaves_no_quarantine_and_nothing_staged(spark, tmp_path):
    house = lake(spark, tmp_path / "lake", {"rule": "not_null", "column": "name", "tolerance_pct": 50})
    before = staged(spark)
    house.ingest("people", csv(tmp_path, "1,Ana\n2,\n"), PEOPLE, "TEST")
    assert (tmp_path / "lake" / "_quarantine" / "bronze" / "people").exists()
    house.ingest("people", csv(tmp_path, "1,Ana\n2,Bia\n"), PEOPLE, "TEST")
    assert not (tmp_path / "lake" / "_quarantine" / "bronze" / "people").exists()
    assert staged(spark) == before


def test_bronze_is_written_without_a_shuffle(spark, tmp_path):
    df = spark.range(5).withColumn("d", F.lit("2025-01-01"))
    seen = []
    hint = type(df).hint
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(df), "hint", lambda self, *a: seen.append(a) or hint(self, *a))
        lake(spark, tmp_path / "lake").ingest("people", csv(tmp_path, "1,Ana\n"), PEOPLE, "TEST")
        assert not seen
        write_table(df, f"{tmp_path}/t", partition_by=["d"])
        assert seen


def test_critical_failure_stops_before_the_table_but_keeps_the_evidence(spark, tmp_path):
    house = lake(spark, tmp_path / "lake", {"rule": "not_null", "column": "name"})
    with pytest.raises(ContractViolation):
        house.ingest("people", csv(tmp_path, "1,Ana\n2,\n"), PEOPLE, "TEST")
    assert spark.read.parquet(f"{tmp_path}/lake/_quarantine/bronze/people").count() == 1
    assert not (tmp_path / "lake" / "bronze").exists()
    house.save_log()
    log = latest_run(spark.read.parquet(f"{tmp_path}/lake/_observability/runs"))
    assert run_summary(log).head().failures == 1
    assert [r.status for r in failed_checks(log).collect()] == ["FAIL"]


def test_critical_failure_may_pass_by_choice(spark, tmp_path):
    house = lake(spark, tmp_path / "lake", {"rule": "not_null", "column": "name"},
                 stop_on_critical=False)
    assert house.ingest("people", csv(tmp_path, "1,Ana\n2,\n"), PEOPLE, "TEST").count() == 1


def test_staged_run(spark, sf_dir, tmp_path):
    house = retail_layers.lakehouse(spark, str(tmp_path / "lake"))
    landing = land(spark, sf_dir)
    before = staged(spark)
    retail_layers.run(house, landing, reprocess=True)
    assert staged(spark) == before
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    steps = {(s.layer, s.table_name): s for s in house.log.steps}
    assert len(steps) == 25 and all(s.status == "OK" for s in steps.values())
    micro = steps["silver", "fact_micro"]
    assert micro.rows_in == lines == micro.rows_out + micro.rows_quarantined and micro.rows_quarantined > 0
    view = house.read("gold", "entity_view")
    ranking = house.read("gold", "ranking")
    assert view.rdd.getNumPartitions() >= 1 and "yr" in view.columns
    assert ranking.count() == steps["gold", "ranking"].rows_out
    # grain of the products
    assert view.select("yr", "entity_id").distinct().count() == view.count()
    # totals agree between the entity grain and the group grain
    groups = house.read("gold", "target_vs_actual").agg({"assessed": "sum", "successes": "sum"}).head()
    entities = view.agg({"assessed": "sum", "successes": "sum"}).head()
    assert groups.asDict() == entities.asDict()


def test_bronze_by_year_is_not_shuffled(spark, tmp_path, monkeypatch):
    text = "id,at\n" + "\n".join(f"{k},{2001 + k % 3}-05-0{1 + k % 9}" for k in range(300))
    (tmp_path / "visits.csv").write_text(text + "\n")
    shuffled, hint = [], type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda df, name, *a: shuffled.append(name) or hint(df, name, *a))
    out = Lakehouse(spark, f"{tmp_path}/lake").ingest(
        "visits", f"{tmp_path}/visits.csv", schema(id="int", at="timestamp"), "T", year_of="at")
    assert not shuffled and out.count() == 300
    assert {r._year: r["count"] for r in out.groupBy("_year").count().collect()} == {2001: 100, 2002: 100, 2003: 100}


def test_files_of_the_lake_are_compressed_beyond_repeats(spark, tmp_path):
    """Hashes in hex take half their characters' bytes; with snappy they take all of them."""
    rows = "".join(f"{k},name {k}\n" for k in range(5000))
    Lakehouse(spark, f"{tmp_path}/lake").ingest("people", csv(tmp_path, rows), PEOPLE, "TEST")
    columns = [group.column(k) for file in (tmp_path / "lake" / "bronze").rglob("*.parquet")
               for group in [pq.ParquetFile(file).metadata.row_group(0)] for k in range(group.num_columns)]
    hashes = [c for c in columns if c.path_in_schema == "_origin.row_hash"]
    assert {c.compression for c in columns} == {"ZSTD"}
    assert sum(c.total_compressed_size for c in hashes) < 40 * 5000


def test_order_lines_are_not_shuffled_by_year(spark, tmp_path, monkeypatch):
    n = 1200
    lines = spark.range(n).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 7).alias("l_partkey"), F.lit(1).alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), F.when(F.col("id") % 100 == 0, 1.0).otherwise(10.0).alias("l_quantity"),
        F.lit(5.0).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"), F.lit(0.0).alias("l_tax"),
        F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.when(F.col("id") % 4 > 0, F.make_timestamp_ntz(
            1991 + F.col("id") % 4, F.lit(5), F.lit(1), F.lit(0), F.lit(0), F.lit(0))).alias("l_shipdate"))
    part = spark.range(7).select(F.col("id").alias("p_partkey"), *[
        F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMAS["part"] if f.name != "p_partkey"])
    for name, rows in (("lineitem", lines), ("part", part)):
        rows.write.option("header", True).csv(f"{tmp_path}/{name}.csv")
    house = retail_layers.lakehouse(spark, f"{tmp_path}/lake")
    retail_layers.run_bronze(house, str(tmp_path), ["lineitem", "part"])
    shuffled, hint = [], type(lines).hint
    monkeypatch.setattr(type(lines), "hint", lambda df, name, *a: shuffled.append(name) or hint(df, name, *a))
    out = retail_layers.publish_micro(house)
    assert not shuffled
    assert {r.yr: r["count"] for r in out.groupBy("yr").count().collect()} == {None: 288, 1992: 300, 1993: 300, 1994: 300}
    assert house.log.steps[-1].rows_quarantined == 12
