"""Every registered query against its SQL equivalent."""

import pytest

import __spark_entry__ as entry
from tests.check_queries import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, sf_dir, name):
    status, _ = compare(spark, con, sf_dir, name)
    assert status.startswith(("ok", "rows-only")), status


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["inequality_panel", "zscore_composite", "weighted_sample",
                                  "contract_quarantine", "target_vs_actual"])
def test_result_does_not_depend_on_partitioning(spark, sf_dir, name):
    seen = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append(sorted(map(str, entry.queries()[name](spark, sf_dir).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["yr", "group_id", "group_name"] and df.count() > 100
