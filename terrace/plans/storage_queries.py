"""Queries that write tables and read them back."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from terrace.functions import columns as c
from terrace.operators.contracts import ContractViolation
from terrace.operators.runlog import read_run_log, told
from terrace.plans import retail_layers
from terrace.plans.gold_queries import _PANEL
from terrace.plans.layers import Lakehouse
from terrace.plans.registry import query, with_model
from terrace.plans.retail import table
from terrace.plans.retail_stream import land_events
from terrace.plans.stream_queries import _CLOSED, _EVENTS, _WINDOWS
from terrace.sources import compaction, tables
from terrace.sources.schemas import SCHEMAS
from terrace.sources.staging import scratch_path, stage


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("yr", F.year("o_orderdate"))


@query("table_roundtrip", """
    select o_orderkey, o_custkey, o_totalprice, o_orderdate, cast(year(o_orderdate) as integer) as yr
    from orders""")
def table_roundtrip(spark, sf_dir):
    """S04, S05, S07, S21."""
    path = scratch_path(spark, "orders")
    tables.write_table(_orders(spark, sf_dir), path, partition_by=["yr"])
    return tables.read_table(spark, path).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "yr")


@query("partition_overwrite", """
    select o_orderkey, case when year(o_orderdate) >= 2000 then 'second' else 'first' end as load,
           cast(year(o_orderdate) as integer) as yr from orders""")
def partition_overwrite(spark, sf_dir):
    """The second load replaces only the years it brings."""
    path = scratch_path(spark, "loads")
    orders = _orders(spark, sf_dir).select("o_orderkey", "yr")
    tables.write_table(orders.withColumn("load", F.lit("first")), path, partition_by=["yr"])
    tables.write_table(orders.where(F.col("yr") >= 2000).withColumn("load", F.lit("second")), path,
                       partition_by=["yr"])
    return tables.read_table(spark, path).select("o_orderkey", "load", "yr")


@query("compact_cluster", "select o_orderkey, o_custkey, o_orderdate, o_totalprice from orders")
def compact_cluster(spark, sf_dir):
    """S23."""
    path = scratch_path(spark, "clustered")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    stored = tables.table_bytes(spark, f"{sf_dir}/orders.parquet")
    tables.compact(orders, path, ["o_custkey", "o_orderdate"], tables.files_for(stored))
    return tables.read_table(spark, path)


@query("compact_incremental", """
    with cut as (select max(year(o_orderdate)) as y from orders)
    select o_orderkey, o_custkey, o_orderdate, o_totalprice, year(o_orderdate) = y as rewritten from orders, cut""")
def compact_incremental(spark, sf_dir):
    """Two clustered files of earlier years, then the last year in six small deliveries; only these are merged."""
    path = scratch_path(spark, "growing")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    last = orders.agg(F.max(F.year("o_orderdate"))).first()[0]
    late = F.year("o_orderdate") == last
    tables.compact(orders.where(~late | late.isNull()), path, ["o_custkey", "o_orderdate"], 2)
    rules = compaction.CompactionRules(target_bytes=tables.table_bytes(spark, path) // 2)
    orders.where(late).repartition(6, "o_orderkey").write.mode("append").parquet(path)
    compaction.compact_files(spark, path, ["o_custkey", "o_orderdate"], rules)
    live = compaction.read_live(spark, path)
    return live.select(*orders.columns, F.col("_metadata.file_name").startswith("compact-").alias("rewritten"))


@query("csv_scan", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def csv_scan(spark, sf_dir):
    """Customers written as CSV and scanned under their schema."""
    path = scratch_path(spark, "customer.csv")
    table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    return tables.scan_csv(spark, path, SCHEMAS["customer"])


@query("external_csv", """
    select n_nationkey as id, n_name as name, n_regionkey as region_id, 'SUPPLIED' as provenance
    from nation""")
def external_csv(spark, sf_dir):
    """A foreign CSV whose first header carries a byte order mark."""
    path = scratch_path(spark, "nation.csv")
    nation = table(spark, sf_dir, "nation")
    nation.withColumnRenamed("n_nationkey", "﻿code").write.option("header", True).csv(path)
    return tables.read_external_csv(
        spark, path, {"code": "id", "n_name": "name", "n_regionkey": "region_id"},
        {"id": "int", "name": "string", "region_id": "int"}, "SUPPLIED", "id")


LANDED_ROWS = 1_000_000     # rows in a file: compressed files are not split by their readers


def land(spark, sf_dir):
    """Supplied tables as compressed CSV files of a landing zone, events as JSON lines."""
    landing = scratch_path(spark, "landing")
    for name in retail_layers.KEYS:
        table(spark, sf_dir, name).write.option("header", True).option("compression", "gzip").option(
            "maxRecordsPerFile", LANDED_ROWS).csv(f"{landing}/{name}.csv")
    land_events(spark, sf_dir, f"{landing}/events")
    return landing


def _step(layer: str, name: str, rows: str, quarantined: str = "0") -> str:
    return (f"select '{layer}' as layer, '{name}' as table_name, 'OK' as status, "
            f"({rows})::bigint as rows_in, (({rows}) - ({quarantined}))::bigint as rows_out, "
            f"({quarantined})::bigint as rows_quarantined, ({rows}) > 0 as stored")


# order lines without a score between 0 and 49, or with an unknown flag or part
_REFUSED = """from lineitem where l_quantity is null or l_quantity <= 2 or l_quantity >= 50
  or upper(trim(l_returnflag)) not in ('A', 'N', 'R') or l_partkey not in (select p_partkey from part)"""

_LAYERED = " union all ".join(
    [_step("bronze", t, f"select count(*) from {t}") for t in
     ("region", "nation", "customer", "orders", "part", "lineitem")]
    + [_step("silver", "dim_group", "select count(*) from nat"),
       _step("silver", "dim_entity", "select count(*) from ent"),
       _step("silver", "entity_years", "select count(*) from ey"),
       _step("silver", "group_years", "select count(*) from g"),
       _step("silver", "group_targets", "select count(*) from tgt"),
       _step("silver", "fact_national", "select y2 - y0 + 1 from cal"),
       _step("silver", "fact_group", "select count(*) from tgt"),
       _step("silver", "fact_indicator", "select count(*) from fact"),
       _step("silver", "fact_micro", "select count(*) from lineitem", f"select count(*) {_REFUSED}"),
       _step("gold", "entity_view", "select count(*) from view0"),
       _step("gold", "target_vs_actual", "select count(*) from (select distinct yr, group_id from view0)"),
       _step("gold", "national_evolution", "select y2 - y0 + 1 from cal"),
       _step("gold", "inequality_panel", "select count(*) from panel"),
       _step("gold", "ranking", """select count(*) from (select rank_all,
             count(*) over (partition by yr) as c from view) where rank_all <= 100 or rank_all > c - 100"""),
       _step("gold", "features", "select count(*) from view0"),
       _step("bronze", "event_stream", "select count(*) from ev"),
       _step("silver", "event_stream", "select count(*) from ev where valid"),
       _step("refused", "event_stream", "select count(*) from ev where not valid"),
       _step("gold", "event_windows", f"select count(*) from w where {_CLOSED}")])


@query("layered_run", with_model(_LAYERED, f"{_PANEL}, {_EVENTS}, {_WINDOWS}"))
def layered_run(spark, sf_dir):
    """Files and events through all layers; the saved log, one row per step."""
    lake = retail_layers.lakehouse(spark, scratch_path(spark, "lake"))
    retail_layers.run(lake, land(spark, sf_dir))
    return told(read_run_log(spark, f"{lake.root}/_observability/json")).select(
        "layer", "table_name", "status", "rows_in", "rows_out", "rows_quarantined",
        (F.col("bytes_written") > 0).alias("stored"))


@query("quarantined_lines", f"""
    select l_orderkey, cast(l_linenumber as bigint) as line,
           concat_ws('|', case when l_quantity is null or l_quantity <= 2 or l_quantity >= 50 then 'range:score' end,
                     case when upper(trim(l_returnflag)) not in ('A', 'N', 'R') then 'allowed:returnflag' end,
                     case when l_partkey not in (select p_partkey from part) then 'foreign_key:l_partkey' end)
             as reason
    {_REFUSED}""")
def quarantined_lines(spark, sf_dir):
    """What the contract of the order lines keeps out, with its reasons."""
    lake = retail_layers.lakehouse(spark, scratch_path(spark, "lake"))
    retail_layers.run_bronze(lake, land(spark, sf_dir))
    retail_layers.publish_micro(lake)
    bad = tables.read_table(spark, tables.quarantine_location(lake.root, "silver", "fact_micro"))
    return bad.select("l_orderkey", "line", F.col("_quarantine_reason").alias("reason"))


# customers of a nation that does not exist: every fiftieth
_STRAY = "c_custkey % 50 = 0"


@query("failed_run", f"""
    with n as (select count(*)::bigint as all_rows, count(*) filter (where {_STRAY})::bigint as bad from customer)
    select 1 as attempt, 'ERROR' as status,
           'ContractViolation: silver.dim_entity: foreign_key:group_id (' || bad || ' of ' || all_rows
             || ' row(s) violate, 0 allowed)' as error,
           all_rows as rows_in, 0::bigint as rows_out, bad as rows_quarantined, bad as in_quarantine, 0::bigint as in_table from n
    union all
    select 2, 'OK', null, all_rows, all_rows, 0, 0, all_rows from n
    union all
    select 0, 'ERROR', 'MissingSourceError', 0, 0, 0, 0, 0""")
def failed_run(spark, sf_dir):
    """A missing file, a run that a critical check stops, and the run after it.

    The stopped run leaves its error in the log and the refused rows in the quarantine, and no table. The
    next one brings the rows as they should be, resets what lies behind bronze, and goes on from there.
    """
    lake = retail_layers.lakehouse(spark, scratch_path(spark, "lake"))
    landing, names = scratch_path(spark, "landing"), ("region", "nation", "customer")
    found = []

    def measured() -> tuple[int, int]:
        return (tables.count_rows(spark, tables.quarantine_location(lake.root, "silver", "dim_entity")),
                tables.count_rows(spark, lake.location("silver", "dim_entity")))

    def attempt(job) -> None:
        try:
            job()
        except (ContractViolation, tables.MissingSourceError):
            pass  # in the log
        found.append((len(found), len(lake.log.steps) - 1, *measured()))

    def deliver(customers) -> None:
        for name in names:
            rows = customers if name == "customer" else table(spark, sf_dir, name)
            rows.write.mode("overwrite").option("header", True).csv(f"{landing}/{name}.csv")
        retail_layers.run_bronze(lake, landing, names)

    customers = table(spark, sf_dir, "customer")
    attempt(lambda: retail_layers.run_bronze(lake, landing, ["customer"]))
    deliver(customers.withColumn("c_nationkey", F.expr(f"if({_STRAY}, -1, c_nationkey)")))
    attempt(lambda: retail_layers.run_dimensions(lake))
    deliver(customers)
    lake.reset(["silver", "gold", "_quarantine"])
    attempt(lambda: retail_layers.run_dimensions(lake))
    lake.save_log()

    steps = spark.createDataFrame(found, "attempt int, position int, in_quarantine long, in_table long")
    log = told(read_run_log(spark, f"{lake.root}/_observability/json"))
    log = log.withColumn("position", F.row_number().over(Window.orderBy("started_at")) - 1)  # a few steps
    # a path is part of the missing file's message
    error = F.when(F.col("error").startswith("MissingSourceError"), "MissingSourceError").otherwise(F.col("error"))
    return steps.join(log, "position").select(
        "attempt", "status", error.alias("error"), "rows_in", "rows_out", "rows_quarantined", "in_quarantine", "in_table")


_KNOWN = ("c_custkey", "c_nationkey", "c_acctbal")


@query("catalog_statistics", " union all ".join(f"""
    select '{c}' as column_name, count(*)::bigint as rows, (count(*) - count({c}))::bigint as nulls, true as near,
           cast(min({c}) as double) as low, cast(max({c}) as double) as high,
           'customers, as supplied' as table_comment, 'meaning of {c}' as column_comment from customer""" for c in _KNOWN))
def catalog_statistics(spark, sf_dir):
    """A table entered into the catalog where it lies, its statistics and comments read back from there.

    Numbers of different values are estimates with a standard error of 5 %; three times that is taken as near.
    """
    path, name = scratch_path(spark, "customers"), f"shelf_{uuid.uuid4().hex}"
    customers = table(spark, sf_dir, "customer")
    tables.write_table(customers, path)
    tables.register_table(spark, name, path)
    try:
        tables.analyze_table(spark, name)
        tables.comment_table(spark, name, "customers, as supplied")
        for c in _KNOWN:
            tables.comment_column(spark, name, c, f"meaning of {c}")
        about = stage(tables.column_statistics(spark, name, _KNOWN), "statistics")
    finally:
        spark.sql(f"DROP TABLE {name}")
    exact = customers.agg(*[F.count_distinct(c).alias(c) for c in _KNOWN])
    exact = exact.unpivot([], list(_KNOWN), "column_name", "exact")
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.greatest(F.lit(1), F.col("exact") * 0.15)
    return about.join(exact, "column_name").select(
        "column_name", "rows", "nulls", near.alias("near"), F.col("low").cast("double").alias("low"),
        F.col("high").cast("double").alias("high"), "table_comment", "column_comment")


@query("bronze_years", """
    select o_orderkey, cast(year(o_orderdate) as integer) as _year,
           case when year(o_orderdate) = (select max(year(o_orderdate)) from orders) then 'second' else 'first' end as load
    from orders where year(o_orderdate) >= (select max(year(o_orderdate)) - 1 from orders)""")
def bronze_years(spark, sf_dir):
    """Orders by day of arrival and year; a second delivery of the last year replaces that year of
    that day only, and a reader of two years opens no other one."""
    lake = Lakehouse(spark, scratch_path(spark, "lake"))
    orders, day = table(spark, sf_dir, "orders"), datetime(2026, 1, 15)
    last = orders.agg(F.max(F.year("o_orderdate"))).first()[0]
    for load, part in (("first", orders), ("second", orders.where(F.year("o_orderdate") == last))):
        landing = scratch_path(spark, "landing")
        part.write.option("header", True).csv(f"{landing}/{load}.csv")
        lake.ingest("orders", f"{landing}/{load}.csv", SCHEMAS["orders"], "RETAIL", day, year_of="o_orderdate")
    out = lake.read("bronze", "orders").where(F.col("_year") >= last - 1)
    return out.select("o_orderkey", "_year", F.split("_origin.file", r"\.")[0].alias("load"))


@query("head_rows", """
    select p_partkey, floor(cast(p_retailprice as double) * 10 + 0.5 + 1e-9) / 10 as price from part order by p_partkey limit 20""")
def head_rows(spark, sf_dir):
    """Prices that come as text, cast and rounded; the first rows by key."""
    part = table(spark, sf_dir, "part").withColumn("price", F.col("p_retailprice").cast("string"))
    return part.select("p_partkey", c.rounded(F.col("price"), 1).alias("price")).orderBy("p_partkey").limit(20)
