"""Queries on the run log, quality, cost and the data dictionary.

The log is read off the events table: each event is one step of the day's run,
so the log grows with the events.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from terrace.operators import runlog
from terrace.plans import retail_layers
from terrace.plans.registry import half_up, query
from terrace.plans.retail import table
from terrace.plans.storage_queries import land
from terrace.sources.catalogue import data_dictionary, table_manifest
from terrace.sources.staging import scratch_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def run_log(spark, sf_dir):
    """Events as steps."""
    events = table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("long"))
    failed = F.col("event_type") == "error"

    def check(rule, column, critical, ok, bad):
        return F.struct(
            F.lit(rule).alias("rule"), F.lit(column).alias("column"),
            F.lit(critical).alias("critical"),
            F.when(ok, "PASS").otherwise(bad).alias("status"),
            F.concat(F.col("k").cast("string"), F.lit(" row(s)")).alias("detail"))

    checks = F.array(
        check("range", "value", False, F.col("k") < 50, "WARN"),
        check("not_null", "user_id", True, ~failed, "FAIL"))
    end = F.unix_micros(F.col("ts").cast("timestamp"))
    return events.select(
        F.concat(F.lit("run-"), F.date_format("ts", "yyyy-MM-dd")).alias("run_id"),
        F.element_at(F.array(F.lit("bronze"), F.lit("silver"), F.lit("gold")),
                     (F.col("user_id") % 3 + 1).cast("int")).alias("layer"),
        F.concat(F.lit("table_"), F.col("user_id").cast("string")).alias("table_name"),
        F.timestamp_micros(end - F.round(F.col("value") * 1e6).cast("long")).alias("started_at"),
        F.timestamp_micros(end).alias("finished_at"),
        (F.col("k") * 100).alias("rows_in"),
        (F.col("k") * 100 - F.col("k") % 7).alias("rows_out"),
        (F.col("k") % 7).alias("rows_quarantined"),
        (F.col("k") * 104857).alias("bytes_written"),
        (F.lit(100.0) - F.col("k") % 20).alias("quality_score"),
        checks.alias("checks"),
        F.when(failed, F.concat(F.lit("StepError: "), F.col("event_id").cast("string"))).alias("error"))


_LOG = """
e as (select *, cast(json_extract(props, '$.k') as bigint) as k from events),
log as (
  select 'run-' || strftime(ts, '%Y-%m-%d') as run_id,
         case user_id % 3 when 0 then 'bronze' when 1 then 'silver' else 'gold' end as layer,
         'table_' || user_id as table_name,
         case when event_type = 'error' then 'ERROR' else 'OK' end as status,
         k * 100 as rows_in, k * 100 - k % 7 as rows_out, k % 7 as rows_quarantined,
         cast(100 - k % 20 as double) as quality_score, value as duration_s,
         k * 104857 as bytes_written,
         case when event_type = 'error' then 'StepError: ' || event_id end as error,
         ts as finished_at, ts, k
  from e),
latest as (
  select * from (select *, row_number() over (partition by layer, table_name
                 order by finished_at desc, run_id desc) as rn from log where status = 'OK')
  where rn = 1)
"""


@query("run_summary", f"""
    with {_LOG}
    select run_id, count(*) as steps, count(*) filter (where status <> 'OK') as failures,
           {half_up('sum(cast(duration_s as decimal(18,3)))')} as duration_s,
           cast(sum(rows_out) as bigint) as rows_out,
           cast(sum(rows_quarantined) as bigint) as rows_quarantined,
           {half_up('cast(sum(bytes_written) as double) / 1048576.0::double', 2)} as mb_written,
           count(*) filter (where quality_score < 90) as degraded
    from log group by 1""")
def run_summary(spark, sf_dir):
    """O05, A22."""
    return runlog.run_summary(run_log(spark, sf_dir))


@query("latest_run_steps", f"""
    with {_LOG}
    select run_id, layer, table_name, status, rows_in, rows_out, rows_quarantined,
           {half_up('quality_score')} as quality_score, {half_up('duration_s', 2)} as duration_s,
           {half_up('bytes_written / 1048576.0::double', 2)} as mb_written
    from log where run_id = (select arg_max(run_id, finished_at) from log)""")
def latest_run_steps(spark, sf_dir):
    """O04, O06."""
    return runlog.step_table(runlog.latest_run(run_log(spark, sf_dir)))


@query("run_failures", f"""
    with {_LOG} select run_id, layer, table_name, error from log where status <> 'OK'""")
def run_failures(spark, sf_dir):
    """O07."""
    return runlog.failures(run_log(spark, sf_dir))


@query("run_failed_checks", f"""
    with {_LOG}
    select run_id, layer, table_name, 'range' as rule, 'value' as "column", false as critical,
           'WARN' as status, k || ' row(s)' as detail from log where k >= 50
    union all
    select run_id, layer, table_name, 'not_null', 'user_id', true, 'FAIL', k || ' row(s)'
    from log where status = 'ERROR'""")
def run_failed_checks(spark, sf_dir):
    """O08, F10."""
    return runlog.failed_checks(run_log(spark, sf_dir))


@query("latest_measure", f"""
    with {_LOG}
    select layer, table_name, run_id, rows_out, bytes_written, duration_s, finished_at from latest""")
def latest_measure(spark, sf_dir):
    """O09, W01."""
    return runlog.latest_measure(run_log(spark, sf_dir)).select(
        "layer", "table_name", "run_id", "rows_out", "bytes_written", "duration_s",
        F.col("finished_at").cast("timestamp_ntz").alias("finished_at"))


@query("cost_scenarios", f"""
    with {_LOG},
    u as (select cast(sum(bytes_written) as double) as bytes,
                 cast(sum(cast(duration_s as decimal(18,3))) as double) as seconds from latest),
    sc(scenario, runs, factor, stream_hours, nodes) as (
      values ('pilot', 30, 5.0::double, 4.0::double, 2), ('national', 30, 50.0::double, 24.0::double, 4),
             ('peak', 60, 120.0::double, 24.0::double, 8)),
    a as (
      select *, bytes * factor / 1073741824.0::double * 1.6::double as gb,
             greatest(seconds * factor / 3600.0::double * runs, 0.05::double * runs) as hours
      from u, sc),
    b as (
      select *, gb * 0.0184::double as storage, hours * nodes * 0.246::double as batch,
             stream_hours * 60.0::double * 0.246::double as stream,
             21.9::double * greatest(1, nodes // 4) as messaging from a)
    select scenario, {half_up('gb', 2)} as stored_gb, {half_up('hours', 2)} as batch_hours,
           {half_up('storage', 2)} as storage_usd, {half_up('batch', 2)} as batch_usd,
           {half_up('stream', 2)} as stream_usd, {half_up('messaging', 2)} as messaging_usd,
           {half_up('storage + batch + stream + messaging', 2)} as total_usd,
           {half_up('(storage + batch + stream + messaging) * 5.4::double', 2)} as total_local
    from b""")
def cost_scenarios(spark, sf_dir):
    """O10."""
    return runlog.cost_projection(runlog.usage(run_log(spark, sf_dir)))


@query("quality_view", f"""
    with {_LOG}
    select run_id, layer, table_name, status, rows_in, rows_out, rows_quarantined, quality_score,
           duration_s, {half_up('bytes_written / 1048576.0::double', 2)} as mb_written,
           finished_at
    from log where cast(ts as date) >= (select max(cast(ts as date)) from events) - 7""")
def quality_view(spark, sf_dir):
    """The last seven days of the log."""
    log = run_log(spark, sf_dir)
    last = log.agg(F.max(F.to_date("finished_at")).alias("d")).scalar()
    return runlog.quality_view(log, last, 7).withColumn("finished_at", F.col("finished_at").cast("timestamp_ntz"))


@query("engine_log", " union all ".join(f"""
    select 'bronze' as layer, '{t}' as table_name, 'OK' as status, count(*) as rows_out, 0::bigint as failed_checks
    from {t}""" for t in retail_layers.KEYS))
def engine_log(spark, sf_dir):
    """The log that the engine wrote about its own ingest, read back from JSON lines."""
    lake = retail_layers.lakehouse(spark, scratch_path(spark, "lake"))
    retail_layers.run_bronze(lake, land(spark, sf_dir))
    lake.save_log()
    log = runlog.told(runlog.read_run_log(spark, f"{lake.root}/_observability/json"))
    failed = runlog.failed_checks(log).groupBy("layer", "table_name").agg(F.count(F.lit(1)).alias("_f"))
    return log.join(failed, ["layer", "table_name"], "left").select(
        "layer", "table_name", "status", "rows_out", F.coalesce("_f", F.lit(0)).alias("failed_checks"))


@query("manifest", " union all ".join(
    f"""select '{t}' as table_name, (select count(*) from {t}) as rows,
        string_agg(column_name, ', ' order by ordinal_position) as columns,
        'SUPPLIED' as provenance, 42::bigint as seed, timestamp '2026-01-15 06:30:00' as made_at
        from (select distinct column_name, ordinal_position from information_schema.columns
              where table_name = '{t}')""" for t in TABLES))
def manifest(spark, sf_dir):
    """S20."""
    made = table_manifest({t: table(spark, sf_dir, t) for t in TABLES}, seed=42, made_at=datetime(2026, 1, 15, 6, 30))
    return made.withColumn("made_at", F.col("made_at").cast("timestamp_ntz"))


@query("data_dictionary", " union all ".join(
    f"""select 'source' as layer, '{t}' as table_name, (select count(*) from {t}) as rows,
        cast(ordinal_position as integer) as position, column_name,
        case data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int'
             when 'DOUBLE' then 'double' when 'VARCHAR' then 'string' when 'FLOAT' then 'float'
             when 'TIMESTAMP' then 'timestamp_ntz' when 'FLOAT[]' then 'array<float>'
             else lower(data_type) end as data_type,
        case when '{t}' = 'nation' and column_name = 'n_name' then 'name of the nation'
             else '' end as description
        from (select distinct column_name, ordinal_position, data_type
              from information_schema.columns where table_name = '{t}')""" for t in TABLES))
def dictionary(spark, sf_dir):
    """O11."""
    return data_dictionary({t: table(spark, sf_dir, t) for t in TABLES},
                           descriptions={("nation", "n_name"): "name of the nation"})
