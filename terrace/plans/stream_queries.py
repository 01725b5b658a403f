"""Queries on the event stream: the events table delivered as records, in several triggers."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.operators.lineage import PROCESSED
from terrace.plans import retail_layers
from terrace.plans.registry import half_up, query
from terrace.plans.retail_stream import FORM, SLICES, deliver, land_events, measures, records, run_stream
from terrace.session import state_on_disk
from terrace.sources.staging import scratch_path
from terrace.streaming import events as ev
from terrace.streaming import runs


ROW_GROUP = 8 << 20


def record_stream(spark, sf_dir, copies: int = 1, late: bool = False):
    """The records as a stream of files, every record delivered ``copies`` times, and ``late`` ones after all."""
    path = scratch_path(spark, "records")
    # small row groups, so that a trigger's few files keep all cores busy
    deliver(records(spark, sf_dir), path, lambda writer, to: writer.option("parquet.block.size", ROW_GROUP).parquet(to),
            late, copies)
    stream = spark.readStream.schema(ev.RECORD).option("maxFilesPerTrigger", ev.MAX_FILES).parquet(path)
    return ev.stamped(ev.envelope(stream), "records", "run-1")


def finish(spark, stream, partition_by=()):
    """Run one query over everything available, to the end, and read its sink."""
    path = scratch_path(spark, "sink")
    started = runs.to_files(stream, path, scratch_path(spark, "checkpoint"), partitionBy=list(partition_by))
    runs.supervise({"stream": started})
    return spark.read.schema(stream.schema).parquet(path)


_EVENTS = """
ev as (
  select cast(event_id as varchar) as event_id, event_type, user_id, 'T' || (user_id % 5) as team,
         ts as sent_at, value, cast(json_extract(props, '$.k') as integer) as k,
         event_type in ('click', 'purchase', 'signup', 'view') as valid,
         cast(json_extract(props, '$.k') as bigint) as latency_s
  from events)
"""
_DECODED = ("event_id", "event_type", "user_id", "team", "sent_at", "value", "k", "latency_s")


def _ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("stream_parse", f"with {_EVENTS} select {', '.join(_DECODED)}, valid from ev")
def stream_parse(spark, sf_dir):
    """E02, F09, F10, P07, P31, P32, on a batch."""
    bronze = ev.stamped(ev.envelope(records(spark, sf_dir)), "records", "run-1")
    return _ntz(ev.decode(bronze, FORM).select(*_DECODED, "valid"), "sent_at")


@query("stream_bronze", """
    select cast(user_id as varchar) as _key, 'events' as _topic, event_id as _offset,
           date_trunc('second', ts) + to_seconds(cast(json_extract(props, '$.k') as bigint))
             as _received_at,
           'records' as system, 'run-1' as run, cast(event_id as varchar) as payload_id
    from events""")
def stream_bronze(spark, sf_dir):
    """E01, P03, S11, S08."""
    out = finish(spark, record_stream(spark, sf_dir), ["_ingestion_date"])
    return _ntz(out.select(
        "_key", "_topic", "_offset", "_received_at", "_origin.system", "_origin.run",
        F.get_json_object("_payload", "$.event_id").alias("payload_id")), "_received_at")


@query("stream_text_source", f"""
    with {_EVENTS} select event_id, event_type, sent_at, value, 'file' as system from ev where valid""")
def stream_text_source(spark, sf_dir):
    """JSON lines in text files, read under the cap of files per trigger."""
    path = scratch_path(spark, "lines")
    land_events(spark, sf_dir, path)
    stream, source = ev.open_source(spark, path)
    good = ev.accepted(ev.decode(ev.stamped(stream, source, "run-1"), FORM))
    out = finish(spark, good.select("event_id", "event_type", "sent_at", "value", "_origin.system"))
    return _ntz(out, "sent_at")


@query("stream_dedup", f"with {_EVENTS} select {', '.join(_DECODED)} from ev where valid")
def stream_dedup(spark, sf_dir):
    """Every record is delivered twice, every valid event is kept once; the keys seen lie on disk."""
    decoded = ev.decode(record_stream(spark, sf_dir, copies=2), FORM)
    with state_on_disk(spark):
        return _ntz(finish(spark, ev.once(ev.accepted(decoded).select(*_DECODED), FORM)), "sent_at")


@query("stream_quarantine", f"""
    with {_EVENTS} select event_id, event_type, sent_at, event_id as payload_id
    from ev where not valid""")
def stream_quarantine(spark, sf_dir):
    """S13, E08."""
    bad = ev.rejected(ev.decode(record_stream(spark, sf_dir), FORM))
    out = finish(spark, bad.select("event_id", "event_type", "sent_at", "_payload"))
    return _ntz(out.select("event_id", "event_type", "sent_at",
                           F.get_json_object("_payload", "$.event_id").alias("payload_id")),
                "sent_at")


_WINDOWS = f"""
w as (
  select time_bucket(interval '5 minutes', sent_at) as window_start, team,
         count(*) as events, count(*) filter (where event_type = 'purchase') as purchases,
         cast(sum(cast(value as decimal(18,2))) filter (where event_type = 'purchase') as double) as revenue,
         {half_up("cast(sum(cast(value as decimal(18,2))) filter (where event_type = 'purchase') as double)"
                  " / nullif(count(*) filter (where event_type = 'purchase'), 0)", 2)} as purchase_mean,
         {half_up("avg(case when event_type = 'purchase' then cast(value >= 250 as integer) end) * 100")}
           as large_pct,
         max(latency_s) as latency_max_s, {half_up("avg(latency_s)", 2)} as latency_mean_s,
         count(distinct user_id) as users
  from ev where valid group by 1, 2)
"""
_CLOSED = """window_start + interval '5 minutes'
  <= (select max(sent_at) - interval '10 minutes' from ev where valid)"""


def tiers(spark, sf_dir):
    """All tiers over records that come twice, and late ones; the lake and the progress of its queries."""
    lake = retail_layers.lakehouse(spark, scratch_path(spark, "tiers"))
    bronze = record_stream(spark, sf_dir, copies=2, late=True)
    with runs.counted(spark) as progress:
        run_stream(lake, bronze)
        progress.complete()
    return lake, progress


@query("stream_windows", f"""
    with {_EVENTS}, {_WINDOWS} select window_start, window_start + interval '5 minutes' as window_end, team,
      events, purchases, revenue, purchase_mean, large_pct, latency_max_s, latency_mean_s from w where {_CLOSED}""")
def stream_windows(spark, sf_dir):
    """Closed windows over the deduplicated tier; records that come twice
    count once, and late ones not at all."""
    lake, _ = tiers(spark, sf_dir)
    return _ntz(lake.read("gold", "event_windows").drop("users", runs.BATCH, PROCESSED), "window_start", "window_end")


@query("approx_distinct", f"""
    with {_EVENTS}
    select date_trunc('day', sent_at)::timestamp as window_start, team, count(*) as events, true as close
    from ev where valid group by 1, 2""")
def approx_distinct(spark, sf_dir):
    """Users per day and team, on a batch, held against the exact count.

    The sketch's relative standard error is 5 %; three times that is taken as close.
    """
    bronze = ev.stamped(ev.envelope(records(spark, sf_dir)), "records", "run-1")
    good = ev.accepted(ev.decode(bronze, FORM))
    exact = F.count_distinct("user_id").alias("exact")
    out = good.groupBy(F.window(FORM.time, "1 day").alias("w"), "team").agg(*measures(), exact)
    close = F.abs(F.col("users") - F.col("exact")) <= F.greatest(F.lit(1), F.col("exact") * 0.15)
    return _ntz(out.select(F.col("w.start").alias("window_start"), "team", "events", close.alias("close")),
                "window_start")


@query("stream_progress", f"""
    with {_EVENTS}, {_WINDOWS},
    late as (
      select count(*) as n, count(*) filter (where valid) as v from ev
      where cast(event_id as bigint) % 20 = 3 and epoch_us(sent_at) < (select (min(epoch_us(sent_at)) + max(epoch_us(sent_at))) // 2 from ev)),
    c as (select 2 * count(*) + (select n from late) as n, count(*) filter (where valid) as v,
                 2 * count(*) filter (where not valid) + (select n - v from late) as bad from ev)
    select 'bronze.event_stream' as query, n as rows_read, n as rows_written, 0::bigint as late_rows, true as timed,
           true as triggers from c
    union all select 'silver.event_stream', n, v, (select v from late), true, true from c
    union all select 'refused.event_stream', n, bad, 0, true, true from c
    union all select 'gold.event_windows', v, (select count(*) from w where {_CLOSED}), 0, true, true from c""")
def stream_progress(spark, sf_dir):
    """All tiers, what each read, wrote and dropped as late, added up over every report."""
    lake, progress = tiers(spark, sf_dir)
    written = [(f"{s.layer}.{s.table_name}", s.rows_out) for s in lake.log.steps]
    written = spark.createDataFrame(written, "query string, rows_written long")
    least = F.when(F.col("query").startswith("gold"), 1).otherwise(SLICES + 1)
    return progress.frame(spark).join(written, "query").select(
        "query", "rows_read", "rows_written", "late_rows", (F.col("mean_batch_ms") > 0).alias("timed"),
        (F.col("batches") >= least).alias("triggers"))
