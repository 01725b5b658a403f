"""The events table as a stream: what its records look like, and its tiers in the layered run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.plans.layers import Lakehouse
from terrace.plans.retail import table
from terrace.sources.schemas import schema
from terrace.streaming import events as ev
from terrace.streaming.runs import Tier, read_tier, run_tier

FORM = ev.EventFormat(
    payload=schema(event_id="string", event_type="string", user_id="long", team="string", sent_at="string",
                   value="double", k="int"),
    key="event_id", time="sent_at", required=("user_id",),
    allowed={"event_type": ("click", "purchase", "signup", "view")}, codes=("team",))

SLICES = 5


def measures():
    """What is counted per window and team."""
    bought = F.col("event_type") == "purchase"
    large = F.avg(F.when(bought, (F.col("value") >= 250).cast("int"))) * 100
    value = F.sum(F.when(bought, F.col("value").cast("decimal(18,2)")))
    return (
        F.count(F.lit(1)).alias("events"), F.count_if(bought).alias("purchases"), value.cast("double").alias("revenue"),
        F.round(F.try_divide(value, F.count_if(bought)).cast("double") + 1e-8, 2).alias("purchase_mean"),
        F.round(large + 1e-8, 1).alias("large_pct"), F.max("latency_s").alias("latency_max_s"),
        F.round(F.avg("latency_s") + 1e-8, 2).alias("latency_mean_s"),
        F.approx_count_distinct("user_id").alias("users"))


def records(spark, sf_dir):
    """Events as records with a JSON payload; a record arrives the event's k seconds after it is sent."""
    events = table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int"))
    ts = F.col("ts").cast("timestamp")
    payload = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"), "event_type", "user_id",
        F.concat(F.lit(" t"), (F.col("user_id") % 5).cast("string")).alias("team"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("sent_at"), "value", "k"))
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        payload.cast("binary").alias("value"), F.lit("events").alias("topic"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
        F.timestamp_seconds(F.unix_timestamp(ts) + F.col("k")).alias("timestamp"), ts.alias("_ts"))


def belated(batch: DataFrame) -> DataFrame:
    """Every twentieth record of the first half of the time, under a new event id: what comes too late, by the
    watermark that the batch before the last one left. Only these are held against each other for repeats."""
    at = F.unix_micros("_ts")
    middle = batch.agg(F.floor((F.min(at) + F.max(at)) / 2)).scalar()
    late = batch.where((F.col("offset") % 20 == 3) & (at < middle)).dropDuplicates(["offset"])
    renamed = F.regexp_replace(F.col("value").cast("string"), '"event_id":"', '"event_id":"late-').cast("binary")
    return late.withColumn("value", renamed)


def deliver(batch: DataFrame, path: str, write: Callable, late: bool = False, copies: int = 1) -> None:
    """Write every record ``copies`` times, slice by slice in the order of their time, and ``late`` ones after all.

    A slice is as many files as a trigger takes, so each trigger brings one
    slice and no event but the late ones is older than the watermark when it arrives.
    A record's text is made once, whatever the copies.
    """
    ends = batch.select(F.percentile_approx(F.unix_micros("_ts"), [k / SLICES for k in range(1, SLICES)])).first()[0]
    at = F.unix_micros("_ts")
    slices = []
    for low, high in zip([None, *(ends or [])], [*(ends or []), None], strict=True):
        part = batch if low is None else batch.where(at > low)
        part = part if high is None else part.where(at <= high)
        if copies > 1:
            part = part.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("_copy")).drop("_copy")
        slices.append(part)
    if late:
        slices.append(belated(batch))
    for part in slices:
        write(part.repartition(ev.MAX_FILES).drop("_ts").write.mode("append"), path)


def land_events(spark, sf_dir, path: str) -> None:
    """The records' JSON texts as lines of compressed files."""
    lines = records(spark, sf_dir).select(F.col("value").cast("string").alias("value"), "_ts")
    deliver(lines, path, lambda writer, to: writer.option("compression", "gzip").text(to))


def source_tiers(bronze: DataFrame) -> list[Tier]:
    """The tiers that read the records: as they came, valid events once, and what is refused."""
    decoded = ev.decode(bronze, FORM)
    return [Tier("bronze", "event_stream", bronze, ("_ingestion_date",)),
            Tier("silver", "event_stream", ev.once(ev.accepted(decoded), FORM)),
            Tier("refused", "event_stream", ev.rejected(decoded))]


def window_tier(lake: Lakehouse, bronze: DataFrame) -> Tier:
    """Windows over the deduplicated tier's files, in a query of its own."""
    events = read_tier(lake, "silver", "event_stream", ev.accepted(ev.decode(bronze, FORM)).schema)
    return Tier("gold", "event_windows", ev.window_metrics(events, FORM, ["team"], measures()))


def run_stream(lake: Lakehouse, bronze: DataFrame, timeout_s: float | None = None) -> None:
    """What has arrived, through all tiers; a later run goes on where this one ended."""
    lake.together(*[lambda t=t: run_tier(lake, t, timeout_s) for t in source_tiers(bronze)])
    run_tier(lake, window_tier(lake, bronze), timeout_s)
