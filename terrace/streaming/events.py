"""Event streams: sources, decoding, deduplication and windows.

What an event looks like is declared once, as an ``EventFormat``; the functions
follow it and map a DataFrame to a DataFrame, on a batch as well as on a stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.functions.columns import canonical_code
from terrace.operators.lineage import ARRIVED_ON, ORIGIN
from terrace.session import has_kafka
from terrace.sources.schemas import schema

# Shape of a record as the message broker's connector delivers it.
RECORD = schema(key="binary", value="binary", topic="string", partition="int", offset="long",
                timestamp="timestamp")
# Names of a record's fields in the tiers that are not just the field with an underscore.
TIER_NAMES = {"value": "_payload", "timestamp": "_received_at"}

# Reader options; the caps are rows and files per trigger.
BROKER_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}
MAX_OFFSETS = 5000
MAX_FILES = 4


@dataclass(frozen=True)
class EventFormat:
    """Payload fields, and what is asked of them.

    ``time`` is a text field that becomes a timestamp; ``required`` fields may
    not be null; ``allowed`` limits the values of a field; ``codes`` are trimmed
    and upper-cased.
    """

    payload: StructType
    key: str
    time: str
    required: tuple[str, ...] = ()
    allowed: Mapping[str, Sequence[str]] = field(default_factory=dict)
    codes: tuple[str, ...] = ()

    def valid(self) -> Column:
        """Does a decoded row meet every demand? Never null."""
        demands = [F.col(c).isNotNull() for c in dict.fromkeys((self.key, self.time, *self.required))]
        demands += [F.col(c).isin(list(values)) for c, values in self.allowed.items()]
        return F.coalesce(reduce(Column.__and__, demands), F.lit(False))


def envelope(records: DataFrame, **constants: Column) -> DataFrame:
    """The record's fields under their tier names; binary fields become text.

    A field that the source does not deliver takes its constant, or null.
    """
    given = set(records.columns)

    def of(name: str, kind: str) -> Column:
        value = F.col(name) if name in given else constants.get(name, F.lit(None))
        return value.cast("string" if kind == "binary" else kind).alias(TIER_NAMES.get(name, f"_{name}"))

    return records.select(*[of(f.name, f.dataType.simpleString()) for f in RECORD])


def broker_stream(spark: SparkSession, servers: str, topic: str, max_offsets: int = MAX_OFFSETS) -> DataFrame:
    """A topic from its start, so many offsets per trigger at most."""
    options = broker_options(servers, topic, max_offsets)
    return envelope(spark.readStream.format("kafka").options(**options).load())


def broker_options(servers: str, topic: str, max_offsets: int = MAX_OFFSETS) -> dict[str, str]:
    return BROKER_OPTIONS | {"kafka.bootstrap.servers": servers, "subscribe": topic,
                             "maxOffsetsPerTrigger": str(max_offsets)}


def text_stream(spark: SparkSession, location: str, max_files: int = MAX_FILES) -> DataFrame:
    """A JSON text per line, so many files per trigger at most."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(location)
    return text_envelope(lines)


def text_envelope(lines: DataFrame) -> DataFrame:
    """Lines know neither topic nor offset; they arrive when they are read."""
    return envelope(lines, topic=F.lit("file"), timestamp=F.current_timestamp())


def open_source(
    spark: SparkSession, location: str | None = None, servers: str | None = None, topic: str | None = None,
) -> tuple[DataFrame, str]:
    """The broker when it is named and its connector is there, else text files."""
    if servers and topic and has_kafka(spark):
        return broker_stream(spark, servers, topic), "kafka"
    if location:
        return text_stream(spark, location), "file"
    raise ValueError("name a file location: the broker's connector is not on the class path")


def stamped(events: DataFrame, source: str, run_id: str) -> DataFrame:
    """When, from where and by which run the events came in."""
    origin = F.struct(F.current_timestamp().alias("at"), F.lit(run_id).alias("run"), F.lit(source).alias("system"))
    return events.select("*", origin.alias(ORIGIN), F.current_date().alias(ARRIVED_ON))


def decode(tier: DataFrame, form: EventFormat) -> DataFrame:
    """Payload fields with their types, beside latency, validity and the tier's own columns.

    Malformed text and unreadable times give nulls, hence an invalid event, and
    do not fail the query (D8). The payload itself stays for the quarantine (D11).
    """
    # a generator is not moved into the filters behind it, each of which would read the text again
    names = {name: f"__{name}" for name in form.payload.fieldNames()}
    read = tier.select("*", F.inline(F.array(F.from_json("_payload", form.payload))).alias(*names.values()))
    fields = {name: F.col(inner) for name, inner in names.items()}
    fields[form.time] = F.try_to_timestamp(fields[form.time])
    fields |= {name: canonical_code(fields[name]) for name in form.codes}
    out = read.select(*[value.alias(name) for name, value in fields.items()],
                      *[c for c in tier.columns if c not in ("_key", "_topic")])
    latency = F.unix_timestamp("_received_at") - F.unix_timestamp(form.time)
    return out.select("*", latency.alias("latency_s"), form.valid().alias("valid"))


def accepted(decoded: DataFrame) -> DataFrame:
    """Valid events."""
    return decoded.where("valid").drop("valid")


def rejected(decoded: DataFrame) -> DataFrame:
    """Invalid events, before deduplication, so that several without a key stay."""
    return decoded.where("not valid")


def once(events: DataFrame, form: EventFormat, delay: str = "10 minutes") -> DataFrame:
    """An event that is delivered again is dropped; a key is forgotten once the
    watermark has passed it (D9)."""
    return events.withWatermark(form.time, delay).dropDuplicatesWithinWatermark([form.key])


def window_metrics(
    events: DataFrame, form: EventFormat, keys: Sequence[str], measures: Sequence[Column],
    size: str = "5 minutes", delay: str = "10 minutes",
) -> DataFrame:
    """The caller's measures per tumbling window and keys.

    Feed it the deduplicated tier, so that an event that is delivered again counts once (D12).
    """
    window = F.window(form.time, size)
    return events.withWatermark(form.time, delay).groupBy(window.alias("_w"), *keys).agg(*measures).select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "*").drop("_w")
