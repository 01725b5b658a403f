"""Streams as steps of a layered run: batches under a contract, supervision, progress.

A tier is one query with one checkpoint and at most one stateful operator. Its
batches pass the contract of the table they belong to and are written under
their number, so a batch that runs again after a failure replaces what it wrote
before. The next tier reads these files as a stream of its own.

Watermarks across tiers: a batch appears as a whole, by renaming, and the reader
takes whole batches, since it has no cap of files. It therefore never judges one
part of a batch by the times in another part, and its watermark, made of earlier
batches, is at most the one under which the batch was accepted before. Nothing
that the tier before kept is late for the next one.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from terrace.operators.runlog import Step
from terrace.plans.layers import Lakehouse

BATCH = "_batch"


class StreamFailure(RuntimeError):
    """A streaming query ended with an error."""


class StreamTimeout(RuntimeError):
    """Streaming queries were not finished in time; their sinks are incomplete."""


@dataclass(frozen=True)
class Tier:
    """A stream and the table that takes its batches; ``every=None`` takes what is there and ends."""

    layer: str
    table: str
    stream: DataFrame
    partition_by: tuple[str, ...] = ()
    every: str | None = None

    @property
    def name(self) -> str:
        return f"{self.layer}.{self.table}"


def to_files(stream: DataFrame, path: str, checkpoint: str, every: str | None = None, **options) -> StreamingQuery:
    """A file sink with a checkpoint of its own; ``options`` are those of ``start``."""
    when = {"availableNow": True} if every is None else {"processingTime": every}
    return stream.writeStream.trigger(**when).start(
        path, format="parquet", outputMode="append", checkpointLocation=checkpoint, **options)


def read_tier(lake: Lakehouse, layer: str, table: str, schema: StructType) -> DataFrame:
    """The table of another tier as a stream of whole batches."""
    lake.make_location(layer, table)
    stored = StructType([*schema.fields, StructField(BATCH, LongType())])
    return lake.spark.readStream.schema(stored).parquet(lake.location(layer, table)).drop(BATCH)


def start_tier(lake: Lakehouse, tier: Tier, step: Step) -> StreamingQuery:
    """A running tier; every batch adds its figures to ``step``."""
    def take(batch: DataFrame, number: int) -> None:
        numbered = batch.withColumn(BATCH, F.lit(number).cast("long"))
        lake.take_in(step, numbered, tier.layer, tier.table, partition_by=[*tier.partition_by, BATCH],
                     overwrite="dynamic", cluster=False, batchwise=True)

    when = {"availableNow": True} if tier.every is None else {"processingTime": tier.every}
    return tier.stream.writeStream.foreachBatch(take).trigger(**when).queryName(tier.name).option(
        "checkpointLocation", f"{lake.root}/_checkpoints/{tier.layer}/{tier.table}").start()


def run_tier(lake: Lakehouse, tier: Tier, timeout_s: float | None = None) -> Step:
    """A bounded tier from start to end as one step of the run log."""
    with lake.log.step(tier.layer, tier.table, lake.location(tier.layer, tier.table)) as step:
        supervise({tier.name: start_tier(lake, tier, step)}, timeout_s)
    return step


def _look(queries: Mapping[str, StreamingQuery]) -> list[str]:
    """Names still running; raises the cause of the first failure."""
    # activity is read first: a query that fails after this is seen as running and looked at again
    running = [name for name, query in queries.items() if query.isActive]
    failed = {name: query.exception() for name, query in queries.items()}
    for name, cause in failed.items():
        if cause is not None:
            raise StreamFailure(f"stream '{name}' ended: {cause}")
    return running


@contextmanager
def _stopped_at_the_end(queries: Mapping[str, StreamingQuery]) -> Iterator[None]:
    try:
        yield
    finally:
        for query in queries.values():
            if query.isActive:
                query.stop()


def supervise(
    queries: Mapping[str, StreamingQuery], timeout_s: float | None = None, poll_s: float = 0.5,
) -> None:
    """Wait until every bounded query has ended by itself.

    The cause of a failure is raised; so is a time-out, with the names of the
    queries that are not finished. What still runs then is stopped.
    """
    begin = time.monotonic()
    with _stopped_at_the_end(queries):
        while running := _look(queries):
            if timeout_s is not None and time.monotonic() - begin >= timeout_s:
                raise StreamTimeout(f"not finished after {timeout_s} s: {', '.join(running)}")
            try:
                queries[running[0]].awaitTermination(poll_s)
            except StreamingQueryException:
                pass  # named and raised by the next look


def observe(queries: Mapping[str, StreamingQuery], seconds: float, poll_s: float = 0.5) -> None:
    """Let continuous queries run for a while, then stop them; a failure is raised."""
    begin = time.monotonic()
    with _stopped_at_the_end(queries):
        while _look(queries) and time.monotonic() - begin < seconds:
            time.sleep(poll_s)


@dataclass
class Totals:
    """What all reports of one query add up to."""

    batches: int = 0
    rows_read: int = 0
    busy_ms: int = 0
    late_rows: int = 0            # dropped by a watermark
    state_rows: int = 0           # at the latest report
    watermark: str | None = None
    ended: bool = False
    last_batch: int = -1


class Progress(StreamingQueryListener):
    """Adds up every report of every named query, however few of them Spark keeps."""

    def __init__(self):
        self.totals: dict[str, Totals] = {}
        self._names: dict[str, str] = {}
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        with self._news:
            self._names[str(event.runId)] = event.name or str(event.id)
            self.totals.setdefault(event.name or str(event.id), Totals()).ended = False

    def onQueryProgress(self, event) -> None:  # noqa: N802
        report = event.progress
        with self._news:
            total = self.totals.setdefault(report.name or str(report.id), Totals())
            # a batch that is tried again counts as work, not as a batch
            total.batches += report.batchId > total.last_batch
            total.last_batch = max(total.last_batch, report.batchId)
            total.rows_read += report.numInputRows
            total.busy_ms += report.durationMs.get("triggerExecution", 0)
            total.late_rows += sum(s.numRowsDroppedByWatermark for s in report.stateOperators)
            total.state_rows = sum(s.numRowsTotal for s in report.stateOperators)
            total.watermark = report.eventTime.get("watermark", total.watermark)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._news:
            if (name := self._names.get(str(event.runId))) in self.totals:
                self.totals[name].ended = True
            self._news.notify_all()

    def complete(self, timeout_s: float = 30.0) -> dict[str, Totals]:
        """The totals once the end of every query has been reported, after all its reports."""
        with self._news:
            if not self._news.wait_for(lambda: all(t.ended for t in self.totals.values()), timeout_s):
                raise StreamTimeout("reports are missing")
            return dict(self.totals)

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per query."""
        rows = [(name, t.batches, t.rows_read, t.late_rows, t.state_rows, t.watermark,
                 t.busy_ms / max(t.batches, 1), 1000.0 * t.rows_read / max(t.busy_ms, 1))
                for name, t in self.complete().items()]
        return spark.createDataFrame(
            rows, "query string, batches long, rows_read long, late_rows long, state_rows long, watermark string, "
                  "mean_batch_ms double, rows_per_s double")


@contextmanager
def counted(spark: SparkSession) -> Iterator[Progress]:
    """Listen to the queries that run inside."""
    progress = Progress()
    spark.streams.addListener(progress)
    try:
        yield progress
    finally:
        spark.streams.removeListener(progress)
