"""Batch layers: ingest, publish and the staged run."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.operators.contracts import REASON, Contract, Marked, enforce, mark, measured_report, summarize
from terrace.operators.lineage import ARRIVED_ON, processed, with_lineage
from terrace.operators.runlog import Check, RunLog, Step
from terrace.sources import tables
from terrace.sources.staging import freed


YEAR = "_year"
LONGEST_REASON = 120      # characters that surely fit into a name of a directory, however they are escaped


@dataclass
class Lakehouse:
    """Where the layers lie, how they are written, and what happened to them."""

    spark: SparkSession
    root: str
    contracts: Mapping[str, Mapping[str, Contract]] = field(default_factory=dict)
    fmt: str = "parquet"
    codec: str = "zstd"         # of Parquet files: most bytes are hashes in hex and payloads, which snappy leaves as they are
    stop_on_critical: bool = True
    parallel: int = 4
    derived: Sequence[str] = ("silver", "gold")     # layers whose rows carry when they were made
    log: RunLog | None = None

    def __post_init__(self):
        self.log = self.log or RunLog(self.spark)

    def location(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return tables.read_table(self.spark, self.location(layer, table), self.fmt)

    def make_location(self, layer: str, table: str) -> None:
        """An empty table directory, for a reader that starts before the first writer."""
        tables.make_dir(self.spark, self.location(layer, table))

    def reset(self, layers: Sequence[str] = ("bronze", "silver", "gold", "refused", "_quarantine", "_checkpoints")) -> None:
        """Full reprocess, table directories removed layer by layer, and how far the streams had read."""
        for layer in layers:
            tables.drop_table_dir(self.spark, f"{self.root}/{layer}")

    def publish(
        self, df: DataFrame, layer: str, table: str,
        references: Mapping[str, DataFrame] | None = None, partition_by: Sequence[str] = (),
        overwrite: str = "static", cluster: bool = True,
    ) -> DataFrame:
        """Contract, quarantine, fail-fast, write, log.

        Rows are written once, refused ones under their reason as a partition
        value, and the checks are counted in that very write. The quarantine
        takes its place before a critical failure raises, so the cause can be
        looked at (D5); a run without quarantined rows removes that of the run
        before. Valid rows become the table by renaming, or not at all.
        ``overwrite="dynamic"`` replaces only the partitions the rows bring. ``cluster=False`` spares the shuffle of rows of
        which a task holds few partition values.
        """
        with self.log.step(layer, table, self.location(layer, table)) as step:
            self.take_in(step, df, layer, table, references, partition_by, overwrite, cluster)
        return self.read(layer, table)

    def take_in(
        self, step: Step, df: DataFrame, layer: str, table: str,
        references: Mapping[str, DataFrame] | None = None, partition_by: Sequence[str] = (),
        overwrite: str = "static", cluster: bool = True, batchwise: bool = False,
    ) -> None:
        """What ``publish`` does inside a step that is already open; figures add up over calls.

        ``batchwise`` keeps the quarantine of the batches before, each a partition.
        """
        contract = self.contracts.get(layer, {}).get(table, Contract())
        location = self.location(layer, table)
        if layer in self.derived:
            df = processed(df, self.log.run_id, datetime.now(timezone.utc))
        with freed(self.spark), self._staging() as path:
            marked = mark(df, contract, references)
            figures = self._write(marked, path, partition_by, cluster)
            report = measured_report(self.spark, marked, figures)
            summary = summarize(report)
            step.rows_in += summary["rows_in"]
            step.rows_quarantined += summary["rows_quarantined"]
            step.add_checks(summary["score"], [
                Check(r["rule"], r["column"], r["critical"], r["status"], r["detail"]) for r in report if r["position"] > 0])
            self._quarantine(marked, path, layer, table, bool(summary["rows_quarantined"]), partition_by, batchwise)
            if self.stop_on_critical:
                enforce(report, f"{layer}.{table}")
            if summary["rows_valid"] == 0 and not (overwrite == "dynamic" and partition_by):
                # no row, no file: the table still has its columns
                tables.write_table(tables.empty_like(df), f"{path}/valid", fmt=self.fmt)
            if self.fmt == "parquet" or summary["rows_valid"] == 0:
                if tables.exists(self.spark, f"{path}/valid"):
                    tables.swap_in(self.spark, f"{path}/valid", location, partition_by, overwrite)
            else:
                valid = self.spark.read.schema(df.schema).parquet(f"{path}/valid")
                tables.write_table(valid, location, partition_by=partition_by, overwrite=overwrite, fmt=self.fmt)
            step.rows_out += summary["rows_valid"]

    @contextmanager
    def _staging(self) -> Iterator[str]:
        """A folder beside the layers, hence on their file system, that does not outlive the step."""
        path = f"{self.root}/_staging/{uuid.uuid4().hex}"
        try:
            yield path
        finally:
            tables.drop_table_dir(self.spark, path)

    def _write(self, marked: Marked, path: str, partition_by: Sequence[str], cluster: bool) -> dict[str, int]:
        """Write marked rows once, to ``valid`` and ``refused`` under ``path``; returns the checks' figures."""
        rows = marked.rows
        if partition_by and cluster:
            rows = rows.hint("rebalance", *partition_by, REASON)
        # behind the shuffle: a map task that runs again would be counted again
        seen = Observation(f"publish-{uuid.uuid4().hex}")
        rows = rows.observe(seen, *marked.counts())
        if marked.longest_reason() > LONGEST_REASON:
            rows = rows.withColumn(REASON, marked.codes())
        rows = rows.drop(*marked.helpers).withColumn(REASON, F.nullif(F.col(REASON), F.lit("")))
        rows.write.option("compression", self.codec).partitionBy(REASON, *partition_by).parquet(f"{path}/refused")
        figures = dict(seen.get)
        if repeats := marked.repeats(self.spark.read.schema(rows.schema).parquet(f"{path}/refused")):
            figures |= {name: n.first()[0] for name, n in repeats.items()}
        valid = f"{path}/refused/{REASON}=__HIVE_DEFAULT_PARTITION__"
        if tables.exists(self.spark, valid):
            tables.replace_dir(self.spark, valid, f"{path}/valid")
        return figures

    def _quarantine(
        self, marked: Marked, path: str, layer: str, table: str, refused: bool, partition_by: Sequence[str], batchwise: bool,
    ) -> None:
        """Refused rows of one table take the place of those of the run before."""
        location = tables.quarantine_location(self.root, layer, table)
        if not batchwise:
            tables.drop_table_dir(self.spark, location)
        mode = "dynamic" if batchwise else "static"
        if refused and marked.longest_reason() > LONGEST_REASON:
            coded = self.spark.read.schema(marked.rows.drop(*marked.helpers).schema).parquet(f"{path}/refused")
            tables.write_table(coded.withColumn(REASON, marked.decoded(F.col(REASON))), location,
                               partition_by=partition_by, overwrite=mode)
        elif refused:
            tables.swap_in(self.spark, f"{path}/refused", location, [REASON, *partition_by], mode)

    def ingest(
        self, entity: str, source: str, schema: StructType, system: str,
        ingested_at: datetime | None = None, partition_by: Sequence[str] = (ARRIVED_ON,), year_of: str | None = None,
    ) -> DataFrame:
        """CSV to bronze with lineage; an earlier ingestion date stays untouched.

        ``year_of`` names a date whose year parts the table inside the other partitions (S07). The rows, most of
        whose bytes are their hashes, are not shuffled for it: a task writes the few years it holds side by side.
        """
        with self.log.step("bronze", entity, self.location("bronze", entity)) as step:
            raw = tables.scan_csv(self.spark, source, schema)
            stamped = with_lineage(raw, entity, source.rsplit("/", 1)[-1], system, self.log.run_id, ingested_at)
            if year_of:
                stamped = stamped.withColumn(YEAR, F.year(year_of))
                partition_by = [*partition_by, YEAR]
            self.take_in(step, stamped, "bronze", entity, partition_by=partition_by, overwrite="dynamic",
                         cluster=not set(partition_by) <= {ARRIVED_ON, YEAR})
        return self.read("bronze", entity)

    def together(self, *jobs: Callable[[], object]) -> list:
        """Independent steps submitted side by side, so that one step's small jobs
        do not leave the cluster idle; the first failure is raised after all ended.
        What a job stages is removed when it ends."""

        def run(job: Callable[[], object]) -> object:
            with freed(self.spark):
                return job()

        with ThreadPoolExecutor(max_workers=self.parallel) as pool:
            futures = [pool.submit(run, job) for job in jobs]
        return [f.result() for f in futures]

    def save_log(self) -> str:
        return self.log.save(self.root)
