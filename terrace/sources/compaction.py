"""Incremental compaction of a Parquet table (S23): only small or overlapping files are written anew.

Files are picked by their sizes, and by how many of them lie over one place of the clustering order. The picked
ones are sorted together and cut into files of the wanted size; all other files stay as they are. New files carry
the run's id in their names, and a run counts from the one renaming that publishes the list of what it replaced, so
``read_live`` shows the rows once, before, at and after that moment. Replaced files are kept for readers that have
begun, until ``expire``. Plain appends to the directory are seen at once; a reader of the bare directory may meet a
row twice between the publishing and ``expire``. A run that dies leaves files that no reader takes.

Sizes, extremes and the choice are tables with one row per file; the names of the files that a read takes pass the
driver, as they do in Spark's own index. One run at a time per table: a run whose files another one has replaced
raises before it publishes. Clustering columns are data columns; null values count as the lowest place. A table
without files gives an empty run.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.sources.staging import stage
from terrace.sources.tables import _path, _rename, exists, files_for, interleaved, make_dir

RUNS = "_runs"
_OF_RUN = "(?:^|/)compact-([0-9a-f]{32})-[^/]*$"


@dataclass(frozen=True)
class CompactionRules:
    target_bytes: int = 128 << 20
    small: float = 0.3              # a file below this share of the target is merged with others
    depth: int | None = 4           # files over one place before they are sorted anew; None: sizes only


@dataclass(frozen=True)
class Compaction:
    run: str | None                 # None: nothing to do
    replaced: int = 0
    written: int = 0


def _relative(spark: SparkSession, location: str, path: Column) -> Column:
    """The part of a file's address behind the table's directory, URL-encoded as Spark gives it."""
    root = _path(spark, location)[0].toUri().getRawPath().rstrip("/")
    return F.split(path, re.escape(root + "/"), 2)[1]


def _replaced(spark: SparkSession, location: str) -> tuple[list[str], DataFrame]:
    """Published runs, and the files that they replaced."""
    found = _path(spark, f"{location}/{RUNS}")[1].globStatus(_path(spark, f"{location}/{RUNS}/[0-9a-f]*")[0])
    runs = [f.getPath().getName() for f in found or []]
    if not runs:
        return [], spark.createDataFrame([], "file string")
    return runs, spark.read.text([f"{location}/{RUNS}/{r}" for r in runs]).toDF("file").distinct()


def _listed(spark: SparkSession, location: str) -> DataFrame:
    """(file, bytes) of every data file in the directory, published or not; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet").load(location)
    return found.select(_relative(spark, location, F.col("_metadata.file_path")).alias("file"),
                        F.col("length").alias("bytes"))


def live_files(spark: SparkSession, location: str) -> DataFrame:
    """(file, bytes) of the files that make up the table now."""
    runs, replaced = _replaced(spark, location)
    run = F.regexp_extract("file", _OF_RUN, 1)
    return _listed(spark, location).where((run == "") | run.isin(runs)).join(replaced, "file", "left_anti")


def _load(spark: SparkSession, location: str, files: Sequence[str], **options) -> DataFrame:
    return spark.read.options(**options).parquet(*[f"{location}/{unquote(f)}" for f in files])


def read_live(spark: SparkSession, location: str) -> DataFrame:
    """The table's rows, each once, with its partition columns."""
    files = [r.file for r in live_files(spark, location).select("file").collect()]
    if not files:
        return spark.read.parquet(location)
    return _load(spark, location, files, basePath=location)


def _place(rows: DataFrame, cluster_by: Sequence[str]) -> Column:
    """The place of a row in the clustering order as one number."""
    if len(cluster_by) > 1:
        return interleaved(rows, cluster_by)
    kind = rows.schema[cluster_by[0]].dataType.typeName()
    value = F.col(cluster_by[0])
    return (value.cast("timestamp") if kind.startswith(("date", "timestamp")) else value).cast("double")


def file_ranges(spark: SparkSession, location: str, files: DataFrame, cluster_by: Sequence[str]) -> DataFrame:
    """(file, bytes, low, high): the files with the extremes of their rows' places; reads the clustering columns."""
    names = [r.file for r in files.select("file").collect()]
    rows = _load(spark, location, names)
    ends = rows.select(_relative(spark, location, F.col("_metadata.file_path")).alias("file"),
                       _place(rows, cluster_by).alias("_at")).groupBy("file").agg(
        F.min("_at").alias("low"), F.max("_at").alias("high"))
    return files.join(ends, "file", "left")


def _folder() -> Column:
    return F.concat(F.lit("/"), F.regexp_extract("file", "^(?:.*/)?", 0))


def crowded(ranges: DataFrame, depth: int) -> DataFrame:
    """(file) of those that cover a place over which more than ``depth`` files of their directory lie.

    Ends are swept in order, one row per end of a file; files that only touch do not overlap.
    """
    ends = ranges.where("low < high").select(_folder().alias("folder"), "file", F.explode(F.array(
        F.struct(F.col("low").alias("at"), F.lit(1).alias("step")),
        F.struct(F.col("high").alias("at"), F.lit(-1).alias("step")))).alias("e")).select("folder", "file", "e.*")
    along = Window.partitionBy("folder").orderBy("at", "step", "file").rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.withColumn("open", F.sum("step").over(along))
    deep = ((F.col("step") == 1) & (F.col("open") > depth)).cast("int")
    ends = ends.withColumn("deep", F.sum(deep).over(along)).withColumn("here", deep)
    by_file = ends.groupBy("file").agg(
        F.max(F.when(F.col("step") == -1, F.col("deep"))).alias("last"),
        F.max(F.when(F.col("step") == 1, F.col("deep") - F.col("here"))).alias("before"),
        F.max(F.when(F.col("step") == 1, F.col("open"))).alias("open"))
    # a deep place inside, or one that was deep when the file began
    return by_file.where((F.col("last") > F.col("before")) | (F.col("open") > depth)).select("file")


def pick(spark: SparkSession, location: str, cluster_by: Sequence[str], rules: CompactionRules) -> DataFrame:
    """(file, bytes) worth writing anew: two or more small files of a directory, and of the others, which the small
    ones will not lie over any more in their number, those that lie too deep."""
    files = stage(live_files(spark, location), "files")
    small = files.where(F.col("bytes") < rules.small * rules.target_bytes).withColumn("folder", _folder())
    several = small.groupBy("folder").count().where("count > 1").select("folder")
    chosen = small.join(several, "folder", "left_semi").select("file")
    others = files.join(chosen, "file", "left_anti")
    if rules.depth is not None and not others.isEmpty():
        chosen = chosen.union(crowded(file_ranges(spark, location, others, cluster_by), rules.depth))
    return stage(files.join(chosen, "file", "left_semi"), "picked")


def compact_files(
    spark: SparkSession, location: str, cluster_by: Sequence[str], rules: CompactionRules = CompactionRules(),
) -> Compaction:
    """Write the picked files anew, clustered, and put them in the place of the old ones."""
    picked = pick(spark, location, cluster_by, rules)
    old = picked.collect()
    if not old:
        return Compaction(None)
    run = uuid.uuid4().hex
    folder, place = f"folder_{run}", f"place_{run}"
    rows = _load(spark, location, [r.file for r in old], mergeSchema=True)
    encoded = _relative(spark, location, F.col("_metadata.file_path"))
    out = rows.select("*", F.concat(F.lit("/"), F.regexp_extract(encoded, "^(?:.*/)?", 0)).alias(folder),
                      _place(rows, cluster_by).alias(place))
    order = [folder, place, *cluster_by]
    out = out.repartitionByRange(files_for(sum(r.bytes for r in old), rules.target_bytes), *order)
    made = f"{location}/_compact-{run}"
    out.sortWithinPartitions(*order).drop(place).write.partitionBy(folder).option("compression", "snappy").parquet(made)

    hidden, fs = _path(spark, made)
    parts = [f.getPath() for f in fs.globStatus(_path(spark, f"{made}/*/part-*")[0])]
    for part in parts:
        # the folder was encoded in the file's address, and again as a partition value
        inside = unquote(unquote(part.getParent().getName().split("=", 1)[1]))
        _rename(fs, part, _path(spark, f"{location}{inside}compact-{run}-{part.getName()}")[0])
    fs.delete(hidden, True)
    publish(spark, location, run, picked.select("file"))
    return Compaction(run, len(old), len(parts))


def publish(spark: SparkSession, location: str, run: str, replaced: DataFrame) -> None:
    """One renaming makes a run's files part of the table and takes the replaced ones out."""
    make_dir(spark, f"{location}/{RUNS}")
    draft, target = f"{location}/{RUNS}/_new-{run}", f"{location}/{RUNS}/{run}"
    replaced.coalesce(1).write.text(draft)
    if not replaced.join(_replaced(spark, location)[1], "file", "left_semi").isEmpty():
        raise RuntimeError(f"{location}: another run has replaced files of this one; run {run} is given up")
    new, fs = _path(spark, draft)
    _rename(fs, new, _path(spark, target)[0])


def expire(spark: SparkSession, location: str, age_hours: float = 24.0) -> int:
    """Delete files that runs replaced at least ``age_hours`` ago; returns their number.

    The age is to be longer than any read. Lists of what was replaced stay, so a published run stays published.
    """
    if not exists(spark, f"{location}/{RUNS}"):
        return 0
    _, fs = _path(spark, location)
    now = spark.sql("select unix_millis(current_timestamp())").first()[0]
    found = fs.globStatus(_path(spark, f"{location}/{RUNS}/[0-9a-f]*")[0]) or []
    due = [f.getPath().getName() for f in found if now - f.getModificationTime() >= age_hours * 3_600_000]
    if not due:
        return 0
    replaced = spark.read.text([f"{location}/{RUNS}/{r}" for r in due]).toDF("file").distinct()
    gone = [r.file for r in _listed(spark, location).join(replaced, "file", "left_semi").select("file").collect()]
    for file in gone:
        fs.delete(_path(spark, f"{location}/{unquote(file)}")[0], False)
    return len(gone)
