"""Table scans and sinks over any Hadoop file system."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class MissingSourceError(FileNotFoundError):
    """An input is absent; the message says how to get it."""


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, location: str) -> bool:
    """Does the table directory exist (local or remote)?"""
    path, fs = _path(spark, location)
    return bool(fs.exists(path))


def require(spark: SparkSession, location: str, remedy: str) -> str:
    """Fail with the remedy when a source is missing."""
    if not exists(spark, location):
        raise MissingSourceError(f"{location} is missing: {remedy}")
    return location


def make_dir(spark: SparkSession, location: str) -> None:
    path, fs = _path(spark, location)
    fs.mkdirs(path)


def drop_table_dir(spark: SparkSession, location: str) -> bool:
    """Remove one table directory before a full reprocess."""
    path, fs = _path(spark, location)
    return bool(fs.delete(path, True)) if fs.exists(path) else False


def table_bytes(spark: SparkSession, location: str | None) -> int:
    """Stored size, 0 for an absent table."""
    if not location or not exists(spark, location):
        return 0
    path, fs = _path(spark, location)
    return int(fs.getContentSummary(path).getLength())


def scan_csv(
    spark: SparkSession, location: str | Sequence[str], schema: StructType, remedy: str = "",
    match_header: bool = True,
) -> DataFrame:
    """Header CSV with an explicit schema; a bad field reads as null.

    With ``match_header`` a reordered or renamed header raises instead of being
    read into the wrong columns (D3).
    """
    for path in [location] if isinstance(location, str) else location:
        require(spark, path, remedy or "deliver the file before the ingest")
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", not match_header)
        .csv(location)
    )


def read_external_csv(
    spark: SparkSession, location: str, rename: Mapping[str, str], types: Mapping[str, str],
    provenance: str, sort_by: str,
) -> DataFrame:
    """Foreign CSV to canonical names and types with a provenance column.

    The byte order mark that some exports put before the first header is
    dropped by name, without a second read of the data.
    """
    raw = spark.read.option("header", True).option("encoding", "UTF-8").csv(location)
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    picked = [F.col(old).try_cast(types[new]).alias(new) for old, new in rename.items()]
    return raw.select(*picked, F.lit(provenance).alias("provenance")).orderBy(sort_by)


def read_table(spark: SparkSession, location: str, fmt: str = "parquet") -> DataFrame:
    """Table scan with partition discovery."""
    return spark.read.format(fmt).load(location)


def write_table(
    df: DataFrame, location: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
    overwrite: str = "dynamic", fmt: str = "parquet", cluster: bool = True,
) -> str:
    """Table sink.

    ``overwrite="dynamic"`` replaces only the partitions present in ``df``;
    ``"static"`` replaces the whole table. For a partitioned sink the rows are
    first spread by partition value with a rebalance, which AQE may split, so a
    value holding a third of the rows is written by many tasks and a task does
    not open one file per value.
    """
    if partition_by and cluster:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", overwrite)
    writer.save(location)
    return location


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {source} to {target}")


def replace_dir(spark: SparkSession, source: str, target: str) -> None:
    """Put one directory in another's place by renaming, on the same file system.

    The old one steps aside under a hidden name first, so a reader sees the old
    or the new files, never both; if the second renaming fails it is put back.
    """
    new, fs = _path(spark, source)
    old, _ = _path(spark, target)
    if not fs.exists(new):
        raise FileNotFoundError(f"{source} is missing: nothing to put in the place of {target}")
    fs.mkdirs(old.getParent())
    aside, _ = _path(spark, f"{old.getParent().toString()}/_old-{uuid.uuid4().hex}")
    moved = bool(fs.exists(old))
    if moved:
        _rename(fs, old, aside)
    try:
        _rename(fs, new, old)
    except BaseException:
        if moved:
            _rename(fs, aside, old)
        raise
    fs.delete(aside, True)


def leaves(spark: SparkSession, location: str, depth: int) -> list[str]:
    """Partition directories ``depth`` levels down, relative to the table."""
    root, fs = _path(spark, location)
    found = fs.globStatus(_path(spark, f"{location}/" + "/".join(["*=*"] * depth))[0]) if depth else []
    # the glob is spelled out by the file system, so the last parts are taken
    return ["/".join(str(f.getPath().toString()).rsplit("/", depth)[-depth:]) for f in found or []]


def swap_in(
    spark: SparkSession, source: str, target: str, partition_by: Sequence[str] = (), overwrite: str = "static",
) -> None:
    """Make written files a table, or only replace the partitions they bring."""
    if overwrite == "static" or not partition_by:
        replace_dir(spark, source, target)
        return
    for leaf in leaves(spark, source, len(partition_by)):
        replace_dir(spark, f"{source}/{leaf}", f"{target}/{leaf}")


def empty_like(df: DataFrame, **extra: str) -> DataFrame:
    """No rows, the same schema, plus typed null columns."""
    out = df.where(F.lit(False))
    return out.withColumns({n: F.lit(None).cast(t) for n, t in extra.items()}) if extra else out


def count_rows(spark: SparkSession, location: str, fmt: str = "parquet") -> int:
    """Rows in a sink, 0 when it is absent or holds no data file yet."""
    if not exists(spark, location):
        return 0
    try:
        return read_table(spark, location, fmt).count()
    except (PySparkException, Py4JJavaError) as err:
        if "UNABLE_TO_INFER_SCHEMA" in str(err):
            return 0
        raise


def quarantine_location(root: str, layer: str, table: str) -> str:
    return f"{root}/_quarantine/{layer}/{table}"


def files_for(size: int, target: int = 128 << 20) -> int:
    """Number of files of about ``target`` bytes."""
    return max(1, -(-size // target))


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 5) -> Column:
    """A number whose bits alternate between the quantile places of the columns (Z-order).

    Rows that are near in it are near in every column, so ranges of it prune on
    each of them. The bounds are approximate quantiles: they place the cuts only.
    """
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    as_number = {c: F.col(c).cast("timestamp").cast("double") if df.schema[c].dataType.typeName().startswith(
        ("date", "timestamp")) else F.col(c).cast("double") for c in columns}
    bounds = df.select(*[F.percentile_approx(x, shares).alias(c) for c, x in as_number.items()]).first()
    z = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        place = sum((F.when(as_number[c] > b, 1).otherwise(0) for b in bounds[c] or []), F.lit(0)).cast("long")
        for bit in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1).cast("long")),
                                        bit * len(columns) + i))
    return z


def compact(df: DataFrame, location: str, cluster_by: Sequence[str], files: int) -> str:
    """Rewrite into ``files`` clustered, sorted files so that statistics prune on every
    clustering column. Several columns must be numbers or times; they are interleaved."""
    if len(cluster_by) == 1:
        out = df.repartitionByRange(files, *cluster_by).sortWithinPartitions(*cluster_by)
    else:
        out = df.withColumn("__z", interleaved(df, cluster_by))
        out = out.repartitionByRange(files, "__z").sortWithinPartitions("__z").drop("__z")
    out.write.mode("overwrite").option("compression", "snappy").parquet(location)
    return location


def _quote(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def register_table(spark: SparkSession, name: str, location: str, fmt: str = "parquet") -> None:
    """Catalog entry for a table that already lies at ``location``."""
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quote(name.rsplit('.', 1)[0])}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quote(name)} USING {fmt} LOCATION :at",
              args={"at": location})


def analyze_table(spark: SparkSession, name: str) -> None:
    """Table and column statistics for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {_quote(name)} COMPUTE STATISTICS FOR ALL COLUMNS")


def column_statistics(spark: SparkSession, name: str, columns: Sequence[str]) -> DataFrame:
    """What the catalog knows of a table: one row per column with the table's rows and comment, and
    the column's nulls, different values (estimated), extremes and comment; read without touching the data."""
    about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {_quote(name)}").collect()}
    rows = re.search(r"(\d+) rows", about.get("Statistics") or "")
    out = []
    for c in columns:
        told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {_quote(name)} `{c}`").collect()}
        known = {k: None if v == "NULL" else v for k, v in told.items()}
        number = {k: None if known.get(k) is None else int(known[k]) for k in ("num_nulls", "distinct_count")}
        out.append((c, int(rows[1]) if rows else None, number["num_nulls"], number["distinct_count"],
                    known.get("min"), known.get("max"), about.get("Comment"), known.get("comment")))
    return spark.createDataFrame(out, "column_name string, rows long, nulls long, distinct_values long, low string, "
                                      "high string, table_comment string, column_comment string")


def comment_column(spark: SparkSession, name: str, column: str, text: str) -> None:
    """Column comment."""
    quoted = text.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {_quote(name)} CHANGE COLUMN `{column}` COMMENT '{quoted}'")


def comment_table(spark: SparkSession, name: str, text: str) -> None:
    """Table comment."""
    spark.sql(f"COMMENT ON TABLE {_quote(name)} IS :text", args={"text": text})
