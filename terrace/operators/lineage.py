"""Where a row came from (P01-P05): one record per row, ``_origin``, and the date it arrived, which partitions bronze."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORIGIN = "_origin"
ARRIVED_ON = "_ingestion_date"
PROCESSED = "_processed"


def framed(value: Column) -> Column:
    """A value as text behind its length, so that no other values run together to the same text; null is ``~``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the framed values."""
    return F.sha2(F.concat(*[framed(F.col(f"`{c}`")) for c in columns]), 256)


def with_lineage(
    df: DataFrame, entity: str, file: str, system: str, run: str, arrived: datetime | None = None,
) -> DataFrame:
    """When, in which run and from which file of which system a row arrived, and the hash of its values.

    One ``arrived`` for the whole run keeps a retried task from stamping its rows differently.
    """
    at = (F.current_timestamp() if arrived is None else F.lit(arrived)).cast("timestamp")
    values = [c for c in df.columns if not c.startswith("_")]
    origin = F.struct(
        at.alias("at"), F.lit(run).alias("run"), F.lit(system).alias("system"), F.lit(entity).alias("entity"),
        F.lit(file).alias("file"), row_hash(values).alias("row_hash"))
    return df.select("*", origin.alias(ORIGIN), F.date_format(at, "yyyy-MM-dd").alias(ARRIVED_ON))


def processed(df: DataFrame, run: str, at: datetime) -> DataFrame:
    """When and in which run a derived row was made."""
    return df.withColumn(PROCESSED, F.struct(F.lit(at).cast("timestamp").alias("at"), F.lit(run).alias("run")))


def drop_technical(df: DataFrame, *more: str) -> DataFrame:
    """Remove the technical records and denormalised columns."""
    return df.drop(ORIGIN, ARRIVED_ON, PROCESSED, *more)
