"""Deduplication, distinct and union operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.operators.enrich import fits_broadcast
from terrace.sources.staging import stage


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1,
    rank_name: str | None = None,
) -> DataFrame:
    """The first ``k`` rows per key under a full order.

    Spark limits each key to ``k`` rows inside every map task before the
    shuffle (WindowGroupLimit), so a key that holds a third of all rows sends
    ``k`` rows per task, not a third of the table. That planner rule covers
    ``k`` up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000).
    """
    rn = rank_name or "__rn"
    ranked = df.withColumn(rn, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(rn) <= k)
    return kept if rank_name else kept.drop(rn)


def dedup_latest(
    df: DataFrame, keys: Sequence[str], latest: str = "arrived",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """One row per business key, the most recently ingested.

    Rows of one ingest share a timestamp (D1), so ``tiebreak`` columns decide
    among them, the smallest values winning.
    """
    order = [F.col(latest).desc(), *[F.col(c).asc() for c in tiebreak]]
    return first_per_key(df, keys, order)


def current_versions(
    df: DataFrame, keys: Sequence[str], latest: str = "arrived",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """``dedup_latest`` of a stored table that spares rows without another version the shuffle.

    Only the keys' hashes are counted first; those that come more than once are
    stored. Rows of other hashes are versions of nothing. A collision, a null
    key or a key that repeats goes through the ordered window. A small table, or
    one with too many repeated keys to broadcast, takes the window as a whole.
    """
    if fits_broadcast(df):
        return dedup_latest(df, keys, latest, tiebreak)
    key = F.xxhash64(*keys)
    seen = df.groupBy(key.alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    repeated = stage(seen.where("__n > 1").select("__key"), "repeated-keys")
    if repeated.isEmpty():
        return df
    if not fits_broadcast(repeated):
        return dedup_latest(df, keys, latest, tiebreak)
    single = df.join(F.broadcast(repeated), key == F.col("__key"), "left_anti")
    versions = df.join(F.broadcast(repeated), key == F.col("__key"), "left_semi")
    return single.unionByName(dedup_latest(versions, keys, latest, tiebreak))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key tuples (combined map-side before the shuffle)."""
    return df.select(*keys).distinct()


def drop_repeats(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row per key, chosen by an explicit order."""
    return first_per_key(df, [key], order)


def union_parts(*parts: DataFrame) -> DataFrame:
    """Bag union by column name; a column absent from a part is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def merged_years(*parts: DataFrame, column: str = "yr") -> DataFrame:
    """Sorted union of the years found in several tables."""
    years = [p.select(column).distinct() for p in parts]
    return union_parts(*years).distinct().orderBy(column)
