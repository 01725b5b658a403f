"""Joins (J01-J09). No strategy is forced: Spark broadcasts a side when its
measured size is under the session's threshold and otherwise shuffles, with AQE
splitting skewed partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.sources.staging import stage


def null_spread(key: Column, columns: Sequence[str]) -> Column:
    """Second join column that is 0 for a present key and a hash of the row for a null
    key: null keys match nothing and are spread over all partitions, however many."""
    return F.when(key.isNull(), F.xxhash64(*[F.col(c) for c in columns])).otherwise(F.lit(0).cast("long"))


def enrich(
    df: DataFrame, dim: DataFrame, on: str | Mapping[str, str], columns: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Attach dimension attributes by key; ``on`` may map fact to dimension names."""
    pairs = {on: on} if isinstance(on, str) else dict(on)
    right = dim.select(*[F.col(d).alias(f"__d_{d}") for d in pairs.values()], *columns)
    cond = [F.col(f) == F.col(f"__d_{d}") for f, d in pairs.items()]
    return df.join(right, cond, how).drop(*[f"__d_{d}" for d in pairs.values()])


def enrich_by_expression(
    df: DataFrame, dim: DataFrame, key: Column, dim_key: str, columns: Sequence[str],
) -> DataFrame:
    """Left join on a derived key; the helper does not survive."""
    keyed = df.withColumn("__key", key)
    return enrich(keyed, dim, {"__key": dim_key}, columns).drop("__key")


def prefer_published(aggregate: DataFrame, published: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Aggregate with the published values beside it, keeping every aggregate row."""
    return aggregate.join(published, list(keys), "left")


def fits_broadcast(df: DataFrame) -> bool:
    """Would Spark broadcast this side by its own size estimate and threshold?"""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(estimate)) <= limit


def reference_keys(reference: DataFrame, key: str) -> DataFrame:
    """Distinct present keys of a reference, as the single column ``__ref``."""
    keys = reference.select(F.col(key).alias("__ref"))
    return keys.where(F.col("__ref").isNotNull()).distinct()


def mark_known(
    df: DataFrame, reference: DataFrame, key: str, reference_key: str | None = None,
    marker: str = "_known",
) -> DataFrame:
    """Boolean marker "key exists in the reference"; a null key is an orphan.

    A reference small enough to broadcast is joined as it is. For a larger one
    the distinct keys of ``df`` are checked first: keys shrink before their
    shuffle and only the unknown ones, usually few, are stored and joined back,
    so the rows need not be shuffled by a possibly skewed key. ``df`` is then
    read twice and should be a stored table.
    """
    keys = reference_keys(reference, reference_key or key)
    small = fits_broadcast(keys)
    if not small:
        asked = df.select(F.col(key).alias("__asked")).where(F.col(key).isNotNull()).distinct()
        unknown = asked.join(keys, F.col("__asked") == F.col("__ref"), "left_anti")
        keys = stage(unknown.select(F.col("__asked").alias("__ref")), "unknown-keys")
    keys = keys.withColumn("__ref_spread", F.lit(0).cast("long"))
    left = df.withColumn("__spread", null_spread(F.col(key), df.columns))
    joined = left.join(
        keys, (F.col(key) == F.col("__ref")) & (F.col("__spread") == F.col("__ref_spread")), "left")
    hit = F.col("__ref").isNotNull()
    known = hit if small else F.col(key).isNotNull() & ~hit
    return joined.withColumn(marker, known).drop("__ref", "__ref_spread", "__spread")


def orphans(
    df: DataFrame, reference: DataFrame, key: str, reference_key: str | None = None,
) -> DataFrame:
    """Rows of ``df`` whose key is null or absent from the reference."""
    marked = mark_known(df, reference, key, reference_key, "__known")
    return marked.where(~F.col("__known")).drop("__known")


def compare_versions(
    before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str],
) -> DataFrame:
    """Rows present in both versions in which a compared column changed."""
    old = before.select(*keys, *[F.col(c).alias(f"{c}_before") for c in columns])
    new = after.select(*keys, *[F.col(c).alias(f"{c}_after") for c in columns])
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(f"{c}_before").eqNullSafe(F.col(f"{c}_after"))
    return old.join(new, list(keys), "inner").where(changed)
