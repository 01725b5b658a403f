"""Profiles and summaries of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.columns import mean_at, round_at
from terrace.operators.quantiles import interpolated


def weighted_mean(value: Column, weight: Column, digits: int = 1) -> Column:
    """Sum of value times weight over sum of weight; null for no weight."""
    return round_at(F.try_divide(F.sum(value * weight), F.sum(weight)), digits)


def value_counts(df: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name)).orderBy(
        F.desc(name), *columns)


def critical_summary(
    df: DataFrame, condition: Column, total: str, mean: str, by: Sequence[str] = (),
) -> DataFrame:
    """Size, sum and mean of the rows under a condition beside the overall mean."""
    return df.groupBy(*by).agg(
        F.count_if(condition).alias("critical_rows"),
        F.coalesce(F.sum(F.when(condition, F.col(total))), F.lit(0)).cast("long")
        .alias(f"critical_{total}"),
        mean_at(F.when(condition, F.col(mean)), 3).alias(f"critical_mean_{mean}"),
        mean_at(F.col(mean), 3).alias(f"mean_{mean}"),
    )


def describe(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """One row per column with count, mean, spread, extremes and exact interpolated
    quartiles.

    All columns are summarised by one aggregate of one row; ``df`` should be a stored table,
    since the quartiles read it again.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    shares = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    quartiles = interpolated(numbers, {f"{c}__{p}": (c, share) for c in columns for p, share in shares.items()})

    def figures(c: str) -> dict[str, Column]:
        x = F.col(c)
        return {"n": F.count(x), "mean": mean_at(x, digits), "std": F.round(F.stddev_samp(x), digits),
                "min": F.round(F.min(x), digits), "max": F.round(F.max(x), digits)}

    stats = numbers.agg(*[F.struct(*[v.alias(k) for k, v in figures(c).items()]).alias(c) for c in columns])
    stats = stats.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("s")) for c in columns])).alias("x"))
    middle = quartiles.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), *[
        F.round(F.col(f"{c}__{p}"), digits).alias(p) for p in shares]) for c in columns])).alias("x"))
    return stats.select("x.column", "x.s.*").join(middle.select("x.*"), "column")


def raw_profile(
    df: DataFrame, key: Sequence[str], nullable: Sequence[str] = (),
    impossible: Mapping[str, Column] | None = None, dirty: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rows, repeated keys, nulls, impossible and dirty values in one pre-aggregated pass."""
    flags = {f"null_{c}": F.col(c).isNull() for c in nullable}
    flags |= {f"impossible_{c}": cond for c, cond in (impossible or {}).items()}
    flags |= {f"dirty_{c}": cond for c, cond in (dirty or {}).items()}
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("__n"), *[F.count_if(c).alias(n) for n, c in flags.items()])
    return per_key.agg(
        F.sum("__n").alias("rows"), F.sum(F.col("__n") - 1).alias("repeated_keys"),
        *[F.sum(n).alias(n) for n in flags])


def coverage(df: DataFrame, flag: Column, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows with a property."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(flag).alias("covered"),
        F.round(F.count_if(flag) * 100.0 / F.count(F.lit(1)), 2).alias("coverage_pct"))


def max_divergence(df: DataFrame, column: str = "divergence", by: Sequence[str] = ()) -> DataFrame:
    """Largest absolute divergence."""
    return df.groupBy(*by).agg(F.max(F.abs(F.col(column))).alias(f"max_abs_{column}"))


def spread(df: DataFrame, value: str, order: str, by: Sequence[str] = ()) -> DataFrame:
    """Value at the highest minus value at the lowest ``order``."""
    return df.groupBy(*by).agg(
        F.min_by(value, order).alias("lowest"), F.max_by(value, order).alias("highest"),
    ).withColumn("spread", F.round(F.col("highest") - F.col("lowest"), 1))


def correlation(df: DataFrame, x: str, y: str, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Pearson correlation per group."""
    return df.groupBy(*by).agg(F.round(F.corr(x, y), digits).alias("correlation"))


def top_groups(df: DataFrame, by: str, k: int = 8, name: str = "n") -> DataFrame:
    """The ``k`` largest groups."""
    return value_counts(df, by, name=name).limit(k)
