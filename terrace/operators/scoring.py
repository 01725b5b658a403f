"""Score columns over group statistics.

Statistics are aggregated first and joined back as one row per group, so a
group that holds a third of all rows is never gathered in one task the way a
window over the group would gather it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.sources.staging import stage


def zscores(
    df: DataFrame, columns: Sequence[str], group: Sequence[str] = (), suffix: str = "_z",
    impute_mean: bool = False,
) -> DataFrame:
    """Population z-score per group; a zero or missing spread scores 0.

    ``impute_mean`` reads a null as the group's mean (score 0) without touching
    the input column; the spread is then that of the imputed values.
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.avg(x).alias(f"__mean_{c}"),
            F.stddev_pop(x).alias(f"__sd_{c}"),
            F.count(x).alias(f"__n_{c}"),
        ]
    stats = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    if group:
        keys = [f"__g_{g}" for g in group]
        stats = stats.select(*[F.col(g).alias(k) for g, k in zip(group, keys)],
                             *[c for c in stats.columns if c not in group])
        # stored, so that its size is known and a small one is broadcast instead of
        # shuffling the rows by group
        stats = stage(stats, "group-stats")
        on = [F.col(g).eqNullSafe(F.col(k)) for g, k in zip(group, keys)]
        joined = df.join(stats, on, "left")
    else:
        # one row: read as a scalar subquery instead of joining it
        row = stats.select(F.struct(*stats.columns)).scalar()
        joined = df.withColumn("__stats", row)
        joined = joined.select("*", "__stats.*")
    out = joined
    for c in columns:
        x, mean = F.col(c).cast("double"), F.col(f"__mean_{c}")
        sd = F.col(f"__sd_{c}")
        if impute_mean:
            # nulls sit on the mean: the sum of squares is unchanged, the count grows
            sd = sd * F.sqrt(F.col(f"__n_{c}") / F.col("__rows"))
            x = F.coalesce(x, mean)
            score = F.coalesce(F.when(sd > 0, (x - mean) / sd), F.lit(0.0))
        else:
            score = F.when(F.coalesce(sd, F.lit(0.0)) > 0, (x - mean) / sd).otherwise(
                F.lit(0.0))
            score = F.when(x.isNull() & (F.coalesce(sd, F.lit(0.0)) > 0), F.lit(None)).otherwise(
                score)
        out = out.withColumn(f"{c}{suffix}", score)
    return out.select(*df.columns, *[f"{c}{suffix}" for c in columns])


def weighted_score(weights: Mapping[str, float], suffix: str = "_z") -> Column:
    """Linear combination of z-score columns."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.lit(float(weight)) * F.col(f"{name}{suffix}")
    return total


def estimated_volume(
    col: Column, factor: float, default: float = 400, minimum: int = 5,
) -> Column:
    """Default for a missing base, scaled, rounded half to even, with a floor."""
    scaled = F.bround(F.coalesce(col.cast("double"), F.lit(float(default))) * F.lit(factor), 0)
    return F.greatest(scaled, F.lit(float(minimum))).cast("long")


def success_count(volume: Column, rate_pct: Column) -> Column:
    """Whole number of successes behind a percentage (half to even)."""
    return F.bround(volume * rate_pct / F.lit(100.0), 0).cast("long")
