"""Targets per group and period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels of where a number comes from.
PUBLISHED = "PUBLISHED"
INTERPOLATED = "INTERPOLATED"
DERIVED = "DERIVED_TRAJECTORY"
ESTIMATED = "ESTIMATED"
NOT_COLLECTED = "NOT_COLLECTED"


def _clip(col: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(col, F.lit(high)), F.lit(low))


def national_value(national: DataFrame, yr: int, value: str = "computed") -> Column:
    """One national value as a scalar subquery: nothing is joined or collected."""
    return national.agg(F.max(F.when(F.col("yr") == yr, F.col(value))).alias("v")).scalar()


def baselines(
    groups: DataFrame, actuals: DataFrame, national: DataFrame, base_year: int,
    value: str = "computed",
) -> DataFrame:
    """Starting point per group: base year, else next year less the national
    change, else the national base. Never the value of the year under review."""
    known = actuals.groupBy("group_id").agg(
        F.max(F.when(F.col("yr") == base_year, F.col(value))).alias("__b0"),
        F.max(F.when(F.col("yr") == base_year + 1, F.col(value))).alias("__b1"),
    )
    n0, n1 = (national_value(national, base_year + i, value) for i in (0, 1))
    joined = groups.select("group_id").distinct().join(known, "group_id", "left")
    joined = joined.withColumns({"__n0": n0, "__n1": n1})
    return joined.select(
        "group_id",
        F.coalesce("__b0", F.col("__b1") - (F.col("__n1") - F.col("__n0")), "__n0").alias("base"),
        F.when(F.col("__b0").isNotNull(), "BASE_YEAR")
        .when(F.col("__b1").isNotNull(), "NEXT_YEAR")
        .otherwise("NATIONAL").alias("base_source"),
    )


def trajectory(
    base: Column, yr: Column, base_year: int, goal_year: int, goal: float = 80.0, digits: int = 1,
) -> Column:
    """Straight line from the baseline to the goal, within 0..100, and level after the goal year."""
    slope = (F.lit(float(goal)) - base) / F.lit(float(goal_year - base_year))
    return F.round(_clip(base + slope * (F.least(yr, F.lit(goal_year)) - F.lit(base_year)), 0.0, 100.0), digits)


def scaffold(groups: DataFrame, first: int, last: int) -> DataFrame:
    """Every group in every year. The years are generated per row, so no
    product of two tables is formed."""
    years = F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long"))
    return groups.select("*", F.explode(years).alias("yr"))


def group_targets(
    base: DataFrame, base_year: int, goal_year: int, goal: float = 80.0, last_year: int | None = None,
) -> DataFrame:
    """Target rows per group and year, null before the first target year."""
    years = scaffold(base, base_year, last_year or goal_year)
    target = trajectory(F.col("base"), F.col("yr"), base_year, goal_year, goal)
    first = F.col("yr") > base_year
    return years.withColumn("target", F.when(first, target)).withColumn(
        "target_source", F.when(first, F.lit(DERIVED)))


def national_targets(
    published: DataFrame, first: int, last_published: int, goal_year: int,
) -> DataFrame:
    """Published national targets; between the last one and the goal year a straight line.

    ``published`` holds (yr, target) and must cover ``last_published`` and ``goal_year``.
    """
    v0 = national_value(published, last_published, "target")
    v1 = national_value(published, goal_year, "target")
    spark = published.sparkSession
    years = spark.range(first, goal_year + 1).withColumnRenamed("id", "yr")
    joined = years.join(published.select("yr", F.col("target").alias("__t")), "yr", "left")
    joined = joined.withColumns({"__v0": v0, "__v1": v1})
    step = (F.col("__v1") - F.col("__v0")) / F.lit(float(goal_year - last_published))
    line = F.round(F.col("__v0") + step * (F.col("yr") - last_published), 1)
    return joined.select(
        "yr", F.coalesce("__t", line).alias("target"),
        F.when(F.col("__t").isNotNull(), PUBLISHED).otherwise(INTERPOLATED).alias("target_source"),
    )


def group_values_with_fallback(
    groups_years: DataFrame, published: DataFrame, national: DataFrame, base_year: int,
    low: float = 3.0, high: float = 99.0,
) -> DataFrame:
    """Published value, else base year moved by the national change (clipped),
    else the national value.

    ``groups_years`` is the (group_id, yr) scaffold, ``published`` holds
    (group_id, yr, published), ``national`` holds (yr, computed).
    """
    base = published.where(F.col("yr") == base_year).select(
        "group_id", F.col("published").alias("__base"))
    nat = national.select("yr", F.col("computed").alias("__nat"))
    joined = (
        groups_years.join(published.select("group_id", "yr", "published"), ["group_id", "yr"], "left")
        .join(base, "group_id", "left")
        .join(nat, "yr", "left")
        .withColumn("__nat0", national_value(national, base_year))
    )
    moved = _clip(F.col("__base") + (F.col("__nat") - F.col("__nat0")), low, high)
    moved = F.when(F.col("__base").isNotNull(), moved)
    return joined.select(
        "group_id", "yr",
        F.coalesce("published", moved, "__nat").alias("value"),
        F.when(F.col("published").isNotNull(), PUBLISHED).otherwise(ESTIMATED).alias("value_source"),
    )
