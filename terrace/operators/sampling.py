"""Weighted sample with replacement, repeatable from a seed.

Entities lie end to end on a line, each as long as its weight, and each draw is
a hashed point on that line. The line is cut into cells of equal length: draws
are spread evenly over cells by construction, also when one entity owns a third
of the weight (it then owns a third of the cells). Inside a cell a draw takes
the last entity that starts at or before it, found by one ordered window over
both, so entities and draws are never multiplied.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONGEST = 10 ** 14      # units of a weight line; a point is a number of 60 bits


def hash_number(*parts: Column, digest_bits: int = 60) -> Column:
    """Non-negative long from SHA-256 of dash-joined parts."""
    digest = F.sha2(F.concat_ws("-", *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(digest, 1, digest_bits // 4), 16, 10).cast("long")


def _line(df: DataFrame, key: str, weight: str, buckets: int, scale: int) -> tuple[DataFrame, DataFrame]:
    """Entities with their [lo, hi) interval in units of 1 / ``scale``, and the one-row total.

    The running sum is taken inside hash buckets and moved by the sum of the
    buckets before, so no task sees more than one bucket.
    """
    units = F.col(weight).cast("long") if scale == 1 else F.round(
        F.col(weight).cast("double") * F.lit(float(scale))).cast("long")
    w = df.where(F.col(weight) > 0).select(
        F.col(key).alias("key"), F.greatest(units, F.lit(1)).alias("w"),
        F.pmod(hash_number(F.col(key), digest_bits=32), F.lit(buckets)).alias("bucket"))
    sums = w.groupBy("bucket").agg(F.sum("w").alias("bw"))
    # one row per bucket: a bounded window
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("bucket", F.coalesce(F.sum("bw").over(before), F.lit(0)).alias("off"))
    inside = Window.partitionBy("bucket").orderBy("key").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    line = (
        w.withColumn("hi", F.sum("w").over(inside))
        .join(offsets, "bucket")
        .select("key", "w", (F.col("off") + F.col("hi") - F.col("w")).alias("lo"),
                (F.col("off") + F.col("hi")).alias("hi"))
    )
    return line, sums.agg(F.sum("bw").alias("total"))


def weighted_sample(
    df: DataFrame, key: str, weight: str, n: int, seed: int = 42, buckets: int | None = None,
    cells: int | None = None,
) -> DataFrame:
    """``n`` draws (draw, key), each entity with probability weight / total.

    ``key`` is unique; rows without a positive weight are never drawn. Whole weights
    are taken as they are. With fractions the line's unit is the smallest power of ten
    at which the line still has at most ``LONGEST`` units, so that a hashed
    point is as good as uniform; weights are rounded to it, and no positive one to nothing.
    Buckets and cells grow with the number of entities and draws.
    """
    spark = df.sparkSession
    w = F.col(weight)
    entities, most, fractions = df.where(w > 0).agg(
        F.count(F.lit(1)), F.sum(w.cast("double")), F.count_if(w != F.floor(w))).first()
    digits = 0 if not fractions else max(0, min(30, math.floor(math.log10(LONGEST / most))))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or max(4096, entities // 100_000)
    cells = cells or max(4 * width, n // 100_000, entities // 100_000)
    line, total_row = _line(df, key, weight, buckets, 10 ** digits)
    total = total_row.scalar()

    starts = line.withColumn("total", total)
    size = F.ceil(F.col("total") / F.lit(cells)).cast("long")
    first, last = F.floor(F.col("lo") / size), F.floor((F.col("hi") - 1) / size)
    starts = starts.withColumn("size", size).select(
        "key", "lo", "size", F.explode(F.sequence(first, last)).alias("cell"))
    starts = starts.select(
        "cell", F.greatest(F.col("lo"), F.col("cell") * F.col("size")).alias("pos"),
        F.lit(0).alias("kind"), "key", F.lit(None).cast("long").alias("draw"))

    draws = spark.range(n).withColumn("total", total_row.scalar()).select(
        F.pmod(hash_number(F.lit(seed), F.col("id")), F.col("total")).alias("pos"),
        F.ceil(F.col("total") / F.lit(cells)).cast("long").alias("size"),
        F.col("id").alias("draw")).select(
        F.floor(F.col("pos") / F.col("size")).alias("cell"), "pos", F.lit(1).alias("kind"),
        F.lit(None).cast(df.schema[key].dataType).alias("key"), "draw")

    order = Window.partitionBy("cell").orderBy("pos", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    hit = F.last("key", ignorenulls=True).over(order)
    return (
        starts.unionByName(draws)
        .withColumn("hit", hit)
        .where(F.col("kind") == 1)
        .select("draw", F.col("hit").alias(key))
    )
