"""Ranks and quantile groups within groups of any size.

``row_number`` over a period puts the whole period in one task. Beyond a
measured size a group is cut into cells by order-preserving bounds, the cells
are counted, and a row's rank is the count of the cells before its own plus its
position in its cell:

* bounds on the value are quantiles of the group, in proportion to its size;
* a value that is itself a bound may be frequent, so it has a cell of its own,
  which, when large, is cut again by quantiles of the unique tie-break column.

Approximate quantiles only move the cuts: whatever they are, the ranks are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.sources.staging import stage

SPLIT_ABOVE = 1_000_000
# cells of a million rows up to some 30 billion rows in a group; a group takes as many splits as it needs
MAX_SPLITS = 1 << 16


def below(bounds: Column, col: Column, splits: int) -> Column:
    """How many of at most ``splits`` sorted bounds lie below the value, by halving steps;
    0 without bounds."""
    steps = [F.lit(1 << i) for i in reversed(range(splits.bit_length()))]
    return F.aggregate(
        F.array(*steps), F.lit(0),
        lambda at, step: at + F.when(F.get(bounds, at + step - 1) < col, step).otherwise(0))


def _bounds(df: DataFrame, keys: Sequence[str], col: str, splits: int, above: int, name: str) -> DataFrame:
    """Quantiles of ``col`` for every key with more than ``above`` rows, about two
    per ``above`` rows and at most ``splits - 1``.

    The stored result has a known size, so Spark broadcasts it only while it is small.
    """
    points = [i / splits for i in range(1, splits)]
    found = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"),
        F.percentile_approx(F.col(col), points, 20 * splits).alias("__all"))
    every = F.greatest(
        F.lit(1), F.floor(F.lit(splits * above / 2.0) / F.col("__rows")).cast("int"))
    thin = F.filter("__all", lambda _, i: (i + 1) % F.col("__every") == 0)
    return stage(
        found.where(F.col("__rows") > above).withColumn("__every", every)
        .select(*keys, thin.alias(name)), "rank-bounds")


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    names = [f"__r_{k}" for k in keys]
    right = right.select(*[F.col(k).alias(n) for k, n in zip(keys, names)],
                         *[c for c in right.columns if c not in keys])
    cond = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    return left.join(right, cond, how).drop(*names)


def rank_within(
    df: DataFrame, group: Sequence[str], value: str, tiebreak: str, name: str = "rank",
    descending: bool = True, size_name: str | None = None, split_above: int = SPLIT_ABOVE,
) -> DataFrame:
    """Rank 1..n per group by ``value``, ties by ascending ``tiebreak`` (unique, numeric).

    The largest group is measured first: while it has at most ``split_above``
    rows the plain window is the cheaper exact plan. ``size_name`` adds the
    group's row count. ``df`` should be a stored or staged table, since it is
    read more than once.
    """
    group = list(group)
    direction = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
    tie = F.col(tiebreak).asc()

    largest = df.groupBy(*group).count().agg(F.max("count")).head()[0] or 0
    if largest <= split_above:
        out = df.withColumn(name, F.row_number().over(
            Window.partitionBy(*group).orderBy(direction, tie)).cast("long"))
        if size_name:
            out = out.withColumn(size_name, F.count(F.lit(1)).over(Window.partitionBy(*group)))
        return out

    splits = min(MAX_SPLITS, max(8, 2 * -(-largest // split_above)))
    bounds = _bounds(df, group, value, splits, split_above, "__vb")
    present = F.col(value).isNotNull()
    # -1 holds the nulls, odd cells hold one value each, even cells a range between bounds
    vcell = F.when(
        present,
        2 * below(F.col("__vb"), F.col(value), splits)
        + F.coalesce(F.array_contains("__vb", F.col(value)).cast("int"), F.lit(0)),
    ).otherwise(F.lit(-1))
    valued = null_safe(df, bounds, group, "left").select(*df.columns, vcell.alias("__vc"))

    cell = [*group, "__vc"]
    ties = _bounds(
        valued.where(F.col("__vc") % 2 != 0), cell, tiebreak, splits, split_above, "__tb")
    tcell = below(F.col("__tb"), F.col(tiebreak), splits)
    celled = null_safe(valued, ties, cell, "left").select(
        *df.columns, "__vc", tcell.alias("__tc"))

    cell = [*group, "__vc", "__tc"]
    cell_order = [F.col("__vc").desc() if descending else F.col("__vc").asc(), F.col("__tc").asc()]
    before = Window.partitionBy(*group).orderBy(*cell_order).rowsBetween(
        Window.unboundedPreceding, -1)
    counts = celled.groupBy(*cell).agg(F.count(F.lit(1)).alias("__cn"))
    # a group has a few cells per ``split_above`` rows, so these windows stay small
    offsets = stage(
        counts.select(
            *cell,
            F.coalesce(F.sum("__cn").over(before), F.lit(0)).alias("__offset"),
            F.sum("__cn").over(Window.partitionBy(*group)).alias("__size"),
        ),
        "rank-offsets",
    )
    within = Window.partitionBy(*cell).orderBy(direction, tie)
    out = null_safe(celled, offsets, cell, "inner").withColumn(
        name, F.col("__offset") + F.row_number().over(within))
    if size_name:
        out = out.withColumn(size_name, F.col("__size"))
    return out.drop("__vc", "__tc", "__offset", "__size")


def rank_extremes(
    ranked: DataFrame, k: int, period: str = "yr", rank: str = "rank_all",
    labels: tuple[str, str] = ("BEST", "WORST"), side: str = "side",
) -> DataFrame:
    """Best and worst ``k`` of every period from a table that carries ranks.

    ``ranked`` should be a stored table. The group sizes are one small stored
    aggregate joined back; no row is reshuffled.
    When a period has fewer than ``2k`` rows, every rank up to ``k`` is BEST (D15).
    """
    sizes = stage(
        ranked.groupBy(F.col(period).alias("__period")).agg(F.max(rank).alias("__n")),
        "period-sizes")
    return (
        ranked.join(sizes, F.col(period) == F.col("__period"), "left")
        .where((F.col(rank) <= k) | (F.col(rank) > F.col("__n") - k))
        .withColumn(side, F.when(F.col(rank) <= k, labels[0]).otherwise(labels[1]))
        .drop("__period", "__n")
    )
