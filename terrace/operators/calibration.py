"""Calibration of values to a group's weighted mean.

Shift every value of a group by the same number and clip it: the weighted mean
is a piecewise linear, rising function of that number. It bends where a value
leaves the lower bound or reaches the upper one, by the value's weight. Running
sums over the sorted bends therefore give the mean anywhere, and the shift that
meets a target is read off between two bends; nothing is tried in rounds.

A group of any size: the range of all bends is cut into equal cells, summed by
one map-side aggregate; running sums over the cells name the one in which the
target is met, and only its bends are sorted. A cell that still holds too many
is cut again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.sources.staging import stage

CELLS = 512
INSIDE = 100_000        # bends that are sorted in one task
LEVELS = 5              # cells are cut until they are narrower than a unit
UNIT = "decimal(24,8)"  # decimals keep sums independent of the order in which parts arrive
MASS = "decimal(38,10)"


def _clip(col: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(col, F.lit(float(high))), F.lit(float(low)))


def _bends(df: DataFrame, targets: DataFrame, value: str, weight: str, group: str, target: str,
           low: float, high: float) -> DataFrame:
    """(group, position, change of slope, weight times distance of the target from ``low``), equal positions as one."""
    v = _clip(F.col(value).cast("double"), low, high).cast(UNIT)
    w = F.col(weight).cast("decimal(20,6)")
    known = df.where(F.col(value).isNotNull() & (w > 0)).select(F.col(group).alias("g"), v.alias("v"), w.alias("w"))
    condensed = known.groupBy("g", "v").agg(F.sum("w").alias("w"))
    goal = targets.where(F.col(target).isNotNull()).select(
        F.col(group).alias("g"), (F.col(target).cast("double") - float(low)).alias("__t"))
    ends = F.array(F.struct((F.lit(low).cast(UNIT) - F.col("v")).alias("p"), F.col("w").alias("d")),
                   F.struct((F.lit(high).cast(UNIT) - F.col("v")).alias("p"), (-F.col("w")).alias("d")))
    bends = condensed.join(goal, "g").select("g", "__t", F.explode(ends).alias("e"))
    return bends.select("g", "__t", F.col("e.p").alias("p"), F.col("e.d").cast("decimal(28,6)").alias("d"))


def _sums(over: Window | None = None) -> tuple[Column, Column]:
    """Sums of the slopes' changes, and of these times their positions."""
    slope, mass = F.sum("d"), F.sum((F.col("d") * F.col("p")).cast(MASS))
    return (slope, mass) if over is None else (slope.over(over), mass.over(over))


def _reached(slope: Column, mass: Column, at: Column) -> Column:
    """Is the target met at or before the position, given the sums up to it?"""
    return slope.cast("double") * at.cast("double") - mass.cast("double") >= F.col("goal")


def _next_cell(bends: DataFrame, state: DataFrame) -> DataFrame:
    """The state one level deeper: borders of the cell in which the target is met, and the sums before it."""
    inside = _inside(bends, state).withColumn("cell", _cell())
    slope, mass = _sums()
    per = inside.groupBy("g", "goal", "low", "width", "s0", "m0", "cell").agg(
        slope.alias("s"), mass.alias("m"), F.max("p").alias("last"), F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("g").orderBy("cell")     # as many rows as cells
    upto = per.withColumns({"s1": F.col("s0") + F.sum("s").over(order), "m1": F.col("m0") + F.sum("m").over(order)})
    found = upto.where(_reached(F.col("s1"), F.col("m1"), F.col("last"))).groupBy("g").agg(
        F.min_by(F.struct("goal", "low", "width", "cell", "n", (F.col("s1") - F.col("s")).alias("s0"),
                          (F.col("m1") - F.col("m")).alias("m0")), "cell").alias("x")).select("g", "x.*")
    width = F.col("width") / CELLS
    return stage(found.select("g", "goal", (F.col("low") + F.col("cell") * width).alias("low"), width.alias("width"),
                              "n", *[F.col(c).cast("decimal(38,6)" if c == "s0" else MASS).alias(c) for c in ("s0", "m0")],
                              F.col("low").alias("low0"), F.col("width").alias("width0"), "cell"), "calibration")


def _cell(low: str = "low", width: str = "width") -> Column:
    place = F.floor((F.col("p").cast("double") - F.col(low)) / (F.col(width) / CELLS))
    return F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), place)).cast("int")


def _inside(bends: DataFrame, state: DataFrame) -> DataFrame:
    """The bends of the state's cell, by the very rule that put them there."""
    joined = bends.drop("__t").join(state, "g")
    if "cell" in state.columns:
        joined = joined.where(_cell("low0", "width0") == F.col("cell")).drop("cell", "low0", "width0", "n")
    return joined


def shifts_to_target(bends: DataFrame, low: float, high: float, inside: int = INSIDE) -> DataFrame:
    """(g, shift) of every group; ``bends`` is a stored table."""
    slope = F.sum(F.when(F.col("d") > 0, F.col("d")))
    whole = bends.groupBy("g").agg((F.max("__t") * slope.cast("double")).alias("goal"), F.max("p").alias("most"))
    whole = stage(whole, "calibration-goals")
    span = float(high) - float(low)
    state = whole.select("g", "goal", F.lit(-span).alias("low"), F.lit(2 * span).alias("width"),
                         F.lit(0).cast("decimal(38,6)").alias("s0"), F.lit(0).cast(MASS).alias("m0"))
    for _ in range(LEVELS):
        state = _next_cell(bends, state)
        if (state.agg(F.max("n")).head()[0] or 0) <= inside:
            break
    near = _inside(bends, state)
    order = Window.partitionBy("g").orderBy("p", "d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s, m = _sums(order)
    at = near.withColumns({"s": F.col("s0") + s, "m": F.col("m0") + m})
    hit = at.where(_reached(F.col("s"), F.col("m"), F.col("p"))).groupBy("g").agg(F.min_by(
        F.struct("p", "goal", (F.col("s") - F.col("d")).alias("s"), (F.col("m") - (F.col("d") * F.col("p")).cast(MASS)).alias("m")),
        F.struct("p", "d")).alias("x")).select("g", "x.*")
    before = F.col("s").cast("double")
    met = F.when(before > 0, (F.col("goal") + F.col("m").cast("double")) / before).otherwise(F.col("p").cast("double"))
    hit = hit.select("g", met.alias("shift"))
    # a target at or beyond the upper bound moves all values there
    return whole.join(hit, "g", "left").select("g", F.coalesce("shift", F.col("most").cast("double")).alias("shift"))


def calibrate_to_group_mean(
    df: DataFrame, targets: DataFrame, value: str = "value", weight: str = "weight",
    group: str = "group_id", target: str = "target", low: float = 2.0, high: float = 99.0,
    output: str = "calibrated", inside: int = INSIDE,
) -> DataFrame:
    """Shift every group's values, clipped to ``[low, high]``, so that their weighted mean is the group's target.

    ``targets`` holds one row per group. A group without target keeps its clipped
    values; a target outside the bounds moves all values to the nearer bound.
    Values count in units of 1e-8, weights in units of 1e-6.
    """
    bends = stage(_bends(df, targets, value, weight, group, target, low, high), "calibration-bends")
    shift = stage(shifts_to_target(bends, low, high, inside=inside), "calibration-shift")
    shift = shift.select(F.col("g").alias("__gs"), F.col("shift").alias("__s"))
    final = _clip(_clip(F.col(value).cast("double"), low, high) + F.coalesce("__s", F.lit(0.0)), low, high)
    joined = df.join(shift, F.col(group) == F.col("__gs"), "left")
    return joined.withColumn(output, F.when(F.col(value).isNotNull(), final)).select(*df.columns, output)
