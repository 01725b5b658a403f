"""Mixing sources to target weights by entropy balancing.

The mix takes every document at a rate between 0 and ``max_copies``. Rates stay
as close to 1 as the token constraints allow: minimising the relative entropy
of the rates under one constraint per source gives the tilted rate
min(max_copies, exp(lambda * size / mean size)), and Newton steps on the convex
dual find each source's lambda. A rate depends on source and size only, so the
steps run over a histogram of (source, size); each is one aggregation, and the
multipliers stay in a table. Rates become whole copies by systematic rounding
along the sizes of a source, whose error is below one large document; the rest
is settled by single copies of documents of falling size.

DataFrame functions only. Prefix sums run in two levels and large groups of
equal size are cut into cells, so no window needs a whole source.

A null text has size 0 and is taken 0 times its size; a null source is a source
of its own, the last; repeated rows count as often as they occur; an empty
table gives an empty mix. Reruns agree: ties are settled by a hash of the id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import split_words, text_of
from terrace.sources.staging import stage


@dataclass(frozen=True)
class MixRules:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)   # in turn over the sources by name
    total_share: float = 1.5                       # of all sizes
    max_copies: int = 2
    max_steps: int = 60
    tolerance: float = 1e-9                        # of a source's target
    cell_rows: int = 1000
    band: int = 64                                 # sizes per first-level prefix sum


def measured(df: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """(_key, _src, size) of every row, stored; ``_src`` sorts by code point with null last."""
    name = F.when(F.col(source).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(source).cast("string")))
    return stage(df.select(F.col(key).alias("_key"), name.alias("_src"),
                           F.size(split_words(text_of(text))).cast("long").alias("size")), "sizes")


def source_targets(sized: DataFrame, rules: MixRules) -> DataFrame:
    """(_src, source_size, target, mean_size, least): one row per source.

    Filling by weight up to a ceiling stops at one common level: the sources
    that stop first are those with the smallest ceiling per weight, so the level
    follows from running sums in that order.
    """
    per = sized.groupBy("_src").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    turn = (F.row_number().over(Window.orderBy("_src")) - 1) % len(rules.weights)
    per = per.withColumn("_w", F.get(F.array(*map(F.lit, rules.weights)), turn))
    everything = Window.partitionBy(F.lit(1))
    order = Window.orderBy(F.col("source_size") / F.col("_w"), "_src")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    ceiling = F.col("source_size") * rules.max_copies
    level = (F.sum("source_size").over(everything) * rules.total_share
             - F.coalesce(F.sum(ceiling).over(upto), F.lit(0))) / (
        F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(upto), F.lit(0.0)))
    per = per.withColumn("_ceiling", ceiling.cast("double")).withColumn("_level", level)
    # the first source that the level leaves below its ceiling fixes the level for all after it
    per = per.withColumn("_final", F.min(F.when(
        F.col("_level") * F.col("_w") <= F.col("_ceiling"), F.struct(
            (F.col("source_size") / F.col("_w")).alias("at"), "_src", F.col("_level").alias("level")))).over(everything))
    return per.select(
        "_src", "source_size", F.least(F.col("_ceiling"), F.col("_final.level") * F.col("_w")).alias("target"),
        F.greatest(F.col("source_size") / F.col("_n"), F.lit(1e-9)).alias("mean_size"),
        F.coalesce("least", F.lit(1)).alias("least"))


def _exact(value: Column) -> Column:
    """A sum that does not depend on the order of its terms, so that reruns agree."""
    return F.sum(value.cast("decimal(28,6)")).cast("double")


def _rate(rules: MixRules) -> Column:
    full = F.col("target") >= F.col("source_size") * rules.max_copies
    tilt = F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean_size"), F.lit(50.0)))
    return F.when(full, F.lit(float(rules.max_copies))).otherwise(F.least(F.lit(float(rules.max_copies)), tilt))


def balance(sized: DataFrame, rules: MixRules) -> tuple[DataFrame, DataFrame]:
    """The histogram of (source, size) and the sources with their multipliers, both stored."""
    hist = stage(sized.groupBy("_src", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    goal = source_targets(sized, rules)
    x_min = F.col("least") / F.col("mean_size")
    ratio = F.col("target") / F.greatest(F.col("source_size"), F.lit(1))
    duals = goal.select(
        "*", F.log(F.greatest(ratio, F.lit(1e-12))).alias("lam"),
        ((F.log(F.greatest(ratio, F.lit(1e-12))) - 1) / x_min).alias("low"),
        ((F.log(F.lit(float(rules.max_copies))) + 1) / x_min).alias("high"), F.lit(1.0).alias("miss"))
    duals = stage(duals, "duals")
    for _ in range(rules.max_steps):
        rate = _rate(rules)
        words = F.col("n") * F.col("size") * rate
        slope = F.when(rate < rules.max_copies, words * F.col("size") / F.col("mean_size")).otherwise(0.0)
        sums = hist.join(duals, "_src").groupBy("_src").agg(_exact(words).alias("_f"), _exact(slope).alias("_d"))
        moved = duals.join(sums, "_src", "left").withColumn("_gap", F.coalesce("_f", F.lit(0.0)) - F.col("target"))
        moved = moved.withColumn("low", F.when(F.col("_gap") <= 0, F.greatest("low", "lam")).otherwise(F.col("low")))
        moved = moved.withColumn("high", F.when(F.col("_gap") > 0, F.least("high", "lam")).otherwise(F.col("high")))
        newton = F.col("lam") - F.col("_gap") / F.col("_d")
        inside = (F.col("_d") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        miss = F.abs("_gap") / F.greatest("target", F.lit(1.0))
        hit = miss <= rules.tolerance
        duals = stage(moved.select(
            "_src", "source_size", "target", "mean_size", "least",
            F.when(hit, F.col("lam")).when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2).alias("lam"),
            "low", "high", miss.alias("miss")), "duals")
        if (duals.agg(F.max("miss")).first()[0] or 0.0) <= rules.tolerance:
            break
    return hist, duals


def _cell(rules: MixRules) -> Column:
    """Cells of one (source, size), so that none holds many more than ``cell_rows``."""
    return F.pmod(F.xxhash64("_key", F.lit(1)), F.ceil(F.col("n") / rules.cell_rows))


def copies(sized: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """Every row of ``sized`` with source_size, target, rate and whole copies."""
    hist, duals = balance(sized, rules)
    rated = hist.join(duals, "_src").withColumn("rate", _rate(rules))
    rows = sized.join(rated.select("_src", "size", "n", "rate", "source_size", "target"), ["_src", "size"])
    rows = stage(rows.withColumn("_cell", _cell(rules)), "rated")
    cells = rows.groupBy("_src", "size", "_cell").agg(
        F.count(F.lit(1)).alias("_n"), F.first("rate").alias("_r"))
    cells = cells.withColumn("_band", F.floor(F.col("size") / rules.band)).withColumn("_sum", (
        F.col("_n") * F.col("_r")).cast("decimal(28,9)"))
    bands = cells.groupBy("_src", "_band").agg(F.sum("_sum").alias("_b"))
    bands = bands.select("_src", "_band", F.coalesce(F.sum("_b").over(
        Window.partitionBy("_src").orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("_src", "_band").orderBy("size", "_cell")
    cells = stage(cells.join(bands, ["_src", "_band"]).select(
        "_src", "size", "_cell", "_n", "_band", "_base", (F.col("_base") + F.sum("_sum").over(inner)).alias("_upto")), "cells")
    # a cell's copies: whole numbers passed between the running sums of its two ends
    before = F.coalesce(F.lag("_upto").over(inner), F.col("_base"))
    cells = cells.withColumn("_take", F.floor(F.col("_upto") + 0.5) - F.floor(before + 0.5))
    cells = cells.select("_src", "size", "_cell", "_n", F.least(F.greatest(
        F.col("_take"), F.lit(0)), F.col("_n") * rules.max_copies).alias("_take"))
    place = F.row_number().over(Window.partitionBy("_src", "size", "_cell").orderBy(F.xxhash64("_key", F.lit(2)), "_key"))
    even = F.floor(F.col("_take") / F.col("_n"))
    rounded = rows.withColumn("_place", place).join(cells, ["_src", "size", "_cell"]).select(
        "_key", "_src", "size", "_cell", "_place", "source_size", "target", "rate",
        (even + F.when(F.col("_place") <= F.col("_take") - even * F.col("_n"), 1).otherwise(0)).cast("int").alias("copies"))
    rounded = stage(rounded, "rounded")
    return settle(rounded, rules)


def settle(rounded: DataFrame, rules: MixRules) -> DataFrame:
    """Single copies added or dropped until each source meets its target closely.

    Per source and power of two of the size, two documents that can give or take
    a copy are candidates; from the largest down, a candidate changes if it fits
    into what is left. There are some dozens a source at most. A row is named by
    its place in its cell, as ids may repeat.
    """
    left = stage(rounded.groupBy("_src").agg(
        (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("_left")), "left")
    order = F.struct(F.xxhash64("_key", F.lit(3)).alias("h"), "_key", "size", "_cell", "_place")
    sign = F.when(F.col("_left") > 0, 1).otherwise(-1)
    movable = rounded.where("size > 0").join(left, "_src").where(
        F.when(F.col("_left") > 0, F.col("copies") < rules.max_copies).otherwise(F.col("copies") > 0))
    named = ("size", "_key", "_cell", "_place")
    picks = movable.groupBy("_src", "_left", F.floor(F.log2("size")).alias("_class")).agg(
        F.min(order).alias("a"), F.max(order).alias("b"))
    picks = picks.groupBy("_src", "_left").agg(F.reverse(F.sort_array(F.array_distinct(F.flatten(F.collect_list(
        F.array(*[F.struct(*[F.col(f"{c}.{x}").alias(x) for x in named]) for c in "ab"])))))).alias("_c"))
    types = ",".join(f"{x}:{rounded.schema[x].dataType.simpleString()}" for x in named)
    start = F.struct(F.abs("_left").alias("rest"),
                     F.array().cast(f"array<struct<{types}>>").alias("chosen"))
    chosen = F.aggregate("_c", start, lambda acc, x: F.when(
        x["size"] <= acc.rest,
        F.struct((acc.rest - x["size"]).alias("rest"), F.array_append(acc.chosen, x).alias("chosen"))).otherwise(acc))
    moves = stage(picks.select("_src", F.explode(chosen.chosen).alias("_m"), sign.alias("_sign")).select(
        "_src", F.col("_m.size").alias("_s"), F.col("_m._cell").alias("_c"), F.col("_m._place").alias("_p"), "_sign"), "moves")
    r, m = rounded.alias("r"), moves.alias("m")
    return r.join(m, (F.col("r._src") == F.col("m._src")) & (F.col("r.size") == F.col("m._s"))
                  & (F.col("r._cell") == F.col("m._c")) & (F.col("r._place") == F.col("m._p")), "left").select(
        "r.*", F.coalesce("_sign", F.lit(0)).alias("_change")).withColumn(
        "copies", F.col("copies") + F.col("_change")).drop("_change", "_cell", "_place")


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
        rules: MixRules = MixRules()) -> DataFrame:
    """(key, size, source_size, target, rate, copies, taken) of every row of ``df``."""
    out = copies(measured(df, key, source, text), rules)
    return out.select(
        F.col("_key").alias(key), "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))
