"""Order statistics of groups of any size by distributed selection.

Nothing is ranked as a whole. A mergeable sketch gives a grid of approximate
quantiles per group; a wanted rank lies between two grid points around it. One
map-side aggregate then counts the rows below each such bracket and keeps, once
per different value, what lies inside. The value at the rank is read off the
kept values by running counts. Where a bracket still holds too many different
values it is cut into cells, whose exact counts name the one cell to go on with.

The sketch only places the brackets; a bracket that turns out not to hold its
rank is opened to the side where the rank lies. Results are exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.operators.ranking import below, null_safe
from terrace.sources.staging import stage

GRID = 512               # grid points of a sketch, hence brackets of some three parts in 512
ACCURACY = 10_000        # relative error of a sketch; a small part of a grid step
INSIDE = 1_000_000       # different values of one bracket that are sorted in one task
CELLS = 256


@dataclass(frozen=True)
class Pick:
    """A value to be found: its column and, as SQL text over ``n``, the number of known values, its rank (1..n, ascending)."""

    column: str
    rank: str


# Expressions are put together as text: a call per literal and operator would cost more than the small jobs here.


def _names(names: Iterable[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def _rank(pick: Pick) -> str:
    """The rank within 1..n; null without rows."""
    n = f"`__n_{pick.column}`"
    rank = re.sub(r"\bn\b", n, pick.rank)
    return f"cast(if({n} > 0, greatest(1, least({rank}, {n})), null) as bigint)"


def _brackets(df: DataFrame, by: Sequence[str], picks: Mapping[str, Pick], grid: int, accuracy: int) -> DataFrame:
    """Per group: known values of every column, and rank, low and high bound of every pick (null: open)."""
    points = "array(" + ", ".join(f"{k / grid!r}D" for k in range(1, grid)) + ")"
    columns = dict.fromkeys(p.column for p in picks.values())
    found = df.groupBy(*by).agg(*[F.expr(x) for c in columns for x in (
        f"count(`{c}`) as `__n_{c}`", f"percentile_approx(`{c}`, {points}, {accuracy}) as `__q_{c}`")])
    found = found.selectExpr(*_names(by), *[f"`__{x}_{c}`" for c in columns for x in "nq"],
                             *[f"{_rank(p)} as `__r_{n}`" for n, p in picks.items()])

    def bounds(name: str, p: Pick) -> list[str]:
        # the k-th point is at index k - 1; one step more on both sides than the rank needs
        place = f"`__r_{name}` * {grid} / `__n_{p.column}`"
        low, high = f"cast(floor({place}) as int) - 2", f"cast(ceil({place}) as int)"
        return [f"`__r_{name}`", f"if({low} >= 0, get(`__q_{p.column}`, {low}), null) as `__lo_{name}`",
                f"if({high} < {grid - 1}, get(`__q_{p.column}`, {high}), null) as `__hi_{name}`"]

    return stage(found.selectExpr(*_names(by), *[f"`__n_{c}`" for c in columns],
                                  *[x for n, p in picks.items() for x in bounds(n, p)]), "brackets")


def _split(df: DataFrame, by: Sequence[str], picks: Mapping[str, Pick], brackets: DataFrame) -> DataFrame:
    """One map-side aggregate: rows that lie in no bracket fall into one row per group, with the
    number of rows below each bracket; the others keep their values."""
    names = [x for n in picks for x in (f"__lo_{n}", f"__hi_{n}")]
    if by:
        rows = null_safe(df, brackets.select(*by, *names), by, "inner")
    else:
        one, kind = brackets.select(*names).first(), dict(brackets.dtypes)
        rows = df.select("*", *[F.lit(one[n]).cast(kind[n]).alias(n) for n in names])
    keys, under = [], []
    for n, p in picks.items():
        below, above = (f"coalesce(`{p.column}` {sign} `__{end}_{n}`, false)" for sign, end in (("<", "lo"), (">", "hi")))
        keys.append(f"if({below} or {above}, null, `{p.column}`) as `__k_{n}`")
        under.append(f"{below} as `__b_{n}`")
    rows = rows.selectExpr(*_names(by), *keys, *under)
    return stage(rows.groupBy(*by, *[f"__k_{n}" for n in picks]).agg(
        F.expr("count(1) as __c"), *[F.expr(f"count_if(`__b_{n}`) as `__b_{n}`") for n in picks]), "inside")


def _condensed(split: DataFrame, by: Sequence[str], picks: Mapping[str, Pick]) -> DataFrame:
    """(by, pick, value, rows): the values inside, and under a null value the rows below."""
    parts = [x for n in picks for x in (
        f"named_struct('pick', '{n}', 'value', `__k_{n}`, 'rows', if(`__k_{n}` is not null, __c, 0L))",
        f"named_struct('pick', '{n}', 'value', nullif(`__k_{n}`, `__k_{n}`), 'rows', `__b_{n}`)")]
    long = split.selectExpr(*_names(by), f"inline(array({', '.join(parts)}))").where("rows > 0")
    return long.groupBy(*by, "pick", "value").agg(F.sum("rows").alias("rows"))


def _ranks(brackets: DataFrame, by: Sequence[str], picks: Mapping[str, Pick]) -> DataFrame:
    parts = [f"named_struct('pick', '{n}', 'rank', `__r_{n}`, 'known', `__n_{p.column}`)" for n, p in picks.items()]
    return brackets.selectExpr(*_names(by), f"inline(array({', '.join(parts)}))")


def _held(condensed: DataFrame, ranks: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, pick, side, values): the bracket's different values, and where its rank is if not inside: -1 below, 1 above."""
    held = condensed.groupBy(*by, "pick").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("rows"))), F.lit(0)).alias("below"),
        F.sum("rows").alias("upto"), F.count("value").alias("values"))
    side = F.when(F.col("rank") <= F.col("below"), -1).when(F.col("rank") > F.col("upto"), 1)
    return null_safe(ranks, held, [*by, "pick"], "left").select(*by, "pick", side.alias("side"), "values")


def _opened(brackets: DataFrame, missed: DataFrame, by: Sequence[str], picks: Mapping[str, Pick]) -> DataFrame:
    """Brackets with the missed ones moved to the side where their rank lies."""
    sides = missed.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("pick", "side"))).alias("__side"))
    joined = null_safe(brackets, sides, by, "left") if by else brackets.withColumn("__side", sides.scalar())
    new = {}
    for n in picks:
        side, low, high = f"__side['{n}']", f"`__lo_{n}`", f"`__hi_{n}`"
        new[f"__lo_{n}"] = F.expr(f"case {side} when 1 then {high} when -1 then null else {low} end")
        new[f"__hi_{n}"] = F.expr(f"case {side} when -1 then {low} when 1 then null else {high} end")
    return stage(joined.withColumns(new).drop("__side"), "brackets")


def _narrowed(condensed: DataFrame, ranks: DataFrame, by: Sequence[str], inside: int) -> DataFrame:
    """Brackets of more than ``inside`` values reduced to the cell that holds their rank."""
    key = [*by, "pick"]
    points = [k / CELLS for k in range(1, CELLS)]
    cuts = stage(condensed.groupBy(*key).agg(
        F.count(F.lit(1)).alias("__rows"), F.percentile_approx("value", points, 20 * CELLS).alias("__cuts")).select(
        *key, F.when(F.col("__rows") > inside, F.col("__cuts")).alias("__cuts")), "cuts")
    celled = null_safe(condensed, cuts, key, "inner").withColumn(
        "__cell", F.when(F.col("value").isNull(), -1).otherwise(F.coalesce(below(F.col("__cuts"), F.col("value"), CELLS), F.lit(0))))
    celled = celled.drop("__cuts")
    cells = celled.groupBy(*key, "__cell").agg(F.sum("rows").alias("__cr"))
    order = Window.partitionBy(*key).orderBy("__cell")   # a few hundred cells
    ends = cells.withColumn("__end", F.sum("__cr").over(order))
    ends = stage(null_safe(ends, ranks, key, "inner").select(
        *key, "__cell", F.when(F.col("__end") < F.col("rank"), "below").when(
            F.col("__end") - F.col("__cr") < F.col("rank"), "here").otherwise("above").alias("__where")), "cells")
    kept = null_safe(celled, ends, [*key, "__cell"], "inner").where("__where <> 'above'")
    value = F.when(F.col("__where") == "here", F.col("value"))
    return stage(kept.select(*key, value.alias("value"), "rows").groupBy(*key, "value").agg(
        F.sum("rows").alias("rows")), "narrowed")


def select_ranks(
    df: DataFrame, by: Sequence[str], picks: Mapping[str, Pick], grid: int = GRID, accuracy: int = ACCURACY,
    inside: int = INSIDE,
) -> DataFrame:
    """One row per group: for every pick its value, and beside it ``<name>_rank``, the column's known values
    ``<name>_known``, the smaller ones ``<name>_below`` and the equal ones ``<name>_rows``.

    ``df`` is read twice and should be a stored table. Columns of different types are
    compared as doubles. A group without a known value gets nulls.
    """
    by = list(by)
    columns = list(dict.fromkeys(p.column for p in picks.values()))
    kinds = {df.schema[c].dataType for c in columns}
    df = df.selectExpr(*_names(by), *[f"cast(`{c}` as double) as `{c}`" if len(kinds) > 1 else f"`{c}`"
                                      for c in columns if c not in by])
    brackets = _brackets(df, by, picks, grid, accuracy)
    ranks = _ranks(brackets, by, picks)
    while True:
        split = _split(df, by, picks, brackets)
        condensed = _condensed(split, by, picks)
        held = _held(condensed, ranks, by)
        missed, most = held.agg(F.count("side"), F.max("values")).first()
        if not missed:
            break
        brackets = _opened(brackets, held.where("side is not null"), by, picks)
    if (most or 0) > inside:
        condensed = stage(condensed, "condensed")
    while (most or 0) > inside:
        condensed = _narrowed(condensed, ranks, by, inside)
        most = _held(condensed, ranks, by).agg(F.max("values")).first()[0]

    key = [*by, "pick"]
    upto = F.sum("rows").over(Window.partitionBy(*key).orderBy(F.col("value").asc_nulls_first()))
    placed = null_safe(condensed.withColumn("end", upto), ranks, key, "inner").where(
        (F.col("end") >= F.col("rank")) & (F.col("end") - F.col("rows") < F.col("rank")))
    placed = placed.withColumn("below", F.col("end") - F.col("rows"))
    wanted = {"": "value", "_rank": "rank", "_known": "known", "_below": "below", "_rows": "rows"}
    found = placed.groupBy(*by).agg(*[F.expr(f"max(if(pick = '{n}', `{c}`, null)) as `{n}{end}`")
                                      for n in picks for end, c in wanted.items()])
    return null_safe(brackets.select(*by), found, by, "left") if by else found


def interpolated(
    df: DataFrame, columns: Mapping[str, tuple[str, float]], by: Sequence[str] = (), **options: int,
) -> DataFrame:
    """linearly interpolated quantiles per group, as name -> (column, share)."""
    def spot(share: float, n: str = "n") -> str:
        return f"(1.0D + {float(share)!r}D * ({n} - 1))"

    picks = {}
    for name, (column, share) in columns.items():
        picks[f"__low_{name}"] = Pick(column, f"floor({spot(share)})")
        picks[f"__high_{name}"] = Pick(column, f"ceil({spot(share)})")

    def value(name: str, share: float) -> str:
        a, b, at = f"cast(`__low_{name}` as double)", f"cast(`__high_{name}` as double)", spot(share, f"`__low_{name}_known`")
        return f"{a} + ({b} - {a}) * ({at} - floor({at})) as `{name}`"

    found = select_ranks(df, by, picks, **options)
    return found.selectExpr(*_names(by), *[value(name, share) for name, (_, share) in columns.items()])


def discrete(
    df: DataFrame, columns: Mapping[str, tuple[str, float]], by: Sequence[str] = (), **options: int,
) -> DataFrame:
    """The smallest value that so large a share of the known values does not exceed."""
    picks = {name: Pick(column, f"ceil({float(share)!r}D * n)") for name, (column, share) in columns.items()}
    return select_ranks(df, by, picks, **options).select(*by, *columns)


def tiles(
    df: DataFrame, within: Sequence[str], order: str, unique: str, count: int, name: str, **options: int,
) -> DataFrame:
    """The ``ntile`` of every row with a known ``order``, ascending, ties by ``unique``.

    The last row of every tile is selected, by ``order`` and among equals by
    ``unique``; rows compare themselves with these few rows, so none is moved.
    """
    known = df.where(F.col(order).isNotNull())
    ends = range(1, count)
    # the first ``n mod count`` tiles hold one row more
    picks = {f"__t{t}": Pick(order, f"(n div {count}) * {t} + least({t}, n % {count})") for t in ends}
    if not picks:
        return known.withColumn(name, F.lit(1))
    cuts = stage(select_ranks(known, within, picks, **options), "tile-ends")

    def shared(t: int) -> Column:
        """Does the tile end between rows of one value?"""
        return F.col(f"__t{t}_rank") - F.col(f"__t{t}_below") < F.col(f"__t{t}_rows")

    tied = F.array_compact(F.array(*[F.when(shared(t), F.struct(
        F.lit(t).alias("__t"), F.col(f"__t{t}").alias("__v"), F.col(f"__t{t}_rows").alias("__rows"),
        (F.col(f"__t{t}_rank") - F.col(f"__t{t}_below")).alias("__need"))) for t in ends]))
    ties = cuts.select(*within, F.explode(tied).alias("__x")).select(*within, "__x.*")
    most = ties.agg(F.max("__rows")).first()[0]
    if most is None:
        last = {t: F.lit(None) for t in ends}
    else:
        equal = null_safe(known.select(*within, F.col(order).alias("__v"), unique), ties, [*within, "__v"], "inner")
        key = [*within, "__t", "__need"]
        if most <= options.get("inside", INSIDE):   # so many rows share the value of a tile's end at most
            place = F.row_number().over(Window.partitionBy(*key).orderBy(unique))
            found = equal.withColumn("__place", place).where("__place = __need").withColumnRenamed(unique, "__u")
        else:
            found = select_ranks(stage(equal, "equals"), key, {"__u": Pick(unique, "__need")}, **options)
        wide = found.groupBy(*within).agg(*[F.max(F.when(F.col("__t") == t, F.col("__u"))).alias(f"__u{t}") for t in ends])
        cuts = stage(null_safe(cuts, wide, within, "left") if within else cuts.withColumns(
            {f"__u{t}": wide.select(f"__u{t}").scalar() for t in ends}), "tile-ends")
        last = {t: F.col(f"__u{t}") for t in ends}

    names = [x for t in ends for x in (f"__t{t}", *([f"__u{t}"] if f"__u{t}" in cuts.columns else []))]
    if within:
        rows = null_safe(known, cuts.select(*within, *names), within, "inner")
    else:
        one, kind = cuts.first(), dict(cuts.dtypes)
        rows = known.withColumns({n: F.lit(one[n]).cast(kind[n]) for n in names})
    beyond = [((F.col(order) > F.col(f"__t{t}")) | ((F.col(order) == F.col(f"__t{t}")) & F.coalesce(
        F.col(unique) > last[t], F.lit(False)))).cast("int") for t in ends]
    return rows.withColumn(name, sum(beyond, F.lit(1))).drop(*names)
