"""Parts of analytical products (G08-G13): totals, reconciliation, change, tiles and lags.

The operators take the names of the columns they work on; which columns make a
product is declared by its plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions import columns as c
from terrace.operators.quantiles import discrete
from terrace.operators.quantiles import tiles as quantile_groups
from terrace.operators.ranking import SPLIT_ABOVE, null_safe, rank_within
from terrace.sources.staging import stage


def totals(
    df: DataFrame, keys: Sequence[str], sums: Sequence[str] = (),
    means: Mapping[str, tuple[str, int]] | None = None, medians: Mapping[str, tuple[str, int]] | None = None,
    counts: Mapping[str, Column] | None = None, distinct: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per key with sums, rounded means and medians, counts of conditions and
    numbers of different values. Medians are exact and discrete, by distributed selection, for
    which ``df`` is read again and should be a stored table."""
    parts = [F.count_if(cond).alias(name) for name, cond in (counts or {}).items()]
    parts += [F.sum(name).alias(name) for name in sums]
    parts += [c.mean_at(F.col(col), digits).alias(name) for name, (col, digits) in (means or {}).items()]
    parts += [F.count_distinct(col).alias(name) for name, col in (distinct or {}).items()]
    out = df.groupBy(*keys).agg(*parts) if parts else df.select(*keys).distinct()
    if not medians:
        return out
    middle = discrete(df, {name: (col, 0.5) for name, (col, _) in medians.items()}, keys)
    middle = middle.select(*keys, *[F.round(name, digits).alias(name) for name, (_, digits) in medians.items()])
    return null_safe(out, middle, keys, "left")


def reconciled(
    df: DataFrame, part: str, whole: str, published: str, target: str, value: str = "indicator",
) -> DataFrame:
    """The share computed from volumes beside the published one.

    ``computed`` is the share in percent, ``value`` the published figure or else
    the computed one, ``gap`` its distance to the target.
    """
    share = c.pct(F.col(part), F.col(whole))
    best = c.prefer(F.col(published), share)
    return df.select("*", share.alias("computed"), best.alias(value), c.gap(best, F.col(target)).alias("gap"))


def change_on_previous(df: DataFrame, value: str, order: str, name: str = "change") -> DataFrame:
    """Difference to the row before, for a table of one row per period; its window is
    as long as the calendar."""
    before = F.lag(value).over(Window.orderBy(order))
    return df.withColumn(name, c.gap(F.col(value), before))


def ranked_twice(
    df: DataFrame, outer: Sequence[str], inner: Sequence[str], order: str, unique: str,
    names: tuple[str, str] = ("rank_all", "rank_group"), split_above: int = SPLIT_ABOVE,
) -> DataFrame:
    """Descending ranks in two partitionings; both read a stored table."""
    once = rank_within(stage(df, "to-rank"), list(outer), order, unique, names[0], split_above=split_above)
    return rank_within(stage(once, "ranked"), list(inner), order, unique, names[1], split_above=split_above)


def tiled(
    df: DataFrame, within: Sequence[str], order: str, unique: str, tiles: int, name: str,
    labels: Mapping[int, str] | None = None, last_label: str | None = None,
) -> DataFrame:
    """Rows with a known ``order`` value and their quantile group, ascending, with its label."""
    out = quantile_groups(df, list(within), order, unique, tiles, name)
    if labels is None:
        return out
    return out.withColumn(f"{name}_label", c.label_by(F.col(name), labels, default=last_label))


def lags(
    df: DataFrame, entity: str, period: str, wanted: Mapping[str, tuple[str, int]],
    changes: Mapping[str, tuple[str, str]] | None = None, gap_aware: bool = False,
) -> DataFrame:
    """Earlier values of an entity's columns, and differences between such values.

    ``wanted`` maps a new name to (column, rows back). An entity has one row per
    period, so its window is as long as the calendar. Lags count rows;
    ``gap_aware`` nulls a value that is not exactly so many periods back (D14).
    """
    w = Window.partitionBy(entity).orderBy(period)

    def back(column: str, n: int) -> Column:
        value = F.lag(column, n).over(w)
        return F.when(F.lag(period, n).over(w) == F.col(period) - n, value) if gap_aware else value

    values = {name: back(*spec) for name, spec in wanted.items()}
    moved = {name: c.gap(values[a], values[b]) for name, (a, b) in (changes or {}).items()}
    return df.select("*", *[v.alias(n) for n, v in (values | moved).items()])


def known_with(label: str, derived: Mapping[str, Sequence[str]]) -> set[str]:
    """Columns that tell the label of the same period.

    These are the label's inputs, what is derived from the label, and what
    shares all its inputs with it, under the declared derivations.
    """
    told = {label, *derived.get(label, ())}
    while more := {name for name, inputs in derived.items() if name not in told and (
            label in inputs or set(inputs) <= told - {label})}:
        told |= more
    return told - {label}
