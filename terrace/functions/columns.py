"""Derived columns: keys, flags, bands, gaps, targets, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class LeakageError(ValueError):
    """A feature table carries columns that are computed from its own label."""


def canonical_code(col: Column) -> Column:
    """Codes are compared trimmed and in upper case."""
    return F.upper(F.trim(col))


def derive_key(col: Column, divisor: int, dtype: str = "long") -> Column:
    """P10: the parent key is the leading digits of a hierarchical code."""
    return F.floor(col / F.lit(divisor)).cast(dtype)


def default_to(col: Column, value, dtype: str = "int") -> Column:
    """Null becomes a default."""
    return F.coalesce(col, F.lit(value)).cast(dtype)


def available(col: Column) -> Column:
    """Absence is kept and flagged, never imputed."""
    return col.isNotNull()


def band(
    col: Column, edges: Sequence[float], labels: Sequence[str], null_label: str | None = None,
    null_is_last: bool = False,
) -> Column:
    """``labels[i]`` below ``edges[i]``, the last label above every edge.

    A null value gets ``null_label`` (null by default), or the last label when
    ``null_is_last`` asks for the plain if/else reading.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(col < F.lit(edge), F.lit(label))
    if null_is_last:
        return out.otherwise(F.lit(labels[-1]))
    return out.when(col.isNotNull(), F.lit(labels[-1])).otherwise(F.lit(null_label).cast("string"))


def gap(actual: Column, target: Column, digits: int = 1) -> Column:
    """Rounded difference in points."""
    return F.round(actual - target, digits)


def rounded(col: Column, digits: int = 1) -> Column:
    """Cast to double and round."""
    return F.round(col.cast("double"), digits)


def capped(part: Column, whole: Column) -> Column:
    """A part may not exceed its whole; a null side is skipped."""
    return F.least(part, whole)


def null_if_below(col: Column, floor: float = 0) -> Column:
    """Impossible values become null."""
    return F.when(col < F.lit(floor), F.lit(None)).otherwise(col)


def cutoff_flag(col: Column, cutoff: float) -> Column:
    """1/0 against a cut-off, null for a missing score."""
    return (col >= F.lit(cutoff)).cast("int")


def gap_status(
    gap_col: Column, tolerance: float = 0.5,
    labels: Sequence[str] = ("ABOVE", "ON", "BELOW"), null_label: str | None = None,
) -> Column:
    """P20: status of a gap; a null gap falls to the last label unless ``null_label`` is given."""
    above, on, below = labels
    out = F.when(gap_col >= tolerance, above).when(gap_col >= -tolerance, on)
    if null_label is not None:
        out = out.when(gap_col.isNull(), null_label)
    return out.otherwise(below)


def target_status(
    actual: Column, target: Column, tolerance: float = 0.5,
    labels: Sequence[str] = ("ABOVE", "ON", "BELOW"), null_label: str | None = None,
) -> Column:
    """Status of an actual value against its target."""
    above, on, below = labels
    out = F.when(actual >= target + tolerance, above).when(actual >= target - tolerance, on)
    if null_label is not None:
        out = out.when(actual.isNull() | target.isNull(), null_label)
    return out.otherwise(below)


def pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """Rounded percentage, null for a zero whole."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def prefer(*cols: Column) -> Column:
    """First available value, such as published before computed."""
    return F.coalesce(*cols)


def label_by(col: Column, labels: Mapping, default: str | None = None) -> Column:
    """Readable label of a code."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for value, label in labels.items():
        out = out.when(col == F.lit(value), F.lit(label))
    return out.otherwise(F.lit(default).cast("string"))


def provenance(*sources: tuple[Column, str], otherwise: str) -> Column:
    """Label of the first available source."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for col, label in sources:
        out = out.when(col.isNotNull(), F.lit(label))
    return out.otherwise(F.lit(otherwise))


def looks_dirty(col: Column) -> Column:
    """Padded with blanks, or written wholly in upper case."""
    return col.rlike(r"^\s|\s$") | (col == F.upper(col))


def refuse_columns(df: DataFrame, banned: Sequence[str]) -> DataFrame:
    """Raise before any action when ``df`` carries a banned column."""
    leaked = [c for c in banned if c in df.columns]
    if leaked:
        raise LeakageError(
            f"leakage: {', '.join(leaked)} are computed from the label of the same period"
        )
    return df


def pseudonym(*parts: Column, length: int = 16) -> Column:
    """Truncated one-way hash of dash-joined parts."""
    return F.substring(F.sha2(F.concat_ws("-", *[p.cast("string") for p in parts]), 256), 1, length)


def round_at(col: Column, digits: int) -> Column:
    """Round half away from zero; the last bits of a double do not decide a tie.

    Means are doubles whose last bits depend on the order of their terms. A ten
    millionth of the last digit, added before rounding, lifts every decimal tie
    to the same side.
    """
    nudge = 1e-7 / 10**digits
    return F.round(col + F.when(col < 0, -nudge).otherwise(nudge), digits)


def mean_at(col: Column, digits: int) -> Column:
    """Mean of the values as they are, rounded; null for an empty group."""
    return round_at(F.avg(col), digits)
