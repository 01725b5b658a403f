"""Data contracts with quarantine (Q01-Q20).

A contract is a list of checks. All row checks become boolean columns of one
marked table, and one aggregate over that table counts every violation, so the
cost does not grow with the number of checks. Table checks on keys take one
pre-aggregated pass over the key columns each.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from terrace.operators.enrich import mark_known

ROW_RULES = ("not_null", "range", "allowed", "regex", "foreign_key")
REASON = "_quarantine_reason"
_META = ("array<struct<position int, rule string, column string, critical boolean, "
         "tolerance_pct double, skipped boolean>>")


class ContractViolation(RuntimeError):
    """A critical check failed; nothing may be published."""


@dataclass(frozen=True)
class Check:
    """One rule of a contract."""

    rule: str
    column: str | None = None
    columns: tuple[str, ...] = ()
    value: object = None
    critical: bool = True
    allow_null: bool = True
    tolerance_pct: float = 0.0
    reference: str | None = None
    reference_column: str | None = None

    @property
    def target(self) -> str | None:
        return ",".join(self.columns) if self.columns else self.column

    @property
    def needed(self) -> tuple[str, ...]:
        return self.columns or ((self.column,) if self.column else ())


@dataclass(frozen=True)
class Contract:
    """Checks of one table."""

    checks: tuple[Check, ...] = ()
    description: str = ""

    @classmethod
    def of(cls, *checks: Mapping | Check, description: str = "") -> Contract:
        made = []
        for c in checks:
            if not isinstance(c, Check):
                c = dict(c)
                if "columns" in c:
                    c["columns"] = tuple(c["columns"])
                c = Check(**c)
            made.append(c)
        return cls(tuple(made), description)


@dataclass
class Outcome:
    """What a contract makes of a table; all three frames are lazy."""

    valid: DataFrame
    quarantine: DataFrame
    report: DataFrame
    skipped: list[Check] = field(default_factory=list)


def load_contracts(path: str | Path) -> dict[str, Contract]:
    """Q18: contracts of one layer from YAML, ``table -> {description, checks}``."""
    raw = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    return {
        table: Contract.of(*spec.get("checks", []), description=spec.get("description", ""))
        for table, spec in raw.items()
    }


def _row_condition(df: DataFrame, check: Check) -> Column:
    """Q03-Q06, Q08: a predicate that is never null."""
    col = F.col(check.column)
    if check.rule == "not_null":
        cond = col.isNotNull()
        if isinstance(df.schema[check.column].dataType, StringType):
            cond = cond & (F.trim(col) != "")
        return F.coalesce(cond, F.lit(False))
    if check.rule == "range":
        low, high = check.value
        cond = col.between(F.lit(low), F.lit(high))
    elif check.rule == "allowed":
        cond = col.isin(list(check.value))
    else:
        cond = col.rlike(check.value)
    if check.allow_null:
        cond = cond | col.isNull()
    return F.coalesce(cond, F.lit(False))


@dataclass
class Marked:
    """A table with the reason for quarantine beside every row (empty: valid), and its checks by kind."""

    rows: DataFrame
    helpers: list[str]
    row: list[tuple[int, Check, Column]]
    table: list[tuple[int, Check]]
    skipped: list[tuple[int, Check]]

    def counts(self) -> list[Column]:
        """Aggregates over ``rows``, for ``agg`` as well as for ``observe``."""
        return [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(REASON) != "").alias("quarantined"),
                *[F.count_if(~cond).alias(f"v{i}") for i, _, cond in self.row]]

    def repeats(self, rows: DataFrame) -> dict[str, DataFrame]:
        """Per uniqueness check the rows beyond the first of their key, a one-row table; a null key
        counts as a value, and the first aggregate combines map-side."""
        return {f"v{i}": rows.groupBy(*check.needed).agg((F.count(F.lit(1)) - 1).alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n")) for i, check in self.table if check.rule == "unique"}

    def longest_reason(self) -> int:
        return sum(len(_reason(c)) + 1 for _, c, _ in self.row if c.critical)

    def codes(self) -> Column:
        """The reason as one digit per critical row check, in their order; empty for a valid row."""
        failed = [F.when(cond, "0").otherwise("1") for _, check, cond in self.row if check.critical]
        return F.when(F.col(REASON) != "", F.concat(*failed)).otherwise("")

    def decoded(self, codes: Column) -> Column:
        """The reason's text from such digits."""
        reasons = [_reason(c) for _, c, _ in self.row if c.critical]
        return F.concat_ws("|", *[F.when(F.substring(codes, k + 1, 1) == "1", F.lit(r)) for k, r in enumerate(reasons)])


def _reason(check: Check) -> str:
    return f"{check.rule}:{check.column}"


def mark(df: DataFrame, contract: Contract, references: Mapping[str, DataFrame] | None = None) -> Marked:
    """Check every row against the row rules.

    Only critical row checks quarantine, also within their tolerance (Q10); the
    reason column lists them in declaration order (Q11). Checks on an absent
    column or reference are reported as SKIPPED and not scored (Q13).
    """
    references = references or {}
    out = Marked(df, [], [], [], [])
    for i, check in enumerate(contract.checks):
        missing = any(c not in df.columns for c in check.needed)
        if not missing and check.rule in ("min_count", "unique"):
            out.table.append((i, check))
        elif not missing and check.rule == "foreign_key" and check.reference in references:
            # named by position: two checks on one column keep separate markers
            marker = f"__fk_{i}"
            out.rows = mark_known(out.rows, references[check.reference], check.column, check.reference_column, marker)
            out.helpers.append(marker)
            out.row.append((i, check, F.col(marker)))
        elif not missing and check.rule in ROW_RULES and check.rule != "foreign_key":
            out.row.append((i, check, _row_condition(df, check)))
        else:
            out.skipped.append((i, check))
    reasons = [F.when(~cond, F.lit(_reason(check))) for _, check, cond in out.row if check.critical]
    out.rows = out.rows.withColumn(REASON, F.concat_ws("|", *reasons) if reasons else F.lit(""))
    return out


def apply_contract(df: DataFrame, contract: Contract, references: Mapping[str, DataFrame] | None = None) -> Outcome:
    """Split ``df`` into valid and quarantined rows and report every check."""
    marked = mark(df, contract, references)
    valid = marked.rows.where(F.col(REASON) == "").drop(REASON, *marked.helpers)
    quarantine = marked.rows.where(F.col(REASON) != "").drop(*marked.helpers)
    metrics = marked.rows.agg(*marked.counts())
    metrics = metrics.withColumns({name: n.scalar() for name, n in marked.repeats(marked.rows).items()})
    return Outcome(valid, quarantine, report_of(marked, metrics), [c for _, c in marked.skipped])


def measured_report(spark: SparkSession, marked: Marked, figures: Mapping[str, int]) -> list[Row]:
    """The report's rows in their order, from figures that were observed elsewhere."""
    names = ["rows", "quarantined", *[f"v{i}" for i, _, _ in marked.row],
             *[f"v{i}" for i, c in marked.table if c.rule == "unique"]]
    metrics = spark.range(1).select(*[F.lit(int(figures.get(n) or 0)).cast("long").alias(n) for n in names])
    return sorted(report_of(marked, metrics).collect(), key=lambda r: r["position"])  # one row per check


def report_of(marked: Marked, metrics: DataFrame) -> DataFrame:
    """Q01, Q02, Q09, Q14-Q16: one row per check from the one-row ``metrics``."""
    row, table, skipped = marked.row, marked.table, marked.skipped
    violations = {i: F.col(f"v{i}") for i, *_ in [*row, *table]}
    violations |= {i: F.lit(None) for i, _ in skipped}
    for i, check in table:
        if check.rule == "min_count":
            violations[i] = F.greatest(F.lit(int(check.value)) - F.col("rows"), F.lit(0))

    checks = [(i, c) for i, c, _ in row] + table
    known = [(i, c, False) for i, c in checks] + [(i, c, True) for i, c in skipped]
    if not known:
        known, violations = [(-1, Check("none"), False)], {-1: F.lit(0)}
    meta = [
        {"position": i + 1, "rule": c.rule, "column": c.target, "critical": c.critical,
         "tolerance_pct": float(c.tolerance_pct), "skipped": skip}
        for i, c, skip in known
    ]
    counts = F.array(*[violations[i].cast("long") for i, _, _ in known])
    zipped = F.arrays_zip(
        F.from_json(F.lit(json.dumps(meta)), _META).alias("m"), counts.alias("violations"))
    long = metrics.select("rows", "quarantined", F.inline(zipped)).select(
        "rows", "quarantined", "m.*", "violations")
    allowed = F.when(
        F.col("rule").isin(*ROW_RULES), F.floor(F.col("rows") * F.col("tolerance_pct") / 100)
    ).otherwise(F.lit(0)).cast("long")
    passed = F.when(~F.col("skipped"), F.col("violations") <= F.col("allowed"))
    return (
        long.withColumn("allowed", allowed)
        .withColumn("passed", passed)
        .withColumn(
            "status",
            F.when(F.col("skipped"), "SKIPPED")
            .when(F.col("passed"), "PASS")
            .when(F.col("critical"), "FAIL")
            .otherwise("WARN"))
        .withColumn("detail", F.format_string(
            "%d of %d row(s) violate, %d allowed", "violations", "rows", "allowed"))
        .select("position", "rule", "column", "critical", "rows", "quarantined", "violations",
                "allowed", "passed", "status", "detail")
    )


def contract_summary(report: DataFrame) -> DataFrame:
    """Q14: one row with counts and the score, 100 when nothing was scored."""
    scored = F.col("passed").isNotNull() & (F.col("position") > 0)
    total = F.count_if(scored)
    return report.agg(
        F.max("rows").alias("rows_in"),
        F.coalesce(F.max("quarantined"), F.lit(0)).alias("rows_quarantined"),
        total.alias("checks_total"),
        F.count_if(scored & ~F.col("passed")).alias("checks_failed"),
        F.count_if(scored & ~F.col("passed") & F.col("critical")).alias("critical_failed"),
        F.coalesce(
            F.round(F.try_divide(F.lit(100.0) * F.count_if(scored & F.col("passed")), total), 1),
            F.lit(100.0)).alias("score"),
    ).withColumn("rows_valid", F.col("rows_in") - F.col("rows_quarantined"))


def summarize(rows: Sequence[Row]) -> dict:
    """The same figures from a collected report, which has one row per check."""
    scored = [r for r in rows if r["passed"] is not None and r["position"] > 0]
    failed = [r for r in scored if not r["passed"]]
    rows_in = max((r["rows"] or 0 for r in rows), default=0)
    quarantined = max((r["quarantined"] or 0 for r in rows), default=0)
    return {
        "rows_in": rows_in,
        "rows_quarantined": quarantined,
        "rows_valid": rows_in - quarantined,
        "checks_total": len(scored),
        "checks_failed": len(failed),
        "critical_failed": sum(r["critical"] for r in failed),
        "score": round(100.0 * (len(scored) - len(failed)) / len(scored), 1) if scored else 100.0,
    }


def enforce(report: DataFrame | Sequence[Row], table: str = "table") -> None:
    """Q17: raise when a critical check failed."""
    if isinstance(report, DataFrame):
        report = report.where(F.col("status") == "FAIL").collect()
    failed = [r for r in report if r["status"] == "FAIL"]
    if failed:
        text = "; ".join(f"{r['rule']}:{r['column']} ({r['detail']})" for r in failed)
        raise ContractViolation(f"{table}: {text}")
