"""Queries on contracts, quarantine and foreign keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.operators.contracts import Contract, apply_contract, contract_summary
from terrace.operators.enrich import orphans
from terrace.plans.registry import query
from terrace.plans.retail import table

LINE_CONTRACT = Contract.of(
    {"rule": "min_count", "value": 1000},
    {"rule": "unique", "columns": ["l_orderkey", "l_linenumber"], "critical": False},
    {"rule": "not_null", "column": "l_returnflag", "tolerance_pct": 5.0},
    {"rule": "range", "column": "l_quantity", "value": [1, 45], "allow_null": False},
    {"rule": "allowed", "column": "l_linestatus", "value": ["F"], "critical": False},
    {"rule": "regex", "column": "l_linestatus", "value": "^[FO]$"},
    {"rule": "foreign_key", "column": "l_suppkey", "reference": "solvent",
     "reference_column": "s_suppkey", "tolerance_pct": 50.0},
    {"rule": "range", "column": "l_discount", "value": [0, 0.09], "tolerance_pct": 12.5},
    {"rule": "foreign_key", "column": "l_partkey", "reference": "part",
     "reference_column": "p_partkey"},
    {"rule": "not_null", "column": "l_comment"},
    description="line items with planted nulls and blanks",
)


def lines(spark, sf_dir):
    """Line items with some quantities nulled and some flags blanked."""
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
        "l_returnflag", "l_linestatus")
    return df.withColumns({
        "l_quantity": F.when(F.col("l_orderkey") % 50 != 0, F.col("l_quantity")),
        "l_returnflag": F.when(F.col("l_orderkey") % 70 == 0, F.lit("  ")).otherwise(
            F.col("l_returnflag")),
        "l_suppkey": F.when(F.col("l_orderkey") % 90 != 0, F.col("l_suppkey")),
    })


def outcome(spark, sf_dir):
    refs = {
        "solvent": table(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= 0),
        "part": table(spark, sf_dir, "part"),
    }
    return apply_contract(lines(spark, sf_dir), LINE_CONTRACT, refs)


_MARKED = """
l as (
  select l_orderkey, l_linenumber, l_partkey, l_discount, l_linestatus,
         case when l_orderkey % 90 <> 0 then l_suppkey end as l_suppkey,
         case when l_orderkey % 50 <> 0 then l_quantity end as l_quantity,
         case when l_orderkey % 70 = 0 then '  ' else l_returnflag end as l_returnflag
  from lineitem),
m as (
  select l.*,
         not (l_returnflag is not null and trim(l_returnflag) <> '') as v3,
         not coalesce(l_quantity between 1 and 45, false) as v4,
         not (l_linestatus is null or l_linestatus in ('F')) as v5,
         not (l_linestatus is null or regexp_matches(l_linestatus, '^[FO]$')) as v6,
         not coalesce(l_suppkey in (select s_suppkey from supplier where s_acctbal >= 0), false)
           as v7,
         not (l_discount is null or l_discount between 0 and 0.09) as v8,
         not coalesce(l_partkey in (select p_partkey from part), false) as v9
  from l),
q as (
  select *, concat_ws('|',
    case when v3 then 'not_null:l_returnflag' end, case when v4 then 'range:l_quantity' end,
    case when v6 then 'regex:l_linestatus' end, case when v7 then 'foreign_key:l_suppkey' end,
    case when v8 then 'range:l_discount' end, case when v9 then 'foreign_key:l_partkey' end)
    as _quarantine_reason
  from m),
t as (select count(*) as n, count(*) filter (where _quarantine_reason <> '') as nq from q),
r as (
  select 1 as position, 'min_count' as rule, null as col, true as critical, null::double as tol,
         (select greatest(1000 - n, 0) from t) as violations
  union all select 2, 'unique', 'l_orderkey,l_linenumber', false, null,
         (select count(*) from l) - (select count(*) from (select distinct l_orderkey, l_linenumber from l))
  union all select 3, 'not_null', 'l_returnflag', true, 5.0, (select count(*) filter (where v3) from q)
  union all select 4, 'range', 'l_quantity', true, 0.0, (select count(*) filter (where v4) from q)
  union all select 5, 'allowed', 'l_linestatus', false, 0.0, (select count(*) filter (where v5) from q)
  union all select 6, 'regex', 'l_linestatus', true, 0.0, (select count(*) filter (where v6) from q)
  union all select 7, 'foreign_key', 'l_suppkey', true, 50.0, (select count(*) filter (where v7) from q)
  union all select 8, 'range', 'l_discount', true, 12.5, (select count(*) filter (where v8) from q)
  union all select 9, 'foreign_key', 'l_partkey', true, 0.0, (select count(*) filter (where v9) from q)
  union all select 10, 'not_null', 'l_comment', true, 0.0, null),
s as (
  select *, case when tol is null then 0 else cast(floor(n * tol / 100) as bigint) end as allowed
  from r, t),
report as (
  select cast(position as integer) as position, rule, col as "column", critical, n as rows,
         nq as quarantined,
         cast(violations as bigint) as violations, cast(allowed as bigint) as allowed,
         violations <= allowed as passed,
         case when violations is null then 'SKIPPED' when violations <= allowed then 'PASS'
              when critical then 'FAIL' else 'WARN' end as status
  from s)
"""


@query("contract_report", f"with {_MARKED} select * from report")
def contract_report(spark, sf_dir):
    """Q01-Q09, Q13-Q16, A12, A13, J07."""
    return outcome(spark, sf_dir).report.drop("detail")


@query("contract_summary", f"""
    with {_MARKED}
    select max(rows) as rows_in, max(quarantined) as rows_quarantined,
           count(passed) as checks_total, count(*) filter (where not passed) as checks_failed,
           count(*) filter (where not passed and critical) as critical_failed,
           floor(count(*) filter (where passed) * 1000.0::double / count(passed) + 0.5) / 10 as score,
           max(rows) - max(quarantined) as rows_valid
    from report""")
def summary(spark, sf_dir):
    """Q14."""
    return contract_summary(outcome(spark, sf_dir).report)


_COLS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_returnflag, l_linestatus"


@query("contract_valid", f"with {_MARKED} select {_COLS} from q where _quarantine_reason = ''")
def contract_valid(spark, sf_dir):
    """Q10, Q12, U05."""
    return outcome(spark, sf_dir).valid


@query("contract_quarantine",
       f"with {_MARKED} select {_COLS}, _quarantine_reason from q where _quarantine_reason <> ''")
def contract_quarantine(spark, sf_dir):
    """Q10-Q12, F06."""
    return outcome(spark, sf_dir).quarantine


@query("fk_orphans", """
    select doc_id, lang, source, n_chars from documents
    where doc_id is null or doc_id not in (select doc_id from labels)""")
def fk_orphans(spark, sf_dir):
    """Documents without a label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return orphans(docs, table(spark, sf_dir, "labels"), "doc_id")
