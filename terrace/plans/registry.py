"""Named queries over the supplied tables, each with its SQL equivalent where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query; ``sql`` must give the same rows in DuckDB."""

    def add(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def half_up(x: str, digits: int = 1) -> str:
    """SQL text that rounds half away from zero at the decimal value, as Spark's ``round`` does.

    DuckDB rounds the binary value; the added 1e-7 of a unit puts exact decimal
    ties on the side Spark puts them.
    """
    x = f"cast({x} as double)"
    return f"(sign({x}) * floor(abs({x}) * 1e{digits} + 0.5 + 1e-7) / 1e{digits} + 0.0)"


def _title(x: str) -> str:
    """SQL text of the standard form of a name of one word."""
    return f"(upper(left(trim({x}), 1)) || lower(substr(trim({x}), 2)))"


# The canonical model in SQL; a query prefixes the parts it needs.
MODEL = f"""
nat as (
  select cast(n_nationkey as bigint) as group_id, {_title('n_name')} as group_name,
         upper(trim(r_name)) as region
  from nation left join region on n_regionkey = r_regionkey),
ent as (
  select c_custkey as entity_id, {_title('c_name')} as entity_name,
         cast(c_nationkey as bigint) as group_id, c_acctbal as context, group_name, region,
         c_acctbal is not null as context_available,
         case when c_acctbal < 2000 then 'SMALL' when c_acctbal < 6000 then 'MEDIUM'
              when c_acctbal is not null then 'LARGE' end as size_class
  from customer left join nat on nat.group_id = c_nationkey),
ey as (
  select cast(year(o_orderdate) as bigint) as yr, o_custkey as entity_id,
         count(*) as assessed, count(*) filter (where o_totalprice >= 250000) as successes
  from orders group by 1, 2),
gsum as (
  select yr, group_id, cast(sum(assessed) as bigint) as assessed,
         cast(sum(successes) as bigint) as successes
  from ey join ent using (entity_id) group by 1, 2),
g as (
  select yr, group_id, assessed, successes,
         {half_up('100.0::double * successes / assessed')} as computed,
         case when (yr + group_id) % 9 <> 0
              then {half_up('100.0::double * successes / assessed', 0)} end as published
  from gsum),
nsum as (
  select yr, cast(sum(assessed) as bigint) as assessed, cast(sum(successes) as bigint) as successes
  from g group by 1),
n as (
  select yr, assessed, successes,
         {half_up('100.0::double * successes / assessed')} as computed
  from nsum),
cal as (
  select min(yr) as y0, max(yr) as y1, min(yr) + 7 as goal, greatest(max(yr), min(yr) + 7) as y2 from g),
b0 as (
  select group_id, max(computed) filter (where yr = y0) as b0,
         max(computed) filter (where yr = y0 + 1) as b1 from g, cal group by 1),
nb as (
  select max(computed) filter (where yr = y0) as n0,
         max(computed) filter (where yr = y0 + 1) as n1 from n, cal),
base as (
  select nat.group_id, coalesce(b0, b1 - (n1 - n0), n0) as base,
         case when b0 is not null then 'BASE_YEAR' when b1 is not null then 'NEXT_YEAR'
              else 'NATIONAL' end as base_source
  from nat left join b0 using (group_id), nb),
tgt as (
  select group_id, base, base_source, cast(y.yr as bigint) as yr,
         case when y.yr > y0 then
           {half_up('greatest(least(base + (80.0::double - base) / 7.0::double * (least(y.yr, goal) - y0), 100.0::double), 0.0::double)')}
         end as target,
         case when y.yr > y0 then 'DERIVED_TRAJECTORY' end as target_source
  from base, cal, (select unnest(range(y0, y2 + 1)) as yr from cal) as y),
fact0 as (
  select ey.yr, ey.entity_id, ey.assessed, least(ey.successes, ey.assessed) as successes,
         {half_up('100.0::double * ey.successes / ey.assessed')} as indicator, tgt.target
  from ey left join ent using (entity_id)
  left join tgt on tgt.yr = ey.yr and tgt.group_id = ent.group_id),
fact as (select *, {half_up('indicator - target')} as gap from fact0),
view0 as (
  select fact.yr, fact.entity_id, assessed, successes, indicator, target, gap,
         entity_name, group_id, group_name, region, context, size_class, context_available,
         case when indicator >= target + 0.5::double then 'ABOVE'
              when indicator >= target - 0.5::double then 'ON' else 'BELOW' end as status,
         case when indicator < 40 then 'CRITICAL' when indicator < 60 then 'ATTENTION'
              when indicator < 80 then 'ADEQUATE' else 'ADVANCED' end as band,
         assessed - successes as shortfall
  from fact join ent using (entity_id)),
view as (
  select *, row_number() over (partition by yr order by indicator desc, entity_id) as rank_all,
         row_number() over (partition by yr, group_id order by indicator desc, entity_id)
           as rank_group
  from view0)
"""


def with_model(select: str, more: str = "") -> str:
    """SQL over the canonical model, with further CTEs if given."""
    return f"with {MODEL}{', ' + more if more else ''} {select}"
