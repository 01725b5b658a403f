"""Queries on columns, keys, dimensions and facts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from terrace.functions import columns as c
from terrace.functions.text import standardize_name
from terrace.operators import dedup, enrich, lineage
from terrace.plans import retail
from terrace.plans.gold_queries import staged_entities, staged_groups
from terrace.plans.registry import half_up, query, with_model
from terrace.plans.retail import table
from terrace.sources.staging import stage

_INGESTED = datetime(2026, 1, 15, 6, 30)


@query("bronze_lineage_hash", """
    select c_custkey, c_name, c_nationkey, c_mktsegment,
           timestamp '2026-01-15 06:30:00' as at, '2026-01-15' as _ingestion_date, 'customer.csv' as file,
           'RETAIL' as system, 'customer' as entity, 'run-1' as run,
           sha256(""" + " || ".join(f"coalesce(length(cast({x} as varchar)) || ':' || cast({x} as varchar), '~')" for x in (
               "c_custkey", "c_name", "c_nationkey", "c_mktsegment")) + """) as row_hash
    from customer""")
def bronze_lineage_hash(spark, sf_dir):
    """P01, P02, F05."""
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    out = lineage.with_lineage(df, "customer", "customer.csv", "RETAIL", "run-1", _INGESTED)
    return out.select("*", "_origin.*").drop("_origin").withColumn("at", F.lit(_INGESTED).cast("timestamp_ntz"))


_LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate")
_LINE_TIES = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus")


@query("dedup_latest", f"""
    select {', '.join(_LINE_COLUMNS)} from (
      select *, row_number() over (partition by l_orderkey, l_linenumber
                order by l_shipdate desc, {', '.join(_LINE_TIES)}) as rn from lineitem)
    where rn = 1""")
def dedup_latest(spark, sf_dir):
    """W01."""
    items = table(spark, sf_dir, "lineitem").select(*_LINE_COLUMNS)
    return dedup.dedup_latest(items, ["l_orderkey", "l_linenumber"], "l_shipdate", _LINE_TIES)


@query("standardize_name", r"""
    with raw as (
      select p_partkey, p_brand,
             concat('  ', upper(p_name), '   DE ', lower(p_type), '-', lower(p_name), ' e',
                    chr(9), p_type, ' ') as raw_name,
             concat(' ', lower(p_brand), ' ') as raw_code from part),
    words as (
      select *, string_split(trim(regexp_replace(raw_name, '\s+', ' ', 'g')), ' ') as w from raw),
    titled as (
      select *, list_transform(w, lambda x: array_to_string(list_transform(string_split(x, '-'),
                lambda y: upper(y[1]) || lower(y[2:])), '-')) as t from words)
    select p_partkey, upper(trim(raw_code)) as code,
           array_to_string(list_transform(t, lambda x, i:
             case when i > 1 and i < len(t) and x in ('De', 'Da', 'Do', 'Das', 'Dos', 'E')
                  then lower(x) else x end), ' ') as name,
           (regexp_matches(raw_name, '^\s|\s$') or raw_name = upper(raw_name)) as dirty
    from titled""")
def standardize_names(spark, sf_dir):
    """P08, P09, P35, F01-F03."""
    part = table(spark, sf_dir, "part")
    raw = F.concat(F.lit("  "), F.upper("p_name"), F.lit("   DE "), F.lower("p_type"), F.lit("-"),
                   F.lower("p_name"), F.lit(" e\t"), F.col("p_type"), F.lit(" "))
    code = F.concat(F.lit(" "), F.lower("p_brand"), F.lit(" "))
    return part.select(
        "p_partkey", c.canonical_code(code).alias("code"), standardize_name(raw).alias("name"),
        c.looks_dirty(raw).alias("dirty"))


@query("derive_key_join", """
    select o_orderkey, cast(o_custkey // 100 as integer) as parent_key,
           o_custkey // 10 as short_key, s_name, s_acctbal,
           s_suppkey is not null as matched
    from orders left join supplier on s_suppkey = o_custkey // 10""")
def derive_key_join(spark, sf_dir):
    """P10, J02, J08, P12."""
    orders, supplier = table(spark, sf_dir, "orders"), table(spark, sf_dir, "supplier")
    joined = enrich.enrich_by_expression(
        orders.select("o_orderkey", "o_custkey"),
        supplier.withColumn("known", F.lit(True)),
        c.derive_key(F.col("o_custkey"), 10), "s_suppkey", ["s_name", "s_acctbal", "known"])
    return joined.select(
        "o_orderkey", c.derive_key(F.col("o_custkey"), 100, "int").alias("parent_key"),
        c.derive_key(F.col("o_custkey"), 10).alias("short_key"), "s_name", "s_acctbal",
        c.available(F.col("known")).alias("matched"))


@query("dim_group", with_model("select group_id, group_name, region from nat"))
def dim_group(spark, sf_dir):
    """G02, P08."""
    return retail.dim_group(retail.supplied(spark, sf_dir))


@query("dim_entity", with_model("""
    select group_id, entity_id, entity_name, context, group_name, region, context_available,
           size_class from ent"""))
def dim_entity(spark, sf_dir):
    """G03, J01, P12, P13."""
    return retail.dim_entity(retail.supplied(spark, sf_dir))


@query("fact_national", with_model(f"""
    select y.yr as yr, y.target, published, published is not null as available,
           {half_up('published - y.target')} as published_gap
    from (select cast(s.yr as bigint) as yr, case when s.yr > y0 then
            {half_up('greatest(least(n0 + (80.0::double - n0) / 7.0::double * (least(s.yr, goal) - y0), 100.0::double), 0.0::double)')}
          end as target from nb, cal, (select unnest(range(y0, y2 + 1)) as yr from cal) as s) y
    left join (select yr, case when yr % 4 <> 0 then {half_up('computed', 0)} end as published
               from n) p on p.yr = y.yr"""))
def fact_national(spark, sf_dir):
    """G04, R08, P12, P14."""
    return retail.national_fact(staged_groups(spark, sf_dir))


@query("fact_group", with_model(f"""
    select tgt.yr, tgt.group_id, target, published, published is not null as available,
           {half_up('published - target')} as published_gap
    from tgt left join g on g.yr = tgt.yr and g.group_id = tgt.group_id"""))
def fact_group(spark, sf_dir):
    """G05, P12, P14."""
    groups = staged_groups(spark, sf_dir)
    return retail.published_of(groups, retail.targets_of(retail.supplied(spark, sf_dir), groups))


@query("fact_indicator", with_model("""
    select yr, entity_id, assessed, successes, indicator, target, gap from fact"""))
def fact_indicator(spark, sf_dir):
    """G06, P14-P16, P23."""
    entities = staged_entities(spark, sf_dir)
    groups = staged_groups(spark, sf_dir, entities)
    targets = stage(retail.targets_of(retail.supplied(spark, sf_dir), groups), "targets")
    return retail.entity_fact(entities, targets)


@query("fact_micro_cutoff", """
    with s as (select *, case when l_quantity <= 2 then -l_quantity
                              when l_quantity < 50 then l_quantity end as s0 from lineitem),
    t as (select *, case when s0 < 0 then null else s0 end as score from s)
    select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as line,
           cast(year(l_shipdate) as bigint) as yr, upper(trim(l_returnflag)) as returnflag,
           upper(trim(l_linestatus)) as linestatus, score,
           cast(score >= 25 as bigint) as passed
    from t""")
def fact_micro_cutoff(spark, sf_dir):
    """G07, P08, P17, P18."""
    return retail.micro_fact(retail.supplied(spark, sf_dir))


@query("default_and_label", """
    select c_custkey,
           cast(coalesce(case when c_acctbal > 0 then 1 end, 0) as integer) as in_credit,
           case c_mktsegment when 'BUILDING' then 'Construction' when 'MACHINERY' then 'Industry'
                else 'Other' end as sector,
           case when c_acctbal >= 5000 then 'RICH' when c_acctbal > 0 then 'CREDIT'
                else 'DEBT' end as origin
    from customer""")
def default_and_label(spark, sf_dir):
    """P11, P27, P33."""
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        c.default_to(F.when(balance > 0, 1), 0).alias("in_credit"),
        c.label_by(F.col("c_mktsegment"), {"BUILDING": "Construction", "MACHINERY": "Industry"},
                   default="Other").alias("sector"),
        c.provenance((F.when(balance >= 5000, balance), "RICH"),
                     (F.when(balance > 0, balance), "CREDIT"), otherwise="DEBT").alias("origin"))


@query("pseudonym", """
    select o_orderkey, substr(sha256(concat_ws('-', cast(o_custkey as varchar),
           cast(year(o_orderdate) as varchar), cast(o_orderkey as varchar))), 1, 16) as alias
    from orders""")
def pseudonym(spark, sf_dir):
    """R12, F14."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        c.pseudonym(F.col("o_custkey"), F.year("o_orderdate"), F.col("o_orderkey")).alias("alias"))


@query("compare_versions", """
    with a as (select p_partkey, case when p_size % 4 = 0 then upper(p_name)
                 when p_size % 4 = 1 then concat(' ', p_name) else p_name end as p_name,
                 p_brand from part),
    b as (select p_partkey, lower(trim(p_name)) as p_name, p_brand from a)
    select a.p_partkey, a.p_name as p_name_before, a.p_brand as p_brand_before,
           b.p_name as p_name_after, b.p_brand as p_brand_after
    from a join b using (p_partkey)
    where a.p_name is distinct from b.p_name or a.p_brand is distinct from b.p_brand""")
def compare_versions(spark, sf_dir):
    """J09."""
    size = F.col("p_size") % 4
    before = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(size == 0, F.upper("p_name")).when(size == 1, F.concat(F.lit(" "), F.col("p_name")))
        .otherwise(F.col("p_name")).alias("p_name"), "p_brand")
    after = before.withColumn("p_name", F.lower(F.trim("p_name")))
    return enrich.compare_versions(before, after, ["p_partkey"], ["p_name", "p_brand"])


@query("union_parts", """
    select l_orderkey, l_partkey, l_quantity, null::bigint as o_custkey, null::double as o_totalprice
    from lineitem
    union all
    select o_orderkey, null, null, o_custkey, o_totalprice from orders""")
def union_parts(spark, sf_dir):
    """U01."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_totalprice")
    return dedup.union_parts(items, orders)


@query("distinct_keys", "select distinct l_orderkey, l_linenumber from lineitem")
def distinct_keys(spark, sf_dir):
    """U02."""
    return dedup.distinct_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("drop_repeats", """
    select o_custkey, o_orderkey, o_totalprice from (
      select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) rn
      from orders) where rn = 1""")
def drop_repeats(spark, sf_dir):
    """U03."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return dedup.drop_repeats(orders, "o_custkey", [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("merged_years", """
    select distinct yr from (
      select cast(year(o_orderdate) as bigint) as yr from orders
      union all select cast(year(l_shipdate) as bigint) from lineitem
      union all select cast(year(ts) as bigint) from events)""")
def merged_years(spark, sf_dir):
    """U04."""
    years = [
        table(spark, sf_dir, name).select(F.year(col).cast("long").alias("yr"))
        for name, col in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    ]
    return dedup.merged_years(*years)
