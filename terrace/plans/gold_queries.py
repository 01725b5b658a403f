"""Queries on analytical products, rankings and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.functions import columns as c
from terrace.operators import dedup, profile
from terrace.operators.regression import what_if
from terrace.plans import retail
from terrace.plans import retail_products as products
from terrace.plans.registry import half_up, query, with_model
from terrace.plans.retail import table
from terrace.sources.staging import stage


def staged_entities(spark, sf_dir):
    """Orders condensed to entity and year: read once, stored, and used for everything else."""
    return stage(retail.entity_years(retail.supplied(spark, sf_dir)), "entity-years")


def staged_groups(spark, sf_dir, entities=None):
    """Group totals, stored because several branches read them."""
    if entities is None:
        entities = retail.entity_years(retail.supplied(spark, sf_dir))
    return stage(retail.group_years(entities), "group-years")


def facts(spark, sf_dir):
    """Unranked entity facts beside the group totals and the targets."""
    read = retail.supplied(spark, sf_dir)
    entities = staged_entities(spark, sf_dir)
    groups = staged_groups(spark, sf_dir, entities)
    targets = stage(retail.targets_of(read, groups), "targets")
    fact = retail.entity_fact(entities, targets)
    return products.entity_facts(fact, retail.dim_entity(read)), groups, targets


def view(spark, sf_dir):
    """Ranked entity view."""
    return products.ranked_view(facts(spark, sf_dir)[0])


_VIEW = """yr, entity_id, assessed, successes, indicator, target, gap, entity_name, group_id,
  group_name, region, context, size_class, context_available, status, band, shortfall"""


@query("entity_view", with_model(f"select {_VIEW}, rank_all, rank_group from view"))
def entity_view(spark, sf_dir):
    """G08, J03, P19, P21, P22, W02, W03."""
    return view(spark, sf_dir)


_TVA = f"""
tva as (
  select yr, group_id, group_name, region, cast(sum(assessed) as bigint) as assessed,
         cast(sum(successes) as bigint) as successes, count(*) as entities,
         count(*) filter (where status = 'BELOW') as entities_below,
         {half_up('avg(context)', 3)} as context_mean
  from view0 group by 1, 2, 3, 4),
tvb as (
  select tva.*, g.published, tgt.target,
         {half_up('100.0::double * tva.successes / tva.assessed')} as computed
  from tva left join g on g.yr = tva.yr and g.group_id = tva.group_id
  left join tgt on tgt.yr = tva.yr and tgt.group_id = tva.group_id),
tvc as (
  select *, {half_up('computed - published', 2)} as divergence,
         coalesce(published, computed) as indicator from tvb),
tvd as (select *, {half_up('indicator - target')} as gap from tvc),
tv as (
  select *, case when gap >= 0.5 then 'ABOVE' when gap >= -0.5 then 'ON' else 'BELOW' end as status
  from tvd)
"""
_TVA_COLUMNS = ("yr", "group_id", "group_name", "region", "assessed", "successes", "entities",
                "entities_below", "context_mean", "published", "target", "computed", "divergence",
                "indicator", "gap", "status")


@query("target_vs_actual", with_model(f"select {', '.join(_TVA_COLUMNS)} from tv", _TVA))
def target_vs_actual(spark, sf_dir):
    """G09, A01-A04, J04, P14, P20, P23-P25."""
    base, groups, targets = facts(spark, sf_dir)
    published = retail.published_of(groups, targets).select(
        "yr", "group_id", "published", "target")
    return products.target_vs_actual(base, published).select(*_TVA_COLUMNS)


@query("national_evolution", with_model(f"""
    select yr, target, published, assessed, successes, entities, computed, indicator,
           {half_up('indicator - lag(indicator) over (order by yr)')} as change,
           {half_up('indicator - target')} as gap,
           {half_up('80.0 - indicator')} as distance_to_goal
    from (select y.yr, y.target, p.published, a.assessed, a.successes, a.entities,
                 {half_up('100.0::double * a.successes / a.assessed')} as computed,
                 coalesce(p.published, {half_up('100.0::double * a.successes / a.assessed')})
                   as indicator
          from (select cast(s.yr as bigint) as yr, case when s.yr > y0 then
                  {half_up('greatest(least(n0 + (80.0::double - n0) / 7.0::double * (least(s.yr, goal) - y0), 100.0::double), 0.0::double)')}
                end as target from nb, cal, (select unnest(range(y0, y2 + 1)) as yr from cal) as s) y
          left join (select yr, case when yr % 4 <> 0 then {half_up('computed', 0)} end as published
                     from n) p on p.yr = y.yr
          left join (select yr, cast(sum(assessed) as bigint) as assessed,
                            cast(sum(successes) as bigint) as successes,
                            count(distinct entity_id) as entities
                     from view0 group by 1) a on a.yr = y.yr)"""))
def national_evolution(spark, sf_dir):
    """G10, A06, A10, J05, P24, P26, W04."""
    base, groups, _ = facts(spark, sf_dir)
    national = retail.national_fact(groups).select("yr", "target", "published")
    return products.national_evolution(national, base, retail.GOAL)


_PANEL = f"""
tiles as (
  select *, ntile(4) over (partition by yr order by context, entity_id) as quartile
  from view0 where context is not null),
panel as (
  select yr, region, cast(quartile as integer) as quartile, count(*) as entities,
         {half_up('avg(indicator)', 1)} as indicator_mean,
         {half_up('quantile_disc(indicator, 0.5)', 1)} as indicator_median,
         {half_up('avg(context)', 3)} as context_mean,
         cast(sum(assessed) as bigint) as assessed, cast(sum(shortfall) as bigint) as shortfall,
         case quartile when 1 then '1 - lowest' when 2 then '2 - lower middle'
              when 3 then '3 - upper middle' else '4 - highest' end as quartile_label
  from tiles group by yr, region, tiles.quartile)
"""


def panel(spark, sf_dir):
    base = facts(spark, sf_dir)[0]
    return products.inequality_panel(stage(base, "entity-facts"))


@query("inequality_panel", with_model("select * from panel", _PANEL))
def inequality_panel(spark, sf_dir):
    """G11, A08, A11, P27, P28, W07."""
    return panel(spark, sf_dir)


@query("ranking_extremes", with_model("""
    select yr, case when rank_all <= 100 then 'BEST' else 'WORST' end as side, rank_all,
           rank_group, entity_id, entity_name, group_name, region, indicator, target, gap, status,
           assessed, context, size_class
    from (select *, count(*) over (partition by yr) as n from view)
    where rank_all <= 100 or rank_all > n - 100"""))
def ranking_extremes(spark, sf_dir):
    """G12, J06, P29, T01, W08."""
    return products.ranking(stage(view(spark, sf_dir), "entity-view"))


@query("leakage_safe_features", with_model(f"""
    select yr, entity_id, entity_name, group_name, region, indicator as label,
           lag(indicator) over w as indicator_lag1, lag(assessed) over w as assessed_lag1,
           {half_up('lag(indicator) over w - lag(indicator, 2) over w')} as change_lag1,
           target as agreed_target, context, size_class
    from view0 window w as (partition by entity_id order by yr)"""))
def leakage_safe_features(spark, sf_dir):
    """G13, P34, W05, W06."""
    return products.features(facts(spark, sf_dir)[0])


@query("gap_aware_features", with_model(f"""
    select yr, entity_id, entity_name, group_name, region, indicator as label,
           case when lag(yr) over w = yr - 1 then lag(indicator) over w end as indicator_lag1,
           case when lag(yr) over w = yr - 1 then lag(assessed) over w end as assessed_lag1,
           {half_up('''case when lag(yr) over w = yr - 1 then lag(indicator) over w end
             - case when lag(yr, 2) over w = yr - 2 then lag(indicator, 2) over w end''')}
             as change_lag1,
           target as agreed_target, context, size_class
    from view0 window w as (partition by entity_id order by yr)"""))
def gap_aware_features(spark, sf_dir):
    """G13 with calendar-aware lags."""
    return products.features(facts(spark, sf_dir)[0], gap_aware=True)


@query("top_orders", """
    select o_orderkey, o_custkey, o_totalprice from orders
    order by o_totalprice desc, o_orderkey limit 20""")
def top_orders(spark, sf_dir):
    """T02."""
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("gap_order", with_model("select yr, group_name, indicator, target, gap from tv", _TVA))
def gap_order(spark, sf_dir):
    """Groups by ascending gap."""
    return target_vs_actual(spark, sf_dir).select(
        "yr", "group_name", "indicator", "target", "gap").orderBy("gap", "yr", "group_name")


@query("group_topk", """
    select o_orderpriority, rank, o_orderkey, o_totalprice from (
      select *, row_number() over (partition by o_orderpriority
                order by o_totalprice desc, o_orderkey) as rank from orders)
    where rank <= 5""")
def group_topk(spark, sf_dir):
    """T04."""
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    top = dedup.first_per_key(orders, ["o_orderpriority"],
                              [F.desc("o_totalprice"), F.asc("o_orderkey")], 5, "rank")
    return top.withColumn("rank", F.col("rank").cast("long"))


@query("top_groups", with_model("""
    select group_name, count(*) as n from view0 where band = 'CRITICAL'
    group by 1 order by 2 desc, 1 limit 8"""))
def top_groups(spark, sf_dir):
    """T05, P30."""
    return profile.top_groups(facts(spark, sf_dir)[0].where("band = 'CRITICAL'"), "group_name")


@query("weighted_mean_panel", with_model(f"""
    select yr, quartile_label,
           {half_up('sum(indicator_mean * entities) / sum(entities)')}
             as indicator_mean,
           cast(sum(entities) as bigint) as entities, cast(sum(shortfall) as bigint) as shortfall
    from panel group by 1, 2""", _PANEL))
def weighted_mean_panel(spark, sf_dir):
    """A14."""
    return panel(spark, sf_dir).groupBy("yr", "quartile_label").agg(
        profile.weighted_mean(F.col("indicator_mean"), F.col("entities")).alias("indicator_mean"),
        F.sum("entities").alias("entities"), F.sum("shortfall").alias("shortfall"))


@query("quartile_spread", with_model(f"""
    select yr, lowest, highest, {half_up('highest - lowest')} as spread from (
      select yr, min_by(m, quartile_label) as lowest, max_by(m, quartile_label) as highest
      from (select yr, quartile_label,
                   {half_up('sum(indicator_mean * entities) / sum(entities)')} as m
            from panel group by 1, 2) group by 1)""", _PANEL))
def quartile_spread(spark, sf_dir):
    """A21."""
    return profile.spread(weighted_mean_panel(spark, sf_dir), "indicator_mean", "quartile_label",
                          by=["yr"])


@query("value_counts", with_model("select status, count(*) as n from view0 group by 1"))
def value_counts(spark, sf_dir):
    """A15."""
    return profile.value_counts(facts(spark, sf_dir)[0], "status")


@query("critical_summary", with_model(f"""
    select yr, count(*) filter (where indicator < 40) as critical_rows,
           coalesce(cast(sum(shortfall) filter (where indicator < 40) as bigint), 0)
             as critical_shortfall,
           {half_up('avg(case when indicator < 40 then context end)', 3)} as critical_mean_context,
           {half_up('avg(context)', 3)} as mean_context
    from view0 group by 1"""))
def critical_summary(spark, sf_dir):
    """A16."""
    return profile.critical_summary(
        facts(spark, sf_dir)[0], F.col("indicator") < 40, "shortfall", "context", by=["yr"])


@query("describe", " union all ".join(f"""
    select '{col}' as "column", count({col}) as n, {half_up(f'avg({col})', 2)} as mean,
           {half_up(f'stddev_samp({col})', 2)} as std, {half_up(f'min({col})', 2)} as min,
           {half_up(f'quantile_cont({col}, 0.25)', 2)} as p25,
           {half_up(f'quantile_cont({col}, 0.5)', 2)} as p50,
           {half_up(f'quantile_cont({col}, 0.75)', 2)} as p75,
           {half_up(f'max({col})', 2)} as max from lineitem"""
    for col in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))
def describe(spark, sf_dir):
    """A17."""
    return profile.describe(table(spark, sf_dir, "lineitem"),
                            ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("raw_profile", """
    select count(*) as rows,
           count(*) - (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem))
             as repeated_keys,
           count(*) filter (where l_quantity is null or l_quantity = 50) as null_score,
           count(*) filter (where l_extendedprice < 5000) as impossible_price,
           count(*) filter (where l_returnflag = upper(l_returnflag)) as dirty_l_returnflag
    from lineitem""")
def raw_profile(spark, sf_dir):
    """A18, P35."""
    items = table(spark, sf_dir, "lineitem").withColumn(
        "score", F.when(F.col("l_quantity") < 50, F.col("l_quantity")))
    return profile.raw_profile(
        items, ["l_orderkey", "l_linenumber"], nullable=["score"],
        impossible={"price": F.col("l_extendedprice") < 5000},
        dirty={"l_returnflag": c.looks_dirty(F.col("l_returnflag"))})


@query("coverage", """
    select lang, count(*) as rows, count(l.doc_id) as covered,
           floor(count(l.doc_id) * 10000.0::double / count(*) + 0.5 + 1e-7) / 100 as coverage_pct
    from documents d left join (select distinct doc_id from labels) l using (doc_id) group by 1""")
def coverage(spark, sf_dir):
    """A19."""
    from terrace.operators.enrich import mark_known

    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    marked = mark_known(docs, table(spark, sf_dir, "labels"), "doc_id", marker="labelled")
    return profile.coverage(marked, F.col("labelled"), by=["lang"])


@query("max_divergence", with_model("""
    select yr, max(abs(divergence)) as max_abs_divergence from tv group by 1""", _TVA))
def max_divergence(spark, sf_dir):
    """A20."""
    return profile.max_divergence(target_vs_actual(spark, sf_dir), by=["yr"])


@query("correlation", with_model(f"""
    select yr, {half_up('corr(context, indicator)', 6)} as correlation from view0 group by 1"""))
def correlation(spark, sf_dir):
    """A23."""
    return profile.correlation(facts(spark, sf_dir)[0], "context", "indicator", by=["yr"])


@query("what_if", with_model(f"""
    select yr, count(*) as entities, cast(sum(assessed) as bigint) as assessed,
           cast(sum(shortfall) as bigint) as shortfall,
           {half_up('sum(assessed) * 3.3::double / 100.0::double')} as gain
    from view0 join (select yr, quantile_cont(context, 0.25) as cut from view0 group by 1)
      using (yr) where context <= cut group by 1"""))
def what_if_query(spark, sf_dir):
    """M10, F13."""
    base = stage(facts(spark, sf_dir)[0], "entity-facts")
    return what_if(base, "context", "assessed", "shortfall", 3.3, "entity_id", ["yr"])
