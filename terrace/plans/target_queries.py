"""Queries on targets, scores, calibration and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.operators import sampling, scoring
from terrace.operators import targets as t
from terrace.operators.calibration import calibrate_to_group_mean
from terrace.plans import retail
from terrace.plans.gold_queries import facts, staged_groups
from terrace.plans.registry import MODEL, half_up, query, with_model
from terrace.plans.retail import table
from terrace.sources.staging import stage


@query("target_trajectory", with_model("""
    select group_id, base, base_source, yr, target, target_source from tgt"""))
def target_trajectory(spark, sf_dir):
    """R08, R10."""
    groups = staged_groups(spark, sf_dir)
    return retail.targets_of(retail.supplied(spark, sf_dir), groups)


_SPARSE = """
gs as (select yr, group_id, case when (yr + group_id) % 3 <> 0 then computed end as computed from g),
s0 as (select group_id, max(computed) filter (where yr = y0) as b0,
              max(computed) filter (where yr = y0 + 1) as b1 from gs, cal group by 1)
"""


@query("baseline_fallback", with_model("""
    select nat.group_id, coalesce(s0.b0, s0.b1 - (n1 - n0), n0) as base,
           case when s0.b0 is not null then 'BASE_YEAR' when s0.b1 is not null then 'NEXT_YEAR'
                else 'NATIONAL' end as base_source
    from nat left join s0 using (group_id), nb""", _SPARSE))
def baseline_fallback(spark, sf_dir):
    """Every third (year, group) is uncollected."""
    groups = staged_groups(spark, sf_dir)
    sparse = groups.withColumn(
        "computed", F.when((F.col("yr") + F.col("group_id")) % 3 != 0, F.col("computed")))
    return t.baselines(retail.dim_group(retail.supplied(spark, sf_dir)), sparse, retail.national_years(groups),
                       retail.calendar_of(groups).first)


@query("group_value_fallback", with_model("""
    select nat.group_id, cast(y.yr as bigint) as yr,
           coalesce(g.published, case when b.published is not null then
             greatest(least(b.published + (n.computed - nb.n0), 99.0::double), 3.0::double) end,
             n.computed) as value,
           case when g.published is not null then 'PUBLISHED' else 'ESTIMATED' end as value_source
    from nat, nb, (select unnest(range(y0, y1 + 1)) as yr from cal) as y
    left join g on g.group_id = nat.group_id and g.yr = y.yr
    left join (select group_id, published from g, cal where yr = y0) b on b.group_id = nat.group_id
    left join n on n.yr = y.yr"""))
def group_value_fallback(spark, sf_dir):
    """R06, R10, P33."""
    groups = staged_groups(spark, sf_dir)
    known = retail.calendar_of(groups)
    years = t.scaffold(retail.dim_group(retail.supplied(spark, sf_dir)).select("group_id"), known.first, known.last)
    return t.group_values_with_fallback(years, groups, retail.national_years(groups), known.first)


@query("national_target", with_model(f"""
    select cast(y.yr as bigint) as yr,
           coalesce(p.target, {half_up('v0 + (80.0::double - v0) / (y1 - y0 - 2)::double * (y.yr - y0 - 3)')})
             as target,
           case when p.target is not null then 'PUBLISHED' else 'INTERPOLATED' end as target_source
    from cal, (select unnest(range(y0, y1 + 2)) as yr from cal) as y
    left join pub p on p.yr = y.yr, (select target as v0 from pub, cal where yr = y0 + 3)""",
    f"""pub as (
      select yr, {half_up('computed', 0)} as target from n, cal where yr <= y0 + 3
      union all select max(yr) + 1, 80.0::double from n)"""))
def national_target(spark, sf_dir):
    """Whole-percent results of the first four years as published targets, then a line to the goal."""
    groups = staged_groups(spark, sf_dir)
    years = retail.calendar_of(groups)
    national = retail.national_years(groups)
    published = national.where(F.col("yr") <= years.first + 3).select(
        "yr", F.round("computed", 0).alias("target"))
    goal = national.agg((F.max("yr") + 1).alias("yr"), F.lit(retail.GOAL).alias("target"))
    return t.national_targets(published.unionByName(goal), years.first, years.first + 3, years.last + 1)


_WEIGHTS = {"balance": 1.0, "missing": -0.55}


@query("zscore_composite", f"""
    with c as (select c_custkey, c_nationkey, c_acctbal as balance,
                      case when c_custkey % 7 <> 0 then c_acctbal end as missing from customer),
    z as (
      select *, coalesce((balance - avg(balance) over w) / nullif(stddev_pop(balance) over w, 0), 0)
               as balance_z,
             coalesce(missing, avg(missing) over w) as filled from c
      window w as (partition by c_nationkey)),
    y as (
      select *, coalesce((filled - avg(filled) over w) / nullif(stddev_pop(filled) over w, 0), 0)
               as missing_z from z window w as (partition by c_nationkey))
    select c_custkey, {half_up('balance_z', 6)} as balance_z,
           {half_up('missing_z', 6)} as missing_z,
           {half_up('balance_z * 1.0::double + missing_z * -0.55::double', 6)} as score
    from y""")
def zscore_composite(spark, sf_dir):
    """Scores inside each nation."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", F.col("c_acctbal").alias("balance"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("missing"))
    scored = scoring.zscores(customers, ["balance"], ["c_nationkey"])
    scored = scoring.zscores(scored, ["missing"], ["c_nationkey"], impute_mean=True)
    return scored.select(
        "c_custkey", F.round("balance_z", 6).alias("balance_z"),
        F.round("missing_z", 6).alias("missing_z"),
        F.round(scoring.weighted_score(_WEIGHTS), 6).alias("score"))


@query("zscore_overall", f"""
    select s_suppkey, {half_up('''(s_acctbal - (select avg(s_acctbal) from supplier))
        / (select stddev_pop(s_acctbal) from supplier)''', 6)} as z
    from supplier""")
def zscore_overall(spark, sf_dir):
    """R01 without groups."""
    scored = scoring.zscores(table(spark, sf_dir, "supplier"), ["s_acctbal"])
    return scored.select("s_suppkey", F.round("s_acctbal_z", 6).alias("z"))


@query("estimated_volume", """
    select c_custkey,
           cast(greatest(round_even(coalesce(case when c_acctbal > 0 then c_acctbal end, 400.0::double)
                * 0.17::double, 0), 5.0::double) as bigint) as volume
    from customer""")
def estimated_volume(spark, sf_dir):
    """Volumes scaled from balances, with default and floor."""
    base = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", scoring.estimated_volume(base, 0.17).alias("volume"))


def _calibration_sql() -> str:
    """Running sums over all bends of a group, in one window."""
    clip = "greatest(least({}, 99.0::double), 2.0::double)"
    final = clip.format("v + coalesce(s, 0)")
    return f"""with {MODEL},
    cv as (select yr, entity_id, group_id, assessed, {clip.format('indicator * 1.6 - 20')} as v from view0),
    tg as (select group_id, target - 2.0::double as t from tgt, cal where yr = y1 and target is not null),
    cd as (
      select group_id, cast(v as decimal(24,8)) as v, sum(cast(assessed as decimal(20,6))) as w
      from cv where v is not null group by 1, 2),
    bend as (
      select group_id, 2 - v as p, w as d from cd union all select group_id, 99 - v, -w from cd),
    run as (
      select bend.group_id, p, d, t * cast(sum(case when d > 0 then d end) over (partition by bend.group_id) as double) as goal,
             max(p) over (partition by bend.group_id) as most,
             cast(sum(d) over o as double) as s, cast(sum(d * p) over o as double) as m,
             cast(coalesce(sum(d) over b, 0) as double) as s0, cast(coalesce(sum(d * p) over b, 0) as double) as m0
      from bend join tg using (group_id)
      window o as (partition by bend.group_id order by p, d rows between unbounded preceding and current row),
             b as (partition by bend.group_id order by p, d rows between unbounded preceding and 1 preceding)),
    hit as (
      select group_id, case when s0 > 0 then (goal + m0) / s0 else cast(p as double) end as s
      from run where s * cast(p as double) - m >= goal
      qualify row_number() over (partition by group_id order by p, d) = 1),
    sh as (select group_id, coalesce(max(hit.s), cast(max(most) as double)) as s from run left join hit using (group_id) group by 1)
    select yr, entity_id, group_id, {half_up(final, 3)} as calibrated,
           cast(round_even(assessed * {half_up(final, 3)} / 100.0::double, 0) as bigint) as successes
    from cv left join sh using (group_id)"""


@query("calibrate_group", _calibration_sql())
def calibrate_group(spark, sf_dir):
    """Stretched indicators calibrated to the group's last target."""
    rows, groups, targets = facts(spark, sf_dir)
    goal = targets.where(F.col("yr") == retail.calendar_of(groups).last)
    stretched = rows.withColumn("value", F.col("indicator") * 1.6 - 20)
    stretched = stage(stretched.select("yr", "entity_id", "group_id", "assessed", "value"), "stretched")
    out = calibrate_to_group_mean(stretched, goal.select("group_id", "target"), weight="assessed")
    out = out.withColumn("calibrated", F.round("calibrated", 3))
    return out.select(
        "yr", "entity_id", "group_id", "calibrated",
        scoring.success_count(F.col("assessed"), F.col("calibrated")).alias("successes"))


_DRAWS = """
w as (
  select o_custkey as key, count(*) as w from orders group by 1),
b as (
  select *, ('0x' || substr(sha256(cast(key as varchar)), 1, 8))::bigint % 4096 as bucket from w),
line as (
  select key, w, cast(sum(w) over (order by bucket, key) as bigint) - w as lo from b),
tot as (select cast(sum(w) as bigint) as total from w),
draws as (
  select cast(i as bigint) as draw,
         ('0x' || substr(sha256('42-' || cast(i as varchar)), 1, 15))::bigint % total as pos
  from tot, (select unnest(range(0, (select count(*) from orders))) as i))
"""


@query("weighted_sample", f"""
    with {_DRAWS}
    select draw, key as o_custkey from draws asof join line on pos >= lo""")
def weighted_sample(spark, sf_dir):
    """As many draws as orders, customers weighted by their orders."""
    orders = table(spark, sf_dir, "orders")
    weights = stage(orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("w")), "weights")
    n = weights.agg(F.sum("w")).head()[0]
    return sampling.weighted_sample(weights, "o_custkey", "w", n)
