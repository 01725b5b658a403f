"""The supplied order tables read as the canonical model.

Group = nation, entity = customer, year = order year, assessed = orders of a
customer in a year, success = an order of at least 250000, context = account
balance. "Published" is the nation's indicator rounded to a whole percent and
missing for some (year, nation). Targets run from the first year of the orders to 80 seven
years later and stay there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import columns as c
from terrace.functions.text import standardize_name
from terrace.operators import targets as t
from terrace.operators.enrich import enrich
from terrace.sources.schemas import SCHEMAS

SUCCESS_PRICE = 250000
GOAL_AFTER = 7      # years from the first one
GOAL = 80.0
MICRO_CUTOFF = 25
SIZE_EDGES = (2000, 6000)
SIZE_LABELS = ("SMALL", "MEDIUM", "LARGE")


@dataclass(frozen=True)
class Calendar:
    """The years that the orders cover, and the year of the goal."""

    first: int
    last: int

    @property
    def goal(self) -> int:
        return self.first + GOAL_AFTER

    @property
    def end(self) -> int:
        """Last year of all tables by year: no observed year is left out."""
        return max(self.last, self.goal)


def calendar_of(groups: DataFrame) -> Calendar:
    """Two numbers from one aggregate over the stored ``group_years``."""
    first, last = groups.agg(F.min("yr"), F.max("yr")).first()
    if first is None:
        raise ValueError("the orders hold no year")
    return Calendar(first, last)


# Reads a named input table, from the supplied files or from a bronze layer.
Read = Callable[[str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table; a known schema spares the inference job."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def supplied(spark: SparkSession, sf_dir: str) -> Read:
    """Reader of the supplied files."""
    return partial(table, spark, sf_dir)


def dim_group(read: Read) -> DataFrame:
    """Nations under standardised names, with their region's code."""
    nation, region = read("nation"), read("region")
    joined = enrich(nation, region, {"n_regionkey": "r_regionkey"}, ["r_name"])
    return joined.select(
        F.col("n_nationkey").cast("long").alias("group_id"),
        standardize_name(F.col("n_name")).alias("group_name"),
        c.canonical_code(F.col("r_name")).alias("region"),
    )


def dim_entity(read: Read) -> DataFrame:
    """Customers with group attributes, size class and availability flag."""
    customer = read("customer").select(
        F.col("c_custkey").alias("entity_id"), standardize_name(F.col("c_name")).alias("entity_name"),
        F.col("c_nationkey").cast("long").alias("group_id"),
        F.col("c_acctbal").alias("context"))
    joined = enrich(customer, dim_group(read), "group_id", ["group_name", "region"])
    return joined.withColumns({
        "context_available": c.available(F.col("context")),
        "size_class": c.band(F.col("context"), SIZE_EDGES, SIZE_LABELS),
    })


def entity_years(read: Read) -> DataFrame:
    """Orders condensed to (year, customer) with the customer's nation.

    The one pass over the orders: sums are combined before the shuffle, and
    customers meet condensed rows instead of orders. Everything else derives
    from this table, so callers store it.
    """
    condensed = read("orders").groupBy(
        F.year("o_orderdate").cast("long").alias("yr"), F.col("o_custkey").alias("entity_id"),
    ).agg(
        F.count(F.lit(1)).alias("assessed"),
        F.count_if(F.col("o_totalprice") >= SUCCESS_PRICE).alias("successes"),
    )
    keys = read("customer").select(
        F.col("c_custkey").alias("entity_id"), F.col("c_nationkey").cast("long").alias("group_id"))
    return condensed.join(keys, "entity_id", "left")


def group_years(entities: DataFrame) -> DataFrame:
    """(year, nation) totals with the computed and the published indicator."""
    totals = entities.where(F.col("group_id").isNotNull()).groupBy("yr", "group_id").agg(
        F.sum("assessed").alias("assessed"), F.sum("successes").alias("successes"))
    collected = F.pmod(F.col("yr") + F.col("group_id"), F.lit(9)) != 0
    return totals.select(
        "yr", "group_id", "assessed", "successes",
        c.pct(F.col("successes"), F.col("assessed")).alias("computed"),
        F.when(collected, c.pct(F.col("successes"), F.col("assessed"), 0)).alias("published"),
    )


def national_years(groups: DataFrame) -> DataFrame:
    """Yearly totals over all groups with the computed indicator."""
    return groups.groupBy("yr").agg(
        F.sum("assessed").alias("assessed"), F.sum("successes").alias("successes"),
    ).withColumn("computed", c.pct(F.col("successes"), F.col("assessed")))


def targets_of(read: Read, groups: DataFrame) -> DataFrame:
    """(year, group) targets; ``groups`` is the staged ``group_years``."""
    names, years = dim_group(read), calendar_of(groups)
    base = t.baselines(names, groups, national_years(groups), years.first)
    return t.group_targets(base, years.first, years.goal, GOAL, last_year=years.end)


def published_of(groups: DataFrame, targets: DataFrame) -> DataFrame:
    """Group fact with target, published value, availability and gap."""
    targets = targets.select("yr", "group_id", "target")
    joined = targets.join(groups.select("yr", "group_id", "published"), ["yr", "group_id"], "left")
    return joined.withColumns({
        "available": c.available(F.col("published")),
        "published_gap": c.gap(F.col("published"), F.col("target")),
    })


def entity_fact(entities: DataFrame, targets: DataFrame) -> DataFrame:
    """Entity-year fact with indicator, the group's target and the gap."""
    fact = entities.join(targets.select("yr", "group_id", "target"), ["yr", "group_id"], "left")
    return fact.select(
        "yr", "entity_id", "assessed",
        c.capped(F.col("successes"), F.col("assessed")).alias("successes"),
        c.pct(F.col("successes"), F.col("assessed")).alias("indicator"),
        "target",
    ).withColumn("gap", c.gap(F.col("indicator"), F.col("target")))


def micro_fact(read: Read) -> DataFrame:
    """Line items with codes cleaned, impossible scores nulled and the cut-off flag.

    Quantity 50 is taken as "no result" and quantities 1 and 2 as impossible,
    so that the cleaning has something to do on the supplied rows.
    """
    score = F.when(F.col("l_quantity") <= 2, -F.col("l_quantity")).when(
        F.col("l_quantity") < 50, F.col("l_quantity"))
    items = read("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").cast("long").alias("line"),
        F.year("l_shipdate").cast("long").alias("yr"),
        c.canonical_code(F.concat(F.lit(" "), F.lower("l_returnflag"))).alias("returnflag"),
        c.canonical_code(F.col("l_linestatus")).alias("linestatus"),
        c.null_if_below(score).alias("score"),
    )
    return items.withColumn("passed", c.cutoff_flag(F.col("score"), MICRO_CUTOFF).cast("long"))


def national_fact(groups: DataFrame) -> DataFrame:
    """National targets of all years up to the goal year or the last one, with the published value where there is one.

    The published value is the whole-percent national indicator, missing every fourth year.
    """
    national = national_years(groups)
    calendar = calendar_of(groups)
    base = t.national_value(national, calendar.first)
    known = national.select(
        "yr",
        F.when(F.col("yr") % 4 != 0, F.round("computed", 0)).alias("published"))
    years = groups.sparkSession.range(calendar.first, calendar.end + 1).select(F.col("id").alias("yr"))
    years = years.withColumn("__base", base)
    target = t.trajectory(F.col("__base"), F.col("yr"), calendar.first, calendar.goal, GOAL)
    return (
        years.withColumn("target", F.when(F.col("yr") > calendar.first, target))
        .join(known, "yr", "left")
        .select("yr", "target", "published",
                c.available(F.col("published")).alias("available"),
                c.gap(F.col("published"), F.col("target")).alias("published_gap"))
    )
