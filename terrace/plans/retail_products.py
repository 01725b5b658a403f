"""The products of the retail model (G08-G13): their columns, and the operators they are made of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions import columns as c
from terrace.operators import products as p
from terrace.operators.enrich import enrich, prefer_published
from terrace.operators.ranking import SPLIT_ABOVE, rank_extremes
from terrace.sources.staging import stage

# Edges and names of the bands, names of the quarters.
BANDS = ((40, "CRITICAL"), (60, "ATTENTION"), (80, "ADEQUATE"), (None, "ADVANCED"))
QUARTERS = {1: "1 - lowest", 2: "2 - lower middle", 3: "3 - upper middle"}
LAST_QUARTER = "4 - highest"

# What each column of the entity view is computed from.
DERIVED = {
    "indicator": ("successes", "assessed"), "gap": ("indicator", "target"), "shortfall": ("assessed", "successes"),
    "group_indicator": ("successes", "assessed"), "status": ("indicator", "target"), "band": ("indicator",),
    "rank_all": ("indicator",), "rank_group": ("indicator",),
}
DIMENSION = ("entity_name", "group_id", "group_name", "region", "context", "size_class", "context_available")
VOLUMES = ("assessed", "successes")


def entity_facts(fact: DataFrame, dim: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """G08 without ranks."""
    edges, names = [e for e, _ in BANDS if e is not None], [n for _, n in BANDS]
    return enrich(fact, dim, "entity_id", DIMENSION, how="inner").select(
        "*", c.target_status(F.col("indicator"), F.col("target"), tolerance).alias("status"),
        c.band(F.col("indicator"), edges, names, null_is_last=True).alias("band"),
        (F.col("assessed") - F.col("successes")).alias("shortfall"))


def ranked_view(facts: DataFrame, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """Ranks among all entities of a year and inside the group."""
    return p.ranked_twice(facts, ["yr"], ["yr", "group_id"], "indicator", "entity_id", split_above=split_above)


def target_vs_actual(view: DataFrame, published: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """G09; ``published`` holds (yr, group_id, published, target) and may lack a group."""
    per_group = p.totals(
        view, ["yr", "group_id", "group_name", "region"], VOLUMES, means={"context_mean": ("context", 3)},
        counts={"entities": F.lit(True), "entities_below": F.col("status") == "BELOW"})
    both = p.reconciled(prefer_published(per_group, published, ["yr", "group_id"]), "successes", "assessed",
                        "published", "target")
    return both.select("*", c.gap(F.col("computed"), F.col("published"), 2).alias("divergence"),
                       c.gap_status(F.col("gap"), tolerance).alias("status"))


def national_evolution(national: DataFrame, view: DataFrame, goal: float = 80.0) -> DataFrame:
    """A row per year of ``national`` (yr, target, published), also without actuals."""
    actual = p.totals(view, ["yr"], VOLUMES, distinct={"entities": "entity_id"})
    both = p.reconciled(national.join(actual, "yr", "left"), "successes", "assessed", "published", "target")
    return p.change_on_previous(both, "indicator", "yr").withColumn(
        "distance_to_goal", c.gap(F.lit(float(goal)), F.col("indicator")))


def inequality_panel(view: DataFrame) -> DataFrame:
    """Region by quarter of the year's entities along the context; ``view`` is a stored table."""
    needed = view.select("yr", "region", "entity_id", "context", "indicator", "assessed", "shortfall")
    quarters = p.tiled(needed, ["yr"], "context", "entity_id", 4, "quartile", QUARTERS, LAST_QUARTER)
    return p.totals(
        stage(quarters, "quarters"), ["yr", "region", "quartile", "quartile_label"], ["assessed", "shortfall"],
        means={"indicator_mean": ("indicator", 1), "context_mean": ("context", 3)},
        medians={"indicator_median": ("indicator", 1)}, counts={"entities": F.lit(True)})


def ranking(view: DataFrame, k: int = 100) -> DataFrame:
    """Best and worst ``k`` entities of every year."""
    return rank_extremes(view, k).select(
        "yr", "side", "rank_all", "rank_group", "entity_id", "entity_name", "group_name",
        "region", "indicator", "target", "gap", "status", "assessed", "context", "size_class")


def features(
    view: DataFrame, context: Sequence[str] = ("context", "size_class"), gap_aware: bool = False,
) -> DataFrame:
    """The label and what is known before its year."""
    earlier = p.lags(
        view, "entity_id", "yr",
        {"indicator_lag1": ("indicator", 1), "__lag2": ("indicator", 2), "assessed_lag1": ("assessed", 1)},
        {"change_lag1": ("indicator_lag1", "__lag2")}, gap_aware)
    out = earlier.select(
        "yr", "entity_id", "entity_name", "group_name", "region", F.col("indicator").alias("label"),
        "indicator_lag1", "assessed_lag1", "change_lag1", F.col("target").alias("agreed_target"), *context)
    return c.refuse_columns(out, sorted(p.known_with("indicator", DERIVED)))
