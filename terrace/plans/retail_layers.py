"""The retail model run layer by layer: CSV to bronze, silver and gold."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from terrace.operators.contracts import load_contracts
from terrace.operators.dedup import current_versions
from terrace.operators.lineage import ORIGIN, drop_technical
from terrace.plans import retail
from terrace.plans import retail_products as products
from terrace.plans.layers import YEAR, Lakehouse
from terrace.plans.retail_stream import run_stream
from terrace.sources.schemas import SCHEMAS
from terrace.sources.staging import freed
from terrace.streaming import events as ev

CONTRACTS = Path(__file__).parent / "contracts"

# Key of every ingested table. Order lines have no business key under which the supplied rows
# are unique: only rows that agree in everything are versions of each other.
KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
    "orders": ["o_orderkey"], "part": ["p_partkey"], "lineitem": ["row_hash"],
}
LAYERS = ("bronze", "silver", "gold")
STAGES = (*LAYERS, "stream")

# Tables that bronze also parts by the year of a date, inside the day of arrival.
YEAR_OF = {"orders": "o_orderdate", "lineitem": "l_shipdate"}


def lakehouse(spark: SparkSession, root: str, **options) -> Lakehouse:
    """A lakehouse at ``root`` under the shipped contracts (Q18, Q19)."""
    contracts = {layer: load_contracts(CONTRACTS / f"{layer}.yml") for layer in LAYERS}
    return Lakehouse(spark, root, contracts, **options)


def run_bronze(lake: Lakehouse, landing: str, names: Sequence[str] = tuple(KEYS)) -> None:
    """CSV files ``<landing>/<table>.csv`` to bronze."""
    lake.together(*[
        partial(lake.ingest, name, f"{landing}/{name}.csv", SCHEMAS[name], "RETAIL", year_of=YEAR_OF.get(name))
        for name in names
    ])


def current(lake: Lakehouse, name: str) -> DataFrame:
    """Latest version of every business key in a bronze table."""
    bronze = lake.read("bronze", name)
    bronze = bronze.select("*", bronze[ORIGIN]["at"].alias("arrived"), bronze[ORIGIN]["row_hash"].alias("row_hash"))
    latest = current_versions(bronze, KEYS[name], "arrived", ["row_hash"])
    return drop_technical(latest, "arrived", "row_hash", YEAR)


def publish_micro(lake: Lakehouse) -> DataFrame:
    """The order-line fact under its contract; bronze keeps the lines by its year, so they are not shuffled for it again."""
    lines = retail.micro_fact(lambda name: current(lake, name))
    return lake.publish(lines, "silver", "fact_micro", {"part": current(lake, "part")}, partition_by=["yr"], cluster=False)


def run_dimensions(lake: Lakehouse) -> tuple[DataFrame, DataFrame]:
    """Nations, then customers, whose nation must be known."""
    read = partial(current, lake)
    nations = lake.publish(retail.dim_group(read), "silver", "dim_group")
    return nations, lake.publish(retail.dim_entity(read), "silver", "dim_entity", {"dim_group": nations})


def run_silver(lake: Lakehouse) -> None:
    """Bronze to dimensions and facts; later facts check their keys against the dimensions."""

    def read(name: str) -> DataFrame:
        return current(lake, name)

    def totals_and_targets():
        years = lake.publish(retail.entity_years(read), "silver", "entity_years")
        totals = lake.publish(retail.group_years(years), "silver", "group_years")
        return years, totals, lake.publish(retail.targets_of(read, totals), "silver", "group_targets")

    (nations, entities), (years, totals, targets), _ = lake.together(
        partial(run_dimensions, lake), totals_and_targets, lambda: publish_micro(lake))
    lake.together(
        lambda: lake.publish(retail.national_fact(totals), "silver", "fact_national"),
        lambda: lake.publish(retail.published_of(totals, targets), "silver", "fact_group",
                             {"dim_group": nations}),
        lambda: lake.publish(retail.entity_fact(years, targets), "silver", "fact_indicator",
                             {"dim_entity": entities}, partition_by=["yr"]),
    )


def run_gold(lake: Lakehouse, k: int = 100) -> None:
    """Silver to products; the entity view is stored once and feeds the others."""
    view = products.ranked_view(products.entity_facts(
        lake.read("silver", "fact_indicator"), lake.read("silver", "dim_entity")))
    view = lake.publish(view, "gold", "entity_view", partition_by=["yr"])
    view = view.withColumn("yr", view["yr"].cast("long"))
    published = lake.read("silver", "fact_group").select("yr", "group_id", "published", "target")
    national = lake.read("silver", "fact_national").select("yr", "target", "published")
    lake.together(
        lambda: lake.publish(products.target_vs_actual(view, published), "gold", "target_vs_actual"),
        lambda: lake.publish(products.national_evolution(national, view, retail.GOAL), "gold",
                             "national_evolution"),
        lambda: lake.publish(products.inequality_panel(view), "gold", "inequality_panel"),
        lambda: lake.publish(products.ranking(view, k), "gold", "ranking"),
        lambda: lake.publish(products.features(view), "gold", "features"),
    )


def run_batch(lake: Lakehouse, landing: str, stages: Sequence[str]) -> None:
    """The layers of the tables, one after the other."""
    if "bronze" in stages:
        run_bronze(lake, landing)
    with freed(lake.spark):
        if "silver" in stages:
            run_silver(lake)
        if "gold" in stages:
            run_gold(lake)


def run_events(lake: Lakehouse, landing: str) -> None:
    """The event lines that have arrived, through the tiers of the stream."""
    lines = ev.text_stream(lake.spark, f"{landing}/events")
    run_stream(lake, ev.stamped(lines, "file", lake.log.run_id))


def run(lake: Lakehouse, landing: str, stages: Sequence[str] = STAGES, reprocess: bool = False) -> None:
    """The chosen stages, the tables' layers in order and the stream beside them; the log is saved whatever happens."""
    if reprocess:
        lake.reset()
    jobs = [lambda: run_batch(lake, landing, stages)]
    if "stream" in stages:
        jobs.append(lambda: run_events(lake, landing))
    try:
        lake.together(*jobs)
    finally:
        lake.save_log()
