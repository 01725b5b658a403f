"""Tables about tables: manifest and data dictionary."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_manifest(
    tables: Mapping[str, DataFrame], provenance: Mapping[str, str] | None = None, seed: int | None = None,
    made_at: datetime | None = None,
) -> DataFrame:
    """Row count, column list and provenance per table, the seed it was drawn with, and when the manifest was made."""
    provenance = provenance or {}
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows",
            F.lit(", ".join(df.columns)).alias("columns"),
            F.lit(provenance.get(name, "SUPPLIED")).alias("provenance"), F.lit(seed).cast("long").alias("seed"),
            (F.current_timestamp() if made_at is None else F.lit(made_at)).cast("timestamp").alias("made_at"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def data_dictionary(
    tables: Mapping[str, DataFrame], layer: str = "source",
    descriptions: Mapping[tuple[str, str], str] | None = None,
) -> DataFrame:
    """One row per column with type and description, beside the table's row count.

    Types come from the schemas; the only work on the data is one count per table.
    """
    descriptions = descriptions or {}
    parts = []
    for name, df in tables.items():
        fields = F.array(*[
            F.struct(
                F.lit(i + 1).cast("int").alias("position"), F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(descriptions.get((name, f.name), "")).alias("description"))
            for i, f in enumerate(df.schema.fields)
        ])
        counted = df.agg(F.count(F.lit(1)).alias("rows"))
        parts.append(counted.select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "rows",
            F.inline(fields)))
    return reduce(DataFrame.unionByName, parts)
