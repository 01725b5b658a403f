"""Column helpers shared by the corpus operators.

Every operator takes the columns it is told to read, ignores all others (so an
extra column may have any name) and treats a null text as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_words(text: Column, gap: str = BLANK_RUN, edge: str = BLANKS) -> Column:
    """Maximal runs of characters outside ``gap``; ``edge`` lists the characters of ``gap``."""
    inner = F.trim(text, F.lit(edge))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, gap, -1))


def row_hash(text: Column) -> Column:
    """Tells rows apart that share an id but not a text."""
    return F.xxhash64(text)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500, size: str = "4m") -> Iterator[None]:
    """Smaller Arrow batches for what runs inside, for texts of any length."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
              "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
