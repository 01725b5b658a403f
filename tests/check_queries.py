"""Compare every query with its SQL equivalent: python tests/check_queries.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float) and value != value:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value


def rows(frame: pd.DataFrame) -> list[str]:
    frame = frame[sorted(frame.columns)]
    return sorted(repr(tuple(plain(v) for v in row)) for row in frame.itertuples(index=False, name=None))


def compare(spark, con, sf_dir: str, name: str) -> tuple[str, float]:
    begin = time.perf_counter()
    df = entry.queries()[name](spark, sf_dir)
    got = df.toArrow()
    took = time.perf_counter() - begin
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows-only {got.num_rows}", took
    want = con.sql(sql).to_arrow_table()
    problems = []
    got_types = {f.name: str(f.type) for f in got.schema}
    want_types = {f.name: str(f.type) for f in want.schema}
    if got_types != want_types:
        diff = {k: (got_types.get(k), want_types.get(k)) for k in got_types | want_types
                if got_types.get(k) != want_types.get(k)}
        problems.append(f"types {diff}")
    if got.num_rows != want.num_rows:
        problems.append(f"rows {got.num_rows} != {want.num_rows}")
    if set(got_types) == set(want_types):
        a, b = rows(got.to_pandas()), rows(want.to_pandas())
        if a != b:
            sa, sb = set(a), set(b)
            problems.append(f"values: only spark {sorted(sa - sb)[:2]} only sql {sorted(sb - sa)[:2]} "
                            f"({len(sa - sb)}/{len(sb - sa)})")
    return ("ok " + str(got.num_rows)) if not problems else "; ".join(problems), took


def main() -> None:
    from pyspark.sql import SparkSession

    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or list(entry.queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        try:
            status, took = compare(spark, con, sf_dir, name)
        except Exception as err:
            status, took = f"ERROR {type(err).__name__}: {str(err)[:700]}", 0.0
        print(f"{name:28s} {took:6.2f}s {status}", flush=True)


if __name__ == "__main__":
    main()
