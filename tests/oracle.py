"""Compares a query with its SQL on the same files, row for row. Run as a script for a summary."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, int):
        return repr(float(value))
    return str(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str:
    """Empty when equal, else what differs."""
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = rows_of(want_columns, result.fetchall())
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(want_columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(want_columns)}"
    if got != want:
        extra, lost = got - want, want - got
        return (
            f"{sum(got.values())} rows instead of {sum(want.values())}; extra {list(extra)[:2]}; missing {list(lost)[:2]}"
        )[:900]
    if not want:
        return "both are empty"
    return ""


def main() -> None:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    from corpuslens.session import SESSION_CONF

    sf = sys.argv[1]
    names = sys.argv[2:]
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false"
    )
    for key, value in {**SESSION_CONF, "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                       "spark.checkpoint.dir": tempfile.mkdtemp(prefix="oracle-")}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(queries):
        start = time.time()
        try:
            df = queries[name](spark, sf)
            note = compare(df, con, oracle[name]) if name in oracle else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            note = f"{type(error).__name__}: {str(error)[:700]}"
        failed = bool(note) and not note.startswith("rows only")
        bad += failed
        print(f"{'FAIL' if failed else 'ok  '} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{bad} of {len(names or queries)} failed, {len(set(oracle) & set(queries))} with SQL")


if __name__ == "__main__":
    main()
