"""Run a catalog entry on Spark and its SQL on DuckDB and compare the results.

    python tests/oracle.py [scale folder] [key ...]

SPARK_SETTINGS may hold further settings, as key=value separated by blanks.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    columns = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in columns]).collect()
    return columns, Counter(tuple(map(_value, r)) for r in rows)


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = result.fetchall()
    return [names[i] for i in order], Counter(tuple(_value(r[i]) for i in order) for r in rows)


def _value(v: object) -> object:
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    # 1 and 1.0 are different results, but equal in Python
    return (type(v).__name__, v)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both results agree, else what differs first."""
    columns, got = spark_rows(df)
    expected_columns, expected = sql_rows(con, sql)
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if got == expected:
        return "" if got else "no rows"
    extra, missing = list((got - expected).items())[:3], list((expected - got).items())[:3]
    return (
        f"{sum(got.values())} rows vs {sum(expected.values())}; "
        f"only Spark: {extra}; only SQL: {missing}"
    )


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from ledgerline.catalog.registry import ENTRIES as entries
    from ledgerline.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(entries)
    settings = {
        "spark.master": "local[8]",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    for pair in os.environ.get("SPARK_SETTINGS", "").split():
        name, _, value = pair.partition("=")
        settings[name] = value
    spark = build_session(**settings)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for key in keys:
        start = time.time()
        try:
            df, sql = entries[key](spark, folder), entries[key].sql
            if sql is None:
                found = "" if df.count() else "no rows"
            else:
                found = differences(df, con, sql)
        except Exception as e:  # noqa: BLE001
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += bool(found)
        print(f"{key:32} {time.time() - start:6.2f}s {'FAIL ' + found if found else 'ok'}", flush=True)
    print(f"{len(keys) - failed} of {len(keys)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
