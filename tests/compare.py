"""Runs queries and their SQL twins side by side: python tests/compare.py [sf] [query ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_value(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def difference(spark_frame, connection, sql):
    """None when equal, otherwise a short account."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(spark_frame.columns):
        return f"columns {sorted(spark_frame.columns)} and {sorted(names)}"
    actual = rows_of(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows and {len(expected)}"
    if not actual:
        return "no rows"
    for a, e in zip(actual, expected):
        if a != e or [type(v) for v in a] != [type(v) for v in e]:
            return f"{a} and {e}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as contract

    from adlake.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("compare", "local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle = connect(sf_dir), contract.oracle_sql()
    failed = 0
    for name, run in contract.queries().items():
        if name not in oracle or len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            problem = difference(run(spark, sf_dir), connection, oracle[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - started:6.1f}s {name} {problem or ''}", flush=True)
    print("failed:", failed)
