"""Runs registered queries next to their check queries and reports differences.

``python tests/check_oracles.py [folder] [query ...]``
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from cardrail.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents".split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, folder):
    """Differences between a query and its check query as a text; empty when they agree."""
    df = entry.queries()[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return "" if got else "no rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(set(columns) ^ set(df.columns))}"
    if got != want:
        odd = [(g, w) for g, w in zip(got, want) if g != w][:2]
        return f"{len(got)} rows for {len(want)}; {odd}"
    return ""


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("oracles", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = []
    for name in sys.argv[2:] or list(entry.queries()):
        start = time.time()
        try:
            report = compare(spark, con, name, folder)
        except Exception as error:
            report = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if not report else 'FAIL'} {name} {time.time() - start:.1f}s {report}", flush=True)
        failed += [name] if report else []
    print("failed:", failed)
