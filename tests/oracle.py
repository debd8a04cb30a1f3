"""Run registered queries beside their SQL on the same parquet files.

``python tests/oracle.py [sf] [name-part ...]`` prints one line per query.
"""

from __future__ import annotations

import decimal
import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None if the query and the SQL give the same columns and rows."""
    df = query(spark, sf_dir)
    columns, rows = normal(df.columns, [tuple(r) for r in df.collect()])
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    want_columns, want = normal(names, relation.fetchall())
    if columns != want_columns:
        return f"{name}: columns {columns} != {want_columns}"
    if len(rows) != len(want):
        return f"{name}: {len(rows)} rows, expected {len(want)}"
    for got, expected in zip(rows, want):
        if got != expected or [type(g) for g in got] != [type(e) for e in expected]:
            return f"{name}: {got} != {expected}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from ledgerloom.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.perf_counter()
        try:
            if name in sql:
                problem = compare(spark, con, name, query, sql[name], sf_dir)
            else:
                problem = None if query(spark, sf_dir).count() else f"{name}: no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{name}: {type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.perf_counter() - start:6.2f}s {problem or name}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
