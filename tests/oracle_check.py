"""Compare catalogue queries with their SQL twins (also a script:
``python tests/oracle_check.py [folder] [query ...]``)."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows) if not rows else sorted(
        (tuple(_cell(row[i]) for i in order) for row in rows), key=repr
    )


def compare(df, con, sql: str) -> str | None:
    """None if equal, else a short description of the difference."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    expected = _rows(names, result.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            cols = sorted(names)
            return f"row differs: {[(c, x, y) for c, x, y in zip(cols, a, e) if x != y]} in {dict(zip(cols, a))}"
        if [type(x) for x in a] != [type(x) for x in e]:
            return f"types differ: {[(c, type(x), type(y)) for c, x, y in zip(sorted(names), a, e) if type(x) is not type(y)]}"
    return None


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pulseledger import catalog
    from pulseledger.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session()
    con = duckdb_tables(sf_dir)
    failures = 0
    for name, query in catalog.QUERIES.items():
        if args[1:] and name not in args[1:]:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            sql = query.sql()
            problem = f"no SQL, {len(df.collect())} rows" if sql is None else compare(df, con, sql)
            n = len(con.execute(sql).fetchall()) if sql else 0
        except Exception as error:  # report and go on with the next query
            problem, n = f"{type(error).__name__}: {str(error)[:300]}", 0
        failures += problem is not None and not problem.startswith("no SQL")
        print(f"\n{'ok  ' if problem is None else 'DIFF'} {name:32s} {n:7d} rows {time.time() - start:6.2f}s  {problem or ''}", flush=True)
    print("failures:", failures)


if __name__ == "__main__":
    main()
