"""Compare registered queries with their SQL oracles on the same tables.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    """One spelling per value; floats keep every digit."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, bool):
        return f"bool {value}"
    if isinstance(value, int):
        return f"int {value}"
    if isinstance(value, float):
        return f"float {value!r}"
    return f"{type(value).__name__} {value}"


def table(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both results hold the same rows, else what differs."""
    ours = table(df.columns, df.collect())
    result = con.execute(sql)
    theirs = table([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}"
    wrong = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> None:
    from __spark_entry__ import oracle_sql, queries
    from skyledger.session import local_session

    spark = local_session(8)
    con, oracles, failed = connect(sf_dir), oracle_sql(), []
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        try:
            found = difference(query(spark, sf_dir), con, oracles[name]) if name in oracles else "no oracle"
        except Exception as error:  # report and go on with the next query
            found = f"error {str(error)[:700]}"
        print(f"{name:34s} {time.perf_counter() - start:6.2f}s {found or 'ok'}", flush=True)
        if found not in (None, "no oracle"):
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main(*sys.argv[1:])
