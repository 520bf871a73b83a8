"""Runs registered queries against their SQL: ``python -m checks.compare [sf_dir] [key ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from checks.registry import QUERIES, SQL
from playlens.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns ordered by name, sorted, with plain values."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, bool) or v is None:
            return str(v)
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else repr(v)
        return repr(float(v)) if isinstance(v, int) and abs(v) < 2**53 else str(v)

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or list(QUERIES)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for key in wanted:
        started = time.time()
        df = QUERIES[key](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        took = time.time() - started
        if key not in SQL:
            print(f"{key:28s} {len(rows):7d} rows {took:6.2f}s  no SQL")
            continue
        result = con.execute(SQL[key])
        columns = [c[0] for c in result.description]
        expected = canonical(columns, result.fetchall())
        got = canonical(df.columns, rows)
        same_names = sorted(columns) == sorted(df.columns)
        verdict = "ok" if same_names and got == expected else "DIFFERENT"
        print(f"{key:28s} {len(rows):7d} rows {took:6.2f}s  {verdict}")
        if verdict != "ok":
            bad += 1
            print("   columns only here/there:", set(df.columns) ^ set(columns))
            print("   rows here/there:", len(got), len(expected))
            mine, theirs = set(got) - set(expected), set(expected) - set(got)
            print("   ", sorted(df.columns))
            print("    spark:", sorted(mine)[:2])
            print("    sql:  ", sorted(theirs)[:2])
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
