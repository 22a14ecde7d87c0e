"""Compare a query's rows with what DuckDB returns for its SQL."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{base}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got = Counter(tuple(row[n] for n in sorted(names)) for row in df.collect())
    index = [names.index(n) for n in sorted(names)]
    want = Counter(tuple(row[i] for i in index) for row in want_rows)
    if got != want:
        return f"rows {sum(got.values())} vs {sum(want.values())}; extra {list((got - want).items())[:2]}; missing {list((want - got).items())[:2]}"
    return None
