"""Run registered queries beside their oracle SQL: rows, columns and values must agree."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        path = path + "/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both agree, else what differs."""
    got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if got != want:
        odd = [(a, b) for a, b in zip(got, want) if a != b][:2]
        return f"{len(got)} and {len(want)} rows; first differences {odd}"
    return ""
