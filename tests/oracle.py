"""Compare a query with its SQL on the tables of a folder."""

from __future__ import annotations

import math
import os

import duckdb

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connection(sf_dir: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def rows_of(df) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, [tuple(plain(r[c]) for c in columns) for r in df.collect()]


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = [names.index(c) for c in sorted(names)]
    return sorted(names), [tuple(plain(r[i]) for i in order) for r in cur.fetchall()]


def same(a: list[tuple], b: list[tuple]) -> bool:
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return [tuple(map(str, r)) for r in sorted(a, key=key)] == [tuple(map(str, r)) for r in sorted(b, key=key)]
