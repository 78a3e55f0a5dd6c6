"""Run a query and its SQL twin over the same tables and compare rows as sets with counts."""

from __future__ import annotations

import datetime
import decimal
import os
from collections import Counter
from pathlib import Path

import duckdb

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")


def connect(data: str = DATA):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in sorted(Path(data).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return repr(v) if isinstance(v, float) else str(v)


def table_of(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def both(spark, con, query, sql: str, data: str = DATA):
    df = query(spark, data)
    got = table_of(df.columns, df.collect())
    con.execute(sql)
    columns = [c[0] for c in con.description]
    return got, table_of(columns, con.fetchall())
