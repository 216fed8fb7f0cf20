"""Run a query in both engines and compare the rows, whatever their order."""

from __future__ import annotations

import datetime
import decimal

import duckdb

from checks.views import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree, else what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(set(df.columns) ^ set(columns))}"
    ours, theirs = _rows(df.columns, df.collect()), _rows(columns, result.fetchall())
    if ours == theirs:
        return None
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    first = next((a, b) for a, b in zip(ours, theirs) if a != b)
    at = [(sorted(columns)[i], x, y) for i, (x, y) in enumerate(zip(*first)) if x != y]
    return f"{sum(a != b for a, b in zip(ours, theirs))} of {len(ours)} rows differ, first: {at}"
