"""Run a registered query and its SQL and compare the results as multisets of rows."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, Decimal):
        return f"{value:f}"
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, folder: str, query, sql: str, con=None) -> tuple[int, str]:
    """Row count and an empty string, or what differs."""
    df = query(spark, folder)
    got_columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = (con or duck(folder)).execute(sql)
    want_columns, want = _rows([d[0] for d in result.description], result.fetchall())
    rows = sum(got.values())
    if got_columns != want_columns:
        return rows, f"columns {got_columns} != {want_columns}"
    if got != want:
        extra, missing = got - want, want - got
        return rows, (
            f"rows {rows} vs {sum(want.values())}; only here {sum(extra.values())} {list(extra)[:2]}; "
            f"only in SQL {sum(missing.values())} {list(missing)[:2]}"
        )
    return rows, ""
