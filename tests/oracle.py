"""Compare a query with its reference SQL run by DuckDB on the same files."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def normal(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(name: str, df, con, sql: str) -> list[str]:
    """Differences as text; empty if columns, types and rows agree."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    problems = []
    if sorted(columns) != sorted(df.columns):
        return [f"{name}: columns {sorted(df.columns)} vs {sorted(columns)}"]
    actual = [tuple(r) for r in df.collect()]
    if len(actual) != len(expected):
        problems.append(f"{name}: {len(actual)} rows vs {len(expected)}")
    a, e = normal(df.columns, actual), normal(columns, expected)
    if a != e:
        only_a, only_e = sorted(set(a) - set(e))[:3], sorted(set(e) - set(a))[:3]
        problems.append(f"{name}: values differ\n  columns {sorted(columns)}\n  spark {only_a}\n  sql   {only_e}")
    return problems
