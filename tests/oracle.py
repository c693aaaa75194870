"""Side-by-side comparison of registered queries with their SQL in DuckDB."""

from __future__ import annotations

import math
from datetime import datetime, timezone
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, datetime):
        return value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return (type(value).__name__, value) if isinstance(value, bool) else value


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(df, con, sql) -> str | None:
    """None if both sides agree, else what differs."""
    relation = con.sql(sql)
    names = list(relation.columns)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expected = canon(relation.fetchall(), names)
    actual = canon([tuple(r) for r in df.collect()], df.columns)
    if len(expected) != len(actual):
        return f"{len(actual)} rows, expected {len(expected)}"
    for left, right in zip(actual, expected):
        if left != right:
            return f"{left} != {right}"
    return None
