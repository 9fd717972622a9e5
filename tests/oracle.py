"""Compares queries with their SQL counterparts, which DuckDB runs on the same files."""

from __future__ import annotations

import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    found = duckdb.connect()
    for t in TABLES:
        found.sql(f"CREATE VIEW {t} AS FROM '{sf_dir}/{t}.parquet'")
    return found


def _plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6) + 0.0
    if isinstance(x, bool) or x is None or isinstance(x, (int, str)):
        return x
    if isinstance(x, (list, tuple)):
        return [_plain(y) for y in x]
    return str(x)


def rows(columns: list[str], found) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in found), key=repr)


def compare(df, connection, sql: str) -> str:
    """Empty if both have the same columns and rows, else what differs."""
    expected = connection.sql(sql)
    if sorted(df.columns) != sorted(expected.columns):
        return f"columns {sorted(df.columns)} and {sorted(expected.columns)}"
    a, b = rows(df.columns, [tuple(r) for r in df.collect()]), rows(expected.columns, expected.fetchall())
    if a == b:
        return ""
    return f"{len(a)} and {len(b)} rows; " + "; ".join(f"{x} / {y}" for x, y in [(x, y) for x, y in zip(a, b) if x != y][:2])
