"""Rows of a query and of its SQL twin in a form that can be compared."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    """Floats to nine digits; nested values as tuples."""
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return str(value) if hasattr(value, "isoformat") else value


def spark_rows(df) -> tuple[list[str], list[str]]:
    columns = sorted(df.columns)
    return columns, sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())


def sql_rows(con, sql: str) -> tuple[list[str], list[str]]:
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(repr(tuple(plain(r[i]) for i in order)) for r in found.fetchall())
