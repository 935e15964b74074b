"""Run a Spark query and its SQL side by side and report the first difference."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _kind(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    if isinstance(v, float):
        return "float"
    return type(v).__name__


def _sort_key(row):
    return tuple("" if v is None else (f"{v:.6g}" if isinstance(v, float) else str(v)) for v in row)


def difference(df, con, sql: str) -> str | None:
    """None if rows, columns and values agree exactly, else a short description."""
    names = sorted(df.columns)
    left = [tuple(r[n] for n in names) for r in df.collect()]
    cursor = con.execute(sql)
    order = [d[0] for d in cursor.description]
    if sorted(order) != names:
        return f"columns {names} != {sorted(order)}"
    at = [order.index(n) for n in names]
    right = [tuple(r[i] for i in at) for r in cursor.fetchall()]
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    left.sort(key=_sort_key)
    right.sort(key=_sort_key)
    kinds: dict[str, set] = {}
    bad = 0
    first = None
    for a, b in zip(left, right):
        for n, x, y in zip(names, a, b):
            kx, ky = _kind(x), _kind(y)
            if kx != "null" and ky != "null" and kx != ky:
                kinds.setdefault(n, set()).add((kx, ky))
            same = x == y or (
                isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y)
            )
            if not same:
                bad += 1
                first = first or f"{n}: {x!r} != {y!r} in {a} / {b}"
    if kinds:
        return f"types differ {kinds}; {first}"
    return f"{bad} cells differ, first {first}" if bad else None
