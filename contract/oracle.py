"""Assembles one DuckDB statement per contract query from named building blocks."""

from __future__ import annotations

import re

from contract.oracle_tables import TABLES
from contract.oracle_views import VIEWS

BLOCKS = {**TABLES, **VIEWS}
_WORDS = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def with_blocks(sql: str) -> str:
    """Prefix ``sql`` with the blocks it needs, in definition order."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        for word in set(_WORDS.findall(todo.pop())):
            if word in BLOCKS and word not in needed:
                needed.add(word)
                todo.append(BLOCKS[word])
    parts = [f"{name} AS MATERIALIZED ({BLOCKS[name]})" for name in BLOCKS if name in needed]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql
