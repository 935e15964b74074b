"""Joins through code lists and code maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def list_members(df: DataFrame, key: str, members: str, out: str) -> DataFrame:
    """``"B, C,D"`` -> one (key, member) row per member."""
    parts = F.split(F.replace(F.col(members), F.lit(" "), F.lit("")), ",")
    return df.select(key, F.explode(parts).alias(out))


def totals_by_list(
    lists: DataFrame, key: str, members: str, facts: DataFrame, member: str, sums: Sequence[Column]
) -> DataFrame:
    """Sum facts over each key's member list: an equi join, not a text search."""
    return list_members(lists, key, members, member).join(facts, member).groupBy(key).agg(*sums)


def extend_code(
    facts: DataFrame, place: DataFrame, short: str = "place_id6", long: str = "place_id"
) -> tuple[DataFrame, DataFrame]:
    """(facts with the long code, facts whose short code is unknown)."""
    codes = place.select(short, long)
    return facts.join(codes, short).drop(short), facts.join(codes, short, "left_anti")
