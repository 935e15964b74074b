"""Conditional pivots with a known column list (no extra job to discover values)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostat.functions import metrics as M


def pivot_max(
    df: DataFrame, keys: Sequence[str], code: str, value: str, columns: Mapping[str, object]
) -> DataFrame:
    """One column per entry: the maximum value among its codes, NULL without a match."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(_in(code, codes), F.col(value))).alias(c) for c, codes in columns.items()]
    )


def pivot_sum(
    df: DataFrame, keys: Sequence[str], code: str, value: str, columns: Mapping[str, object]
) -> DataFrame:
    """One column per entry: the exact sum over its codes, NULL without a match."""
    return df.groupBy(*keys).agg(
        *[
            M.exact_sum(F.when(_in(code, codes), F.col(value))).alias(c)
            for c, codes in columns.items()
        ]
    )


def pivot_count(
    df: DataFrame, keys: Sequence[str], code: str, value: str, columns: Mapping[str, object]
) -> DataFrame:
    """One column per entry: the sum over its codes, 0 without a match."""
    return df.groupBy(*keys).agg(
        *[
            F.sum(F.when(_in(code, codes), F.col(value)).otherwise(0)).alias(c)
            for c, codes in columns.items()
        ]
    )


def pivot_first(
    df: DataFrame, keys: Sequence[str], code: str, value: str, columns: Mapping[str, object]
) -> DataFrame:
    """Long file to wide table: one non-null value per cell.

    Rows with a NULL value or an unknown code are removed first, so a key that has nothing else
    does not survive. Where a cell has several values, the smallest by file order column
    ``_order`` wins if present.
    """
    known = [c for codes in columns.values() for c in _as_list(codes)]
    rows = df.filter(F.col(value).isNotNull() & F.col(code).isin(known))
    rows = rows.dropna(subset=list(keys))

    def cell(codes):
        hit = F.when(_in(code, codes), F.col(value))
        if "_order" in df.columns:
            return F.min_by(hit, F.when(_in(code, codes), F.col("_order")))
        return F.first(hit, ignorenulls=True)

    return rows.groupBy(*keys).agg(*[cell(codes).alias(c) for c, codes in columns.items()])


def unpivot_sum(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], code: str, value: str
) -> DataFrame:
    """Wide value columns to (key, code) sums; empty cells and NULL keys are dropped."""
    long = df.unpivot(list(keys), list(columns), code, value).dropna(subset=[value, *keys])
    return long.groupBy(*keys, code).agg(M.exact_sum(F.col(value)).alias(value))


def _as_list(codes) -> list:
    return list(codes) if isinstance(codes, (list, tuple)) else [codes]


def _in(code: str, codes):
    return F.col(code).isin(_as_list(codes))
