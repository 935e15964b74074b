"""Data-quality checks: each returns its violations as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostat import constants as C


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def without_partner(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Unknown keys with their row counts."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(dimension.select(key).distinct(), key, "left_anti")


def unclassified(df: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct().join(classes.select(key), key, "left_anti")


def unparsed_titles(catalogue: DataFrame) -> DataFrame:
    return (
        catalogue.filter(F.col("parse_status") != C.PARSED)
        .select("code", "title", "search")
        .orderBy("search", "code")
    )


def parse_summary(catalogue: DataFrame) -> DataFrame:
    return catalogue.groupBy("parse_status", "metric").agg(F.count(F.lit(1)).alias("series"))


def load_summary(df: DataFrame, key: str, period: str = "period") -> DataFrame:
    """Rows, first and last period, distinct keys of a loaded table."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(period).alias("first_period"),
        F.max(period).alias("last_period"),
        F.count_distinct(key).alias("keys"),
    )
