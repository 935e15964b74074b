"""Gap-free reference population: two sources, one grid, filled forward then backward."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_sources(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both sources; the first one wins on the same (place, year)."""
    missing = F.lit(None).cast("double")
    a, b = F.col("population").alias("a"), F.col("population").alias("b")
    both = first.select("place_id", "year", a, missing.alias("b")).unionByName(
        second.select("place_id", "year", missing.alias("a"), b)
    )
    return both.groupBy("place_id", "year").agg(
        F.coalesce(F.max("a"), F.max("b")).alias("population")
    )


def reference_population(first: DataFrame, second: DataFrame) -> DataFrame:
    """Every place gets every year between the first and last year of either source.

    A gap takes the last known value before it, a gap at the start the first known one. A place
    collects one entry per year (calendar-sized), so one shuffle does the whole fill.
    """
    known = merge_sources(first, second).dropna(subset=["population"])
    all_years = first.select("year", "population").unionByName(second.select("year", "population"))
    years = (
        all_years.dropna(subset=["population"])
        .agg(F.sequence(F.min("year"), F.max("year")).alias("v"))
        .scalar()
    )
    entries = F.sort_array(F.collect_list(F.struct("year", "population")))

    def filled(year):
        before = F.filter("known", lambda e: e["year"] <= year)
        value = F.coalesce(
            F.try_element_at(before, F.lit(-1))["population"], F.col("known")[0]["population"]
        )
        return F.struct(year.alias("year"), value.alias("population"))

    return (
        known.groupBy("place_id").agg(entries.alias("known"))
        .select("known", "place_id", years.alias("years"))
        .select("place_id", F.explode(F.transform("years", filled)).alias("g"))
        .select("place_id", "g.year", "g.population")
    )
