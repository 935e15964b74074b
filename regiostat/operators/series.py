"""Aligned series: one array per key on a shared, calendar-sized period axis."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.functions import metrics as M


def align(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, str],
    axis: Column,
    period: str = "period",
    also: Sequence[Column] = (),
    first_by: Sequence[str] = (),
) -> DataFrame:
    """One row per key with one array per value; position i belongs to ``axis[i]``, gaps NULL.

    ``also`` adds named aggregates of the same group.

    Each key collects its cells, mixes them with one marker for each axis position and sorts them once; the
    cell right behind a marker is the one of that position. One shuffle, no key x axis product, and the work of a
    key is that of a sort. Of several rows for one (key, period) the first by ``first_by`` counts, then
    the one with the smallest values. An axis holds each period once; a NULL period is no position of it.
    """
    cells = F.struct(*[F.col(c).alias(out) for c, out in values.items()]).alias("_values")
    none = F.lit(None)
    entry = F.struct(
        F.col(period).alias("_at"), F.lit(1).alias("_kind"), none.cast("int").alias("_pos"), *first_by, cells
    )
    grouped = df.groupBy(*keys).agg(F.collect_list(entry).alias("_entries"), *also)
    extra = [c for c in grouped.columns if c not in (*keys, "_entries")]
    fields = grouped.schema["_entries"].dataType.elementType.fields

    def marker(p: Column, i: Column) -> Column:
        given = {"_at": p, "_kind": F.lit(0), "_pos": i}
        return F.struct(*[given.get(f.name, none).cast(f.dataType).alias(f.name) for f in fields])

    mixed = F.sort_array(F.concat(F.transform("_axis", marker), "_entries"))

    def cell(e: Column, i: Column) -> Column:
        follows = F.get("_mixed", i + 1)
        hit = (follows["_kind"] == 1) & (follows["_at"] == e["_at"])
        return F.struct(e["_pos"].alias("pos"), F.when(hit, follows["_values"]).alias("values"))

    per_key = grouped.withColumn("_axis", axis).withColumn("_mixed", mixed).drop("_entries", "_axis")
    placed = F.sort_array(F.filter(F.transform("_mixed", cell), lambda c: c["pos"].isNotNull()))
    per_key = per_key.withColumn("_cells", placed).drop("_mixed")

    def series(out: str) -> Column:
        return F.transform("_cells", lambda c: c["values"][out]).alias(out)

    return per_key.select(*keys, *extra, *[series(out) for out in values.values()])


def long_series(df: DataFrame, keys: Sequence[str], arrays: Sequence[str], axis: Column):
    """Aligned arrays back to rows (key, series, position, period, value)."""
    tagged = F.array(
        *[F.struct(F.lit(a).alias("series"), F.col(a).cast("array<double>").alias("v")) for a in arrays]
    )
    rows = df.withColumn("_axis", axis).select(
        *keys, "_axis", F.explode(tagged).alias("_s")
    )
    cells = F.arrays_zip(F.col("_axis").alias("period"), F.col("_s.v").alias("value"))
    return rows.select(
        *keys, F.col("_s.series").alias("series"), F.posexplode(cells).alias("position", "_c")
    ).select(*keys, "series", "position", F.col("_c.period").alias("period"), F.col("_c.value").alias("value"))


def by_period(rows: DataFrame, columns: Sequence[str], last: Column | None = None) -> DataFrame:
    """One row from a national series: ``period`` (the last one) and a period -> values map.

    The map is as long as the calendar; look it up with ``at``.
    """
    entry = F.struct(F.col("period"), F.struct(*columns))
    period = F.max("period") if last is None else last
    return rows.agg(
        period.alias("period"), F.map_from_entries(F.collect_list(entry)).alias("_at")
    )


def at(period: Column) -> Column:
    """Values at ``period`` in a row made by ``by_period``; NULL where the period is absent."""
    return F.try_element_at("_at", period.cast("int"))


def label_values(columns: Mapping[str, str]) -> Column:
    """``[(label, value), ...]`` of the non-null columns, in the given order."""
    pairs = F.array(
        *[
            F.struct(F.lit(label).alias("label"), F.col(c).cast("double").alias("value"))
            for c, label in columns.items()
        ]
    )
    return F.filter(pairs, lambda p: p["value"].isNotNull())


def nested_list(label: str, value: str) -> Column:
    """``[(label, value), ...]`` of a group, largest value first, label as tie-break."""
    ordered = F.sort_array(
        F.collect_list(
            F.struct((-F.col(value)).alias("k"), F.col(label).alias("label"), F.col(value).alias("value"))
        )
    )
    return F.transform(
        ordered, lambda p: F.struct(p["label"].alias("label"), p["value"].alias("value"))
    )


def position_changes(arr: Column) -> dict[str, Column]:
    """Changes by position on an aligned array: step, step percent, 12-step percent."""

    def back(i: Column, n: int) -> Column:
        return F.when(i >= n, F.get(arr, i - n))

    return {
        "step": F.transform(arr, lambda v, i: v - back(i, 1)),
        "step_pct": F.transform(arr, lambda v, i: _growth(v, back(i, 1))),
        "year_pct": F.transform(arr, lambda v, i: _growth(v, back(i, 12))),
    }


def _growth(now: Column, before: Column) -> Column:
    return F.round((now / F.nullif(before.cast("double"), F.lit(0.0)) - 1) * 100, 2)


def array_ratio(num: str, den: str, scale: float, digits: int) -> Column:
    """Element-wise ratio of two arrays on the same axis."""
    return F.zip_with(num, den, lambda a, b: M.ratio(a, b, scale, digits))


def last_known(value: str, period: str = "period") -> Column:
    """Aggregate: the last non-null value of a series."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.col(period)))


def record_high(value: str, period: str = "period") -> Column:
    """Aggregate: struct (value, period) of the maximum, earliest period on ties."""
    best = F.max(
        F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), (-F.col(period)).alias("p")))
    )
    return F.struct(best["v"].alias("value"), (-best["p"]).alias("period"))


def best_and_worst(df: DataFrame, key: str, metric: str) -> DataFrame:
    """One row: keys and values of the extremes; NULLs skipped, smallest key on ties."""
    known = df.filter(F.col(metric).isNotNull())
    high = F.min(F.struct((-F.col(metric)).alias("m"), F.col(key).alias("k")))
    low = F.min(F.struct(F.col(metric).alias("m"), F.col(key).alias("k")))
    return known.agg(high.alias("h"), low.alias("l")).select(
        F.col("h.k").alias("best"), (-F.col("h.m")).alias("best_value"),
        F.col("l.k").alias("worst"), F.col("l.m").alias("worst_value"),
    )
