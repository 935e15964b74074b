"""Ranks and top-N that never pull a whole group into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiostat.functions import metrics as M

#: Cut points are looked up in runs of so many.
RUN = 32
SALTS = 64


def _bucketed(df: DataFrame, metric: str, cuts: Column, buckets: int) -> DataFrame:
    """Adds ``_bucket`` (the higher the metric, the lower; NULL last) and ``_tie``: all its rows are equal."""
    value = F.col(metric)
    # Cut points up to the value: first whole runs of them, then those of its run.
    runs = F.size(F.filter("_cuts.last", lambda cut: cut <= value))
    inside = F.filter(F.slice("_cuts.all", F.col("_runs") * RUN + 1, F.lit(RUN)), lambda cut: cut <= value)
    on_cut = F.get("_cuts.all", F.col("_upto") - 1) == value
    tie = value.isNull() | F.coalesce(on_cut, F.lit(False))
    last = 2 * buckets
    # A cut is a bucket of its own, behind the values above it.
    cut = F.when(F.coalesce(on_cut, F.lit(False)), 1).otherwise(0)
    bucket = F.when(value.isNull(), last + 2).otherwise(last - 2 * F.col("_upto") + cut)
    return (
        df.withColumn("_cuts", cuts)
        .withColumn("_runs", runs)
        .withColumn("_upto", F.col("_runs") * RUN + F.size(inside))
        .withColumn("_bucket", bucket)
        .withColumn("_tie", tie)
        .drop("_cuts", "_runs", "_upto")
    )


def _better_rows(sizes: DataFrame, group: Sequence[str]) -> DataFrame:
    """Adds ``_outside``: rows in the buckets before, per group. The whole table is one array of its buckets."""
    if group:
        better = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        return sizes.withColumn("_outside", F.coalesce(F.sum("n").over(better), F.lit(0)))
    every = F.sort_array(F.collect_list(F.struct("_bucket", "_tie", "n"))).alias("_every")

    def bucket(b: Column, i: Column) -> Column:
        before = F.slice("_every", F.lit(1), i)
        rows = F.aggregate(before, F.lit(0).cast("long"), lambda total, x: total + x["n"])
        return F.struct(b["_bucket"].alias("_bucket"), b["_tie"].alias("_tie"), rows.alias("_outside"))

    return sizes.agg(every).select(F.explode(F.transform("_every", bucket)).alias("_b")).select("_b.*")


def with_ranks(
    df: DataFrame, metric: str, ranks: Mapping[str, Sequence[str]], buckets: int = RUN * RUN
) -> DataFrame:
    """``rank()`` by ``metric`` descending (NULL last) inside each group of ``ranks``.

    ``ranks`` maps an output column to its group columns (none = the whole table); the result
    equals the plain window function.

    1. approximate cut points of the metric, as one small array;
    2. each value between two cut points goes to one bucket, each cut point is a bucket of its
       own: equal values always share a bucket, so any cut points give the same ranks;
    3. running sums of the rows per group and bucket give the number of better rows outside a bucket; one
       row with that number joins its bucket;
    4. the rank inside a bucket is a window over one bucket of one group, in the same shuffle.

    A value held by many rows is a cut point, and all rows of such a bucket (and all NULLs) tie:
    their rank needs no window, so they are spread by a salt. Other buckets hold about one of ``buckets`` parts of
    all rows at most, whether those are of one group or of many. ``df`` is read three times, twice for a few columns only; stage it first
    if it is expensive.
    """
    steps = [i / buckets for i in range(1, buckets)]
    every_last = F.filter("c", lambda _, i: i % RUN == RUN - 1)
    cuts = (
        df.agg(F.percentile_approx(metric, steps).alias("c"))
        .select(F.struct(F.col("c").alias("all"), every_last.alias("last")).alias("cuts"))
        .scalar()
    )
    value = F.col(metric)
    every = list(dict.fromkeys(c for group in ranks.values() for c in group))
    sizes = _bucketed(df.select(*every, metric), metric, cuts, buckets).groupBy(*every, "_bucket", "_tie").agg(
        F.count(F.lit(1)).alias("n")
    )
    salt = F.when(F.col("_tie"), F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))).otherwise(0).cast("int")
    rows = _bucketed(df, metric, cuts, buckets).withColumn("_salt", salt)
    salts = F.when(F.col("_tie"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    for out, group in ranks.items():
        per_group = sizes.groupBy(*group, "_bucket", "_tie").agg(F.sum("n").alias("n"))
        offsets = _better_rows(per_group, group)
        offsets = offsets.select(*group, "_bucket", "_outside", F.explode(salts).alias("_salt"))
        mixed = rows.withColumn("_offset", F.lit(False)).unionByName(
            offsets.withColumn("_offset", F.lit(True)), allowMissingColumns=True
        )
        place = Window.partitionBy(*group, "_bucket", "_salt")
        inside = F.rank().over(place.orderBy("_offset", value.desc_nulls_last()))
        outside = F.max("_outside").over(place)
        rows = (
            mixed.withColumn("_inside", inside)
            .withColumn(out, outside + F.when(F.col("_tie"), 1).otherwise(F.col("_inside")))
            .filter(~F.col("_offset"))
            .drop("_offset", "_inside", "_outside")
        )
    return rows.select(*df.columns, *ranks)


def with_rank(
    df: DataFrame, metric: str, out: str, group: Sequence[str] = (), buckets: int = RUN * RUN
) -> DataFrame:
    """``with_ranks`` for one column."""
    return with_ranks(df, metric, {out: list(group)}, buckets)


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Global top-N report; the last order column must be unique."""
    return df.orderBy(*order).limit(n)


def top_keys(df: DataFrame, key: str, n: int, *order: Column) -> DataFrame:
    return top(df, n, *order).select(key)


def top_per_group(
    df: DataFrame, n: int, group: Sequence[str], *order: Column, position: str = "position"
) -> DataFrame:
    """Top-N of each group; Spark limits each group before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(position, F.row_number().over(w)).filter(F.col(position) <= n)


def top_series_and_rest(
    values: DataFrame, total: DataFrame, top_codes: DataFrame, code: str = "code"
) -> DataFrame:
    """Chosen series, the residual of the total after them, and the total, per period.

    A series missing in a period counts as zero in the residual. ``top_codes`` holds
    (code, label); result rows are (label, kind, period, value).
    """
    chosen = values.join(top_codes, code)
    axis = total.select("period", F.col("value").alias("_total"))
    taken = chosen.groupBy("period").agg(M.exact_sum(F.col("value")).alias("_taken"))
    rest = axis.join(taken, "period", "left").select(
        F.lit("Outros").alias("label"),
        F.lit("rest").alias("kind"),
        "period",
        F.round(F.col("_total") - F.coalesce("_taken", F.lit(0.0)), 1).alias("value"),
    )
    series = chosen.join(axis.select("period"), "period", "left_semi").select(
        "label", F.lit("series").alias("kind"), "period", "value"
    )
    whole = axis.select(
        F.lit("Total").alias("label"), F.lit("total").alias("kind"), "period",
        F.col("_total").alias("value"),
    )
    return series.unionByName(rest).unionByName(whole)
