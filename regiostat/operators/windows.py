"""Series windows. Inputs are one row per (key, period), so a key holds a calendar's worth of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiostat.functions import metrics as M


def series_window(keys: Sequence[str], period: str = "period"):
    """Window over one series per key; without keys the input must be one row per period."""
    return Window.partitionBy(*keys).orderBy(period) if keys else Window.orderBy(period)


def row_lag(c: str, n: int, keys: Sequence[str], period: str = "period") -> Column:
    """Value ``n`` rows earlier (rows, not calendar months)."""
    return F.lag(c, n).over(series_window(keys, period))


def row_change(c: str, n: int, keys: Sequence[str], period: str = "period") -> Column:
    return M.pct_change(F.col(c), row_lag(c, n, keys, period))


def rolling_sum(c: str, keys: Sequence[str], rows: int = 12, period: str = "period") -> Column:
    """Sum of the last ``rows`` rows, partial at the start."""
    return F.sum(c).over(series_window(keys, period).rowsBetween(1 - rows, 0))


def with_year_ago(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Value of the same period one year earlier, by exact period (any frequency, any gap)."""
    earlier = df.select(*keys, (F.col("period") + 100).alias("period"), F.col(value).alias(out))
    return df.join(earlier, [*keys, "period"], "left")


def share_of_group(
    df: DataFrame,
    value: str,
    group: Sequence[str],
    out: str,
    digits: int = 2,
    of: DataFrame | None = None,
) -> DataFrame:
    """Share in the group total (of the rows ``of``, by default of ``df`` itself).

    Totals are pre-aggregated and joined back (NULL-safe), so a hot group is never one task.
    """
    totals = (df if of is None else of).groupBy(*group).agg(M.exact_sum(F.col(value)).alias("_total")).alias("g")
    rows = df.alias("d")
    on = [F.col(f"d.{k}").eqNullSafe(F.col(f"g.{k}")) for k in group]
    joined = rows.join(totals, on, "left") if on else rows
    return joined.select(
        "d.*", M.ratio(F.col(f"d.{value}"), F.col("g._total"), 100.0, digits).alias(out)
    )
