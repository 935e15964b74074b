"""Integer periods: months AAAAMM, quarters AAAATT, quarter ends AAAAMM with MM in 3/6/9/12."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_of(d: Column) -> Column:
    return (F.year(d) * 100 + F.month(d)).cast("int")


def quarter_of(d: Column) -> Column:
    return (F.year(d) * 100 + F.quarter(d)).cast("int")


def quarter_end_of(d: Column) -> Column:
    return (F.year(d) * 100 + F.quarter(d) * 3).cast("int")


def month_start(period: Column) -> Column:
    return F.make_date(_year(period), _month(period), F.lit(1))


def iso_month_start(period: Column) -> Column:
    return F.format_string("%04d-%02d-01", _year(period), _month(period))


def _year(period: Column) -> Column:
    return F.floor(period / F.lit(100)).cast("int")


def _month(period: Column) -> Column:
    return (period % 100).cast("int")


def previous_month(period: Column) -> Column:
    january = _month(period) == 1
    return F.when(january, (_year(period) - 1) * 100 + 12).otherwise(period - 1).cast("int")


def december_before(period: Column) -> Column:
    return ((_year(period) - 1) * 100 + 12).cast("int")


def same_month_last_year(period: Column) -> Column:
    return (period - 100).cast("int")


def month_of_dmy(text: Column) -> Column:
    """``dd/mm/yyyy`` -> AAAAMM."""
    part = F.split(text, "/")
    return F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(1))).try_cast("int")


def iso_of_dmy(text: Column) -> Column:
    """``dd/mm/yyyy`` -> ``yyyy-mm-dd``."""
    return F.array_join(F.reverse(F.split(text, "/")), "-")


def year_of_iso(text: Column) -> Column:
    return F.substring(text, 1, 4).try_cast("int")


def month_of_iso(text: Column) -> Column:
    return F.concat(F.substring(text, 1, 4), F.substring(text, 6, 2)).try_cast("int")


def month_list(bounds: DataFrame, first: str, as_of: str, lag_months: int) -> DataFrame:
    """All months from ``first`` to ``as_of`` minus the publication lag.

    ``bounds`` holds one row with two date columns; "today" is data, never the clock.
    """
    last = F.add_months(F.trunc(F.col(as_of), "month"), -lag_months)
    start = F.trunc(F.col(first), "month")
    months = F.when(start <= last, F.sequence(start, last, F.expr("interval 1 month")))
    return bounds.select(F.explode(months).alias("month")).select(
        month_of(F.col("month")).alias("period")
    )


def quarter_ends(months: DataFrame, period: str = "period") -> DataFrame:
    return months.filter(F.col(period) % 100 % 3 == 0)


def one_day_per_month(days: DataFrame, day: str) -> DataFrame:
    """The earliest available day of each month."""
    return (
        days.groupBy(month_of(F.col(day)).alias("period"))
        .agg(F.min(day).alias(day))
    )
