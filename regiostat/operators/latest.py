"""Latest-position filters. The maximum is a scalar subquery, so no join and no cross product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar_of(df: DataFrame, value: Column) -> Column:
    """One aggregated value of ``df`` as a column usable in any other query."""
    return df.agg(value.alias("v")).scalar()


def latest(df: DataFrame, period: str = "period", where: Column | None = None) -> Column:
    return scalar_of(df if where is None else df.filter(where), F.max(period))


def at_latest(
    df: DataFrame,
    of: DataFrame | None = None,
    period: str = "period",
    where: Column | None = None,
) -> DataFrame:
    """Rows of ``df`` at the last period of ``of`` (default: of itself)."""
    return df.filter(F.col(period) == latest(of if of is not None else df, period, where))


def trailing_year(df: DataFrame, of: DataFrame | None = None, period: str = "period") -> DataFrame:
    """Rows of the last 12 calendar months."""
    return df.filter(F.col(period) > latest(of if of is not None else df, period) - 100)


def at_latest_per_frequency(df: DataFrame, monthly: str, quarterly: str) -> DataFrame:
    """Latest quarterly position of all rows plus the latest monthly position of monthly rows."""
    freq = F.col("frequency")
    block = at_latest(df, where=freq == quarterly)
    own = at_latest(df.filter(freq == monthly), of=df, where=freq == monthly)
    return block.unionByName(own)


def at_two_latest(df: DataFrame, period: str, family: Column) -> DataFrame:
    """Main rows at the main family's last period, family rows at their own last period.

    A family row that falls on the main date passes as well.
    """
    main = latest(df, period, ~family)
    own = latest(df, period, family)
    return df.filter((F.col(period) == main) | (family & (F.col(period) == own)))


def last_periods(df: DataFrame, n: int, period: str = "period") -> DataFrame:
    """The last ``n`` distinct periods (rows, not calendar steps)."""
    return df.select(period).distinct().orderBy(F.col(period).desc()).limit(n)


def period_axis(df: DataFrame, period: str = "period", last: int | None = None) -> Column:
    """Sorted array of the (last) distinct periods of ``df`` as a scalar column, calendar-sized."""
    axis = F.sort_array(F.collect_set(period))
    if last is not None:
        axis = F.slice(axis, F.greatest(F.size(axis) - (last - 1), F.lit(1)), last)
    return scalar_of(df, axis)


def year_axis(df: DataFrame, years: int, period: str = "year") -> Column:
    """Every year of the last ``years`` years, never before the first one present."""
    low, high = F.min(period), F.max(period)
    return scalar_of(df, F.sequence(F.greatest(low, high - (years - 1)), high))


def first_by_precedence(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key: the smallest by ``order``; a map-side ``min_by``, no sort."""
    rest = [c for c in df.columns if c not in keys]
    row = F.min_by(F.struct(*rest), F.struct(*order)).alias("row")
    return df.groupBy(*keys).agg(row).select(*keys, "row.*").select(*df.columns)


def fill_missing_groups(
    primary: DataFrame, fallback: DataFrame, group: Sequence[str]
) -> DataFrame:
    """All primary rows, plus fallback rows of the groups the primary source has none of."""
    present = primary.select(*group).distinct()
    return primary.unionByName(fallback.join(present, list(group), "left_anti"))
