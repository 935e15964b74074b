"""Metric expressions. Rounding is half-up on the printed decimal; a zero base gives NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Size bands by GDP (thousand) and by population, highest first.
GDP_BANDS = [
    (10_000_000, "1. Acima de R$ 10 bi"),
    (1_000_000, "2. R$ 1 bi a 10 bi"),
    (100_000, "3. R$ 100 mi a 1 bi"),
]
GDP_LOWEST_BAND = "4. Até R$ 100 mi"
POPULATION_BANDS = [
    (1_000_000, "1. Acima de 1 milhão"),
    (500_000, "2. 500 mil a 1 milhão"),
    (100_000, "3. 100 mil a 500 mil"),
    (20_000, "4. 20 mil a 100 mil"),
]
POPULATION_LOWEST_BAND = "5. Até 20 mil"


def _non_zero(c: Column) -> Column:
    return F.nullif(c.cast("double"), F.lit(0.0))


def ratio(num: Column, den: Column, scale: float = 100.0, digits: int | None = None) -> Column:
    value = F.lit(float(scale)) * num / _non_zero(den)
    return value if digits is None else F.round(value, digits)


def pct_change(now: Column, before: Column, digits: int = 2) -> Column:
    return F.round(F.lit(100.0) * now / _non_zero(before) - F.lit(100.0), digits)


def pct_change_nonzero(now: Column, before: Column, digits: int = 2) -> Column:
    """Percent change that treats a zero on either side as missing."""
    return F.when(now != 0, pct_change(now, before, digits))


def point_change(now: Column, before: Column, digits: int = 2) -> Column:
    return F.round(now - before, digits)


def cents_sum(c: Column) -> Column:
    """Exact, order-free sum of a two-decimal amount, as integer cents."""
    return F.sum(F.rint(c * 100).cast("long"))


def money_sum(c: Column) -> Column:
    return cents_sum(c) / F.lit(100.0)


def exact_sum(c: Column) -> Column:
    """Order-free sum of an already aggregated double (six decimals kept)."""
    return F.sum(c.cast("decimal(28,6)")).cast("double")


def exact_mean(c: Column) -> Column:
    return exact_sum(c) / F.nullif(F.count(c), F.lit(0).cast("long")).cast("double")


def weighted_mean(mean: Column, weight: Column, digits: int = 2) -> Column:
    """Mean of means; a row without a mean carries no weight."""
    known = F.sum(F.when(mean.isNotNull(), weight))
    return F.round(exact_sum(mean * weight) / _non_zero(known), digits)


def band(c: Column, bands: Sequence[tuple[float, str]], lowest: str) -> Column:
    """First band whose floor is reached; NULL lands in the lowest one."""
    return F.coalesce(*[F.when(c >= floor, F.lit(label)) for floor, label in bands], F.lit(lowest))


def gdp_band(c: Column) -> Column:
    return band(c, GDP_BANDS, GDP_LOWEST_BAND)


def population_band(c: Column) -> Column:
    return band(c, POPULATION_BANDS, POPULATION_LOWEST_BAND)


def annual_factor(quarter_end: Column) -> Column:
    """4 / quarter for a year-to-date flow; NULL off the quarter ends."""
    month = quarter_end % 100
    return F.when((month > 0) & (month % 3 == 0), F.lit(12.0) / month)


def return_on_assets(net_income: Column, assets: Column, quarter_end: Column) -> Column:
    yearly = net_income * annual_factor(quarter_end)
    return F.round(yearly / _non_zero(assets) * F.lit(100.0), 2)


def with_client(label: Column, client: Column) -> Column:
    return F.concat(label, F.coalesce(F.concat(F.lit(" ("), client, F.lit(")")), F.lit("")))
