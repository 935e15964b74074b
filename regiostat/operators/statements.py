"""Income-statement totals, return on assets and accounting identities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat import constants as C
from regiostat.functions import metrics as M

ZERO = 0.0


def _or_zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(ZERO))


def _total(parts) -> Column:
    return reduce(lambda a, b: a + b, parts)


def total_revenue() -> Column:
    """Fixed revenue columns plus the positive ones of either nature."""
    fixed = [_or_zero(c) for c in C.REVENUE_COLUMNS]
    gains = [F.greatest(_or_zero(c), F.lit(ZERO)) for c in C.EITHER_COLUMNS]
    return F.when(F.col(C.NEW_SCHEME_MARKER).isNotNull(), _total(fixed + gains))


def total_cost() -> Column:
    """Magnitude of the (negative) cost columns plus that of the negative ones of either nature."""
    fixed = -_total([_or_zero(c) for c in C.COST_COLUMNS])
    losses = [-F.least(_or_zero(c), F.lit(ZERO)) for c in C.EITHER_COLUMNS]
    return F.when(F.col(C.NEW_SCHEME_MARKER).isNotNull(), _total([fixed, *losses]))


def with_statement_metrics(statement: DataFrame) -> DataFrame:
    """Totals, loss shown as a magnitude, yearly return on assets in percent."""
    return statement.withColumns(
        {
            "total_revenue": total_revenue(),
            "total_cost": total_cost(),
            "credit_expected_loss": -F.col("credit_expected_loss"),
            "roa": M.return_on_assets(F.col("net_income"), F.col("total_assets"), F.col("period")),
        }
    )


def broken_totals(statement: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Rows whose revenue - cost misses net income by more than the tolerance, worst first."""
    gap = F.abs(F.col("total_revenue") - F.col("total_cost") - F.col("net_income"))
    return (
        statement.withColumn("gap", F.round(gap, 2))
        .filter(F.col("gap") > tolerance)
        .orderBy(F.col("gap").desc(), "inst_id", "period")
    )


def broken_identities(statement: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """(inst_id, period, total, gap) for every broken identity of the statement tree."""
    gaps = F.array(
        *[
            F.struct(
                F.lit(total).alias("total"),
                F.round(F.abs(F.col(total) - _total([_or_zero(p) for p in parts])), 2).alias("gap"),
            )
            for total, parts in C.STATEMENT_IDENTITIES.items()
        ]
    )
    rows = statement.filter(F.col(C.NEW_SCHEME_MARKER).isNotNull())
    return (
        rows.select("inst_id", "period", F.explode(gaps).alias("g"))
        .select("inst_id", "period", "g.*")
        .filter(F.col("gap") > tolerance)
    )
