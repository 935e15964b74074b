"""Institution statements, portfolios and insolvency counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostat import constants as C
from regiostat.operators.pivot import pivot_count, pivot_max
from regiostat.tables import TableSet

KEYS = ["inst_id", "period"]


def statement_of(t: TableSet, values: DataFrame) -> DataFrame:
    """Pivot account rows (filter them first, not the result) and add the registry columns."""
    wide = pivot_max(values, KEYS, "account", "value", C.STATEMENT_COLUMNS)
    registry = t["institution"].select(*KEYS, "name", "segment", "state", "city", "status")
    return registry.join(wide, KEYS).select(
        *KEYS, "name", "segment", "state", "city", "status", *C.STATEMENT_COLUMNS
    )


def income_statement(t: TableSet) -> DataFrame:
    return statement_of(t, t["statement_value"])


def _portfolio(t: TableSet, *reports: str) -> DataFrame:
    registry = t["institution"].select(*KEYS, "name", "segment", "state", "status")
    values = t["portfolio_value"].filter(F.col("report").isin(list(reports)))
    return values.join(registry, KEYS)


HEAD = [*KEYS, "name", "segment", "state", "status"]


def portfolio_aging(t: TableSet) -> DataFrame:
    household = F.col("report") == C.REPORT_HOUSEHOLD_AGING
    return _portfolio(t, C.REPORT_HOUSEHOLD_AGING, C.REPORT_FIRM_AGING).select(
        *HEAD,
        F.when(household, C.CLIENT_HOUSEHOLD).otherwise(C.CLIENT_FIRM).alias("client"),
        F.col("group").alias("modality"), F.col("column_name").alias("bucket"), "value",
    )


def portfolio_activity(t: TableSet) -> DataFrame:
    return (
        _portfolio(t, C.REPORT_FIRM_ACTIVITY)
        .filter(F.col("group").isNotNull())
        .select(
            *HEAD, F.col("group").alias("activity"), F.col("column_name").alias("bucket"), "value"
        )
    )


def portfolio_size(t: TableSet) -> DataFrame:
    return _portfolio(t, C.REPORT_FIRM_SIZE).select(
        *HEAD, F.col("column_name").alias("size"), "value"
    )


def insolvency_state(t: TableSet) -> DataFrame:
    return pivot_count(
        t["insolvency"], ["state", "court", "period"], "class", "cases", C.INSOLVENCY_COLUMNS
    )


def insolvency_national(t: TableSet) -> DataFrame:
    return pivot_count(t["insolvency"], ["period"], "class", "cases", C.INSOLVENCY_COLUMNS)


VIEWS = {
    "income_statement": income_statement,
    "portfolio_aging": portfolio_aging,
    "portfolio_activity": portfolio_activity,
    "portfolio_size": portfolio_size,
    "insolvency_state": insolvency_state,
    "insolvency_national": insolvency_national,
}
