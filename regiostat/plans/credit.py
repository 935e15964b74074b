"""National and place credit views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat import constants as C
from regiostat.functions import metrics as M
from regiostat.operators import windows as W
from regiostat.operators.latest import at_latest, trailing_year
from regiostat.operators.pivot import pivot_max, pivot_sum
from regiostat.operators.ranking import with_rank, with_ranks
from regiostat.tables import TableSet


def sector_credit(t: TableSet) -> DataFrame:
    """Credit by sector and month with 12-row change and share among the top-level sectors."""
    kept = t["series"].filter(F.col("family") == C.FAMILY_SECTOR)
    rows = t["series_value"].select("code", "period", "value").join(
        kept.select("code", "name", "level", "sector", "subsector"), "code"
    )
    top_level = F.col("level") == C.LEVEL_SECTOR
    totals = rows.filter(top_level).groupBy("period").agg(
        M.exact_sum(F.col("value")).alias("_total")
    )
    return (
        rows.withColumn("change_12m_pct", W.row_change("value", 12, ["code"]))
        .join(totals, "period", "left")
        .select(
            "code", "name", "level", "sector", "subsector", "period", "value", "change_12m_pct",
            F.when(top_level, M.ratio(F.col("value"), F.col("_total"), 100, 2)).alias("share_pct"),
        )
    )


def credit_macro(t: TableSet) -> DataFrame:
    return pivot_max(t["series_value"], ["period"], "code", "value", C.CREDIT_MACRO_SERIES)


def national_pulse(t: TableSet) -> DataFrame:
    """One row per month, so the unpartitioned windows see a few hundred rows at any scale."""
    base = pivot_max(t["series_value"], ["period"], "code", "value", C.PULSE_SERIES)
    return base.select(
        "period", "activity", "activity_adjusted",
        W.row_change("activity_adjusted", 1, []).alias("activity_change_1m_pct"),
        W.row_change("activity", 12, []).alias("activity_change_12m_pct"),
        "credit_balance",
        W.row_change("credit_balance", 12, []).alias("credit_change_12m_pct"),
        "lending",
        W.row_change("lending", 12, []).alias("lending_change_12m_pct"),
        "default_rate", "credit_gdp_pct",
    )


def regional_activity(t: TableSet) -> DataFrame:
    kept = t["series"].filter(F.col("family") == C.FAMILY_ACTIVITY).select("code", "name")
    rows = t["series_value"].select("code", "period", "value").join(kept, "code")
    return rows.select(
        "period", F.col("name").alias("indicator"), "value",
        W.row_change("value", 12, ["code"]).alias("change_12m_pct"),
    )


def credit_detail(t: TableSet) -> DataFrame:
    """Detailed series with the value of the same period one year before (any frequency)."""
    t.stage("credit_value")
    values = t["credit_value"].select("code", "period", "value")
    dims = t["credit_series"].select(
        "code", "metric", "client", "size", "origin", "region", "modality", "frequency", "unit"
    )
    return (
        W.with_year_ago(values, ["code"], "value", "value_year_ago")
        .join(dims, "code")
        .select(
            "code", "metric", "client", "size", "origin", "region", "modality", "frequency",
            "unit", "period", "value", "value_year_ago",
            M.pct_change(F.col("value"), F.col("value_year_ago")).alias("change_year_pct"),
        )
    )


def detail_of(t: TableSet, *metrics: str, where: Column | None = None) -> DataFrame:
    rows = t["credit_detail"].filter(F.col("metric").isin(list(metrics)))
    return rows if where is None else rows.filter(where)


def credit_rates(t: TableSet) -> DataFrame:
    return detail_of(t, "TAXA_JUROS")


def credit_defaults(t: TableSet) -> DataFrame:
    return detail_of(t, "TAXA_INADIMPLENCIA")


def credit_balance_by_size(t: TableSet) -> DataFrame:
    """Balances with their share inside (client, size, period); totals and regions are rows too."""
    return W.share_of_group(
        detail_of(t, "SALDO"), "value", ["client", "size", "period"], "share_pct"
    )


def credit_cost_index(t: TableSet) -> DataFrame:
    return detail_of(t, "ICC", "SPREAD_ICC")


def credit_term(t: TableSet) -> DataFrame:
    return detail_of(t, "PRAZO_MEDIO_CARTEIRA", "PRAZO_MEDIO_CONCESSAO")


def credit_lending(t: TableSet) -> DataFrame:
    return detail_of(t, "CONCESSAO", where=F.col("modality").isNotNull())


def credit_balance_by_region(t: TableSet) -> DataFrame:
    return detail_of(t, "SALDO", where=F.col("region").isNotNull())


PLACE_AMOUNTS = list(C.PLACE_CREDIT_COLUMNS)


def _provision_pct() -> Column:
    return M.ratio(F.col("provision"), F.col("credit_total"), -100.0, 2).alias("provision_pct")


def place_credit(t: TableSet) -> DataFrame:
    """Bank balance sheet by place and month: ten amounts, presence, 12-row change."""
    wide = pivot_sum(
        t["place_balance"], ["period", "place_id"], "account", "amount", C.PLACE_CREDIT_COLUMNS
    )
    dims = t["place"].select("place_id", "name", "state", "region")
    return (
        wide.join(dims, "place_id")
        .join(t["place_presence"], ["period", "place_id"], "left")
        .select(
            "period", "place_id", "name", "state", "region", *PLACE_AMOUNTS, _provision_pct(),
            "institutions", "branches",
            W.row_lag("credit_total", 12, ["place_id"]).alias("credit_12m_before"),
            W.row_change("credit_total", 12, ["place_id"]).alias("credit_change_12m_pct"),
        )
    )


def state_credit(t: TableSet) -> DataFrame:
    """State roll-up; ``institutions`` adds up the places' distinct counts."""
    sums = t["place_credit"].groupBy("period", "state").agg(
        *[M.exact_sum(F.col(c)).alias(c) for c in PLACE_AMOUNTS],
        F.sum("institutions").alias("institutions"),
        F.sum("branches").alias("branches"),
    )
    return sums.select(
        "period", "state", *PLACE_AMOUNTS, "institutions", "branches", _provision_pct(),
        W.row_lag("credit_total", 12, ["state"]).alias("credit_12m_before"),
        W.row_change("credit_total", 12, ["state"]).alias("credit_change_12m_pct"),
    )


def latest_population(t: TableSet) -> DataFrame:
    t.stage("population_ref")
    return at_latest(t["population_ref"], period="year").select("place_id", "population")


def place_credit_per_capita(t: TableSet) -> DataFrame:
    """Latest month per place, per capita, ranked in the country and in the state."""
    t.stage("place", "place_balance", "place_presence", "population_ref")
    t.stage("place_credit")
    now = at_latest(t["place_credit"], t["place_balance"])
    rows = (
        now.join(latest_population(t), "place_id", "left")
        .withColumn(
            "credit_per_capita", M.ratio(F.col("credit_total"), F.col("population"), 1000, 0)
        )
    )
    ranked = with_ranks(rows, "credit_total", {"national_rank": [], "state_rank": ["state"]})
    return ranked.select(
        *now.columns, "population", "credit_per_capita", "national_rank", "state_rank"
    )


def credit_penetration(t: TableSet) -> DataFrame:
    """Mean credit of the last 12 months over the GDP of the last year, ranked unrounded."""
    t.stage("place", "place_balance", "place_presence", "place_gdp")
    t.stage("place_credit")
    recent = trailing_year(
        t["place_credit"].select("place_id", "period", "credit_total"), t["place_balance"]
    )
    mean = recent.groupBy("place_id").agg(
        M.exact_mean(F.col("credit_total")).alias("mean_credit_12m")
    )
    gdp = at_latest(t["place_gdp"], period="year").select(
        "place_id", F.col("year").alias("gdp_year"), "gdp"
    )
    rows = (
        t["place"].select("place_id", "name", "state", "region")
        .join(mean, "place_id")
        .join(gdp, "place_id")
        .withColumn("_ratio", M.ratio(F.col("mean_credit_12m"), F.col("gdp"), 100))
        .withColumn("credit_gdp_pct", F.round("_ratio", 1))
    )
    return with_rank(rows, "_ratio", "penetration_rank").select(
        "place_id", "name", "state", "region", "mean_credit_12m", "gdp_year", "gdp",
        "credit_gdp_pct", "penetration_rank",
    )


VIEWS = {
    "sector_credit": sector_credit,
    "credit_macro": credit_macro,
    "national_pulse": national_pulse,
    "regional_activity": regional_activity,
    "credit_detail": credit_detail,
    "credit_rates": credit_rates,
    "credit_defaults": credit_defaults,
    "credit_balance_by_size": credit_balance_by_size,
    "credit_cost_index": credit_cost_index,
    "credit_term": credit_term,
    "credit_lending": credit_lending,
    "credit_balance_by_region": credit_balance_by_region,
    "place_credit": place_credit,
    "state_credit": state_credit,
    "place_credit_per_capita": place_credit_per_capita,
    "credit_penetration": credit_penetration,
}
