"""The ten report workbooks: 47 sheets, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat import constants as C
from regiostat.functions import metrics as M
from regiostat.operators.latest import (
    at_latest,
    at_latest_per_frequency,
    at_two_latest,
)
from regiostat.operators.quality import unparsed_titles
from regiostat.operators.ranking import top, top_keys
from regiostat.tables import TableSet

Sheet = Callable[[TableSet], DataFrame]


def _desc(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def _sums(*columns: str) -> list[Column]:
    return [M.exact_sum(F.col(c)).alias(c) for c in columns]


# --- 1 national overview ---------------------------------------------------------------------


def pulse(t: TableSet) -> DataFrame:
    return t["national_pulse"].orderBy(_desc("period"))


def credit_panel(t: TableSet) -> DataFrame:
    return t["credit_macro"].orderBy(_desc("period"))


def activity(t: TableSet) -> DataFrame:
    return t["regional_activity"].orderBy("indicator", _desc("period"))


def quarters(t: TableSet, since: int = 201901) -> DataFrame:
    rows = t["quarter_gdp_view"].filter(F.col("quarter") >= since)
    return rows.orderBy(_desc("quarter"), "sector")


# --- 2 credit by sector ----------------------------------------------------------------------


def sector_latest(t: TableSet) -> DataFrame:
    t.stage("series_value")
    return at_latest(t["sector_credit"]).drop("code").orderBy("level", _desc("value"), "name")


def _sector_series(t: TableSet, level: str) -> DataFrame:
    return t["sector_credit"].filter(F.col("level") == level).select(
        "period", "name", "sector", "subsector", "value", "change_12m_pct"
    )


def sector_series(t: TableSet) -> DataFrame:
    return _sector_series(t, C.LEVEL_SECTOR).orderBy("name", _desc("period"))


def subsector_series(t: TableSet) -> DataFrame:
    return _sector_series(t, C.LEVEL_SUBSECTOR).orderBy("sector", "name", _desc("period"))


def sector_shares(t: TableSet) -> DataFrame:
    rows = t["sector_credit"].filter(F.col("level") == C.LEVEL_SECTOR)
    return rows.select("period", "name", "value", "share_pct").orderBy(
        _desc("period"), _desc("value"), "name"
    )


# --- 3 credit by place -----------------------------------------------------------------------


def top_credit_places(t: TableSet, n: int = 300) -> DataFrame:
    rows = t["place_credit_per_capita"].select(
        "place_id", "national_rank", "name", "state", "region", "period", "credit_total",
        "credit_change_12m_pct", "credit_per_capita", "rural_credit", "housing_credit",
        "provision_pct", "savings", "time_deposits", "institutions", "branches", "population",
    )
    return top(rows, n, F.col("national_rank"), F.col("place_id"))


def top_credit_per_capita(t: TableSet, n: int = 300, min_population: int = 20_000) -> DataFrame:
    rows = t["place_credit_per_capita"].filter(F.col("population") >= min_population).select(
        "place_id", "name", "state", "period", "credit_per_capita", "credit_total", "population",
        "credit_change_12m_pct",
    )
    return top(rows, n, _desc("credit_per_capita"), F.col("place_id"))


def state_credit_series(t: TableSet) -> DataFrame:
    sums = t["place_credit"].groupBy("period", "state").agg(
        *_sums("credit_total", "rural_credit", "housing_credit", "savings", "time_deposits")
    )
    return sums.orderBy("state", _desc("period"))


def top_penetration(t: TableSet, n: int = 300, min_gdp: int = 100_000) -> DataFrame:
    rows = t["credit_penetration"].filter(F.col("gdp") >= min_gdp)
    return top(rows, n, F.col("penetration_rank"), F.col("place_id"))


# --- 4 GDP by place --------------------------------------------------------------------------


def _gdp_now(t: TableSet) -> DataFrame:
    return at_latest(t["place_gdp_profile"], t["place_gdp"], "year")


def top_gdp(t: TableSet, n: int = 500) -> DataFrame:
    rows = _gdp_now(t).select(
        "place_id", "national_rank", "name", "state", "region", "year", "gdp", "population",
        "gdp_per_capita", "state_share_pct", "pct_agri", "pct_industry", "pct_services",
        "pct_public",
    )
    return top(rows, n, F.col("national_rank"), F.col("place_id"))


def top_gdp_per_capita(t: TableSet, n: int = 500, min_population: int = 20_000) -> DataFrame:
    rows = _gdp_now(t).filter(F.col("population") >= min_population).select(
        "place_id", "name", "state", "year", "gdp_per_capita", "gdp", "population"
    )
    return top(rows, n, _desc("gdp_per_capita"), F.col("place_id"))


def _bands(t: TableSet, *extra: Column) -> DataFrame:
    return (
        t["place_size"].groupBy("gdp_band", "population_band")
        .agg(F.count(F.lit(1)).alias("places"), *_sums("gdp", "population"), *extra)
        .orderBy("gdp_band", "population_band")
    )


def size_matrix(t: TableSet) -> DataFrame:
    return _bands(t)


def state_gdp(t: TableSet) -> DataFrame:
    parts = ["gdp", "va_agri", "va_industry", "va_services", "va_public"]
    sums = t["place_gdp_profile"].groupBy("state", "year").agg(*_sums(*parts))
    return sums.orderBy("state", _desc("year"))


# --- 5 companies -----------------------------------------------------------------------------


def companies_by_section(t: TableSet) -> DataFrame:
    sums = t["place_companies"].groupBy("year", "section", "section_name").agg(
        *_sums("companies", "staff", "paid_staff", "wages")
    )
    return sums.orderBy(_desc("year"), _desc("companies"), "section")


def companies_by_state(t: TableSet) -> DataFrame:
    t.stage("place_company")
    now = at_latest(t["place_companies"], t["place_company"], "year")
    sums = now.groupBy("year", "state", "section", "section_name").agg(*_sums("companies", "staff"))
    return sums.orderBy("state", _desc("companies"), "section")


def top_company_places(t: TableSet, n: int = 300) -> DataFrame:
    t.stage("place_company_total")
    now = at_latest(t["place_company_total"], period="year")
    rows = now.join(t["place"].select("place_id", "name", "state"), "place_id").select(
        "year", "place_id", "name", "state", "active_companies", "local_units", "staff",
        "paid_staff", "mean_wage",
    )
    return top(rows, n, _desc("active_companies"), F.col("place_id"))


def company_density(t: TableSet, n: int = 300, min_companies: int = 1000) -> DataFrame:
    t.stage("place_company")
    now = at_latest(t["place_companies"], t["place_company"], "year")
    sums = now.groupBy("year", "place_id", "name", "state").agg(
        *_sums("companies"),
        F.round(M.exact_sum(F.col("companies_per_1000")), 1).alias("companies_per_1000"),
    )
    rows = sums.filter(F.col("companies") >= min_companies)
    return top(rows, n, _desc("companies_per_1000"), F.col("place_id"))


# --- 6 employment ----------------------------------------------------------------------------


def jobs_by_division(t: TableSet) -> DataFrame:
    t.stage("place_jobs")
    return at_latest(t["sector_jobs"], t["place_jobs"]).orderBy(_desc("net_12m"), "division")


def _job_sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("hires", "leavers", "net")]


def jobs_by_section(t: TableSet) -> DataFrame:
    sums = t["sector_jobs"].groupBy("period", "section", "section_name").agg(*_job_sums())
    return sums.orderBy("section", _desc("period"))


def jobs_by_state(t: TableSet) -> DataFrame:
    sums = t["place_employment"].groupBy("period", "state").agg(*_job_sums())
    return sums.orderBy("state", _desc("period"))


def top_job_places(t: TableSet, n: int = 300) -> DataFrame:
    t.stage("place_jobs")
    rows = at_latest(t["place_employment"], t["place_jobs"]).select(
        "place_id", "name", "state", "region", "period", "net_12m", "net_12m_per_1000", "hires",
        "leavers",
    )
    return top(rows, n, _desc("net_12m"), F.col("place_id"))


def national_jobs_series(t: TableSet) -> DataFrame:
    return t["national_employment"].orderBy(_desc("period"))


# --- 7 state sheets --------------------------------------------------------------------------


def state_panel(t: TableSet) -> DataFrame:
    return t["state_scorecard"].orderBy(_desc("gdp"), "state")


def state_credit_total(t: TableSet) -> DataFrame:
    sums = t["place_credit"].groupBy("period", "state").agg(*_sums("credit_total"))
    return sums.orderBy("state", _desc("period"))


def state_net_jobs(t: TableSet) -> DataFrame:
    sums = t["place_employment"].groupBy("period", "state").agg(F.sum("net").alias("net"))
    return sums.orderBy("state", _desc("period"))


# --- 8 rankings ------------------------------------------------------------------------------


def ranking(t: TableSet, n: int = 1000, min_population: int = 20_000) -> DataFrame:
    rows = t["place_ranking"].filter(F.col("population") >= min_population)
    return top(rows, n, F.col("gdp_rank").asc_nulls_last(), F.col("place_id"))


def band_means(t: TableSet) -> DataFrame:
    return _bands(
        t,
        F.round(M.exact_mean(F.col("pct_industry")), 1).alias("mean_pct_industry"),
        F.round(M.exact_mean(F.col("pct_agri")), 1).alias("mean_pct_agri"),
    )


def sectors(t: TableSet) -> DataFrame:
    return t["sector_crosswalk"].orderBy(_desc("value_added"), "sector")


# --- 9 detailed credit -----------------------------------------------------------------------

DETAIL = ["code", "client", "size", "origin", "modality", "period", "value", "change_year_pct"]


def rates_now(t: TableSet) -> DataFrame:
    return at_latest(t["credit_rates"]).select(*DETAIL).orderBy(
        "client", "size", "origin", _desc("value"), "code"
    )


def defaults_now(t: TableSet) -> DataFrame:
    rows = at_latest_per_frequency(t["credit_defaults"], C.MONTHLY, C.QUARTERLY)
    return rows.select(*DETAIL).orderBy("client", "size", "origin", _desc("value"), "code")


def balances_now(t: TableSet) -> DataFrame:
    rows = at_latest_per_frequency(t["credit_balance_by_size"], C.MONTHLY, C.QUARTERLY)
    return rows.select(*DETAIL, "share_pct").orderBy("client", "size", _desc("value"), "code")


def _metric_now(t: TableSet, view: str) -> DataFrame:
    return at_latest(t[view]).select(
        "code", "metric", "client", "origin", "modality", "period", "value", "change_year_pct"
    ).orderBy("metric", "client", "origin", _desc("value"), "code")


def cost_index_now(t: TableSet) -> DataFrame:
    return _metric_now(t, "credit_cost_index")


def term_now(t: TableSet) -> DataFrame:
    return _metric_now(t, "credit_term")


def lending_now(t: TableSet) -> DataFrame:
    return at_latest(t["credit_lending"]).select(
        "code", "client", "origin", "modality", "period", "value", "change_year_pct"
    ).orderBy("client", "origin", _desc("value"), "code")


def title_audit(t: TableSet) -> DataFrame:
    return unparsed_titles(t["credit_series"])


# --- 10 institutions -------------------------------------------------------------------------

KEYS = ["inst_id", "period"]


def segments(t: TableSet) -> DataFrame:
    """Registered and matched institutions per segment: two answers, two names."""
    t.stage("institution")
    now = at_latest(t["institution"]).filter(F.col("status") == "A")
    assets = t["income_statement"].select(*KEYS, "total_assets", F.lit(1).alias("_hit"))
    return (
        now.join(assets, KEYS, "left").groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("registered"), F.count("_hit").alias("with_statement"),
            F.round(M.exact_sum(F.col("total_assets")) / F.lit(1e6), 1).alias("assets_bn"),
        )
        .orderBy(_desc("assets_bn"), "segment")
    )


def _statement_now(t: TableSet, column: str) -> DataFrame:
    """Statement at the last quarter in which ``column`` is known.

    The quarter is read from the account rows, never from the pivoted view.
    """
    t.stage("statement_value", "institution")
    known = t["statement_value"].filter(
        F.col("account").isin(C.STATEMENT_COLUMNS[column]) & F.col("value").isNotNull()
    )
    of = known.join(t["institution"].select(*KEYS), KEYS, "left_semi")
    return at_latest(t["income_statement"], of)


def rank_by_income(t: TableSet) -> DataFrame:
    return _statement_now(t, "net_income").select(
        "inst_id", "name", "segment", "state", "status", "total_assets", "credit_interest_income",
        "credit_income", "credit_expected_loss", "expected_loss", "net_income",
    ).orderBy(_desc("net_income"), "inst_id")


def rank_by_credit_income(t: TableSet) -> DataFrame:
    return _statement_now(t, "credit_income").select(
        "inst_id", "name", "segment", "state", "total_assets", "credit_interest_income",
        "credit_income", "net_income",
    ).orderBy(_desc("credit_income"), "inst_id")


def registry(t: TableSet) -> DataFrame:
    return at_latest(t["institution"]).select(
        "inst_id", "name", "segment", "state", "city", "status", "consolidation"
    ).orderBy("segment", "name", "inst_id")


def largest_portfolios(t: TableSet, n: int = 30) -> DataFrame:
    """Keys of the largest firm portfolios at the last quarter."""
    t.stage("portfolio_value", "institution")
    sizes = t["portfolio_size"]
    totals = at_latest(sizes).filter(F.col("size") == C.FIRM_PORTFOLIO_TOTAL)
    return top_keys(totals, "inst_id", n, _desc("value"), F.col("inst_id"))


def _firm_cut(t: TableSet, view: str, label: str, where: Column) -> DataFrame:
    t.stage("portfolio_value", "institution")
    rows = at_latest(t[view]).filter(where)
    return rows.join(largest_portfolios(t), "inst_id", "left_semi").select(
        "inst_id", "name", "state", label, "value"
    ).orderBy("name", _desc("value"), label)


def _firms(bucket: str) -> Column:
    return (F.col("client") == C.CLIENT_FIRM) & (F.col("bucket") == bucket)


def firm_by_modality(t: TableSet) -> DataFrame:
    return _firm_cut(t, "portfolio_aging", "modality", _firms(C.BUCKET_TOTAL))


def firm_overdue(t: TableSet) -> DataFrame:
    return _firm_cut(t, "portfolio_aging", "modality", _firms(C.BUCKET_OVERDUE))


def firm_by_activity(t: TableSet) -> DataFrame:
    return _firm_cut(t, "portfolio_activity", "activity", F.col("bucket") == C.BUCKET_TOTAL)


def firm_by_size(t: TableSet) -> DataFrame:
    return _firm_cut(t, "portfolio_size", "size", F.lit(True))


def lending_rates_now(t: TableSet) -> DataFrame:
    return current_lending_rates(t).orderBy("segment", "modality", "year_rate", "tax_id8")


def current_lending_rates(t: TableSet) -> DataFrame:
    """The sheet's rows without its order."""
    t.stage("lending_rate")
    housing = F.col("modality").ilike(C.HOUSING_PATTERN)
    return at_two_latest(t["lending_rate"], "start_date", housing).select(
        "tax_id8", "institution", "segment", "modality", "month_rate", "year_rate"
    )


WORKBOOKS: dict[str, dict[str, Sheet]] = {
    "R1": {
        "monthly pulse": pulse, "credit panel": credit_panel, "regional activity": activity,
        "quarterly gdp": quarters,
    },
    "R2": {
        "latest position": sector_latest, "sector series": sector_series,
        "subsector series": subsector_series, "shares": sector_shares,
    },
    "R3": {
        "top 300 places": top_credit_places, "per capita": top_credit_per_capita,
        "state series": state_credit_series, "penetration": top_penetration,
    },
    "R4": {
        "gdp ranking": top_gdp, "gdp per capita": top_gdp_per_capita, "size matrix": size_matrix,
        "gdp by state": state_gdp,
    },
    "R5": {
        "nation by section": companies_by_section, "state by section": companies_by_state,
        "top places": top_company_places, "density": company_density,
    },
    "R6": {
        "by division": jobs_by_division, "by section": jobs_by_section, "by state": jobs_by_state,
        "top places": top_job_places, "national series": national_jobs_series,
    },
    "R7": {
        "state panel": state_panel, "credit by state": state_credit_total,
        "jobs by state": state_net_jobs,
    },
    "R8": {"ranking": ranking, "by band": band_means, "sector crosswalk": sectors},
    "R9": {
        "rates": rates_now, "defaults": defaults_now, "balances": balances_now,
        "cost index": cost_index_now, "term": term_now, "new lending": lending_now,
        "title audit": title_audit,
    },
    "R10": {
        "segments": segments, "net income": rank_by_income, "credit income": rank_by_credit_income,
        "registry": registry, "firm modality": firm_by_modality, "firm overdue": firm_overdue,
        "firm activity": firm_by_activity, "firm size": firm_by_size,
        "lending rates": lending_rates_now,
    },
}


def sheets() -> dict[str, Sheet]:
    """``R3_1`` style key -> sheet."""
    return {
        f"{book}_{i}": sheet
        for book, pages in WORKBOOKS.items()
        for i, sheet in enumerate(pages.values(), 1)
    }

