"""GDP, employment, companies and the multi-source scorecards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat import constants as C
from regiostat.functions import metrics as M
from regiostat.operators import windows as W
from regiostat.operators.crosswalk import totals_by_list
from regiostat.operators.latest import at_latest, trailing_year
from regiostat.operators.ranking import with_ranks
from regiostat.plans.credit import latest_population
from regiostat.tables import TableSet

# Fact tables that the scorecards read several times.
SCORECARD_TABLES = [
    "place", "population_ref", "place_gdp", "place_balance", "place_jobs", "place_company",
]
VA_PARTS = ["va_agri", "va_industry", "va_services", "va_public"]
GDP_AMOUNTS = ["gdp", "taxes", "va_total", *VA_PARTS]


def place_gdp_profile(t: TableSet) -> DataFrame:
    """GDP per place and year: per capita, share in the state, composition, two ranks."""
    t.stage("place", "place_gdp", "population_ref")
    rows = (
        t["place_gdp"].join(t["place"].select("place_id", "name", "state", "region"), "place_id")
        .join(t["population_ref"], ["place_id", "year"], "left")
        .withColumn("gdp_per_capita", M.ratio(F.col("gdp"), F.col("population"), 1000, 2))
    )
    ranks = {"national_rank": ["year"], "state_rank": ["state", "year"]}
    shared = W.share_of_group(
        with_ranks(rows, "gdp", ranks), "gdp", ["state", "year"], "state_share_pct", 3, of=rows
    )
    pct = {f"pct_{p[3:]}": M.ratio(F.col(p), F.col("va_total"), 100, 1) for p in VA_PARTS}
    return shared.withColumns(pct).select(
        "place_id", "name", "state", "region", "year", *GDP_AMOUNTS, "population",
        "gdp_per_capita", "state_share_pct", *pct, "national_rank", "state_rank",
    )


def place_size(t: TableSet) -> DataFrame:
    """Size bands of each place at the last GDP year."""
    return at_latest(t["place_gdp_profile"], t["place_gdp"], "year").select(
        "place_id", "name", "state", "region", "year", "gdp", "population", "gdp_per_capita",
        M.gdp_band(F.col("gdp")).alias("gdp_band"),
        M.population_band(F.col("population")).alias("population_band"),
        "pct_agri", "pct_industry", "pct_services", "pct_public",
    )


def quarter_gdp_view(t: TableSet) -> DataFrame:
    return t["quarter_gdp"].select(
        "quarter", "sector", "volume_index", "rate_vs_prev_quarter", "rate_vs_prev_year_quarter",
        "rate_4q", "rate_ytd",
    )


JOB_COUNTS = ["hires", "leavers", "net"]


def _job_sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in JOB_COUNTS]


def sector_jobs(t: TableSet) -> DataFrame:
    """Jobs by activity division and month, weighted hiring wage, rolling 12."""
    sums = t["place_jobs"].groupBy("period", "division").agg(
        *_job_sums(), M.weighted_mean(F.col("mean_wage"), F.col("hires")).alias("mean_wage")
    )
    names = t["division"].select(
        "division", "section", "section_name", F.col("name").alias("division_name")
    )
    return sums.join(names, "division", "left").select(
        "period", "division", "section", "section_name", "division_name", *JOB_COUNTS, "mean_wage",
        W.rolling_sum("net", ["division"]).alias("net_12m"),
    )


def place_employment(t: TableSet) -> DataFrame:
    """Jobs by place and month, rolling 12, per 1,000 inhabitants of the latest year."""
    sums = t["place_jobs"].groupBy("period", "place_id").agg(*_job_sums())
    return (
        sums.withColumn("net_12m", W.rolling_sum("net", ["place_id"]))
        .join(t["place"].select("place_id", "name", "state", "region"), "place_id")
        .join(latest_population(t), "place_id", "left")
        .select(
            "period", "place_id", "name", "state", "region", *JOB_COUNTS, "net_12m",
            M.ratio(F.col("net_12m"), F.col("population"), 1000, 2).alias("net_12m_per_1000"),
        )
    )


def state_employment(t: TableSet) -> DataFrame:
    by_place = t["place_jobs"].groupBy("period", "place_id").agg(*_job_sums())
    sums = by_place.join(t["place"].select("place_id", "state"), "place_id").groupBy(
        "period", "state"
    ).agg(*_job_sums())
    return sums.withColumn("net_12m", W.rolling_sum("net", ["state"]))


def section_names(t: TableSet) -> DataFrame:
    """One name per section."""
    return t["division"].groupBy("section").agg(F.min("section_name").alias("section_name"))


def place_companies(t: TableSet) -> DataFrame:
    return (
        t["place_company"].join(
            t["place"].select("place_id", "name", "state", "region"), "place_id"
        )
        .join(section_names(t), "section", "left")
        .join(t["population_ref"], ["place_id", "year"], "left")
        .select(
            "year", "place_id", "name", "state", "region", "section", "section_name", "companies",
            "staff", "paid_staff", "wages",
            M.ratio(F.col("companies"), F.col("population"), 1000, 2).alias("companies_per_1000"),
        )
    )


def national_employment(t: TableSet, cut: int = C.NEW_ERA_START) -> DataFrame:
    """Both eras of the national series; the window runs over one row per month."""
    rows = t["national_jobs"].select("period", "era", *JOB_COUNTS)
    old = rows.filter(F.col("era") == C.ERA_OLD)
    new = rows.filter((F.col("era") == C.ERA_NEW) & (F.col("period") >= cut))
    return old.unionByName(new).withColumn("net_12m", W.rolling_sum("net", []))


def _latest_value_added(t: TableSet) -> DataFrame:
    t.stage("place_gdp")
    sums = at_latest(t["place_gdp"], period="year").agg(
        *[M.exact_sum(F.col(c)).alias(name) for name, c in C.VALUE_ADDED_SECTORS.items()],
        F.max("year").alias("va_year"),
    )
    return sums.unpivot("va_year", list(C.VALUE_ADDED_SECTORS), "value_added_sector", "value_added")


def _latest_companies(t: TableSet, *columns: str) -> DataFrame:
    t.stage("place_company")
    rows = t["place_company"].select("year", "section", "place_id", *columns)
    return at_latest(rows, period="year")


def _section_jobs(t: TableSet) -> DataFrame:
    """Last 12 months of jobs per section: reduced to divisions before the small join."""
    t.stage("place_jobs")
    recent = trailing_year(t["place_jobs"].select("period", "division", "net", "hires"))
    by_division = recent.groupBy("division").agg(F.sum("net").alias("n"), F.sum("hires").alias("h"))
    return (
        by_division.join(t["division"].select("division", "section"), "division")
        .groupBy("section")
        .agg(F.sum("n").alias("net_12m"), F.sum("h").alias("hires_12m"))
    )


def sector_crosswalk(t: TableSet) -> DataFrame:
    """Credit, value added, jobs and companies side by side for each consolidated sector."""
    t.stage("series_value", "place_gdp", "place_jobs", "place_company")
    sector_codes = t["series"].filter(F.col("family") == C.FAMILY_SECTOR).select("code")
    sector_values = t["series_value"].join(sector_codes, "code", "left_semi")
    credit = (
        at_latest(t["sector_credit"].filter(F.col("level") == C.LEVEL_SECTOR), sector_values)
        .groupBy(F.col("sector").alias("series_sector"))
        .agg(M.exact_sum(F.col("value")).alias("credit"), F.max("period").alias("credit_period"))
    )
    added = _latest_value_added(t)
    all_added = added.agg(M.exact_sum(F.col("value_added")).alias("v")).scalar()
    sectors = t["sector_map"]
    jobs = totals_by_list(
        sectors, "sector", "sections", _section_jobs(t), "section",
        [F.sum("net_12m").alias("net_12m"), F.sum("hires_12m").alias("hires_12m")],
    )
    per_section = _latest_companies(t, "companies", "staff").groupBy("section").agg(
        M.exact_sum(F.col("companies")).alias("companies"), M.exact_sum(F.col("staff")).alias("staff")
    )
    firms = totals_by_list(
        sectors, "sector", "sections", per_section, "section",
        [
            M.exact_sum(F.col("companies")).alias("companies"),
            M.exact_sum(F.col("staff")).alias("staff"),
        ],
    )
    return (
        sectors.join(credit, "series_sector", "left")
        .join(added, "value_added_sector", "left")
        .join(jobs, "sector", "left")
        .join(firms, "sector", "left")
        .select(
            "sector", "credit", "credit_period", "value_added", "va_year",
            M.ratio(F.col("value_added"), all_added, 100, 1).alias("value_added_share_pct"),
            "net_12m", "hires_12m", "companies", "staff",
        )
    )


def _left_all(key: str, first: DataFrame, *others: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.join(b, key, "left"), others, first)


def state_scorecard(t: TableSet) -> DataFrame:
    """One row per state from five sources, each reduced to places before the dimension join."""
    t.stage(*SCORECARD_TABLES)
    state_of = t["place"].select("place_id", "state")

    def by_state(per_place: DataFrame, *sums: Column) -> DataFrame:
        return per_place.join(state_of, "place_id").groupBy("state").agg(*sums)

    gdp = by_state(
        at_latest(t["place_gdp"], period="year").select("place_id", "gdp", "year"),
        M.exact_sum(F.col("gdp")).alias("gdp"), F.max("year").alias("gdp_year"),
    )
    people = by_state(latest_population(t), M.exact_sum(F.col("population")).alias("population"))
    credit = at_latest(t["place_credit"], t["place_balance"]).groupBy("state").agg(
        M.exact_sum(F.col("credit_total")).alias("credit"),
        M.exact_sum(F.col("credit_12m_before")).alias("_credit_before"),
        F.max("period").alias("credit_period"),
    )
    recent = trailing_year(t["place_jobs"].select("place_id", "period", "net"))
    jobs = by_state(
        recent.groupBy("place_id").agg(F.sum("net").alias("net")),
        F.sum("net").alias("net_12m"),
    )
    firms = by_state(
        _latest_companies(t, "companies").groupBy("place_id").agg(
            M.exact_sum(F.col("companies")).alias("companies")
        ),
        M.exact_sum(F.col("companies")).alias("companies"),
    )
    states = t["place"].select("state", "region").distinct()
    people_col = F.col("population")
    return _left_all("state", states, gdp, people, credit, jobs, firms).select(
        "state", "region", "population", "gdp", "gdp_year",
        M.ratio(F.col("gdp"), people_col, 1000, 0).alias("gdp_per_capita"),
        "credit", "credit_period",
        M.pct_change(F.col("credit"), F.col("_credit_before")).alias("credit_change_12m_pct"),
        M.ratio(F.col("credit"), F.col("gdp"), 100, 1).alias("credit_gdp_pct"),
        M.ratio(F.col("credit"), people_col, 1000, 0).alias("credit_per_capita"),
        "net_12m",
        M.ratio(F.col("net_12m"), people_col, 1000, 2).alias("net_12m_per_1000"),
        "companies",
        M.ratio(F.col("companies"), people_col, 1000, 1).alias("companies_per_1000"),
    )


def state_gdp_history(t: TableSet) -> DataFrame:
    """State GDP per year, composition over the four components, share of the nation."""
    sums = (
        t["place_gdp"].join(t["place"].select("place_id", "state", "region"), "place_id")
        .join(t["population_ref"], ["place_id", "year"], "left")
        .groupBy("state", "region", "year")
        .agg(*[M.exact_sum(F.col(c)).alias(c) for c in ["gdp", *VA_PARTS, "population"]])
    )
    nation = sums.groupBy("year").agg(M.exact_sum(F.col("gdp")).alias("_nation"))
    parts = F.col("va_agri") + F.col("va_industry") + F.col("va_services") + F.col("va_public")
    return sums.join(nation, "year").select(
        "state", "region", "year", "gdp", "population",
        M.ratio(F.col("gdp"), F.col("population"), 1000, 0).alias("gdp_per_capita"),
        M.ratio(F.col("va_agri"), parts, 100, 1).alias("pct_agri"),
        M.ratio(F.col("va_industry"), parts, 100, 1).alias("pct_industry"),
        M.ratio(F.col("va_services"), parts, 100, 1).alias("pct_services"),
        M.ratio(F.col("gdp"), F.col("_nation"), 100, 2).alias("national_share_pct"),
    )


def section_scorecard(t: TableSet) -> DataFrame:
    t.stage("place_jobs", "place_company")
    firms = _latest_companies(t, "companies", "staff", "wages").groupBy("section").agg(
        *[M.exact_sum(F.col(c)).alias(c) for c in ["companies", "staff", "wages"]]
    )
    all_firms = firms.agg(M.exact_sum(F.col("companies")).alias("v")).scalar()
    return (
        section_names(t).join(firms, "section", "left")
        .join(_section_jobs(t), "section", "left")
        .filter(F.col("companies").isNotNull() | F.col("net_12m").isNotNull())
        .select(
            "section", "section_name", "companies", "staff", "wages", "net_12m", "hires_12m",
            M.ratio(F.col("companies"), all_firms, 100, 2).alias("companies_share_pct"),
        )
    )


def section_by_state(t: TableSet) -> DataFrame:
    sums = (
        _latest_companies(t, "companies", "staff")
        .join(t["place"].select("place_id", "state"), "place_id")
        .groupBy("state", "section", "year")
        .agg(*[M.exact_sum(F.col(c)).alias(c) for c in ["companies", "staff"]])
    )
    return sums.join(section_names(t), "section", "left").select(
        "state", "section", "section_name", "year", "companies", "staff"
    )


def place_ranking(t: TableSet) -> DataFrame:
    """One row per place with the latest position of every source."""
    t.stage(*SCORECARD_TABLES, "place_presence")
    t.stage("place_credit")
    gdp = at_latest(t["place_gdp_profile"], t["place_gdp"], "year").select(
        "place_id", "gdp", "gdp_per_capita", F.col("national_rank").alias("gdp_rank")
    )
    credit = t["place_credit_per_capita"].select(
        "place_id", "credit_total", "credit_change_12m_pct", "credit_per_capita",
        F.col("national_rank").alias("credit_rank"),
    )
    reach = t["credit_penetration"].select("place_id", "credit_gdp_pct")
    jobs = at_latest(t["place_employment"], t["place_jobs"]).select(
        "place_id", "net_12m", "net_12m_per_1000"
    )
    firms = _latest_companies(t, "companies").groupBy("place_id").agg(
        M.exact_sum(F.col("companies")).alias("companies")
    )
    places = t["place"].select("place_id", "name", "state", "region", "is_capital")
    return _left_all("place_id", places, latest_population(t), gdp, credit, reach, jobs, firms).select(
        "place_id", "name", "state", "region", "is_capital", "population", "gdp",
        "gdp_per_capita", "gdp_rank", "credit_total", "credit_change_12m_pct",
        "credit_per_capita", "credit_rank", "credit_gdp_pct", "net_12m", "net_12m_per_1000",
        "companies",
        M.ratio(F.col("companies"), F.col("population"), 1000, 1).alias("companies_per_1000"),
    )


VIEWS = {
    "place_gdp_profile": place_gdp_profile,
    "place_size": place_size,
    "quarter_gdp_view": quarter_gdp_view,
    "sector_jobs": sector_jobs,
    "place_employment": place_employment,
    "state_employment": state_employment,
    "place_companies": place_companies,
    "national_employment": national_employment,
    "sector_crosswalk": sector_crosswalk,
    "state_scorecard": state_scorecard,
    "state_gdp_history": state_gdp_history,
    "section_scorecard": section_scorecard,
    "section_by_state": section_by_state,
    "place_ranking": place_ranking,
}
