"""Dashboard datasets. Panels are one nested row per entity; series share one period axis."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat import constants as C
from regiostat.functions import metrics as M
from regiostat.functions.clean import region_code
from regiostat.functions.periods import december_before, previous_month, same_month_last_year
from regiostat.operators import series as S
from regiostat.operators.latest import (
    at_latest,
    latest,
    period_axis,
    year_axis,
)
from regiostat.operators.pivot import pivot_max
from regiostat.operators.ranking import (
    top,
    top_keys,
    top_per_group,
    top_series_and_rest,
    with_rank,
)
from regiostat.operators.statements import broken_totals, with_statement_metrics
from regiostat.plans.institutions import statement_of
from regiostat.plans.reports import current_lending_rates
from regiostat.tables import TableSet

HISTORY_YEARS = 10
HISTORY_MONTHS = 120
TOP_PRODUCTS = 12
TOP_PORTFOLIOS = 5
PLACE_ACTIVITIES = 6
STATE_ACTIVITIES = 8
# Fact tables that the map reads several times.
MAP_TABLES = [
    "place", "place_gdp", "population_ref", "place_balance", "place_jobs", "place_company", "insolvency",
]
TOP_STATEMENTS = 50
TOP_FIRM_PORTFOLIOS = 30
TOP_IN_SEGMENT = 10
QUARTERS_PER_YEAR = 4
STATEMENT_YEARS = 12
RATE_YEARS = 5


def _desc(c: str) -> Column:
    return F.col(c).desc_nulls_last()


# --- D1 .. D6: credit dashboard ---------------------------------------------------------------

SERIES_COLUMNS = [
    "balance_total", "balance_firms", "balance_households", "rate_total", "default_total",
    "credit_gdp_pct",
]


def credit_series_panel(t: TableSet) -> DataFrame:
    return t["credit_macro"].select("period", *SERIES_COLUMNS)


def credit_headline(t: TableSet) -> DataFrame:
    """Last month against the same month one year before, one row from one pass."""
    columns = ["balance_total", "rate_total", "default_total", "credit_gdp_pct"]
    one = S.by_period(t["credit_macro"], columns)
    now, before = S.at(F.col("period")), S.at(F.col("period") - 100)
    b, r, d = "balance_total", "rate_total", "default_total"
    return one.select(
        "period", now[b].alias(b),
        M.pct_change_nonzero(now[b], before[b]).alias("balance_change_12m_pct"),
        now[r].alias(r), M.point_change(now[r], before[r]).alias("rate_change_12m_pp"),
        now[d].alias(d), M.point_change(now[d], before[d]).alias("default_change_12m_pp"),
        now["credit_gdp_pct"].alias("credit_gdp_pct"),
    )


def product_ranking(
    t: TableSet,
    view: str,
    client: str | None = None,
    metric: str | None = None,
    quarterly: bool = True,
    n: int = TOP_PRODUCTS,
) -> DataFrame:
    """Mean value per product at the latest position, top N on the rounded mean."""
    rows = t[view]
    last = latest(rows, where=(F.col("frequency") == C.QUARTERLY) if quarterly else None)
    rows = rows.filter((F.col("period") == last) & F.col("modality").isNotNull())
    if client:
        rows = rows.filter(F.col("client") == client)
    if metric:
        rows = rows.filter(F.col("metric") == metric)
    means = rows.groupBy("modality").agg(F.round(M.exact_mean(F.col("value")), 1).alias("value"))
    return top(means, n, _desc("value"), F.col("modality"))


def rate_ranking(t: TableSet) -> DataFrame:
    return product_ranking(t, "credit_rates", C.CLIENT_FIRM)


def default_ranking(t: TableSet) -> DataFrame:
    return product_ranking(t, "credit_defaults", C.CLIENT_FIRM)


def term_ranking(t: TableSet) -> DataFrame:
    return product_ranking(t, "credit_term", metric="PRAZO_MEDIO_CARTEIRA", quarterly=False)


def leaf_products(t: TableSet, metric: str, search: str) -> DataFrame:
    """Series of one family without nested or parallel products (nothing is counted twice)."""
    nested = t.spark.createDataFrame([(p,) for p in C.NESTED_PRODUCTS], "modality string")
    family = (F.col("metric") == metric) & (F.col("search") == search)
    rows = t["credit_series"].filter(family & F.col("modality").isNotNull())
    return rows.join(nested, "modality", "left_anti")


def _largest_now(t: TableSet, candidates: DataFrame, n: int) -> DataFrame:
    now = at_latest(t["credit_value"]).select("code", "value")
    return top(candidates.join(now, "code"), n, _desc("value"), F.col("code"))


def lending_ranking(t: TableSet, n: int = TOP_PRODUCTS) -> DataFrame:
    chained = F.coalesce(F.contains("modality", F.lit(C.CHAINED_SERIES)), F.lit(False))
    products = leaf_products(t, "CONCESSAO", C.SEARCH_LENDING).filter(~chained)
    return _largest_now(t, products, n).select(
        "code", M.with_client(F.col("modality"), F.col("client")).alias("label"),
        F.round("value", 1).alias("value"),
    )


def balance_by_size(t: TableSet) -> DataFrame:
    rows = t["credit_balance_by_size"]
    now = at_latest(rows, where=F.col("frequency") == C.QUARTERLY)
    return now.groupBy("client", "size").agg(
        F.round(M.exact_sum(F.col("value")), 0).alias("value")
    )


def largest_portfolios_history(
    t: TableSet, total_code: int = C.TOTAL_BALANCE_SERIES, n: int = TOP_PORTFOLIOS
) -> DataFrame:
    """Monthly history of the largest products, the rest and the total."""
    t.stage("credit_value")
    products = leaf_products(t, "SALDO", C.SEARCH_BALANCE)
    label = F.concat(M.with_client(F.col("modality"), F.col("client")))
    chosen = _largest_now(t, products, n).select("code", label.alias("label"))
    values = t["credit_value"].select("code", "period", "value")
    total = values.filter(F.col("code") == total_code).select("period", "value")
    return top_series_and_rest(values, total, chosen)


def invoice_rate(t: TableSet) -> DataFrame:
    """Invoice discount rate per year and per month at the last period, 12-month change."""
    units = {"yearly": C.INVOICE_RATE_YEARLY, "monthly": C.INVOICE_RATE_MONTHLY}
    wide = pivot_max(
        t["series_value"].filter(F.col("code").isin(list(units.values()))),
        ["period"], "code", "value", units,
    )
    last = F.max(F.when(F.col("yearly").isNotNull(), F.col("period")))
    one = S.by_period(wide, list(units), last)
    now, before = S.at(F.col("period")), S.at(F.col("period") - 100)
    return one.filter(F.col("period").isNotNull()).select(
        "period", now["yearly"].alias("yearly"), now["monthly"].alias("monthly"),
        M.point_change(now["yearly"], before["yearly"]).alias("change_12m_pp"),
    )


def total_rate_monthly(t: TableSet) -> DataFrame:
    rows = t["series_value"].filter(F.col("code") == C.TOTAL_RATE_MONTHLY)
    return rows.agg(F.max_by("value", "period").alias("value"))


# --- D7 .. D13: map -------------------------------------------------------------------------


def axes(t: TableSet) -> dict[str, Column]:
    """The shared period axes of the map, each a scalar array."""
    t.stage(*MAP_TABLES)
    months = HISTORY_MONTHS
    return {
        "gdp": year_axis(t["place_gdp"], HISTORY_YEARS),
        "credit": period_axis(t["place_balance"], last=months),
        "jobs": period_axis(t["place_jobs"], last=months),
        "companies": period_axis(t["place_company"], "year", HISTORY_YEARS),
        "population": year_axis(t["population_ref"], HISTORY_YEARS),
        "insolvency": period_axis(t["insolvency"], last=months),
    }


def axis_rows(t: TableSet) -> DataFrame:
    """(axis, position, period) for every axis."""
    one = t.spark.range(1)
    tagged = F.array(
        *[
            F.struct(F.lit(name).alias("axis"), axis.alias("periods"))
            for name, axis in axes(t).items()
        ]
    )
    return one.select(F.explode(tagged).alias("a")).select(
        "a.axis", F.posexplode("a.periods").alias("position", "period")
    )


def map_totals(t: TableSet) -> DataFrame:
    return t["place_ranking"].agg(
        *[
            M.exact_sum(F.col(c)).alias(f"total_{c}")
            for c in ("gdp", "credit_total", "companies", "population")
        ],
        F.count(F.lit(1)).alias("places"),
    ).select(
        "*",
        latest(t["place_gdp"], "year").alias("gdp_year"),
        latest(t["place_gdp"], "year", F.col("va_agri").isNotNull()).alias("composition_year"),
        latest(t["place_company"], "year").alias("company_year"),
        latest(t["place_balance"]).alias("credit_period"),
        latest(t["place_jobs"]).alias("jobs_period"),
    )


def product_breakdown(rows: DataFrame, key: str, of: DataFrame) -> DataFrame:
    """Label/value list of the credit products at the last period."""
    return at_latest(rows, of).select(key, S.label_values(C.PRODUCT_LABELS).alias("products"))


def _left_all(first: DataFrame, key: str, others: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.join(b, key, "left"), others, first)


PLACE_HISTORIES = {
    "hist_gdp": "gdp", "hist_credit": "credit", "hist_jobs": "jobs",
    "hist_companies": "companies", "hist_population": "population",
    "hist_population_gdp": "gdp",
}


def place_histories(t: TableSet) -> list[DataFrame]:
    t.stage(*MAP_TABLES)
    ax = axes(t)
    key = ["place_id"]
    companies = t["place_company"].groupBy("place_id", "year").agg(
        M.exact_sum(F.col("companies")).alias("companies")
    )
    people = t["population_ref"]
    return [
        S.align(t["place_gdp"], key, {"gdp": "hist_gdp"}, ax["gdp"], "year"),
        S.align(t["place_credit"], key, {"credit_total": "hist_credit"}, ax["credit"]),
        S.align(t["place_employment"], key, {"net_12m": "hist_jobs"}, ax["jobs"]),
        S.align(companies, key, {"companies": "hist_companies"}, ax["companies"], "year"),
        S.align(people, key, {"population": "hist_population"}, ax["population"], "year"),
        S.align(people, key, {"population": "hist_population_gdp"}, ax["gdp"], "year"),
    ]


def place_activities(t: TableSet, n: int = PLACE_ACTIVITIES) -> DataFrame:
    """The largest activities of each place at the last year."""
    t.stage("place_company")
    rows = at_latest(t["place_companies"], t["place_company"], "year")
    rows = rows.filter(F.col("companies").isNotNull()).select(
        "place_id", "section", "section_name", "companies"
    )
    return top_per_group(rows, n, ["place_id"], _desc("companies"), F.col("section"))


def state_activities(t: TableSet, n: int = STATE_ACTIVITIES) -> DataFrame:
    rows = t["section_by_state"].filter(F.col("companies").isNotNull()).select(
        "state", "section", "section_name", "companies"
    )
    return top_per_group(rows, n, ["state"], _desc("companies"), F.col("section"))


def _activity_list(rows: DataFrame, key: str) -> DataFrame:
    entry = F.struct("position", F.col("section_name").alias("label"), F.col("companies").alias("value"))
    ordered = F.array_sort(F.collect_list(entry))
    return rows.groupBy(key).agg(
        F.transform(ordered, lambda e: F.struct(e["label"].alias("label"), e["value"].alias("value")))
        .alias("activities")
    )


def place_profile(t: TableSet) -> DataFrame:
    """Flat part of the place panel: ranking, coordinates, bands."""
    t.stage(*MAP_TABLES, "place_presence")
    t.stage("place_gdp_profile")
    dims = t["place"].select("place_id", "lat", "lng", "name_key")
    bands = t["place_size"].select("place_id", "gdp_band", "population_band")
    return t["place_ranking"].join(dims, "place_id").join(bands, "place_id", "left")


def place_panel(t: TableSet) -> DataFrame:
    """One nested row per place: profile, six aligned histories, activities, products."""
    t.stage(*MAP_TABLES, "place_presence")
    t.stage("place_credit", "place_employment", "place_companies", "place_gdp_profile")
    panel = _left_all(
        place_profile(t), "place_id",
        [
            *place_histories(t),
            _activity_list(place_activities(t), "place_id"),
            product_breakdown(t["place_credit"], "place_id", t["place_balance"]),
        ],
    )
    return panel


STATE_HISTORIES = {
    "hist_gdp": "gdp", "hist_population_gdp": "gdp", "hist_population": "population",
    "hist_credit": "credit", "hist_jobs": "jobs", "hist_companies": "companies",
    "hist_judicial": "insolvency", "hist_extrajudicial": "insolvency",
    "hist_bankruptcy": "insolvency",
}


def state_histories(t: TableSet) -> list[DataFrame]:
    t.stage(*MAP_TABLES)
    t.stage("state_gdp_history")
    ax = axes(t)
    key = ["state"]
    state_of = t["place"].select("place_id", "state")
    companies = (
        t["place_company"].groupBy("place_id", "year")
        .agg(M.exact_sum(F.col("companies")).alias("companies"))
        .join(state_of, "place_id").groupBy("state", "year")
        .agg(M.exact_sum(F.col("companies")).alias("companies"))
    )
    people = t["population_ref"].join(state_of, "place_id").groupBy("state", "year").agg(
        M.exact_sum(F.col("population")).alias("population")
    )
    courts = t["insolvency_state"].groupBy("state", "period").agg(
        *[F.sum(c).alias(c) for c in C.INSOLVENCY_COLUMNS]
    )
    return [
        S.align(
            t["state_gdp_history"], key,
            {"gdp": "hist_gdp", "population": "hist_population_gdp"}, ax["gdp"], "year",
        ),
        S.align(people, key, {"population": "hist_population"}, ax["population"], "year"),
        S.align(t["state_credit"], key, {"credit_total": "hist_credit"}, ax["credit"]),
        S.align(t["state_employment"], key, {"net_12m": "hist_jobs"}, ax["jobs"]),
        S.align(companies, key, {"companies": "hist_companies"}, ax["companies"], "year"),
        S.align(
            courts, key, {c: f"hist_{c}" for c in C.INSOLVENCY_COLUMNS}, ax["insolvency"]
        ),
    ]


def state_profile(t: TableSet) -> DataFrame:
    """Flat part of the state panel: scorecard and GDP composition of the last known year."""
    year = latest(t["place_gdp"], "year", F.col("va_agri").isNotNull())
    parts = t["state_gdp_history"].filter(F.col("year") == year).select(
        "state", "pct_agri", "pct_industry", "pct_services"
    )
    return t["state_scorecard"].join(parts, "state", "left")


def regional_balances(t: TableSet) -> DataFrame:
    """Balances by client and size of each state's region (the finest cut published)."""
    now = at_latest(t["credit_balance_by_region"]).select(
        F.col("region").alias("_code"), "code", "client", "size", "value"
    )
    states = t["place"].select("state", region_code(F.col("region")).alias("_code")).distinct()
    return states.join(now, "_code").filter(F.col("value").isNotNull()).drop("_code")


def state_panel(t: TableSet) -> DataFrame:
    balances = regional_balances(t).groupBy("state").agg(
        F.sort_array(F.collect_list(F.struct("client", "size", "code", "value"))).alias("balances")
    )
    return _left_all(
        state_profile(t), "state",
        [
            *state_histories(t),
            _activity_list(state_activities(t), "state"),
            product_breakdown(t["state_credit"], "state", t["place_balance"]),
            balances,
        ],
    )


def activity_ranking(t: TableSet) -> DataFrame:
    return t["section_scorecard"].select(
        "section", "section_name", "companies", "companies_share_pct", "net_12m"
    ).orderBy(_desc("companies"), "section")


def insolvency_ranking(t: TableSet) -> DataFrame:
    """Latest month by state with each state's share of the national count."""
    now = at_latest(t["insolvency_state"], t["insolvency"])
    nation = t["insolvency_national"].select(
        "period", *[F.col(c).alias(f"national_{c}") for c in C.INSOLVENCY_COLUMNS]
    )
    rows = now.join(nation, "period")
    shares = {
        f"{c}_share_pct": M.ratio(F.col(c), F.col(f"national_{c}"), 100, 1)
        for c in C.INSOLVENCY_COLUMNS
    }
    return rows.withColumns(shares)


def credit_gdp_history(t: TableSet) -> DataFrame:
    rows = t["credit_macro"].filter(F.col("credit_gdp_pct").isNotNull())
    return rows.select("period", "credit_gdp_pct")


def outlines(t: TableSet) -> DataFrame:
    return t["state_outline"].select("state", "geometry")


# --- D14, D15 ---------------------------------------------------------------------------------

GDP_SERIES = {
    "volume_index": "hist_index", "rate_vs_prev_quarter": "hist_vs_prev_quarter",
    "rate_vs_prev_year_quarter": "hist_vs_prev_year", "rate_4q": "hist_4q",
    "rate_ytd": "hist_ytd",
}


def gdp_classes(t: TableSet) -> DataFrame:
    return t.spark.createDataFrame(
        [(s, g, level) for s, (g, level) in C.GDP_SECTORS.items()],
        "sector string, sector_group string, level string",
    )


def gdp_sector_panel(t: TableSet) -> DataFrame:
    """Five aligned histories per classified sector."""
    axis = period_axis(t["quarter_gdp"], "quarter")
    rows = S.align(t["quarter_gdp"], ["sector"], GDP_SERIES, axis, "quarter")
    return rows.join(gdp_classes(t), "sector")


def insolvency_panel(t: TableSet) -> DataFrame:
    """National history per class with step, step percent and 12-step percent changes."""
    axis = period_axis(t["insolvency"])
    wide = S.align(
        t["insolvency_national"].withColumn("scope", F.lit("BR")), ["scope"],
        {c: c for c in C.INSOLVENCY_COLUMNS}, axis,
    )
    classes = F.array(
        *[F.struct(F.lit(c).alias("class"), F.col(c).alias("hist")) for c in C.INSOLVENCY_COLUMNS]
    )
    rows = wide.select(F.explode(classes).alias("c")).select("c.class", "c.hist")
    return rows.withColumns({f"hist_{k}": v for k, v in S.position_changes(F.col("hist")).items()})


def insolvency_state_panel(t: TableSet) -> DataFrame:
    axis = period_axis(t["insolvency"])
    courts = t["insolvency_state"].groupBy("state", "period").agg(
        *[F.sum(c).alias(c) for c in C.INSOLVENCY_COLUMNS]
    )
    regions = t["place"].select("state", "region").distinct()
    rows = S.align(courts, ["state"], {c: f"hist_{c}" for c in C.INSOLVENCY_COLUMNS}, axis)
    return rows.join(regions, "state", "left")


# --- D16 .. D19: institutions -----------------------------------------------------------------

KEYS = ["inst_id", "period"]


def _assets(t: TableSet) -> DataFrame:
    """Total assets straight from the account rows: no pivot for one account."""
    rows = t["statement_value"].filter(
        (F.col("account") == C.TOTAL_ASSETS_ACCOUNT) & F.col("value").isNotNull()
    )
    return rows.select(*KEYS, F.col("value").alias("total_assets"))


def _bn(c: str) -> Column:
    return F.round(M.exact_sum(F.col(c)) / F.lit(1e6), 2).alias("assets_bn")


def segment_totals(t: TableSet) -> DataFrame:
    """Active institutions with a statement, and their assets, per segment."""
    t.stage("institution")
    now = at_latest(t["institution"]).filter(F.col("status") == "A")
    return now.join(_assets(t), KEYS, "left").groupBy("segment").agg(
        F.count("total_assets").alias("institutions"), _bn("total_assets")
    )


def system_evolution(t: TableSet, years: int = RATE_YEARS) -> DataFrame:
    axis = period_axis(t["institution"], last=years * QUARTERS_PER_YEAR)
    active = t["institution"].filter(F.col("status") == "A")
    rows = active.filter(F.array_contains(axis, F.col("period")))
    matched = F.when(F.col("total_assets").isNotNull(), F.col("inst_id"))
    return rows.join(_assets(t), KEYS, "left").groupBy("period").agg(
        F.count_distinct(matched).alias("institutions"), _bn("total_assets")
    )


def active_institutions(t: TableSet) -> DataFrame:
    """Active institutions of the last quarter with assets, income and yearly return."""
    t.stage("institution")
    last = latest(t["institution"])
    values = t["statement_value"].filter(F.col("period") == last)
    rows = statement_of(t, values).filter(
        (F.col("status") == "A") & F.col("total_assets").isNotNull()
    )
    return rows.select(
        "inst_id", "name", "segment", "state", "total_assets", "net_income",
        M.return_on_assets(F.col("net_income"), F.col("total_assets"), F.col("period")).alias("roa"),
    )


def segment_leaders(t: TableSet, n: int = TOP_IN_SEGMENT) -> DataFrame:
    rows = active_institutions(t).filter(F.col("segment").isNotNull())
    return top_per_group(rows, n, ["segment"], _desc("total_assets"), F.col("inst_id"))


def statement_scope(
    t: TableSet,
    n: int = TOP_STATEMENTS,
    states: list[str] | None = None,
    cities: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """Keys kept in the history: national top N, or based in a listed state or city; all live."""
    t.stage("statement_value", "institution")
    states = C.FULL_COVERAGE_STATES if states is None else states
    cities = C.FULL_COVERAGE_CITIES if cities is None else cities
    live = at_latest(_assets(t), t["statement_value"])
    largest = top_keys(live, "inst_id", n, _desc("total_assets"), F.col("inst_id"))
    based = F.col("state").isin(states)
    for state, city in cities:
        based = based | ((F.col("state") == state) & (F.col("city") == city))
    regional = t["institution"].filter(based).join(live, KEYS, "left_semi").select("inst_id")
    return largest.union(regional).distinct()


STATEMENT_FIELDS = [
    "total_assets", "total_revenue", "credit_interest_income", "credit_income", "total_cost",
    "credit_expected_loss", "net_income", "roa",
]


def scoped_statements(t: TableSet, **scope) -> DataFrame:
    """Statements of the kept institutions: semi join on the account rows, then the pivot."""
    values = t["statement_value"].join(statement_scope(t, **scope), "inst_id", "left_semi")
    return with_statement_metrics(statement_of(t, values))


def statement_history(t: TableSet, **scope) -> DataFrame:
    """Eight aligned histories per institution with its last known attributes."""
    axis = period_axis(t["statement_value"], last=STATEMENT_YEARS * QUARTERS_PER_YEAR)
    rows = scoped_statements(t, **scope)
    inside = rows.filter(F.array_contains(axis, F.col("period")))
    known = F.when(F.col("name").isNotNull(), F.col("period"))
    names = ["name", "segment", "state", "status"]
    last = F.max_by(F.struct(*names), known).alias("_last")
    columns = {c: f"hist_{c}" for c in STATEMENT_FIELDS}
    rows = S.align(inside, ["inst_id"], columns, axis, also=[last])
    return rows.select("inst_id", *[f"_last.{c}" for c in names], *columns.values())


def statement_ranking(t: TableSet, **scope) -> DataFrame:
    """The last position of each history, largest assets first, missing ones last."""
    last = [F.element_at(f"hist_{c}", -1).alias(c) for c in STATEMENT_FIELDS]
    rows = statement_history(t, **scope).select("inst_id", "name", "segment", "state", *last)
    return rows.orderBy(_desc("total_assets"), "inst_id")


def statement_breaks(t: TableSet, **scope) -> DataFrame:
    return broken_totals(scoped_statements(t, **scope))


def firm_portfolio_totals(t: TableSet, n: int = TOP_FIRM_PORTFOLIOS) -> DataFrame:
    t.stage("portfolio_value", "institution")
    totals = at_latest(t["portfolio_size"]).filter(F.col("size") == C.FIRM_PORTFOLIO_TOTAL)
    rows = totals.select("inst_id", "name", "state", F.col("value").alias("firm_portfolio"))
    return top(rows, n, _desc("firm_portfolio"), F.col("inst_id"))


def firm_portfolio_cells(t: TableSet) -> DataFrame:
    """(inst_id, cut, label, value) of the four cuts of the largest firm portfolios."""
    t.stage("portfolio_value", "institution")
    keys = firm_portfolio_totals(t).select("inst_id")
    aging = at_latest(t["portfolio_aging"]).filter(F.col("client") == C.CLIENT_FIRM)

    def cut(rows: DataFrame, name: str, label: str) -> DataFrame:
        return rows.select("inst_id", F.lit(name).alias("cut"), F.col(label).alias("label"), "value")

    activity = at_latest(t["portfolio_activity"]).filter(F.col("bucket") == C.BUCKET_TOTAL)
    sizes = at_latest(t["portfolio_size"]).filter(F.col("size") != C.FIRM_PORTFOLIO_TOTAL)
    cells = (
        cut(aging.filter(F.col("bucket") == C.BUCKET_TOTAL), "modality", "modality")
        .unionByName(cut(aging.filter(F.col("bucket") == C.BUCKET_OVERDUE), "overdue", "modality"))
        .unionByName(cut(activity, "activity", "activity"))
        .unionByName(cut(sizes, "size", "size"))
    )
    return cells.join(keys, "inst_id", "left_semi")


def firm_portfolios(t: TableSet) -> DataFrame:
    """One nested row per institution: total and four sorted label/value lists."""
    cuts = ["modality", "overdue", "activity", "size"]
    lists = firm_portfolio_cells(t).groupBy("inst_id", "cut").agg(
        S.nested_list("label", "value").alias("cells")
    )
    wide = lists.groupBy("inst_id").agg(
        *[F.max(F.when(F.col("cut") == c, F.col("cells"))).alias(c) for c in cuts]
    )
    return firm_portfolio_totals(t).join(wide, "inst_id", "left")


def rates_by_modality(t: TableSet) -> DataFrame:
    """Current rates with their place in the modality, cheapest first, missing rates last.

    A modality may hold a large part of all institutions, so it stays rows, not one list.
    """
    now = current_lending_rates(t).withColumn("_cheap", -F.col("year_rate"))
    return with_rank(now, "_cheap", "position", ["modality"]).drop("_cheap")


def rate_history(t: TableSet, as_of_year: int, years: int = RATE_YEARS) -> DataFrame:
    """Yearly rate per (modality, institution) on one shared date axis.

    Both segments fall on one cell; the household rate is published if there are two.
    """
    t.stage("lending_rate")
    start = f"{as_of_year - years}-01-01"
    rows = t["lending_rate"].filter(
        (F.col("start_date") >= start) & F.col("year_rate").isNotNull()
    )
    axis = period_axis(t["lending_rate"].filter(F.col("start_date") >= start), "start_date")
    cells = rows.groupBy("modality", "institution", "start_date").agg(
        F.min_by("year_rate", "segment").alias("year_rate")
    )
    return S.align(
        cells, ["modality", "institution"], {"year_rate": "hist_year_rate"}, axis, "start_date"
    )


# --- D20: overview ----------------------------------------------------------------------------


def monthly_changes(rows: DataFrame, value: str) -> DataFrame:
    """Changes of the last row against exact periods: month before, last December, a year ago."""
    here = F.col("period")
    now = S.at(here)[value]
    refs = {
        "month": previous_month(here), "december": december_before(here),
        "year": same_month_last_year(here),
    }
    return S.by_period(rows, [value]).select(
        "period", now.alias("value"),
        *[
            M.pct_change(now, S.at(ref)[value], 1).alias(f"change_{name}_pct")
            for name, ref in refs.items()
        ],
    )


def yearly_change(rows: DataFrame, value: str) -> DataFrame:
    """Latest against the previous available year of a national total."""
    totals = rows.groupBy("year").agg(M.exact_sum(F.col(value)).alias("value"))
    known = totals.filter(F.col("value").isNotNull())
    last_two = known.orderBy(F.col("year").desc()).limit(2)
    pair = last_two.agg(
        F.max("year").alias("year"), F.max_by("value", "year").alias("value"),
        F.min("year").alias("previous_year"), F.min_by("value", "year").alias("_before"),
    )
    two = F.col("previous_year") < F.col("year")
    return pair.select(
        "year", "value", F.when(two, F.col("previous_year")).alias("previous_year"),
        F.when(two, M.pct_change(F.col("value"), F.col("_before"), 1)).alias("change_pct"),
    )


def record_credit_gdp(t: TableSet) -> DataFrame:
    return t["credit_macro"].agg(S.record_high("credit_gdp_pct").alias("r")).select("r.*")


def recent_employment(t: TableSet, months: int = 26) -> DataFrame:
    """The last rolling values in ascending order."""
    rows = t["national_employment"].filter(F.col("net_12m").isNotNull())
    last = rows.select("period", "net_12m").orderBy(_desc("period")).limit(months)
    return last.orderBy("period")


def _state_totals(t: TableSet, table: str, value: str) -> DataFrame:
    inside = t[table].join(t["place"].select("place_id"), "place_id", "left_semi")
    return inside.groupBy("place_id", "year").agg(M.exact_sum(F.col(value)).alias(value))


def overview_figures(t: TableSet) -> DataFrame:
    """The headline figures in long form: (figure, period, value, change_pct)."""
    headline = t["quarter_gdp"].filter(F.col("sector") == C.GDP_HEADLINE)
    gdp = headline.agg(
        F.max(F.when(F.col("rate_vs_prev_quarter").isNotNull(), F.col("quarter"))).alias("period"),
        S.last_known("rate_vs_prev_quarter", "quarter").alias("value"),
    ).withColumn("change_pct", F.lit(None).cast("double"))
    credit = monthly_changes(t["credit_macro"], "balance_total")
    jobs = monthly_changes(recent_employment(t), "net_12m")

    def yearly(table: str, value: str) -> DataFrame:
        return yearly_change(_state_totals(t, table, value), value).select(
            F.col("year").alias("period"), "value", "change_pct"
        )

    def tag(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.lit(name).alias("figure"), F.col("period").cast("int").alias("period"),
            F.col("value").cast("double").alias("value"), "change_pct",
        )

    def steps(df: DataFrame, name: str) -> DataFrame:
        changes = F.array(
            *[
                F.struct(F.lit(f"{name}_{k}").alias("figure"), F.col(f"change_{k}_pct").alias("change"))
                for k in ("month", "december", "year")
            ]
        )
        rows = df.select("period", "value", F.explode(changes).alias("c"))
        return rows.select(
            "c.figure", F.col("period").cast("int").alias("period"),
            F.col("value").cast("double").alias("value"), F.col("c.change").alias("change_pct"),
        )

    record = record_credit_gdp(t).withColumn("change_pct", F.lit(None).cast("double"))
    parts = [
        tag(gdp, "gdp_vs_prev_quarter"), steps(credit, "credit"), tag(record, "credit_gdp_record"),
        tag(yearly("population_ref", "population"), "population"),
        tag(yearly("place_company", "companies"), "companies"), steps(jobs, "jobs_12m"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def highlights(t: TableSet) -> DataFrame:
    """Best and worst entity of four measures."""
    t.stage(*MAP_TABLES, "place_presence")
    t.stage("state_scorecard", "place_ranking", "insolvency_state")
    sectors = (
        t["quarter_gdp"].join(gdp_classes(t), "sector").filter(F.col("sector_group") != "AGREGADO")
        .groupBy("sector").agg(S.last_known("rate_vs_prev_year_quarter", "quarter").alias("value"))
    )
    courts = at_latest(t["insolvency_state"], t["insolvency"]).filter(F.col("judicial") > 0)

    def extremes(df: DataFrame, key: str, metric: str, name: str) -> DataFrame:
        rows = df.select(F.col(key).alias("k"), F.col(metric).cast("double").alias("m"))
        return S.best_and_worst(rows, "k", "m").withColumn("measure", F.lit(name))

    parts = [
        extremes(sectors, "sector", "value", "gdp_sector"),
        extremes(t["state_scorecard"], "state", "credit_gdp_pct", "state_credit_gdp"),
        extremes(t["place_ranking"], "place_id", "gdp_per_capita", "place_gdp_per_capita"),
        extremes(courts, "state", "judicial", "state_judicial"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def small_projection(t: TableSet) -> DataFrame:
    """The part of the place panel that the overview needs."""
    return t["place_ranking"].select("name", "state", "gdp_per_capita")


DATASETS = {
    "credit_series_panel": credit_series_panel, "credit_headline": credit_headline,
    "rate_ranking": rate_ranking, "default_ranking": default_ranking, "term_ranking": term_ranking,
    "lending_ranking": lending_ranking, "balance_by_size": balance_by_size,
    "largest_portfolios": largest_portfolios_history, "invoice_rate": invoice_rate,
    "total_rate_monthly": total_rate_monthly, "axes": axis_rows, "map_totals": map_totals,
    "places": place_panel, "states": state_panel, "activities": activity_ranking,
    "state_activities": state_activities, "insolvency_ranking": insolvency_ranking,
    "credit_gdp_history": credit_gdp_history, "outlines": outlines,
    "gdp_sectors": gdp_sector_panel, "insolvency": insolvency_panel,
    "insolvency_states": insolvency_state_panel, "segment_totals": segment_totals,
    "system_evolution": system_evolution, "segment_leaders": segment_leaders,
    "institutions": active_institutions, "statements": statement_history,
    "statement_ranking": statement_ranking, "firm_portfolios": firm_portfolios,
    "rates": rates_by_modality, "overview": overview_figures, "highlights": highlights,
}
