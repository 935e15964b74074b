"""One Spark query per operator, view, sheet, dataset and check of the engine.

Every query reads whole driver tables through the adapter; keys carry the operator id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.adapter import DriverTables
from contract.oracle_views import VIEW_NAMES
from contract.round_trips import ROUND_TRIPS
from regiostat import constants as C
from regiostat.functions import clean as X
from regiostat.functions import metrics as M
from regiostat.functions import periods as P
from regiostat.operators import crosswalk, latest, pivot, population, quality, ranking, statements
from regiostat.operators import series as S
from regiostat.operators import titles as T
from regiostat.operators import windows as W
from regiostat.plans import datasets as D
from regiostat.plans import reports as R
from regiostat.session import work_folder
from regiostat.sources.movements import finish_jobs, signed_jobs
from regiostat.sources.rates import housing_rates
from regiostat.streaming import incremental as I

col = F.col
Query = Callable[[DriverTables], DataFrame]
QUERIES: dict[str, Query] = {}

SCOPE = {"n": 10, "states": ["NATION_3", "NATION_7"], "cities": [("NATION_5", "CITY_2")]}
AS_OF_YEAR = 2003
TOTAL_CODE = 0


def query(key: str):
    def keep(f: Query) -> Query:
        QUERIES[key] = f
        return f

    return keep


def rows(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


# --- cleaning --------------------------------------------------------------------------------


@query("S15_catalogue_first_search")
def _(t):
    return T.build_catalogue(t["catalogue_hits"], T.size_series(t.spark))


@query("C1_digits_only")
def _(t):
    return t["customer"].select("c_custkey", X.digits_only(col("c_name")).alias("digits"))


@query("C2_accent_fold")
def _(t):
    hits = t["catalogue_hits"]
    return hits.select("code", "search_order", X.fold_accents(col("title")).alias("folded"))


@query("C3_name_key")
def _(t):
    hits = t["catalogue_hits"]
    padded = F.concat(F.lit("  "), col("title"), F.lit(" "))
    return hits.select("code", "search_order", X.name_key(padded).alias("name_key"))


@query("C4_lenient_number")
def _(t):
    raw = F.when(col("p_partkey") % 3 == 0, col("p_name")).otherwise(
        F.concat(F.lit(" "), col("p_size").cast("string"), F.lit(".5 "))
    )
    return t["part"].select("p_partkey", X.lenient_number(raw).alias("number"))


@query("C5_decimal_comma")
def _(t):
    raw = F.replace(F.format_string("%.2f", col("l_extendedprice")), F.lit("."), F.lit(","))
    parsed = t["lineitem"].select("l_suppkey", X.decimal_comma(raw).alias("amount"))
    return parsed.groupBy("l_suppkey").agg(M.money_sum(col("amount")).alias("total"))


@query("C6_day_month_year")
def _(t):
    raw = F.date_format("o_orderdate", "dd/MM/yyyy")
    return rows(t["orders"], P.month_of_dmy(raw).alias("period"), P.iso_of_dmy(raw).alias("day"))


@query("C7_iso_prefix")
def _(t):
    raw = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00-03:00"))
    return rows(t["orders"], P.year_of_iso(raw).alias("year"), P.month_of_iso(raw).alias("period"))


@query("C8_code_prefix")
def _(t):
    key7 = F.lpad(col("p_partkey").cast("string"), 7, "0")
    return t["part"].select(
        "p_partkey", X.prefix(key7, 6).alias("short_code"), X.prefix(key7, 2).alias("division"),
        X.section_of_label(F.concat(F.lit(" "), col("p_type"))).alias("section"),
    )


@query("C9_code_label")
def _(t):
    return rows(t["customer"], X.region_label(col("c_nationkey") % 6 + 1).alias("region"))


@query("C10_thousands")
def _(t):
    return t["orders"].select("o_orderkey", X.thousands(col("o_totalprice"), 1).alias("thousands"))


@query("C11_drop_missing")
def _(t):
    return rows(t["job_movement"].dropna(subset=["wage"]), "division")


@query("C12_first_per_key")
def _(t):
    lines = t["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    order = [col(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")]
    return latest.first_by_precedence(lines, ["l_orderkey", "l_linenumber"], order)


@query("C13_constant_by_kind")
def _(t):
    raw = t["lending_rate"].filter(col("modality").ilike(C.HOUSING_PATTERN)).select(
        F.substring("start_date", 1, 7).alias("anoMes"), F.col("tax_id8").alias("cnpj8"),
        F.col("institution").alias("InstituicaoFinanceira"), F.col("modality").alias("Modalidade"),
        F.col("month_rate").alias("TaxaJurosAoMes"), F.col("year_rate").alias("TaxaJurosAoAno"),
    )
    return rows(housing_rates(raw), "start_date", "segment", "modality")


@query("C14_count_or_zero")
def _(t):
    raw = F.when(col("l_linenumber") == 3, F.lit("x")).when(
        col("l_linenumber") == 5, F.lit(None)
    ).otherwise(col("l_quantity").cast("int").cast("string"))
    return t["lineitem"].groupBy("l_linenumber").agg(F.sum(X.count_or_zero(raw)).alias("total"))


@query("C15_blank_to_null")
def _(t):
    raw = F.when(col("o_orderstatus") == "P", "").otherwise(col("o_orderstatus"))
    return rows(t["orders"], X.null_if_blank(raw).alias("status"))


@query("C16_two_schemes")
def _(t):
    columns = {c: C.STATEMENT_COLUMNS[c] for c in ("credit_income", "credit_expected_loss", "net_income")}
    known = [a for accounts in columns.values() for a in accounts]
    values = t["statement_value"].filter(col("account").isin(known))
    return pivot.pivot_max(values, ["inst_id", "period"], "account", "value", columns)


def _months(t):
    bounds = t["orders"].agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("as_of"))
    return P.month_list(bounds, "first", "as_of", 2)


@query("C17_month_list")
def _(t):
    return _months(t)


@query("C17_quarter_ends")
def _(t):
    return P.quarter_ends(_months(t))


@query("C18_one_day_per_month")
def _(t):
    days = t["orders"].select("o_orderdate")
    chosen = P.one_day_per_month(days, "o_orderdate")
    hits = days.join(chosen.select("o_orderdate"), "o_orderdate", "left_semi")
    return rows(hits, F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


def _parsed(t):
    return T.parse_titles(t["catalogue_hits"])


@query("C19_title_prefix")
def _(t):
    return T.match_prefix(t["catalogue_hits"]).select(
        "code", "search_order", "metric", "client", "origin", "modality", "rest"
    )


@query("C20_title_tokens")
def _(t):
    return _parsed(t).select(
        "code", "search_order", "client", "size", "origin", "region", "modality"
    )


@query("C21_parse_status")
def _(t):
    return _parsed(t).select("code", "search_order", "title", "metric", "parse_status")


@query("C22_frequency")
def _(t):
    return t["catalogue_hits"].select(
        "code", "search_order", X.monthly_quarterly(col("frequency")).alias("frequency")
    )


@query("C23_sector_classes")
def _(t):
    return t["quarter_gdp"].join(D.gdp_classes(t), "sector").select(
        "quarter", "sector", "sector_group", "level", "volume_index"
    )


@query("C24_size_bands")
def _(t):
    wide = t["place_gdp"].join(t["population_b"], ["place_id", "year"], "left")
    return wide.select(
        "place_id", "year", M.gdp_band(col("gdp")).alias("gdp_band"),
        M.population_band(col("population") * 40).alias("population_band"),
    )


@query("C25_region_codes")
def _(t):
    return rows(t["place"], "state", "region", X.region_code(col("region")).alias("code"))


# --- filters ---------------------------------------------------------------------------------


@query("P1_latest_position")
def _(t):
    return latest.at_latest(t["place_balance"])


@query("P1_latest_of_other")
def _(t):
    return latest.at_latest(t["portfolio_value"], t["statement_value"])


@query("P2_latest_where_known")
def _(t):
    known = col("rate_vs_prev_quarter").isNotNull()
    return latest.at_latest(t["quarter_gdp"], period="quarter", where=known)


@query("P3_latest_per_frequency")
def _(t):
    return latest.at_latest_per_frequency(t["credit_detail"], C.MONTHLY, C.QUARTERLY)


@query("P4_trailing_year")
def _(t):
    return rows(latest.trailing_year(t["place_balance"]), "period")


@query("P5_size_limits")
def _(t):
    big = t["place_gdp"].filter(col("gdp") >= 1000)
    return big.groupBy("place_id").agg(M.exact_sum(col("gdp")).alias("gdp")).filter(col("gdp") >= 5000)


@query("P6_metric_family")
def _(t):
    return rows(t["credit_detail"].filter(col("metric").isin("SALDO", "CONCESSAO")), "metric", "client")


@query("P7_case_insensitive")
def _(t):
    return rows(t["lending_rate"].filter(col("modality").ilike(C.HOUSING_PATTERN)), "modality", "segment")


@query("P8_two_latest")
def _(t):
    housing = col("modality").ilike(C.HOUSING_PATTERN)
    return latest.at_two_latest(t["lending_rate"], "start_date", housing)


@query("P9_leaf_products")
def _(t):
    return D.leaf_products(t, "SALDO", C.SEARCH_BALANCE).select("code", "modality", "client")


@query("P10_null_safe_exclusion")
def _(t):
    hit = F.coalesce(F.contains(col("modality"), F.lit(C.CHAINED_SERIES)), F.lit(False))
    values = t["credit_value"].join(t["credit_series"].filter(~hit).select("code", "modality"), "code")
    return rows(values, "code", "modality")


@query("P11_scope")
def _(t):
    return D.statement_scope(t, **SCOPE)


@query("P12_last_periods")
def _(t):
    recent = latest.last_periods(t["place_balance"], 6)
    kept = t["place_balance"].join(recent, "period", "left_semi")
    return kept.groupBy("period").agg(M.exact_sum(col("amount")).alias("amount"))


@query("P13_as_of_cut")
def _(t):
    start = f"{AS_OF_YEAR - 5}-01-01"
    return rows(t["lending_rate"].filter(col("start_date") >= start), "start_date")


# --- joins -----------------------------------------------------------------------------------


@query("J1_fact_dimension")
def _(t):
    sums = t["place_balance"].groupBy("place_id", "account").agg(M.exact_sum(col("amount")).alias("amount"))
    named = sums.join(t["place"].select("place_id", "state"), "place_id")
    return named.groupBy("state", "account").agg(M.exact_sum(col("amount")).alias("amount"))


@query("J2_optional_fact")
def _(t):
    return t["place_gdp"].join(t["population_b"], ["place_id", "year"], "left").select(
        "place_id", "year", "gdp", "population"
    )


@query("J3_year_ago")
def _(t):
    values = t["credit_value"].select("code", "period", "value")
    return W.with_year_ago(values, ["code"], "value", "value_year_ago").select(
        "*", M.pct_change(col("value"), col("value_year_ago")).alias("change_pct")
    )


@query("J4_denominator")
def _(t):
    values = t["series_value"].select("code", "period", "value")
    return W.share_of_group(values, "value", ["period"], "share_pct")


@query("J5_many_sources")
def _(t):
    gdp = t["place_gdp"].groupBy("place_id").agg(M.exact_sum(col("gdp")).alias("gdp"))
    firms = t["place_company_total"].groupBy("place_id").agg(F.max("active_companies").alias("firms"))
    banks = t["place_presence"].groupBy("place_id").agg(F.max("institutions").alias("banks"))
    keys = t["place"].select("place_id")
    return keys.join(gdp, "place_id", "left").join(firms, "place_id", "left").join(banks, "place_id", "left")


@query("J6_list_membership")
def _(t):
    per_section = t["place_company"].groupBy("year", "section").agg(
        M.exact_sum(col("companies")).alias("companies")
    )
    members = crosswalk.list_members(t["sector_map"], "sector", "sections", "section")
    return members.join(per_section, "section").groupBy("sector", "year").agg(
        M.exact_sum(col("companies")).alias("companies")
    )


@query("J7_semi_join_top")
def _(t):
    return t["portfolio_value"].join(R.largest_portfolios(t), "inst_id", "left_semi").groupBy(
        "inst_id", "report"
    ).agg(M.exact_sum(col("value")).alias("value"))


@query("J8_valid_keys")
def _(t):
    return rows(t["place_balance"].join(t["place"].select("place_id"), "place_id", "left_semi"), "place_id")


@query("J9_anti_join")
def _(t):
    return rows(t["place_balance"].join(t["place"].select("place_id"), "place_id", "left_anti"), "place_id")


def _fallback_case(t):
    cells = t["portfolio_value"].select("inst_id", "period", "report", "account", "value")
    absent = (col("period") / 100).cast("int") % 3 == col("report").cast("int") % 3
    return cells.filter(~absent), cells.withColumn("value", col("value") * 2)


@query("J10_fallback_fill")
def _(t):
    primary, fallback = _fallback_case(t)
    return latest.fill_missing_groups(primary, fallback, ["period", "report"])


@query("J11_extend_code")
def _(t):
    sums = rows(t["job_movement"], "place_id6")
    return crosswalk.extend_code(sums, t["place"])[0]


@query("J11_unmatched_codes")
def _(t):
    sums = rows(t["job_movement"], "place_id6")
    return crosswalk.extend_code(sums, t["place"])[1]


@query("J12_distinct_pairs")
def _(t):
    pairs = t["division"].select("section", "section_name").distinct()
    firms = t["place_company"].groupBy("section").agg(M.exact_sum(col("companies")).alias("companies"))
    return firms.join(pairs, "section", "left")


@query("J13_first_name")
def _(t):
    names = t["division"].groupBy("section").agg(F.min("name").alias("first_name"))
    staff = t["place_company"].groupBy("section").agg(M.exact_sum(col("staff")).alias("staff"))
    return staff.join(names, "section", "left")


@query("J14_one_row_total")
def _(t):
    firms = t["place_company"].groupBy("section").agg(M.exact_sum(col("companies")).alias("companies"))
    total = latest.scalar_of(firms, M.exact_sum(col("companies")))
    return firms.withColumn("share_pct", M.ratio(col("companies"), total, 100, 2))


# --- aggregations ----------------------------------------------------------------------------


@query("A1_pivot_max")
def _(t):
    return pivot.pivot_max(
        t["place_balance"], ["place_id"], "account", "amount", C.PLACE_CREDIT_COLUMNS
    )


@query("A2_pivot_sum")
def _(t):
    return pivot.pivot_sum(
        t["place_balance"], ["period"], "account", "amount", C.PLACE_CREDIT_COLUMNS
    )


@query("A3_pivot_zero")
def _(t):
    return pivot.pivot_count(t["insolvency"], ["state"], "class", "cases", C.INSOLVENCY_COLUMNS)


@query("A4_pivot_first")
def _(t):
    return pivot.pivot_first(
        t["statement_value"], ["inst_id", "period"], "account", "value",
        {"assets": "140220", "credit": ["141835", "78203"]},
    )


@query("A5_unpivot_sum")
def _(t):
    parts = ["va_agri", "va_industry", "va_services", "va_public"]
    return pivot.unpivot_sum(t["place_gdp"], ["year"], parts, "part", "amount")


@query("A6_distinct_and_sum")
def _(t):
    return t["lineitem"].groupBy("l_suppkey").agg(
        F.count_distinct("l_partkey").alias("parts"),
        F.coalesce(F.sum(F.when(col("l_linenumber") == 9, col("l_quantity"))), F.lit(0.0)).alias("none"),
        F.coalesce(F.sum("l_quantity"), F.lit(0.0)).alias("quantity"),
    )


@query("A7_two_phase")
def _(t):
    return t["lineitem"].groupBy("l_returnflag", "l_linestatus").agg(
        M.money_sum(col("l_extendedprice")).alias("price"), F.sum("l_quantity").alias("quantity"),
        F.count(F.lit(1)).alias("rows"),
    )


@query("A8_signed_microdata")
def _(t):
    on_time = t["job_movement"].filter(col("kind") == "MOV")
    return signed_jobs(on_time, ["period", "division"])


@query("A9_retractions")
def _(t):
    return signed_jobs(t["job_movement"], ["period", "division"])


@query("A10_mean_wage")
def _(t):
    return finish_jobs(signed_jobs(t["job_movement"], ["division"]))


@query("A11_weighted_mean")
def _(t):
    return t["place_jobs"].groupBy("division").agg(
        M.weighted_mean(col("mean_wage"), col("hires")).alias("mean_wage")
    )


@query("A12_roll_up")
def _(t):
    named = t["place_gdp"].join(t["place"].select("place_id", "state", "region"), "place_id")
    states = named.groupBy("region", "state", "year").agg(M.exact_sum(col("gdp")).alias("gdp"))
    return states.groupBy("region", "year").agg(
        M.exact_sum(col("gdp")).alias("gdp"), F.count(F.lit(1)).alias("states")
    )


@query("A13_carried_attributes")
def _(t):
    return t["place_companies"].groupBy("place_id", "name", "state").agg(
        M.exact_sum(col("companies")).alias("companies")
    )


@query("A14_band_pairs")
def _(t):
    banded = t["place_gdp_profile"].withColumns(
        {"gdp_band": M.gdp_band(col("gdp") * 50), "population_band": M.population_band(col("population"))}
    )
    return banded.groupBy("gdp_band", "population_band").agg(
        F.count(F.lit(1)).alias("places"), M.exact_sum(col("gdp")).alias("gdp"),
        M.exact_mean(col("gdp")).alias("mean_gdp"),
    )


@query("A15_all_and_matched")
def _(t):
    assets = D._assets(t)
    joined = t["institution"].join(assets, ["inst_id", "period"], "left")
    return joined.groupBy("period").agg(
        F.count(F.lit(1)).alias("registered"), F.count("total_assets").alias("matched")
    )


@query("A16_distinct_per_period")
def _(t):
    return t["statement_value"].groupBy("period").agg(
        F.count_distinct("inst_id").alias("institutions"), M.exact_sum(col("value")).alias("value")
    )


@query("A17_rounded_mean_top")
def _(t):
    means = t["lending_rate"].groupBy("institution").agg(
        F.round(M.exact_mean(col("year_rate")), 1).alias("rate")
    )
    return ranking.top(means, 12, col("rate").desc(), col("institution"))


@query("A18_having")
def _(t):
    return rows(t["lending_rate"], "tax_id8", "modality").filter(col("rows") >= 80)


@query("A19_load_summary")
def _(t):
    return quality.load_summary(t["place_balance"], "place_id")


# --- windows ---------------------------------------------------------------------------------


@query("W1_lag_12_rows")
def _(t):
    return t["insolvency"].select(
        "state", "class", "period", "cases",
        W.row_lag("cases", 12, ["state", "class"]).alias("before"),
        W.row_change("cases", 12, ["state", "class"]).alias("change_pct"),
    )


@query("W2_national_lags")
def _(t):
    nation = t["place_balance"].groupBy("period").agg(M.exact_sum(col("amount")).alias("amount"))
    return nation.select(
        "period", "amount", W.row_change("amount", 1, []).alias("change_1_pct"),
        W.row_change("amount", 12, []).alias("change_12_pct"),
    )


@query("W3_rolling_12")
def _(t):
    cells = t["place_presence"].select("place_id", "period", "institutions")
    return cells.withColumn("rolling", W.rolling_sum("institutions", ["place_id"]))


@query("W4_share_of_group")
def _(t):
    cells = t["credit_detail"].select("code", "client", "size", "period", "value")
    return W.share_of_group(cells, "value", ["client", "size", "period"], "share_pct")


@query("W5_global_rank")
def _(t):
    spend = t["orders"].groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return ranking.with_rank(spend, "orders", "position")


@query("W5_rank_per_year")
def _(t):
    cells = t["orders"].select(
        "o_orderkey", F.year("o_orderdate").alias("year"),
        F.when(col("o_orderkey") % 10 != 0, F.floor(col("o_totalprice") / 1000)).alias("price"),
    )
    return ranking.with_rank(cells, "price", "position", ["year"])


@query("W5_rank_in_state")
def _(t):
    cells = t["place_gdp"].join(t["place"].select("place_id", "state"), "place_id")
    cells = cells.select("place_id", "state", "year", "gdp")
    groups = {"in_state": ["state", "year"], "in_nation": ["year"], "ever": []}
    return ranking.with_ranks(cells, "gdp", groups).drop("gdp")


@query("W6_share_of_nation")
def _(t):
    cells = t["state_gdp_history"].select("state", "year", "gdp")
    return W.share_of_group(cells, "gdp", ["year"], "share_pct")


@query("W7_population_grid")
def _(t):
    return t["population_ref"]


@query("W8_source_precedence")
def _(t):
    return population.merge_sources(t["population_a"], t["population_b"])


@query("W9_position_changes")
def _(t):
    long = D.insolvency_panel(t).select(
        "class", F.posexplode(F.arrays_zip("hist", "hist_step", "hist_step_pct", "hist_year_pct"))
        .alias("position", "c"),
    )
    return long.select(
        "class", "position", col("c.hist").alias("cases"), col("c.hist_step").alias("step"),
        col("c.hist_step_pct").alias("step_pct"), col("c.hist_year_pct").alias("year_pct"),
    )


@query("W10_exact_period_changes")
def _(t):
    nation = t["place_balance"].groupBy("period").agg(M.exact_sum(col("amount")).alias("amount"))
    return D.monthly_changes(nation, "amount")


@query("W11_previous_year")
def _(t):
    return D.yearly_change(t["place_gdp"], "gdp")


@query("W12_record_high")
def _(t):
    return t["series_value"].groupBy("code").agg(S.record_high("value").alias("r")).select("code", "r.*")


@query("W13_last_known")
def _(t):
    return t["quarter_gdp"].groupBy("sector").agg(
        S.last_known("rate_vs_prev_quarter", "quarter").alias("last_rate")
    )


# --- sorts, limits, top-k --------------------------------------------------------------------


@query("T1_top")
def _(t):
    cells = t["orders"].select("o_orderkey", "o_totalprice")
    return ranking.top(cells, 300, col("o_totalprice").desc(), col("o_orderkey"))


@query("T2_top_keys")
def _(t):
    totals = t["statement_value"].groupBy("inst_id").agg(M.exact_sum(col("value")).alias("value"))
    return ranking.top_keys(totals, "inst_id", 10, col("value").desc(), col("inst_id"))


@query("T3_top_per_group")
def _(t):
    cells = t["place_company"].select("place_id", "year", "section", "companies")
    return ranking.top_per_group(
        cells, 3, ["place_id", "year"], col("companies").desc(), col("section")
    )


@query("T4_top_and_rest")
def _(t):
    return D.largest_portfolios_history(t, TOTAL_CODE)


@query("T5_nulls_last")
def _(t):
    cells = t["quarter_gdp"].select("quarter", "sector", "rate_vs_prev_quarter")
    return ranking.top(
        cells, 60, col("rate_vs_prev_quarter").desc_nulls_last(), col("quarter"), col("sector")
    )


@query("T6_multi_key_sort")
def _(t):
    return t["insolvency"].orderBy("state", col("period").desc(), "class")


@query("T7_extremes")
def _(t):
    cells = t["place_gdp"].groupBy("place_id").agg(M.exact_sum(col("gdp")).alias("gdp"))
    return S.best_and_worst(cells, "place_id", "gdp")


@query("T8_missing_last")
def _(t):
    cells = t["institution"].join(D._assets(t), ["inst_id", "period"], "left")
    return cells.select("inst_id", "period", "total_assets").orderBy(
        col("total_assets").desc_nulls_last(), "inst_id", "period"
    )


# --- set operations --------------------------------------------------------------------------


@query("U1_two_eras")
def _(t):
    return t["national_employment"].select("period", "era", "net")


@query("U2_columns_to_rows")
def _(t):
    parts = ["va_agri", "va_industry", "va_services", "va_public"]
    sums = t["place_gdp"].groupBy("year").agg(*[M.exact_sum(col(c)).alias(c) for c in parts])
    return sums.unpivot("year", parts, "part", "amount")


@query("U3_union_of_latest")
def _(t):
    rows_ = t["credit_detail"].select("code", "frequency", "period", "value")
    return latest.at_latest_per_frequency(rows_, C.MONTHLY, C.QUARTERLY)


@query("U4_union_of_keys")
def _(t):
    big = t["orders"].filter(col("o_totalprice") > 400000).select(col("o_custkey").alias("key"))
    late = t["orders"].filter(F.year("o_orderdate") == 2001).select(col("o_custkey").alias("key"))
    return big.union(late).distinct()


@query("U5_differing_layouts")
def _(t):
    a = t["population_a"].withColumn("source", F.lit("a"))
    b = t["population_b"].drop("population").withColumn("source", F.lit("b"))
    return a.unionByName(b, allowMissingColumns=True)


# --- scalar functions and metrics ------------------------------------------------------------


@query("F1_percent_change")
def _(t):
    return t["place_gdp"].select(
        "place_id", "year", M.pct_change(col("va_agri"), col("va_industry")).alias("change_pct")
    )


@query("F2_ratios")
def _(t):
    return t["place_company_total"].select(
        "place_id", "year", M.ratio(col("wages"), col("staff"), 1000, 2).alias("per_head"),
        M.ratio(col("paid_staff"), col("staff"), 100, 1).alias("paid_pct"),
        M.ratio(col("active_companies"), col("local_units"), 1, 3).alias("firms_per_unit"),
    )


@query("F3_null_rules")
def _(t):
    return t["place_gdp"].select(
        "place_id", "year", M.ratio(col("va_agri"), F.nullif(col("taxes"), F.lit(0.0)), 100, 2).alias("r"),
        F.when(col("taxes") > 100, "high").otherwise(F.lit(None)).alias("level"),
    )


@query("F4_strings")
def _(t):
    return t["part"].select(
        "p_partkey", F.concat("p_brand", F.lit("/"), "p_type").alias("joined"),
        F.replace(col("p_name"), F.lit(" "), F.lit("_")).alias("replaced"),
        F.regexp_extract("p_brand", r"#(\d+)", 1).alias("number"),
        col("p_type").like("S%").alias("is_s"), F.trim(F.concat(F.lit(" "), col("p_name"))).alias("stripped"),
    )


@query("F5_sign_flip")
def _(t):
    return t["place_balance"].filter(col("account") == 174).select(
        "place_id", "period", (-col("amount")).alias("provision")
    )


def _statement(t):
    return statements.with_statement_metrics(t["income_statement"])


@query("F6_statement_totals")
def _(t):
    return _statement(t).select("inst_id", "period", "total_revenue", "total_cost", "net_income")


@query("F7_return_on_assets")
def _(t):
    return _statement(t).select(
        "inst_id", "period", M.annual_factor(col("period")).alias("factor"), "roa"
    )


@query("F8_year_changes")
def _(t):
    cells = W.with_year_ago(t["credit_value"].select("code", "period", "value"), ["code"], "value", "before")
    return cells.select(
        "code", "period", M.pct_change_nonzero(col("value"), col("before")).alias("pct"),
        M.point_change(col("value"), col("before")).alias("points"),
    )


@query("F9_two_units")
def _(t):
    return D.invoice_rate(t)


@query("F10_label_with_client")
def _(t):
    return t["credit_series"].select("code", M.with_client(col("title"), col("client")).alias("label"))


# --- aligned series --------------------------------------------------------------------------


@query("N1_align")
def _(t):
    axis = latest.period_axis(t["insolvency"])
    wide = S.align(t["insolvency_state"], ["state"], {"judicial": "judicial"}, axis)
    return S.long_series(wide, ["state"], ["judicial"], axis)


@query("N2_reindex")
def _(t):
    axis = latest.period_axis(t["quarter_gdp"], "quarter")
    wide = S.align(t["quarter_gdp"], ["sector"], D.GDP_SERIES, axis, "quarter")
    return S.long_series(wide, ["sector"], list(D.GDP_SERIES.values()), axis)


@query("N3_last_attributes")
def _(t):
    known = F.when(col("segment").isNotNull(), col("period"))
    return t["institution"].groupBy("inst_id").agg(
        F.max_by(F.struct("name", "segment", "state"), known).alias("a")
    ).select("inst_id", "a.*")


@query("N4_label_values")
def _(t):
    panel = D.product_breakdown(t["state_credit"], "state", t["place_balance"])
    return panel.select("state", F.explode("products").alias("p")).select("state", "p.label", "p.value")


@query("N5_series_ratio")
def _(t):
    axis = D.axes(t)["gdp"]
    gdp = S.align(t["place_gdp"], ["place_id"], {"gdp": "gdp"}, axis, "year")
    people = S.align(t["population_ref"], ["place_id"], {"population": "people"}, axis, "year")
    wide = gdp.join(people, "place_id").withColumn(
        "per_capita", S.array_ratio("gdp", "people", 1000.0, 2)
    )
    return S.long_series(wide, ["place_id"], ["per_capita"], axis)


@query("N6_compare_capitals")
def _(t):
    chosen = t["place"].filter(col("is_capital") & (col("region") == "Nordeste")).select("place_id", "name")
    return t["place_credit"].select("place_id", "period", "credit_total").join(chosen, "place_id")


@query("N7_state_share")
def _(t):
    cells = t["insolvency_state"].select("state", "period", "judicial")
    return W.share_of_group(cells, "judicial", ["period"], "share_pct", 1)


@query("N8_nested_portfolio")
def _(t):
    nested = D.firm_portfolios(t).select(
        "inst_id", "firm_portfolio", F.posexplode("modality").alias("position", "m")
    )
    return nested.select(
        "inst_id", "firm_portfolio", "position", col("m.label").alias("label"), col("m.value").alias("value")
    )


def _rate_axis(t):
    start = f"{AS_OF_YEAR - D.RATE_YEARS}-01-01"
    return latest.period_axis(t["lending_rate"].filter(col("start_date") >= start), "start_date")


@query("N9_rate_history")
def _(t):
    wide = D.rate_history(t, AS_OF_YEAR)
    return S.long_series(wide, ["modality", "institution"], ["hist_year_rate"], _rate_axis(t)).drop("series")


@query("N10_small_projection")
def _(t):
    return D.small_projection(t)


@query("N11_recent_values")
def _(t):
    return D.recent_employment(t)


# --- views and sheets ------------------------------------------------------------------------


def _view(name: str) -> Query:
    return lambda t: t[name]


for _number, _name in VIEW_NAMES.items():
    QUERIES[f"V{_number}_{_name}"] = _view(_name)

QUERIES.update(R.sheets())
QUERIES["R1_4"] = lambda t: R.quarters(t, since=199901)
QUERIES["R3_4"] = lambda t: R.top_penetration(t, min_gdp=100)
QUERIES["R5_4"] = lambda t: R.company_density(t, min_companies=20)


# --- datasets --------------------------------------------------------------------------------

query("D1_credit_series")(D.credit_series_panel)
query("D1_credit_headline")(D.credit_headline)
query("D2_rate_ranking")(D.rate_ranking)
query("D2_default_ranking")(D.default_ranking)
query("D2_term_ranking")(D.term_ranking)
query("D3_lending_ranking")(D.lending_ranking)
query("D4_balance_by_size")(D.balance_by_size)
query("D5_largest_portfolios")(lambda t: D.largest_portfolios_history(t, TOTAL_CODE))
query("D6_invoice_rate")(D.invoice_rate)
query("D6_total_rate_monthly")(D.total_rate_monthly)
query("D7_axes")(D.axis_rows)
query("D7_totals")(D.map_totals)


def _long_panel(t, panel: DataFrame, key: str, histories: dict[str, str]) -> DataFrame:
    """Aligned arrays of a panel as rows, each on its own axis."""
    ax = D.axes(t)
    parts = [
        S.long_series(panel.filter(col(h).isNotNull()).select(key, h), [key], [h], ax[a])
        for h, a in histories.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _joined(first: DataFrame, key: str, others: list[DataFrame]) -> DataFrame:
    for other in others:
        first = first.join(other, key, "left")
    return first


@query("D8_place_histories")
def _(t):
    panel = _joined(t["place"].select("place_id"), "place_id", D.place_histories(t))
    return _long_panel(t, panel, "place_id", D.PLACE_HISTORIES)


query("D8_place_profile")(D.place_profile)
query("D8_place_activities")(D.place_activities)


@query("D8_place_products")
def _(t):
    panel = D.product_breakdown(t["place_credit"], "place_id", t["place_balance"])
    return panel.select("place_id", F.explode("products").alias("p")).select("place_id", "p.label", "p.value")


@query("D8_place_panel")
def _(t):
    panel = D.place_panel(t)
    arrays = [*D.PLACE_HISTORIES, "activities", "products"]
    return panel.select("place_id", "gdp_band", *[F.size(a).alias(f"n_{a}") for a in arrays])


@query("D9_state_histories")
def _(t):
    panel = _joined(t["place"].select("state").distinct(), "state", D.state_histories(t))
    return _long_panel(t, panel, "state", D.STATE_HISTORIES)


query("D9_state_profile")(D.state_profile)
query("D9_regional_balances")(D.regional_balances)


@query("D9_state_panel")
def _(t):
    arrays = [*D.STATE_HISTORIES, "activities", "products", "balances"]
    return D.state_panel(t).select("state", *[F.size(a).alias(f"n_{a}") for a in arrays])


query("D10_activities")(D.activity_ranking)
query("D10_state_activities")(D.state_activities)
query("D11_insolvency_ranking")(D.insolvency_ranking)
query("D12_credit_gdp_history")(D.credit_gdp_history)


@query("D14_gdp_sectors")
def _(t):
    axis = latest.period_axis(t["quarter_gdp"], "quarter")
    panel = D.gdp_sector_panel(t)
    return S.long_series(panel, ["sector", "sector_group", "level"], list(D.GDP_SERIES.values()), axis)


@query("D15_insolvency_states")
def _(t):
    axis = latest.period_axis(t["insolvency"])
    hist = [f"hist_{c}" for c in C.INSOLVENCY_COLUMNS]
    return S.long_series(D.insolvency_state_panel(t), ["state", "region"], hist, axis)


QUERIES["D15_insolvency"] = QUERIES["W9_position_changes"]
query("D16_segments")(D.segment_totals)
query("D16_evolution")(D.system_evolution)
query("D16_leaders")(D.segment_leaders)
query("D16_institutions")(D.active_institutions)


@query("D17_statement_history")
def _(t):
    axis = latest.period_axis(t["statement_value"], last=D.STATEMENT_YEARS * D.QUARTERS_PER_YEAR)
    wide = D.statement_history(t, **SCOPE)
    return S.long_series(
        wide, ["inst_id", "name", "segment", "state", "status"],
        [f"hist_{c}" for c in D.STATEMENT_FIELDS], axis,
    )


query("D17_statement_ranking")(lambda t: D.statement_ranking(t, **SCOPE))
query("D18_portfolio_totals")(D.firm_portfolio_totals)
query("D18_portfolio_cells")(D.firm_portfolio_cells)


query("D19_rates_now")(D.rates_by_modality)
QUERIES["D19_rate_history"] = QUERIES["N9_rate_history"]
query("D20_figures")(D.overview_figures)
query("D20_highlights")(D.highlights)


# --- checks ----------------------------------------------------------------------------------


@query("Q1_duplicate_keys")
def _(t):
    return quality.duplicate_keys(t["lineitem"], ["l_orderkey", "l_linenumber"])


@query("Q2_without_partner")
def _(t):
    return quality.without_partner(t["place_balance"], t["place"], "place_id")


@query("Q3_broken_totals")
def _(t):
    return statements.broken_totals(_statement(t)).select("inst_id", "period", "gap")


@query("Q4_unclassified")
def _(t):
    return quality.unclassified(t["quarter_gdp"], D.gdp_classes(t), "sector")


@query("Q5_unparsed_titles")
def _(t):
    catalogue = T.build_catalogue(t["catalogue_hits"], T.size_series(t.spark))
    return quality.unparsed_titles(catalogue)


@query("Q6_broken_identities")
def _(t):
    return statements.broken_identities(t["income_statement"])


@query("Q7_parse_summary")
def _(t):
    return quality.parse_summary(T.build_catalogue(t["catalogue_hits"], T.size_series(t.spark)))


# --- incremental -----------------------------------------------------------------------------


def _folders(t, name: str) -> tuple[str, str]:
    base = work_folder(t.spark, name)
    return f"{base}/out", f"{base}/checkpoint"


@query("ST1_new_inputs_only")
def _(t):
    keys = ["period", "l_returnflag"]

    def reduce(batch: DataFrame) -> DataFrame:
        return batch.groupBy(P.month_of(col("l_shipdate")).alias("period"), "l_returnflag").agg(
            M.cents_sum(col("l_extendedprice")).alias("cents"), F.count(F.lit(1)).alias("rows")
        )

    out, checkpoint = _folders(t, "new-files")
    stream = I.file_stream(t.spark, t.folder, "lineitem.parquet")
    return I.add_up(I.aggregate_new_files(stream, reduce, out, checkpoint), keys)


@query("ST2_late_and_retracted")
def _(t):
    number, part = col("l_linenumber"), col("l_partkey")
    moves = I.file_stream(t.spark, t.folder, "lineitem.parquet").select(
        P.month_of(col("l_shipdate")).alias("period"),
        F.lpad((part % 99 + 1).cast("string"), 2, "0").alias("division"),
        F.when(part % 2 == 0, 1).otherwise(-1).cast("long").alias("movement"),
        F.when(part % 11 != 0, col("l_extendedprice")).alias("wage"),
        F.when(number <= 4, "MOV").when(number <= 6, "FOR").otherwise("EXC").alias("kind"),
    )
    return I.stream_signed_totals(moves, ["period", "division"], *_folders(t, "signed"))


@query("ST3_calendar_months")
def _(t):
    return I.monthly_counts(t["events"], "ts", "event_type")


@query("ST3_streamed_months")
def _(t):
    stream = I.file_stream(t.spark, t.folder, "events.parquet")
    days = I.stream_daily_counts(stream, "ts", "event_type", *_folders(t, "months"))
    return I.months_of_days(days)


@query("ST4_latest_release")
def _(t):
    releases = t["orders"].select(
        (col("o_orderkey") % 400).alias("key"), P.month_of(col("o_orderdate")).alias("period"),
        col("o_orderkey").alias("release"), col("o_totalprice").alias("value"),
    )
    return I.newest_release(releases, ["key", "period"], "release")


@query("ST5_fallback_before_load")
def _(t):
    primary, fallback = _fallback_case(t)
    return rows(latest.fill_missing_groups(primary, fallback, ["period", "report"]), "period", "report")


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(f: Query):
        return lambda spark, folder: f(DriverTables(spark, folder))

    return {key: bind(f) for key, f in {**QUERIES, **ROUND_TRIPS}.items()}

