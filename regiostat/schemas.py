"""Explicit schemas of the base tables, used for empty sources and written tables.

Units: place money in thousand R$, series balances in million R$, per capita in R$.
"""

TABLE_SCHEMAS = {
    "place": (
        "place_id string, place_id6 string, name string, name_key string, state string, "
        "state_code string, region string, lat double, lng double, is_capital boolean"
    ),
    "population_a": "place_id string, year int, population double",
    "population_b": "place_id string, year int, population double",
    "division": "division string, section string, section_name string, name string",
    "account": "account int, name string, account_group string",
    "series": (
        "code int, name string, family string, level string, sector string, subsector string, "
        "unit string"
    ),
    "sector_map": "sector string, series_sector string, sections string, value_added_sector string",
    "series_value": "code int, period int, date string, value double",
    "place_gdp": (
        "place_id string, year int, gdp double, taxes double, va_total double, va_agri double, "
        "va_industry double, va_services double, va_public double"
    ),
    "quarter_gdp": (
        "quarter int, sector string, volume_index double, rate_vs_prev_year_quarter double, "
        "rate_4q double, rate_ytd double, rate_vs_prev_quarter double"
    ),
    "place_balance": "period int, place_id string, account int, amount double",
    "place_presence": "period int, place_id string, institutions long, branches double",
    "place_jobs": (
        "period int, place_id string, division string, hires long, leavers long, net long, "
        "mean_wage double"
    ),
    "place_company": (
        "place_id string, year int, section string, companies double, staff double, "
        "paid_staff double, wages double"
    ),
    "place_company_total": (
        "place_id string, year int, local_units double, active_companies double, staff double, "
        "paid_staff double, wages double, mean_wage double"
    ),
    "national_jobs": "period int, era string, hires double, leavers double, net double",
    "credit_series": (
        "code int, title string, metric string, client string, size string, origin string, "
        "region string, modality string, frequency string, unit string, search string, "
        "parse_status string"
    ),
    "credit_value": "code int, period int, date string, value double",
    "state_outline": "state string, geometry string",
    "institution": (
        "inst_id string, period int, name string, segment string, state string, city string, "
        "status string, consolidation string, fin_group_id string, prud_group_id string"
    ),
    "statement_value": "inst_id string, period int, account string, value double",
    "portfolio_value": (
        "inst_id string, period int, report string, `group` string, account string, "
        "column_name string, value double"
    ),
    "lending_rate": (
        "start_date string, tax_id8 string, institution string, segment string, modality string, "
        "month_rate double, year_rate double"
    ),
    "insolvency": "state string, court string, period int, class string, cases long",
}

# Key of each table: loads are checked for uniqueness on it.
TABLE_KEYS = {
    "place": ["place_id"],
    "population_a": ["place_id", "year"],
    "population_b": ["place_id", "year"],
    "division": ["division"],
    "account": ["account"],
    "series": ["code"],
    "sector_map": ["sector"],
    "series_value": ["code", "period"],
    "place_gdp": ["place_id", "year"],
    "quarter_gdp": ["quarter", "sector"],
    "place_balance": ["period", "place_id", "account"],
    "place_presence": ["period", "place_id"],
    "place_jobs": ["period", "place_id", "division"],
    "place_company": ["place_id", "year", "section"],
    "place_company_total": ["place_id", "year"],
    "national_jobs": ["period", "era"],
    "credit_series": ["code"],
    "credit_value": ["code", "period"],
    "state_outline": ["state"],
    "institution": ["inst_id", "period"],
    "statement_value": ["inst_id", "period", "account"],
    "portfolio_value": ["inst_id", "period", "report", "account"],
    "lending_rate": ["start_date", "tax_id8", "segment", "modality"],
    "insolvency": ["court", "period", "class"],
}
