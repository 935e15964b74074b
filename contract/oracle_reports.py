"""The 47 report sheets in DuckDB SQL (row order is not part of the comparison)."""

from __future__ import annotations

from contract.oracle_tables import exact, long, rnd
from contract.oracle_views import MAX_COMPANY, MAX_GDP, MAX_JOBS

SHEETS: dict[str, str] = {}

# 1
SHEETS["R1_1"] = "SELECT * FROM v3"
SHEETS["R1_2"] = "SELECT * FROM v2"
SHEETS["R1_3"] = "SELECT * FROM v4"
SHEETS["R1_4"] = "SELECT * FROM v21 WHERE quarter >= 199901"
# 2
SHEETS["R2_1"] = """SELECT name, level, sector, subsector, period, value, change_12m_pct, share_pct
FROM v1 WHERE period = (SELECT max(period) FROM v1)"""
for _n, _level in ((2, "SETOR"), (3, "SUBSETOR")):
    SHEETS[f"R2_{_n}"] = f"""SELECT period, name, sector, subsector, value, change_12m_pct FROM v1
WHERE level = '{_level}'"""
SHEETS["R2_4"] = "SELECT period, name, value, share_pct FROM v1 WHERE level = 'SETOR'"
# 3
SHEETS["R3_1"] = """SELECT place_id, national_rank, name, state, region, period, credit_total,
       credit_change_12m_pct, credit_per_capita, rural_credit, housing_credit, provision_pct, savings,
       time_deposits, institutions, branches, population
FROM v24 ORDER BY national_rank NULLS LAST, place_id LIMIT 300"""
SHEETS["R3_2"] = """SELECT place_id, name, state, period, credit_per_capita, credit_total, population,
       credit_change_12m_pct
FROM v24 WHERE population >= 20000 ORDER BY credit_per_capita DESC NULLS LAST, place_id LIMIT 300"""


def _sum(*columns: str) -> str:
    return ", ".join(f"{exact(c)} AS {c}" for c in columns)


SHEETS["R3_3"] = f"""SELECT period, state,
       {_sum('credit_total', 'rural_credit', 'housing_credit', 'savings', 'time_deposits')}
FROM v22 GROUP BY 1, 2"""
SHEETS["R3_4"] = """SELECT * FROM v25 WHERE gdp >= 100
ORDER BY penetration_rank NULLS LAST, place_id LIMIT 300"""
# 4
SHEETS["R4_1"] = f"""SELECT place_id, national_rank, name, state, region, year, gdp, population, gdp_per_capita,
       state_share_pct, pct_agri, pct_industry, pct_services, pct_public
FROM v19 WHERE year = {MAX_GDP} ORDER BY national_rank, place_id LIMIT 500"""
SHEETS["R4_2"] = f"""SELECT place_id, name, state, year, gdp_per_capita, gdp, population FROM v19
WHERE year = {MAX_GDP} AND population >= 20000
ORDER BY gdp_per_capita DESC NULLS LAST, place_id LIMIT 500"""
SHEETS["R4_3"] = f"""SELECT gdp_band, population_band, count(*) AS places, {_sum('gdp', 'population')}
FROM v20 GROUP BY 1, 2"""
SHEETS["R4_4"] = f"""SELECT state, year, {_sum('gdp', 'va_agri', 'va_industry', 'va_services', 'va_public')}
FROM v19 GROUP BY 1, 2"""
# 5
SHEETS["R5_1"] = f"""SELECT year, section, section_name, {_sum('companies', 'staff', 'paid_staff', 'wages')}
FROM v29 GROUP BY 1, 2, 3"""
SHEETS["R5_2"] = f"""SELECT year, state, section, section_name, {_sum('companies', 'staff')}
FROM v29 WHERE year = {MAX_COMPANY} GROUP BY 1, 2, 3, 4"""
SHEETS["R5_3"] = """SELECT t.year, t.place_id, p.name, p.state, t.active_companies, t.local_units, t.staff,
       t.paid_staff, t.mean_wage
FROM place_company_total t JOIN place p USING (place_id)
WHERE t.year = (SELECT max(year) FROM place_company_total)
ORDER BY t.active_companies DESC, t.place_id LIMIT 300"""
SHEETS["R5_4"] = f"""SELECT year, place_id, name, state, {_sum('companies')},
       {rnd(exact('companies_per_1000'), 1)} AS companies_per_1000
FROM v29 WHERE year = {MAX_COMPANY} GROUP BY 1, 2, 3, 4 HAVING SUM(companies) >= 20
ORDER BY 6 DESC NULLS LAST, place_id LIMIT 300"""
# 6
SHEETS["R6_1"] = f"SELECT * FROM v26 WHERE period = {MAX_JOBS}"
_jobs = ", ".join(f"{long(f'SUM({c})')} AS {c}" for c in ("hires", "leavers", "net"))
SHEETS["R6_2"] = f"SELECT period, section, section_name, {_jobs} FROM v26 GROUP BY 1, 2, 3"
SHEETS["R6_3"] = f"SELECT period, state, {_jobs} FROM v27 GROUP BY 1, 2"
SHEETS["R6_4"] = f"""SELECT place_id, name, state, region, period, net_12m, net_12m_per_1000, hires, leavers
FROM v27 WHERE period = {MAX_JOBS} ORDER BY net_12m DESC, place_id LIMIT 300"""
SHEETS["R6_5"] = "SELECT * FROM v30"
# 7
SHEETS["R7_1"] = "SELECT * FROM v32"
SHEETS["R7_2"] = f"SELECT period, state, {_sum('credit_total')} FROM v22 GROUP BY 1, 2"
SHEETS["R7_3"] = f"SELECT period, state, {long('SUM(net)')} AS net FROM v27 GROUP BY 1, 2"
# 8
SHEETS["R8_1"] = """SELECT * FROM v36 WHERE population >= 20000
ORDER BY gdp_rank NULLS LAST, place_id LIMIT 1000"""


def mean(c: str) -> str:
    return f"{exact(c)} / NULLIF(CAST(count({c}) AS DOUBLE), 0)"


SHEETS["R8_2"] = f"""SELECT gdp_band, population_band, count(*) AS places, {_sum('gdp', 'population')},
       {rnd(mean('pct_industry'), 1)} AS mean_pct_industry, {rnd(mean('pct_agri'), 1)} AS mean_pct_agri
FROM v20 GROUP BY 1, 2"""
SHEETS["R8_3"] = "SELECT * FROM v31"
# 9
_detail = "code, client, size, origin, modality, period, value, change_year_pct"
SHEETS["R9_1"] = f"SELECT {_detail} FROM v6 WHERE period = (SELECT max(period) FROM v6)"


def _per_frequency(view: str, columns: str) -> str:
    def last(freq: str) -> str:
        return f"(SELECT max(period) FROM {view} WHERE frequency = '{freq}')"

    return f"""SELECT {columns} FROM {view} WHERE period = {last('TRIMESTRAL')}
UNION ALL
SELECT {columns} FROM {view} WHERE frequency = 'MENSAL' AND period = {last('MENSAL')}"""


SHEETS["R9_2"] = _per_frequency("v7", _detail)
SHEETS["R9_3"] = _per_frequency("v8", _detail + ", share_pct")
_metric = "code, metric, client, origin, modality, period, value, change_year_pct"
SHEETS["R9_4"] = f"SELECT {_metric} FROM v9 WHERE period = (SELECT max(period) FROM v9)"
SHEETS["R9_5"] = f"SELECT {_metric} FROM v10 WHERE period = (SELECT max(period) FROM v10)"
SHEETS["R9_6"] = """SELECT code, client, origin, modality, period, value, change_year_pct FROM v11
WHERE period = (SELECT max(period) FROM v11)"""
SHEETS["R9_7"] = "SELECT code, title, search FROM credit_series WHERE parse_status <> 'OK'"
# 10
MAX_INST = "(SELECT max(period) FROM institution)"
SHEETS["R10_1"] = f"""SELECT i.segment, count(*) AS registered, count(d.inst_id) AS with_statement,
       {rnd(f"{exact('d.total_assets')} / 1e6", 1)} AS assets_bn
FROM institution i LEFT JOIN v13 d ON d.inst_id = i.inst_id AND d.period = i.period
WHERE i.period = {MAX_INST} AND i.status = 'A' GROUP BY 1"""
SHEETS["R10_2"] = """SELECT inst_id, name, segment, state, status, total_assets, credit_interest_income,
       credit_income, credit_expected_loss, expected_loss, net_income
FROM v13 WHERE period = (SELECT max(period) FROM v13 WHERE net_income IS NOT NULL)"""
SHEETS["R10_3"] = """SELECT inst_id, name, segment, state, total_assets, credit_interest_income, credit_income,
       net_income
FROM v13 WHERE period = (SELECT max(period) FROM v13 WHERE credit_income IS NOT NULL)"""
SHEETS["R10_4"] = f"""SELECT inst_id, name, segment, state, city, status, consolidation FROM institution
WHERE period = {MAX_INST}"""
TOP_PORTFOLIOS = """(SELECT inst_id FROM v16 WHERE period = (SELECT max(period) FROM v16)
  AND size = 'Total da Carteira de Pessoa Jurídica' ORDER BY value DESC NULLS LAST, inst_id LIMIT 30)"""


def _firm(view: str, label: str, where: str) -> str:
    return f"""SELECT inst_id, name, state, {label}, value FROM {view}
WHERE {where} period = (SELECT max(period) FROM {view}) AND inst_id IN {TOP_PORTFOLIOS}"""


SHEETS["R10_5"] = _firm("v14", "modality", "client = 'PJ' AND bucket = 'Total' AND")
SHEETS["R10_6"] = _firm("v14", "modality", "client = 'PJ' AND bucket = 'Vencido a Partir de 15 Dias' AND")
SHEETS["R10_7"] = _firm("v15", "activity", "bucket = 'Total' AND")
SHEETS["R10_8"] = _firm("v16", "size", "")
RATES_NOW = """SELECT tax_id8, institution, segment, modality, month_rate, year_rate FROM lending_rate
WHERE start_date = (SELECT max(start_date) FROM lending_rate WHERE modality NOT ILIKE '%imobili%')
   OR (modality ILIKE '%imobili%'
       AND start_date = (SELECT max(start_date) FROM lending_rate WHERE modality ILIKE '%imobili%'))"""
SHEETS["R10_9"] = RATES_NOW
