"""The 36 views in DuckDB SQL, named v1 .. v36."""

from __future__ import annotations

from contract.oracle_tables import change, exact, long, ratio, rnd, text
from regiostat import constants as C

MAX_BALANCE = "(SELECT max(period) FROM place_balance)"
MAX_JOBS = "(SELECT max(period) FROM place_jobs)"
MAX_GDP = "(SELECT max(year) FROM place_gdp)"
MAX_COMPANY = "(SELECT max(year) FROM place_company)"
MAX_POP = "(SELECT max(year) FROM population_ref)"


def _max_of(columns: dict, code: str = "code", value: str = "value") -> str:
    def codes(c):
        return ", ".join(text(x) if isinstance(x, str) else str(x) for x in (c if isinstance(c, list) else [c]))

    return ",\n       ".join(
        f"max(CASE WHEN {code} IN ({codes(c)}) THEN {value} END) AS {name}" for name, c in columns.items()
    )


def lag(c: str, n: int, part: str = "") -> str:
    return f"lag({c}, {n}) OVER ({'PARTITION BY ' + part if part else ''} ORDER BY period)"


def roll(c: str, part: str = "") -> str:
    over = f"{'PARTITION BY ' + part if part else ''} ORDER BY period ROWS BETWEEN 11 PRECEDING AND CURRENT ROW"
    return f"SUM({c}) OVER ({over})"


VIEWS: dict[str, str] = {}

VIEWS["v1"] = f"""
WITH rows AS (
  SELECT s.code, s.name, s.level, s.sector, s.subsector, v.period, v.value
  FROM series_value v JOIN series s USING (code) WHERE s.family = 'CREDITO_SETOR'),
whole AS (SELECT period, {exact('value')} AS total FROM rows WHERE level = 'SETOR' GROUP BY 1)
SELECT r.*, {change('value', lag('value', 12, 'code').replace('period', 'r.period'))} AS change_12m_pct,
       CASE WHEN level = 'SETOR' THEN {ratio('value', 'total', '1e2', 2)} END AS share_pct
FROM rows r LEFT JOIN whole w ON w.period = r.period"""

VIEWS["v2"] = f"SELECT period, {_max_of(C.CREDIT_MACRO_SERIES)} FROM series_value GROUP BY period"

VIEWS["v3"] = f"""
WITH b AS (SELECT period, {_max_of(C.PULSE_SERIES)} FROM series_value GROUP BY period)
SELECT period, activity, activity_adjusted,
       {change('activity_adjusted', lag('activity_adjusted', 1))} AS activity_change_1m_pct,
       {change('activity', lag('activity', 12))} AS activity_change_12m_pct, credit_balance,
       {change('credit_balance', lag('credit_balance', 12))} AS credit_change_12m_pct, lending,
       {change('lending', lag('lending', 12))} AS lending_change_12m_pct, default_rate, credit_gdp_pct
FROM b"""

VIEWS["v4"] = f"""
SELECT period, name AS indicator, value, {change('value', lag('value', 12, 'code'))} AS change_12m_pct
FROM series_value JOIN series USING (code) WHERE family = 'ATIVIDADE'"""

VIEWS["v5"] = f"""
SELECT v.code, s.metric, s.client, s.size, s.origin, s.region, s.modality, s.frequency, s.unit,
       v.period, v.value, a.value AS value_year_ago, {change('v.value', 'a.value')} AS change_year_pct
FROM credit_value v JOIN credit_series s ON s.code = v.code
LEFT JOIN credit_value a ON a.code = v.code AND a.period + 100 = v.period"""

VIEWS["v6"] = "SELECT * FROM v5 WHERE metric = 'TAXA_JUROS'"
VIEWS["v7"] = "SELECT * FROM v5 WHERE metric = 'TAXA_INADIMPLENCIA'"
VIEWS["v8"] = f"""
SELECT d.*, {ratio('value', 'CAST(SUM(CAST(value AS DECIMAL(28,6))) OVER (PARTITION BY client, size, period) AS DOUBLE)', '1e2', 2)} AS share_pct
FROM v5 d WHERE metric = 'SALDO'"""
VIEWS["v9"] = "SELECT * FROM v5 WHERE metric IN ('ICC', 'SPREAD_ICC')"
VIEWS["v10"] = "SELECT * FROM v5 WHERE metric IN ('PRAZO_MEDIO_CARTEIRA', 'PRAZO_MEDIO_CONCESSAO')"
VIEWS["v11"] = "SELECT * FROM v5 WHERE metric = 'CONCESSAO' AND modality IS NOT NULL"
VIEWS["v12"] = "SELECT * FROM v5 WHERE metric = 'SALDO' AND region IS NOT NULL"

VIEWS["v13"] = f"""
SELECT i.inst_id, i.period, i.name, i.segment, i.state, i.city, i.status,
       {_max_of(C.STATEMENT_COLUMNS, 'd.account', 'd.value')}
FROM institution i JOIN statement_value d ON d.inst_id = i.inst_id AND d.period = i.period
GROUP BY ALL"""

_head = "i.inst_id, i.period, i.name, i.segment, i.state, i.status"
_join = "FROM institution i JOIN portfolio_value c ON c.inst_id = i.inst_id AND c.period = i.period"
VIEWS["v14"] = f"""
SELECT {_head}, CASE c.report WHEN '11' THEN 'PF' WHEN '13' THEN 'PJ' END AS client,
       c."group" AS modality, c.column_name AS bucket, c.value {_join} WHERE c.report IN ('11', '13')"""
VIEWS["v15"] = f"""
SELECT {_head}, c."group" AS activity, c.column_name AS bucket, c.value {_join}
WHERE c.report = '12' AND c."group" IS NOT NULL"""
VIEWS["v16"] = f"SELECT {_head}, c.column_name AS size, c.value {_join} WHERE c.report = '14'"

_classes = ", ".join(
    f"{long(f'SUM(CASE WHEN class = {text(v)} THEN cases ELSE 0 END)')} AS {k}"
    for k, v in C.INSOLVENCY_COLUMNS.items()
)
VIEWS["v17"] = f"SELECT state, court, period, {_classes} FROM insolvency GROUP BY ALL"
VIEWS["v18"] = f"SELECT period, {_classes} FROM insolvency GROUP BY ALL"

VIEWS["v19"] = f"""
WITH b AS (
  SELECT g.place_id, p.name, p.state, p.region, g.year, g.gdp, g.taxes, g.va_total, g.va_agri,
         g.va_industry, g.va_services, g.va_public, r.population,
         {ratio('g.gdp', 'r.population', '1e3', 2)} AS gdp_per_capita
  FROM place_gdp g JOIN place p USING (place_id)
  LEFT JOIN population_ref r ON r.place_id = g.place_id AND r.year = g.year)
SELECT *,
       {ratio('gdp', 'CAST(SUM(CAST(gdp AS DECIMAL(28,6))) OVER (PARTITION BY state, year) AS DOUBLE)', '1e2', 3)} AS state_share_pct,
       {ratio('va_agri', 'va_total', '1e2', 1)} AS pct_agri,
       {ratio('va_industry', 'va_total', '1e2', 1)} AS pct_industry,
       {ratio('va_services', 'va_total', '1e2', 1)} AS pct_services,
       {ratio('va_public', 'va_total', '1e2', 1)} AS pct_public,
       rank() OVER (PARTITION BY year ORDER BY gdp DESC NULLS LAST) AS national_rank,
       rank() OVER (PARTITION BY state, year ORDER BY gdp DESC NULLS LAST) AS state_rank
FROM b"""

VIEWS["v20"] = f"""
SELECT place_id, name, state, region, year, gdp, population, gdp_per_capita,
       CASE WHEN gdp >= 1e7 THEN '1. Acima de R$ 10 bi' WHEN gdp >= 1e6 THEN '2. R$ 1 bi a 10 bi'
            WHEN gdp >= 1e5 THEN '3. R$ 100 mi a 1 bi' ELSE '4. Até R$ 100 mi' END AS gdp_band,
       CASE WHEN population >= 1000000 THEN '1. Acima de 1 milhão'
            WHEN population >= 500000 THEN '2. 500 mil a 1 milhão'
            WHEN population >= 100000 THEN '3. 100 mil a 500 mil'
            WHEN population >= 20000 THEN '4. 20 mil a 100 mil' ELSE '5. Até 20 mil' END AS population_band,
       pct_agri, pct_industry, pct_services, pct_public
FROM v19 WHERE year = {MAX_GDP}"""

VIEWS["v21"] = """
SELECT quarter, sector, volume_index, rate_vs_prev_quarter, rate_vs_prev_year_quarter, rate_4q, rate_ytd
FROM quarter_gdp"""

AMOUNTS = list(C.PLACE_CREDIT_COLUMNS)
_pivot = ",\n         ".join(
    f"{exact(f'CASE WHEN account IN ({str(a)[1:-1]}) THEN amount END')} AS {c}"
    for c, a in C.PLACE_CREDIT_COLUMNS.items()
)
VIEWS["v22"] = f"""
WITH b AS (SELECT period, place_id, {_pivot} FROM place_balance GROUP BY 1, 2)
SELECT b.period, b.place_id, p.name, p.state, p.region, {', '.join('b.' + c for c in AMOUNTS)},
       {ratio('b.provision', 'b.credit_total', '-1e2', 2)} AS provision_pct, q.institutions, q.branches,
       lag(b.credit_total, 12) OVER w AS credit_12m_before,
       {change('b.credit_total', 'lag(b.credit_total, 12) OVER w')} AS credit_change_12m_pct
FROM b JOIN place p ON p.place_id = b.place_id
LEFT JOIN place_presence q ON q.place_id = b.place_id AND q.period = b.period
WINDOW w AS (PARTITION BY b.place_id ORDER BY b.period)"""

VIEWS["v23"] = f"""
WITH s AS (
  SELECT period, state, {', '.join(f'{exact(c)} AS {c}' for c in AMOUNTS)},
         {long('SUM(institutions)')} AS institutions, SUM(branches) AS branches
  FROM v22 GROUP BY 1, 2)
SELECT *, {ratio('provision', 'credit_total', '-1e2', 2)} AS provision_pct,
       {lag('credit_total', 12, 'state')} AS credit_12m_before,
       {change('credit_total', lag('credit_total', 12, 'state'))} AS credit_change_12m_pct
FROM s"""

VIEWS["v24"] = f"""
SELECT u.*, r.population, {ratio('u.credit_total', 'r.population', '1e3', 0)} AS credit_per_capita,
       rank() OVER (ORDER BY u.credit_total DESC NULLS LAST) AS national_rank,
       rank() OVER (PARTITION BY u.state ORDER BY u.credit_total DESC NULLS LAST) AS state_rank
FROM v22 u LEFT JOIN population_ref r ON r.place_id = u.place_id AND r.year = {MAX_POP}
WHERE u.period = {MAX_BALANCE}"""

VIEWS["v25"] = f"""
WITH c AS (
  SELECT place_id, {exact('credit_total')} / NULLIF(CAST(count(credit_total) AS DOUBLE), 0) AS mean_credit_12m
  FROM v22 WHERE period > {MAX_BALANCE} - 100 GROUP BY 1)
SELECT p.place_id, p.name, p.state, p.region, c.mean_credit_12m, g.year AS gdp_year, g.gdp,
       {ratio('c.mean_credit_12m', 'g.gdp', '1e2', 1)} AS credit_gdp_pct,
       rank() OVER (ORDER BY {ratio('c.mean_credit_12m', 'g.gdp')} DESC NULLS LAST) AS penetration_rank
FROM place p JOIN c USING (place_id) JOIN place_gdp g ON g.place_id = p.place_id AND g.year = {MAX_GDP}"""

_jobs = ", ".join(f"{long(f'SUM({c})')} AS {c}" for c in ("hires", "leavers", "net"))
VIEWS["v26"] = f"""
WITH s AS (
  SELECT period, division, {_jobs},
         {rnd(f"{exact('mean_wage * hires')} / NULLIF(CAST(SUM(CASE WHEN mean_wage IS NOT NULL THEN hires END) AS DOUBLE), 0)", 2)} AS mean_wage
  FROM place_jobs GROUP BY 1, 2)
SELECT s.period, s.division, d.section, d.section_name, d.name AS division_name, s.hires, s.leavers,
       s.net, s.mean_wage,
       {long(roll('s.net', 's.division').replace('BY period', 'BY s.period'))} AS net_12m
FROM s LEFT JOIN division d USING (division)"""

VIEWS["v27"] = f"""
WITH s AS (SELECT period, place_id, {_jobs} FROM place_jobs GROUP BY 1, 2),
w AS (SELECT *, {long(roll('net', 'place_id'))} AS net_12m FROM s)
SELECT w.period, w.place_id, p.name, p.state, p.region, w.hires, w.leavers, w.net, w.net_12m,
       {ratio('w.net_12m', 'r.population', '1e3', 2)} AS net_12m_per_1000
FROM w JOIN place p USING (place_id)
LEFT JOIN population_ref r ON r.place_id = w.place_id AND r.year = {MAX_POP}"""

VIEWS["v28"] = f"""
WITH s AS (SELECT period, state, {_jobs} FROM place_jobs JOIN place USING (place_id) GROUP BY 1, 2)
SELECT *, {long(roll('net', 'state'))} AS net_12m FROM s"""

VIEWS["section_name"] = "SELECT section, min(section_name) AS section_name FROM division GROUP BY 1"

VIEWS["v29"] = f"""
SELECT c.year, c.place_id, p.name, p.state, p.region, c.section, n.section_name, c.companies, c.staff,
       c.paid_staff, c.wages, {ratio('c.companies', 'r.population', '1e3', 2)} AS companies_per_1000
FROM place_company c JOIN place p USING (place_id) LEFT JOIN section_name n USING (section)
LEFT JOIN population_ref r ON r.place_id = c.place_id AND r.year = c.year"""

VIEWS["v30"] = f"""
SELECT period, era, hires, leavers, net, {roll('net')} AS net_12m
FROM (SELECT * FROM national_jobs WHERE era = 'CAGED_ANTIGO' OR (era = 'NOVO_CAGED' AND period >= 199901))"""

VIEWS["section_jobs"] = f"""
SELECT d.section, {long('SUM(j.net)')} AS net_12m, {long('SUM(j.hires)')} AS hires_12m
FROM place_jobs j JOIN division d USING (division) WHERE j.period > {MAX_JOBS} - 100 GROUP BY 1"""

VIEWS["section_firms"] = f"""
SELECT section, {exact('companies')} AS companies, {exact('staff')} AS staff, {exact('wages')} AS wages
FROM place_company WHERE year = {MAX_COMPANY} GROUP BY 1"""


def _by_list(value: str, source: str, wrap=lambda x: x) -> str:
    inside = f"',' || replace(m.sections, ' ', '') || ',' LIKE '%,' || x.section || ',%'"
    return f"(SELECT {wrap(f'SUM(x.{value})')} FROM {source} x WHERE {inside})"


VIEWS["v31"] = f"""
WITH credit AS (
  SELECT sector, {exact('value')} AS credit, max(period) AS credit_period FROM v1
  WHERE level = 'SETOR' AND period = (SELECT max(v.period) FROM series_value v JOIN series s USING (code)
                                      WHERE s.family = 'CREDITO_SETOR') GROUP BY 1),
va AS (
  SELECT max(year) AS va_year, {', '.join(f"{exact(c)} AS {n}" for n, c in C.VALUE_ADDED_SECTORS.items())}
  FROM place_gdp WHERE year = {MAX_GDP}),
added AS (
  {' UNION ALL '.join(f"SELECT '{n}' AS part, {n} AS value_added, va_year FROM va" for n in C.VALUE_ADDED_SECTORS)})
SELECT m.sector, c.credit, c.credit_period, a.value_added, a.va_year,
       {ratio('a.value_added', f"(SELECT {exact('value_added')} FROM added)", '1e2', 1)} AS value_added_share_pct,
       {_by_list('net_12m', 'section_jobs', long)} AS net_12m,
       {_by_list('hires_12m', 'section_jobs', long)} AS hires_12m,
       {_by_list('companies', 'section_firms')} AS companies, {_by_list('staff', 'section_firms')} AS staff
FROM sector_map m LEFT JOIN credit c ON c.sector = m.series_sector
LEFT JOIN added a ON a.part = m.value_added_sector"""

VIEWS["v32"] = f"""
WITH g AS (SELECT p.state, {exact('gdp')} AS gdp, max(year) AS gdp_year FROM place_gdp JOIN place p USING (place_id)
           WHERE year = {MAX_GDP} GROUP BY 1),
n AS (SELECT p.state, {exact('population')} AS population FROM population_ref JOIN place p USING (place_id)
      WHERE year = {MAX_POP} GROUP BY 1),
c AS (SELECT state, {exact('credit_total')} AS credit, {exact('credit_12m_before')} AS before, max(period) AS credit_period
      FROM v22 WHERE period = {MAX_BALANCE} GROUP BY 1),
j AS (SELECT p.state, {long('SUM(net)')} AS net_12m FROM place_jobs JOIN place p USING (place_id)
      WHERE period > {MAX_JOBS} - 100 GROUP BY 1),
f AS (SELECT p.state, {exact('companies')} AS companies FROM place_company JOIN place p USING (place_id)
      WHERE year = {MAX_COMPANY} GROUP BY 1)
SELECT u.state, u.region, n.population, g.gdp, g.gdp_year,
       {ratio('g.gdp', 'n.population', '1e3', 0)} AS gdp_per_capita, c.credit, c.credit_period,
       {change('c.credit', 'c.before')} AS credit_change_12m_pct,
       {ratio('c.credit', 'g.gdp', '1e2', 1)} AS credit_gdp_pct,
       {ratio('c.credit', 'n.population', '1e3', 0)} AS credit_per_capita, j.net_12m,
       {ratio('j.net_12m', 'n.population', '1e3', 2)} AS net_12m_per_1000, f.companies,
       {ratio('f.companies', 'n.population', '1e3', 1)} AS companies_per_1000
FROM (SELECT DISTINCT state, region FROM place) u LEFT JOIN g USING (state) LEFT JOIN n USING (state)
LEFT JOIN c USING (state) LEFT JOIN j USING (state) LEFT JOIN f USING (state)"""

_parts = "b.va_agri + b.va_industry + b.va_services + b.va_public"
VIEWS["v33"] = f"""
WITH b AS (
  SELECT p.state, p.region, g.year,
         {', '.join(f"{exact('g.' + c)} AS {c}" for c in ('gdp', 'va_agri', 'va_industry', 'va_services', 'va_public'))},
         {exact('r.population')} AS population
  FROM place_gdp g JOIN place p USING (place_id)
  LEFT JOIN population_ref r ON r.place_id = g.place_id AND r.year = g.year GROUP BY 1, 2, 3)
SELECT b.state, b.region, b.year, b.gdp, b.population,
       {ratio('b.gdp', 'b.population', '1e3', 0)} AS gdp_per_capita,
       {ratio('b.va_agri', _parts, '1e2', 1)} AS pct_agri,
       {ratio('b.va_industry', _parts, '1e2', 1)} AS pct_industry,
       {ratio('b.va_services', _parts, '1e2', 1)} AS pct_services,
       {ratio('b.gdp', 'CAST(SUM(CAST(b.gdp AS DECIMAL(28,6))) OVER (PARTITION BY b.year) AS DOUBLE)', '1e2', 2)} AS national_share_pct
FROM b"""

VIEWS["v34"] = f"""
SELECT s.section, s.section_name, f.companies, f.staff, f.wages, j.net_12m, j.hires_12m,
       {ratio('f.companies', f"(SELECT {exact('companies')} FROM section_firms)", '1e2', 2)} AS companies_share_pct
FROM section_name s LEFT JOIN section_firms f USING (section) LEFT JOIN section_jobs j USING (section)
WHERE f.companies IS NOT NULL OR j.net_12m IS NOT NULL"""

VIEWS["v35"] = f"""
SELECT p.state, c.section, max(n.section_name) AS section_name, c.year, {exact('companies')} AS companies,
       {exact('staff')} AS staff
FROM place_company c JOIN place p USING (place_id) LEFT JOIN section_name n USING (section)
WHERE c.year = {MAX_COMPANY} GROUP BY p.state, c.section, c.year"""

VIEWS["v36"] = f"""
WITH f AS (SELECT place_id, {exact('companies')} AS companies FROM place_company WHERE year = {MAX_COMPANY} GROUP BY 1)
SELECT p.place_id, p.name, p.state, p.region, p.is_capital, n.population, g.gdp, g.gdp_per_capita,
       g.national_rank AS gdp_rank, c.credit_total, c.credit_change_12m_pct, c.credit_per_capita,
       c.national_rank AS credit_rank, e.credit_gdp_pct, j.net_12m, j.net_12m_per_1000, f.companies,
       {ratio('f.companies', 'n.population', '1e3', 1)} AS companies_per_1000
FROM place p
LEFT JOIN population_ref n ON n.place_id = p.place_id AND n.year = {MAX_POP}
LEFT JOIN v19 g ON g.place_id = p.place_id AND g.year = {MAX_GDP}
LEFT JOIN v24 c ON c.place_id = p.place_id
LEFT JOIN v25 e ON e.place_id = p.place_id
LEFT JOIN v27 j ON j.place_id = p.place_id AND j.period = {MAX_JOBS}
LEFT JOIN f ON f.place_id = p.place_id"""

# View number -> engine view.
VIEW_NAMES = {
    1: "sector_credit", 2: "credit_macro", 3: "national_pulse", 4: "regional_activity",
    5: "credit_detail", 6: "credit_rates", 7: "credit_defaults", 8: "credit_balance_by_size",
    9: "credit_cost_index", 10: "credit_term", 11: "credit_lending",
    12: "credit_balance_by_region", 13: "income_statement", 14: "portfolio_aging",
    15: "portfolio_activity", 16: "portfolio_size", 17: "insolvency_state",
    18: "insolvency_national", 19: "place_gdp_profile", 20: "place_size", 21: "quarter_gdp_view",
    22: "place_credit", 23: "state_credit", 24: "place_credit_per_capita",
    25: "credit_penetration", 26: "sector_jobs", 27: "place_employment", 28: "state_employment",
    29: "place_companies", 30: "national_employment", 31: "sector_crosswalk",
    32: "state_scorecard", 33: "state_gdp_history", 34: "section_scorecard",
    35: "section_by_state", 36: "place_ranking",
}
