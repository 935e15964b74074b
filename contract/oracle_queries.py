"""DuckDB SQL of the operator, dataset and check queries, by the same keys."""

from __future__ import annotations

from contract.oracle import with_blocks
from contract.oracle_reports import RATES_NOW, SHEETS, TOP_PORTFOLIOS, mean
from contract.oracle_tables import (
    change,
    exact,
    long,
    money,
    month,
    ratio,
    rnd,
    text,
)
from contract.oracle_views import (
    MAX_BALANCE,
    MAX_COMPANY,
    MAX_GDP,
    MAX_JOBS,
    VIEW_NAMES,
    _max_of,
    _pivot,
)
from contract.round_trips import SQL as ROUND_TRIP_SQL
from regiostat import constants as C
from regiostat.operators import titles as T
from regiostat.plans import datasets as D

SQL: dict[str, str] = {}

# --- title grammar ---------------------------------------------------------------------------

_patterns = ", ".join("(" + ", ".join(text(v) for v in p) + ")" for p in T.TITLE_PATTERNS)


def _token(column: str, tokens: dict) -> str:
    return "CASE " + " ".join(
        f"WHEN lower({column}) = {text(k)} OR starts_with(lower({column}), {text(k + ' - ')}) THEN {text(v)}"
        for k, v in tokens.items()
    ) + " END"


def _cut(column: str, tokens: dict) -> str:
    return "CASE " + " ".join(
        f"WHEN lower({column}) = {text(k)} THEN '' "
        f"WHEN starts_with(lower({column}), {text(k + ' - ')}) THEN substr({column}, {len(k) + 4})"
        for k, v in tokens.items()
    ) + f" ELSE {column} END"


def _matched(source: str) -> str:
    return f"""
matched AS (
  SELECT h.*, p.metric, NULLIF(p.client, '') AS client, NULLIF(p.origin, '') AS origin,
         NULLIF(p.modality, '') AS modality,
         ltrim(substr(h.title, length(p.prefix) + 1), ' -') AS rest
  FROM {source} h LEFT JOIN (VALUES {_patterns}) p(prefix, metric, client, origin, modality)
    ON starts_with(h.title, p.prefix)
  QUALIFY row_number() OVER (PARTITION BY h.code, h.search ORDER BY length(p.prefix) DESC NULLS LAST) = 1)"""


def _parsed(source: str) -> str:
    return f"""{_matched(source)},
s1 AS (SELECT * EXCLUDE (rest), {_token('rest', T.SIZE_TOKENS)} AS size, {_cut('rest', T.SIZE_TOKENS)} AS r1 FROM matched),
s2 AS (SELECT * EXCLUDE (client, r1), COALESCE(client, {_token('r1', T.CLIENT_TOKENS)}) AS client,
              CASE WHEN client IS NULL THEN {_cut('r1', T.CLIENT_TOKENS)} ELSE r1 END AS r2 FROM s1),
s3 AS (SELECT * EXCLUDE (origin, r2), COALESCE(origin, {_token('r2', T.ORIGIN_TOKENS)}) AS origin,
              CASE WHEN origin IS NULL THEN {_cut('r2', T.ORIGIN_TOKENS)} ELSE r2 END AS r3 FROM s2),
s4 AS (SELECT * EXCLUDE (client, r3), COALESCE(client, {_token('r3', T.CLIENT_TOKENS)}) AS client,
              CASE WHEN client IS NULL THEN {_cut('r3', T.CLIENT_TOKENS)} ELSE r3 END AS r4 FROM s3),
s5 AS (SELECT * EXCLUDE (r4), {_token('r4', T.REGION_TOKENS)} AS region, {_cut('r4', T.REGION_TOKENS)} AS r5 FROM s4),
parsed AS (
  SELECT * EXCLUDE (modality, r5, size, client, origin, region),
         CASE WHEN metric IS NOT NULL THEN size END AS size, CASE WHEN metric IS NOT NULL THEN client END AS client,
         CASE WHEN metric IS NOT NULL THEN origin END AS origin, CASE WHEN metric IS NOT NULL THEN region END AS region,
         CASE WHEN metric IS NOT NULL THEN COALESCE(modality,
           CASE WHEN lower(trim(r5, ' -')) <> 'total' THEN NULLIF(trim(r5, ' -'), '') END) END AS modality,
         CASE WHEN metric IS NOT NULL THEN 'OK' ELSE 'NAO_PARSEADO' END AS parse_status
  FROM s5)"""


_freq = "CASE WHEN lower(trim(frequency)) = 'mensal' THEN 'MENSAL' ELSE 'TRIMESTRAL' END"
_static = ", ".join(
    f"({code}, '[agregado por porte] {m} - {s}', 'MENSAL', {text(u)}, {text(T.SIZE_SERIES_SEARCH)}, {text(m)}, {text(c)}, {text(s)}, 'OK')"
    for code, m, c, s, u in T.SIZE_SERIES
)
_catalogue = f"""
first_hit AS (
  SELECT code, trim(title) AS title, {_freq} AS frequency, unit, search FROM catalogue_hits
  QUALIFY row_number() OVER (PARTITION BY code ORDER BY search_order, title) = 1),
{_parsed('first_hit')},
static AS (SELECT * FROM (VALUES {_static}) v(code, title, frequency, unit, search, metric, client, size, parse_status)),
built AS (
  SELECT code, title, frequency, unit, search, metric, client, size, origin, region, modality, parse_status
  FROM parsed WHERE code NOT IN (SELECT code FROM static)
  UNION ALL
  SELECT code, title, frequency, unit, search, metric, client, size, NULL, NULL, NULL, parse_status FROM static)"""


def _nested(ctes: str, select: str) -> str:
    return f"SELECT * FROM (WITH {ctes} {select})"


SQL["S15_catalogue_first_search"] = _nested(_catalogue, "SELECT * FROM built")
SQL["C19_title_prefix"] = _nested(
    _matched("catalogue_hits"),
    "SELECT code, search_order, metric, client, origin, modality, rest FROM matched",
)
SQL["C20_title_tokens"] = _nested(
    _parsed("catalogue_hits"),
    "SELECT code, search_order, client, size, origin, region, modality FROM parsed",
)
SQL["C21_parse_status"] = _nested(
    _parsed("catalogue_hits"), "SELECT code, search_order, title, metric, parse_status FROM parsed"
)
SQL["C22_frequency"] = f"SELECT code, search_order, {_freq} AS frequency FROM catalogue_hits"
SQL["Q5_unparsed_titles"] = _nested(
    _catalogue, "SELECT code, title, search FROM built WHERE parse_status <> 'OK'"
)
SQL["Q7_parse_summary"] = _nested(
    _catalogue, "SELECT parse_status, metric, count(*) AS series FROM built GROUP BY 1, 2"
)

# --- cleaning --------------------------------------------------------------------------------

_plain = "regexp_replace(strip_accents(title), '[^\\x00-\\x7F]', '', 'g')"
SQL["C1_digits_only"] = "SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits FROM customer"
SQL["C2_accent_fold"] = f"SELECT code, search_order, {_plain} AS folded FROM catalogue_hits"
SQL["C3_name_key"] = f"SELECT code, search_order, trim(upper({_plain})) AS name_key FROM catalogue_hits"
SQL["C4_lenient_number"] = """SELECT p_partkey,
  CASE WHEN p_partkey % 3 = 0 THEN TRY_CAST(p_name AS DOUBLE) ELSE p_size + 0.5 END AS number FROM part"""
SQL["C5_decimal_comma"] = f"SELECT l_suppkey, {money('l_extendedprice')} AS total FROM lineitem GROUP BY 1"
SQL["C6_day_month_year"] = f"""SELECT {month('o_orderdate')} AS period, strftime(o_orderdate, '%Y-%m-%d') AS day,
  count(*) AS rows FROM orders GROUP BY 1, 2"""
SQL["C7_iso_prefix"] = f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {month('o_orderdate')} AS period,
  count(*) AS rows FROM orders GROUP BY 1, 2"""
SQL["C8_code_prefix"] = """SELECT p_partkey, substr(lpad(CAST(p_partkey AS VARCHAR), 7, '0'), 1, 6) AS short_code,
  substr(lpad(CAST(p_partkey AS VARCHAR), 7, '0'), 1, 2) AS division, substr(p_type, 1, 1) AS section FROM part"""
SQL["C9_code_label"] = """SELECT CASE c_nationkey % 6 WHEN 0 THEN 'Norte' WHEN 1 THEN 'Nordeste' WHEN 2 THEN 'Sudeste'
  WHEN 3 THEN 'Sul' WHEN 4 THEN 'Centro-Oeste' END AS region, count(*) AS rows FROM customer GROUP BY 1"""
SQL["C10_thousands"] = f"SELECT o_orderkey, {rnd('o_totalprice / 1e3', 1)} AS thousands FROM orders"
SQL["C11_drop_missing"] = "SELECT division, count(*) AS rows FROM job_movement WHERE wage IS NOT NULL GROUP BY 1"
SQL["C12_first_per_key"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1"""
SQL["C13_constant_by_kind"] = """SELECT start_date, 'Pessoa Física' AS segment, modality, count(*) AS rows
FROM lending_rate WHERE modality = 'FINANCIAMENTO IMOBILIARIO' GROUP BY 1, 2, 3"""
SQL["C14_count_or_zero"] = f"""SELECT l_linenumber,
  {long("SUM(CASE WHEN l_linenumber IN (3, 5) THEN 0 ELSE l_quantity END)")} AS total FROM lineitem GROUP BY 1"""
SQL["C15_blank_to_null"] = """SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, count(*) AS rows
FROM orders GROUP BY 1"""
_two = {c: C.STATEMENT_COLUMNS[c] for c in ("credit_income", "credit_expected_loss", "net_income")}
_two_known = ", ".join(text(a) for accounts in _two.values() for a in accounts)
SQL["C16_two_schemes"] = f"""SELECT inst_id, period, {_max_of(_two, 'account')} FROM statement_value
WHERE account IN ({_two_known}) GROUP BY 1, 2"""
_months = f"""SELECT {month('m')} AS period FROM (SELECT unnest(generate_series(
  date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)) - INTERVAL 2 MONTH, INTERVAL 1 MONTH)) AS m
  FROM orders)"""
SQL["C17_month_list"] = _months
SQL["C17_quarter_ends"] = f"SELECT period FROM ({_months}) WHERE period % 100 IN (3, 6, 9, 12)"
SQL["C18_one_day_per_month"] = """SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS rows FROM orders
WHERE o_orderdate IN (SELECT min(o_orderdate) FROM orders GROUP BY date_trunc('month', o_orderdate)) GROUP BY 1"""
_classes = ", ".join(f"({text(s)}, {text(g)}, {text(lv)})" for s, (g, lv) in C.GDP_SECTORS.items())
CLASS_TABLE = f"(SELECT * FROM (VALUES {_classes}) c(sector, sector_group, level))"
SQL["C23_sector_classes"] = f"""SELECT quarter, sector, sector_group, level, volume_index
FROM quarter_gdp JOIN {CLASS_TABLE} USING (sector)"""
SQL["C24_size_bands"] = """SELECT g.place_id, g.year,
  CASE WHEN gdp >= 1e7 THEN '1. Acima de R$ 10 bi' WHEN gdp >= 1e6 THEN '2. R$ 1 bi a 10 bi'
       WHEN gdp >= 1e5 THEN '3. R$ 100 mi a 1 bi' ELSE '4. Até R$ 100 mi' END AS gdp_band,
  CASE WHEN p >= 1e6 THEN '1. Acima de 1 milhão' WHEN p >= 5e5 THEN '2. 500 mil a 1 milhão'
       WHEN p >= 1e5 THEN '3. 100 mil a 500 mil' WHEN p >= 2e4 THEN '4. 20 mil a 100 mil'
       ELSE '5. Até 20 mil' END AS population_band
FROM place_gdp g LEFT JOIN (SELECT place_id, year, population * 40 AS p FROM population_b) b
  ON b.place_id = g.place_id AND b.year = g.year"""
SQL["C25_region_codes"] = """SELECT state, region, replace(upper(region), '-', '_') AS code, count(*) AS rows
FROM place GROUP BY 1, 2, 3"""

# --- filters ---------------------------------------------------------------------------------

SQL["P1_latest_position"] = f"SELECT * FROM place_balance WHERE period = {MAX_BALANCE}"
SQL["P1_latest_of_other"] = """SELECT * FROM portfolio_value
WHERE period = (SELECT max(period) FROM statement_value)"""
SQL["P2_latest_where_known"] = """SELECT * FROM quarter_gdp
WHERE quarter = (SELECT max(quarter) FROM quarter_gdp WHERE rate_vs_prev_quarter IS NOT NULL)"""


def _both_latest(columns: str) -> str:
    return f"""SELECT {columns} FROM v5 WHERE period = (SELECT max(period) FROM v5 WHERE frequency = 'TRIMESTRAL')
UNION ALL SELECT {columns} FROM v5 WHERE frequency = 'MENSAL'
  AND period = (SELECT max(period) FROM v5 WHERE frequency = 'MENSAL')"""


SQL["P3_latest_per_frequency"] = _both_latest("*")
SQL["P4_trailing_year"] = f"""SELECT period, count(*) AS rows FROM place_balance
WHERE period > {MAX_BALANCE} - 100 GROUP BY 1"""
SQL["P5_size_limits"] = f"""SELECT place_id, {exact('gdp')} AS gdp FROM place_gdp WHERE gdp >= 1000 GROUP BY 1
HAVING SUM(gdp) >= 5000"""
SQL["P6_metric_family"] = """SELECT metric, client, count(*) AS rows FROM v5
WHERE metric IN ('SALDO', 'CONCESSAO') GROUP BY 1, 2"""
SQL["P7_case_insensitive"] = """SELECT modality, segment, count(*) AS rows FROM lending_rate
WHERE lower(modality) LIKE '%imobili%' GROUP BY 1, 2"""
SQL["P8_two_latest"] = RATES_NOW.replace(
    "SELECT tax_id8, institution, segment, modality, month_rate, year_rate FROM", "SELECT * FROM", 1
)
_nested_list = ", ".join(text(p) for p in C.NESTED_PRODUCTS)


def _leaf(metric: str, search: str) -> str:
    return f"""credit_series WHERE metric = '{metric}' AND search = '{search}' AND modality IS NOT NULL
  AND modality NOT IN ({_nested_list})"""


SQL["P9_leaf_products"] = f"SELECT code, modality, client FROM {_leaf('SALDO', 'Saldo da carteira de crédito')}"
SQL["P10_null_safe_exclusion"] = """SELECT v.code, s.modality, count(*) AS rows FROM credit_value v
JOIN credit_series s USING (code) WHERE s.modality IS NULL OR s.modality NOT LIKE '%Série encadeada%' GROUP BY 1, 2"""
_live = """SELECT inst_id, period, value AS total_assets FROM statement_value
  WHERE account = '140220' AND period = (SELECT max(period) FROM statement_value)"""
SCOPE = f"""(SELECT inst_id FROM (SELECT * FROM ({_live}) ORDER BY total_assets DESC, inst_id LIMIT 10)
  UNION SELECT i.inst_id FROM institution i JOIN ({_live}) v ON v.inst_id = i.inst_id AND v.period = i.period
  WHERE i.state IN ('NATION_3', 'NATION_7') OR (i.state = 'NATION_5' AND i.city = 'CITY_2'))"""
SQL["P11_scope"] = f"SELECT inst_id FROM {SCOPE}"
SQL["P12_last_periods"] = f"""SELECT period, {exact('amount')} AS amount FROM place_balance
WHERE period IN (SELECT DISTINCT period FROM place_balance ORDER BY period DESC LIMIT 6) GROUP BY 1"""
SQL["P13_as_of_cut"] = """SELECT start_date, count(*) AS rows FROM lending_rate
WHERE start_date >= '1998-01-01' GROUP BY 1"""

# --- joins -----------------------------------------------------------------------------------

SQL["J1_fact_dimension"] = f"""SELECT p.state, b.account, {exact('b.amount')} AS amount
FROM place_balance b JOIN place p USING (place_id) GROUP BY 1, 2"""
SQL["J2_optional_fact"] = """SELECT g.place_id, g.year, g.gdp, b.population FROM place_gdp g
LEFT JOIN population_b b ON b.place_id = g.place_id AND b.year = g.year"""
SQL["J3_year_ago"] = f"""SELECT v.code, v.period, v.value, a.value AS value_year_ago,
  {change('v.value', 'a.value')} AS change_pct
FROM credit_value v LEFT JOIN credit_value a ON a.code = v.code AND a.period = v.period - 100"""


def _share(value: str, part: str, digits: int = 2) -> str:
    whole = f"CAST(SUM(CAST({value} AS DECIMAL(28,6))) OVER (PARTITION BY {part}) AS DOUBLE)"
    return ratio(value, whole, "1e2", digits)


SQL["J4_denominator"] = f"SELECT code, period, value, {_share('value', 'period')} AS share_pct FROM series_value"
SQL["J5_many_sources"] = f"""SELECT p.place_id, g.gdp, f.firms, b.banks FROM place p
LEFT JOIN (SELECT place_id, {exact('gdp')} AS gdp FROM place_gdp GROUP BY 1) g USING (place_id)
LEFT JOIN (SELECT place_id, max(active_companies) AS firms FROM place_company_total GROUP BY 1) f USING (place_id)
LEFT JOIN (SELECT place_id, max(institutions) AS banks FROM place_presence GROUP BY 1) b USING (place_id)"""
SQL["J6_list_membership"] = f"""SELECT m.sector, c.year, {exact('c.companies')} AS companies
FROM sector_map m JOIN place_company c
  ON ',' || replace(m.sections, ' ', '') || ',' LIKE '%,' || c.section || ',%' GROUP BY 1, 2"""
SQL["J7_semi_join_top"] = f"""SELECT inst_id, report, {exact('value')} AS value FROM portfolio_value
WHERE inst_id IN {TOP_PORTFOLIOS} GROUP BY 1, 2"""
SQL["J8_valid_keys"] = """SELECT place_id, count(*) AS rows FROM place_balance
WHERE place_id IN (SELECT place_id FROM place) GROUP BY 1"""
SQL["J9_anti_join"] = """SELECT place_id, count(*) AS rows FROM place_balance
WHERE place_id NOT IN (SELECT place_id FROM place) GROUP BY 1"""
_absent = "((period // 100) % 3 = CAST(report AS INTEGER) % 3)"
_filled = f"""SELECT inst_id, period, report, account, CASE WHEN {_absent} THEN value * 2 ELSE value END AS value
FROM portfolio_value"""
SQL["J10_fallback_fill"] = _filled
SQL["ST5_fallback_before_load"] = f"SELECT period, report, count(*) AS rows FROM ({_filled}) GROUP BY 1, 2"
SQL["J11_extend_code"] = """SELECT p.place_id, count(*) AS rows FROM job_movement j
JOIN place p ON p.place_id6 = j.place_id6 GROUP BY 1"""
SQL["J11_unmatched_codes"] = """SELECT place_id6, count(*) AS rows FROM job_movement
WHERE place_id6 NOT IN (SELECT place_id6 FROM place) GROUP BY 1"""
SQL["J12_distinct_pairs"] = f"""SELECT c.section, c.companies, n.section_name
FROM (SELECT section, {exact('companies')} AS companies FROM place_company GROUP BY 1) c
LEFT JOIN (SELECT DISTINCT section, section_name FROM division) n USING (section)"""
SQL["J13_first_name"] = f"""SELECT c.section, {exact('c.staff')} AS staff,
  (SELECT min(name) FROM division d WHERE d.section = c.section) AS first_name FROM place_company c GROUP BY 1"""
SQL["J14_one_row_total"] = f"""SELECT section, companies, {ratio('companies', 'SUM(companies) OVER ()', '1e2', 2)} AS share_pct
FROM (SELECT section, {exact('companies')} AS companies FROM place_company GROUP BY 1)"""

# --- aggregations ----------------------------------------------------------------------------

SQL["A1_pivot_max"] = f"""SELECT place_id, {_max_of(C.PLACE_CREDIT_COLUMNS, 'account', 'amount')}
FROM place_balance GROUP BY 1"""
SQL["A2_pivot_sum"] = f"SELECT period, {_pivot} FROM place_balance GROUP BY 1"
SQL["A3_pivot_zero"] = "SELECT state, " + ", ".join(
    f"{long(f'SUM(CASE WHEN class = {text(v)} THEN cases ELSE 0 END)')} AS {k}"
    for k, v in C.INSOLVENCY_COLUMNS.items()
) + " FROM insolvency GROUP BY 1"
SQL["A4_pivot_first"] = """SELECT inst_id, period, max(value) FILTER (account = '140220') AS assets,
  max(value) FILTER (account IN ('141835', '78203')) AS credit FROM statement_value
WHERE account IN ('140220', '141835', '78203') GROUP BY 1, 2"""
SQL["A5_unpivot_sum"] = " UNION ALL ".join(
    f"SELECT year, '{c}' AS part, {exact(c)} AS amount FROM place_gdp GROUP BY 1"
    for c in ("va_agri", "va_industry", "va_services", "va_public")
)
SQL["U2_columns_to_rows"] = SQL["A5_unpivot_sum"]
SQL["A6_distinct_and_sum"] = """SELECT l_suppkey, count(DISTINCT l_partkey) AS parts,
  COALESCE(SUM(l_quantity) FILTER (l_linenumber = 9), 0)::DOUBLE AS none, SUM(l_quantity) AS quantity FROM lineitem GROUP BY 1"""
SQL["A7_two_phase"] = f"""SELECT l_returnflag, l_linestatus, {money('l_extendedprice')} AS price,
  SUM(l_quantity) AS quantity, count(*) AS rows FROM lineitem GROUP BY 1, 2"""


def _signed(keys: str, where: str = "") -> str:
    sgn = "CASE kind WHEN 'EXC' THEN -1 ELSE 1 END"
    return f"""SELECT {keys}, {long(f"SUM(CASE WHEN movement > 0 THEN {sgn} ELSE 0 END)")} AS hires,
  {long(f"SUM(CASE WHEN movement < 0 THEN {sgn} ELSE 0 END)")} AS leavers, {long(f"SUM({sgn} * movement)")} AS net,
  CAST(COALESCE(SUM(CASE WHEN movement > 0 THEN {sgn} * CAST(wage AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS wage_sum,
  {long(f"SUM(CASE WHEN movement > 0 AND wage IS NOT NULL THEN {sgn} ELSE 0 END)")} AS wage_count
FROM job_movement {where} GROUP BY {keys}"""


SQL["A8_signed_microdata"] = _signed("period, division", "WHERE kind = 'MOV'")
SQL["A9_retractions"] = _signed("period, division")
SQL["ST2_late_and_retracted"] = SQL["A9_retractions"]
SQL["A10_mean_wage"] = f"""SELECT division, hires, leavers, net, {ratio('wage_sum', 'wage_count', '1e0', 2)} AS mean_wage
FROM ({_signed('division')})"""
SQL["A11_weighted_mean"] = f"""SELECT division,
  {rnd(f"{exact('mean_wage * hires')} / NULLIF(CAST(SUM(hires) FILTER (mean_wage IS NOT NULL) AS DOUBLE), 0)", 2)} AS mean_wage
FROM place_jobs GROUP BY 1"""
SQL["A12_roll_up"] = f"""SELECT p.region, g.year, {exact('g.gdp')} AS gdp, count(DISTINCT p.state) AS states
FROM place_gdp g JOIN place p USING (place_id) GROUP BY 1, 2"""
SQL["A13_carried_attributes"] = f"""SELECT place_id, any_value(name) AS name, any_value(state) AS state,
  {exact('companies')} AS companies FROM v29 GROUP BY 1"""
SQL["A14_band_pairs"] = f"""SELECT gdp_band, population_band, count(*) AS places, {exact('gdp')} AS gdp, {mean('gdp')} AS mean_gdp
FROM (SELECT gdp, CASE WHEN gdp * 50 >= 1e7 THEN '1. Acima de R$ 10 bi' WHEN gdp * 50 >= 1e6 THEN '2. R$ 1 bi a 10 bi'
       WHEN gdp * 50 >= 1e5 THEN '3. R$ 100 mi a 1 bi' ELSE '4. Até R$ 100 mi' END AS gdp_band,
      CASE WHEN population >= 1e6 THEN '1. Acima de 1 milhão' WHEN population >= 5e5 THEN '2. 500 mil a 1 milhão'
       WHEN population >= 1e5 THEN '3. 100 mil a 500 mil' WHEN population >= 2e4 THEN '4. 20 mil a 100 mil'
       ELSE '5. Até 20 mil' END AS population_band FROM v19) GROUP BY 1, 2"""
_assets = "(SELECT inst_id, period, value AS total_assets FROM statement_value WHERE account = '140220')"
SQL["A15_all_and_matched"] = f"""SELECT i.period, count(*) AS registered, count(d.total_assets) AS matched
FROM institution i LEFT JOIN {_assets} d ON d.inst_id = i.inst_id AND d.period = i.period GROUP BY 1"""
SQL["A16_distinct_per_period"] = f"""SELECT period, count(DISTINCT inst_id) AS institutions, {exact('value')} AS value
FROM statement_value GROUP BY 1"""
SQL["A17_rounded_mean_top"] = f"""SELECT institution, {rnd(mean('year_rate'), 1)} AS rate FROM lending_rate GROUP BY 1
ORDER BY rate DESC, institution LIMIT 12"""
SQL["A18_having"] = """SELECT tax_id8, modality, count(*) AS rows FROM lending_rate GROUP BY 1, 2 HAVING count(*) >= 80"""
SQL["A19_load_summary"] = """SELECT count(*) AS rows, min(period) AS first_period, max(period) AS last_period,
  count(DISTINCT place_id) AS keys FROM place_balance"""

# --- windows ---------------------------------------------------------------------------------

_w = "OVER (PARTITION BY state, class ORDER BY period)"
SQL["W1_lag_12_rows"] = f"""SELECT state, class, period, cases, lag(cases, 12) {_w} AS before,
  {change('cases', f'lag(cases, 12) {_w}')} AS change_pct FROM insolvency"""
_nation = f"(SELECT period, {exact('amount')} AS amount FROM place_balance GROUP BY 1)"
SQL["W2_national_lags"] = f"""SELECT period, amount, {change('amount', 'lag(amount) OVER (ORDER BY period)')} AS change_1_pct,
  {change('amount', 'lag(amount, 12) OVER (ORDER BY period)')} AS change_12_pct FROM {_nation}"""
SQL["W3_rolling_12"] = f"""SELECT place_id, period, institutions,
  {long("SUM(institutions) OVER (PARTITION BY place_id ORDER BY period ROWS 11 PRECEDING)")} AS rolling FROM place_presence"""
SQL["W4_share_of_group"] = f"SELECT code, client, size, period, value, {_share('value', 'client, size, period')} AS share_pct FROM v5"
SQL["W5_global_rank"] = """SELECT o_custkey, orders, rank() OVER (ORDER BY orders DESC) AS position
FROM (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1)"""
SQL["W5_rank_per_year"] = """SELECT *, rank() OVER (PARTITION BY year ORDER BY price DESC NULLS LAST) AS position FROM (
  SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
         CASE WHEN o_orderkey % 10 <> 0 THEN CAST(floor(o_totalprice / 1000) AS BIGINT) END AS price FROM orders)"""
SQL["W5_rank_in_state"] = """SELECT g.place_id, p.state, g.year,
  rank() OVER (PARTITION BY p.state, g.year ORDER BY g.gdp DESC) AS in_state,
  rank() OVER (PARTITION BY g.year ORDER BY g.gdp DESC) AS in_nation, rank() OVER (ORDER BY g.gdp DESC) AS ever FROM place_gdp g JOIN place p USING (place_id)"""
SQL["W6_share_of_nation"] = f"SELECT state, year, gdp, {_share('gdp', 'year')} AS share_pct FROM v33"
SQL["W7_population_grid"] = "SELECT * FROM population_ref"
SQL["W8_source_precedence"] = "SELECT * FROM population_merged"
_axis = "(SELECT DISTINCT period FROM insolvency)"
_unions = " UNION ALL ".join(
    f"SELECT '{c}' AS class, period, {c} AS cases FROM v18" for c in C.INSOLVENCY_COLUMNS
)
SQL["W9_position_changes"] = f"""SELECT class, CAST(row_number() OVER w - 1 AS INTEGER) AS position, cases,
  cases - lag(cases) OVER w AS step,
  {rnd('(cases / NULLIF(CAST(lag(cases) OVER w AS DOUBLE), 0) - 1) * 100', 2)} AS step_pct,
  {rnd('(cases / NULLIF(CAST(lag(cases, 12) OVER w AS DOUBLE), 0) - 1) * 100', 2)} AS year_pct
FROM ({_unions}) WINDOW w AS (PARTITION BY class ORDER BY period)"""
SQL["D15_insolvency"] = SQL["W9_position_changes"]


def _exact_changes(source: str, value: str) -> str:
    return f"""SELECT n.period, n.{value} AS value, {change(f'n.{value}', f'm.{value}', 1)} AS change_month_pct,
  {change(f'n.{value}', f'd.{value}', 1)} AS change_december_pct, {change(f'n.{value}', f'y.{value}', 1)} AS change_year_pct
FROM (SELECT * FROM {source} ORDER BY period DESC LIMIT 1) n
LEFT JOIN {source} m ON m.period = CASE WHEN n.period % 100 = 1 THEN n.period - 89 ELSE n.period - 1 END
LEFT JOIN {source} d ON d.period = (n.period // 100 - 1) * 100 + 12
LEFT JOIN {source} y ON y.period = n.period - 100"""


def _previous_year(source: str, value: str) -> str:
    return f"""SELECT year, value, lag(year) OVER (ORDER BY year) AS previous_year,
  {change('value', 'lag(value) OVER (ORDER BY year)', 1)} AS change_pct
FROM (SELECT year, {exact(value)} AS value FROM {source} GROUP BY 1) WHERE value IS NOT NULL
ORDER BY year DESC LIMIT 1"""


SQL["W10_exact_period_changes"] = _exact_changes(_nation, "amount")
SQL["W11_previous_year"] = _previous_year("place_gdp", "gdp")
SQL["W12_record_high"] = """SELECT code, value, period FROM series_value
QUALIFY row_number() OVER (PARTITION BY code ORDER BY value DESC, period) = 1"""
SQL["W13_last_known"] = "SELECT sector, max_by(rate_vs_prev_quarter, quarter) FILTER (rate_vs_prev_quarter IS NOT NULL) AS last_rate FROM quarter_gdp GROUP BY 1"

# --- sorts, limits, top-k --------------------------------------------------------------------

SQL["T1_top"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 300"
SQL["T2_top_keys"] = f"""SELECT inst_id FROM (SELECT inst_id, {exact('value')} AS value FROM statement_value GROUP BY 1)
ORDER BY value DESC, inst_id LIMIT 10"""
SQL["T3_top_per_group"] = """SELECT place_id, year, section, companies,
  CAST(row_number() OVER w AS INTEGER) AS position FROM place_company
WINDOW w AS (PARTITION BY place_id, year ORDER BY companies DESC, section) QUALIFY row_number() OVER w <= 3"""
_label = "modality || COALESCE(' (' || client || ')', '')"
_largest = f"""(SELECT s.code, {_label} AS label, v.value FROM (SELECT * FROM {_leaf('SALDO', 'Saldo da carteira de crédito')}) s
  JOIN credit_value v ON v.code = s.code AND v.period = (SELECT max(period) FROM credit_value)
  ORDER BY v.value DESC, s.code LIMIT 5)"""
_total = "(SELECT period, value FROM credit_value WHERE code = 0)"
SQL["T4_top_and_rest"] = f"""SELECT l.label, 'series' AS kind, v.period, v.value FROM credit_value v
JOIN {_largest} l ON l.code = v.code WHERE v.period IN (SELECT period FROM {_total})
UNION ALL
SELECT 'Outros', 'rest', t.period, {rnd("t.value - COALESCE(s.taken, 0)", 1)} FROM {_total} t
LEFT JOIN (SELECT v.period, {exact('v.value')} AS taken FROM credit_value v JOIN {_largest} l ON l.code = v.code GROUP BY 1) s
  ON s.period = t.period
UNION ALL SELECT 'Total', 'total', period, value FROM {_total}"""
SQL["D5_largest_portfolios"] = SQL["T4_top_and_rest"]
SQL["T5_nulls_last"] = """SELECT quarter, sector, rate_vs_prev_quarter FROM quarter_gdp
ORDER BY rate_vs_prev_quarter DESC NULLS LAST, quarter, sector LIMIT 60"""
SQL["T6_multi_key_sort"] = "SELECT * FROM insolvency ORDER BY state, period DESC, class"
_places = f"(SELECT place_id, {exact('gdp')} AS gdp FROM place_gdp GROUP BY 1)"


def _extremes(source: str, key: str, metric: str) -> str:
    def pick(c: str, direction: str) -> str:
        return f"(SELECT {c} FROM {source} WHERE {metric} IS NOT NULL ORDER BY {metric} {direction}, {key} LIMIT 1)"

    return f"""SELECT {pick(key, 'DESC')} AS best, {pick(metric, 'DESC')} AS best_value,
  {pick(key, 'ASC')} AS worst, {pick(metric, 'ASC')} AS worst_value"""


SQL["T7_extremes"] = _extremes(_places, "place_id", "gdp")
SQL["T8_missing_last"] = f"""SELECT i.inst_id, i.period, d.total_assets FROM institution i
LEFT JOIN {_assets} d ON d.inst_id = i.inst_id AND d.period = i.period"""

# --- set operations, scalars -----------------------------------------------------------------

SQL["U1_two_eras"] = "SELECT period, era, net FROM v30"
SQL["U3_union_of_latest"] = _both_latest("code, frequency, period, value")
SQL["U4_union_of_keys"] = """SELECT o_custkey AS key FROM orders WHERE o_totalprice > 400000
UNION SELECT o_custkey FROM orders WHERE year(o_orderdate) = 2001"""
SQL["U5_differing_layouts"] = """SELECT place_id, year, population, 'a' AS source FROM population_a
UNION ALL SELECT place_id, year, NULL, 'b' FROM population_b"""
SQL["F1_percent_change"] = f"SELECT place_id, year, {change('va_agri', 'va_industry')} AS change_pct FROM place_gdp"
SQL["F2_ratios"] = f"""SELECT place_id, year, {ratio('wages', 'staff', '1e3', 2)} AS per_head,
  {ratio('paid_staff', 'staff', '1e2', 1)} AS paid_pct, {ratio('active_companies', 'local_units', '1e0', 3)} AS firms_per_unit
FROM place_company_total"""
SQL["F3_null_rules"] = f"""SELECT place_id, year, {ratio('va_agri', 'NULLIF(taxes, 0)', '1e2', 2)} AS r,
  CASE WHEN taxes > 100 THEN 'high' END AS level FROM place_gdp"""
SQL["F4_strings"] = """SELECT p_partkey, p_brand || '/' || p_type AS joined, replace(p_name, ' ', '_') AS replaced,
  regexp_extract(p_brand, '#(\\d+)', 1) AS number, p_type LIKE 'S%' AS is_s, trim(p_name) AS stripped FROM part"""
SQL["F5_sign_flip"] = "SELECT place_id, period, -amount AS provision FROM place_balance WHERE account = 174"


def _sum0(columns: list[str], wrap: str = "{}") -> str:
    return " + ".join(wrap.format(f"COALESCE({c}, 0e0)") for c in columns)


_revenue = f"{_sum0(C.REVENUE_COLUMNS)} + {_sum0(C.EITHER_COLUMNS, 'greatest({}, 0e0)')}"
_cost = f"-({_sum0(C.COST_COLUMNS)}) + {_sum0(C.EITHER_COLUMNS, '(-least({}, 0e0))')}"
_roa = rnd(
    "net_income * CASE period % 100 WHEN 3 THEN 4e0 WHEN 6 THEN 2e0 WHEN 9 THEN 4e0 / 3 WHEN 12 THEN 1e0 END"
    " / NULLIF(total_assets, 0) * 1e2", 2,
)


def _metrics(source: str) -> str:
    return f"""(SELECT * REPLACE (-credit_expected_loss AS credit_expected_loss),
  CASE WHEN interbank_income IS NOT NULL THEN {_revenue} END AS total_revenue,
  CASE WHEN interbank_income IS NOT NULL THEN {_cost} END AS total_cost, {_roa} AS roa FROM {source})"""


SQL["F6_statement_totals"] = f"SELECT inst_id, period, total_revenue, total_cost, net_income FROM {_metrics('v13')}"
SQL["F7_return_on_assets"] = f"""SELECT inst_id, period, 4e0 / (period % 100 // 3) AS factor, roa FROM {_metrics('v13')}"""
SQL["F8_year_changes"] = f"""SELECT v.code, v.period,
  CASE WHEN v.value <> 0 THEN {change('v.value', 'a.value')} END AS pct, {rnd('v.value - a.value', 2)} AS points
FROM credit_value v LEFT JOIN credit_value a ON a.code = v.code AND a.period = v.period - 100"""
SQL["F9_two_units"] = f"""SELECT y.period, y.value AS yearly, m.value AS monthly, {rnd('y.value - b.value', 2)} AS change_12m_pp
FROM (SELECT * FROM series_value WHERE code = 20719 ORDER BY period DESC LIMIT 1) y
LEFT JOIN series_value m ON m.code = 25438 AND m.period = y.period
LEFT JOIN series_value b ON b.code = 20719 AND b.period = y.period - 100"""
SQL["D6_invoice_rate"] = SQL["F9_two_units"]
SQL["F10_label_with_client"] = "SELECT code, title || COALESCE(' (' || client || ')', '') AS label FROM credit_series"

# --- aligned series --------------------------------------------------------------------------


def _aligned(keys: str, source: str, axis: str, values: dict[str, str], period: str = "period") -> str:
    """Keys x axis with gaps, one block per value, as (keys, series, position, period, value)."""
    names = [k.strip() for k in keys.split(",")]
    on = " AND ".join(f"s.{k} IS NOT DISTINCT FROM k.{k}" for k in names)
    head = ", ".join(f"k.{k}" for k in names)
    return " UNION ALL ".join(
        f"""SELECT {head}, '{out}' AS series, CAST(a.n AS INTEGER) AS position, a.p AS period,
  CAST(s.{c} AS DOUBLE) AS value
FROM (SELECT DISTINCT {keys} FROM {source}) k
CROSS JOIN (SELECT p, row_number() OVER (ORDER BY p) - 1 AS n FROM {axis}) a
LEFT JOIN {source} s ON {on} AND s.{period} = a.p"""
        for c, out in values.items()
    )


def _last(source: str, n: int, period: str = "period") -> str:
    return f"(SELECT DISTINCT {period} AS p FROM {source} ORDER BY p DESC LIMIT {n})"


def _years(source: str) -> str:
    return f"(SELECT CAST(unnest(range(greatest(min(year), max(year) - 9), max(year) + 1)) AS INTEGER) AS p FROM {source})"


AXES = {
    "gdp": _years("place_gdp"),
    "credit": _last("place_balance", 120),
    "jobs": _last("place_jobs", 120),
    "companies": _last("place_company", 10, "year"),
    "population": _years("population_ref"),
    "insolvency": _last("insolvency", 120),
}
_quarters = "(SELECT DISTINCT quarter AS p FROM quarter_gdp)"
_all_months = "(SELECT DISTINCT period AS p FROM insolvency)"
SQL["N1_align"] = _aligned("state", "v17", _all_months, {"judicial": "judicial"})
SQL["N2_reindex"] = _aligned("sector", "quarter_gdp", _quarters, D.GDP_SERIES, "quarter")
SQL["N3_last_attributes"] = """SELECT inst_id, name, segment, state FROM institution WHERE segment IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY inst_id ORDER BY period DESC) = 1
UNION ALL SELECT DISTINCT inst_id, NULL, NULL, NULL FROM institution
WHERE inst_id NOT IN (SELECT inst_id FROM institution WHERE segment IS NOT NULL)"""


def _products(source: str, key: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, {text(label)} AS label, {c} AS value FROM {source} WHERE period = {MAX_BALANCE} AND {c} IS NOT NULL"
        for c, label in C.PRODUCT_LABELS.items()
    )


SQL["N4_label_values"] = _products("v23", "state")
SQL["N5_series_ratio"] = f"""SELECT k.place_id, 'per_capita' AS series, CAST(a.n AS INTEGER) AS position, a.p AS period,
  {ratio('g.gdp', 'r.population', '1e3', 2)} AS value
FROM (SELECT DISTINCT place_id FROM place_gdp) k
CROSS JOIN (SELECT p, row_number() OVER (ORDER BY p) - 1 AS n FROM {AXES['gdp']}) a
LEFT JOIN place_gdp g ON g.place_id = k.place_id AND g.year = a.p
LEFT JOIN population_ref r ON r.place_id = k.place_id AND r.year = a.p"""
SQL["N6_compare_capitals"] = """SELECT c.place_id, c.period, c.credit_total, p.name FROM v22 c
JOIN place p USING (place_id) WHERE p.is_capital AND p.region = 'Nordeste'"""
SQL["N7_state_share"] = f"SELECT state, period, judicial, {_share('judicial', 'period', 1)} AS share_pct FROM v17"
_firm_total = """(SELECT inst_id, name, state, value AS firm_portfolio FROM v16 WHERE period = (SELECT max(period) FROM v16)
  AND size = 'Total da Carteira de Pessoa Jurídica' ORDER BY value DESC NULLS LAST, inst_id LIMIT 30)"""
SQL["N8_nested_portfolio"] = f"""SELECT t.inst_id, t.firm_portfolio,
  CAST(row_number() OVER (PARTITION BY t.inst_id ORDER BY a.value DESC, a.modality) - 1 AS INTEGER) AS position,
  a.modality AS label, a.value
FROM {_firm_total} t JOIN v14 a ON a.inst_id = t.inst_id AND a.client = 'PJ' AND a.bucket = 'Total'
  AND a.period = (SELECT max(period) FROM v14)"""
_recent_rates = "(SELECT * FROM lending_rate WHERE start_date >= '1998-01-01')"
_rate_cells = f"""(SELECT modality, institution, start_date, year_rate FROM {_recent_rates}
  QUALIFY row_number() OVER (PARTITION BY modality, institution, start_date ORDER BY segment) = 1)"""
SQL["N9_rate_history"] = "SELECT * EXCLUDE (series) FROM (" + _aligned(
    "modality, institution", _rate_cells, f"(SELECT DISTINCT start_date AS p FROM {_recent_rates})",
    {"year_rate": "x"}, "start_date",
) + ")"
SQL["D19_rate_history"] = SQL["N9_rate_history"]
SQL["N10_small_projection"] = "SELECT name, state, gdp_per_capita FROM v36"
SQL["N11_recent_values"] = "SELECT period, net_12m FROM v30 WHERE net_12m IS NOT NULL ORDER BY period DESC LIMIT 26"

# --- views, sheets ---------------------------------------------------------------------------

for _n, _name in VIEW_NAMES.items():
    SQL[f"V{_n}_{_name}"] = f"SELECT * FROM v{_n}"
SQL.update(SHEETS)

# --- datasets --------------------------------------------------------------------------------

SQL["D1_credit_series"] = f"SELECT period, {', '.join(D.SERIES_COLUMNS)} FROM v2"
SQL["D1_credit_headline"] = f"""SELECT n.period, n.balance_total,
  CASE WHEN n.balance_total <> 0 THEN {change('n.balance_total', 'b.balance_total')} END AS balance_change_12m_pct,
  n.rate_total, {rnd('n.rate_total - b.rate_total', 2)} AS rate_change_12m_pp, n.default_total,
  {rnd('n.default_total - b.default_total', 2)} AS default_change_12m_pp, n.credit_gdp_pct
FROM (SELECT * FROM v2 ORDER BY period DESC LIMIT 1) n LEFT JOIN v2 b ON b.period = n.period - 100"""


def _ranking(view: str, where: str, quarterly: bool = True) -> str:
    last = f"(SELECT max(period) FROM {view}{' WHERE frequency = ' + text('TRIMESTRAL') if quarterly else ''})"
    return f"""SELECT modality, {rnd(mean('value'), 1)} AS value FROM {view}
WHERE modality IS NOT NULL AND period = {last} AND {where} GROUP BY 1 ORDER BY value DESC NULLS LAST, modality LIMIT 12"""


SQL["D2_rate_ranking"] = _ranking("v6", "client = 'PJ'")
SQL["D2_default_ranking"] = _ranking("v7", "client = 'PJ'")
SQL["D2_term_ranking"] = _ranking("v10", "metric = 'PRAZO_MEDIO_CARTEIRA'", quarterly=False)
SQL["D3_lending_ranking"] = f"""SELECT s.code, {_label} AS label, {rnd('v.value', 1)} AS value
FROM (SELECT * FROM {_leaf('CONCESSAO', 'Concessões de crédito')} AND modality NOT LIKE '%Série encadeada%') s
JOIN credit_value v ON v.code = s.code AND v.period = (SELECT max(period) FROM credit_value)
ORDER BY v.value DESC, s.code LIMIT 12"""
SQL["D4_balance_by_size"] = f"""SELECT client, size, {rnd(exact('value'), 0)} AS value FROM v8
WHERE period = (SELECT max(period) FROM v8 WHERE frequency = 'TRIMESTRAL') GROUP BY 1, 2"""
SQL["D6_total_rate_monthly"] = "SELECT value FROM series_value WHERE code = 25433 ORDER BY period DESC LIMIT 1"
SQL["D7_axes"] = " UNION ALL ".join(
    f"SELECT '{name}' AS axis, CAST(row_number() OVER (ORDER BY p) - 1 AS INTEGER) AS position, p AS period FROM {axis}"
    for name, axis in AXES.items()
)
SQL["D7_totals"] = f"""SELECT {', '.join(f"{exact(c)} AS total_{c}" for c in ('gdp', 'credit_total', 'companies', 'population'))},
  count(*) AS places, {MAX_GDP} AS gdp_year, (SELECT max(year) FROM place_gdp WHERE va_agri IS NOT NULL) AS composition_year,
  {MAX_COMPANY} AS company_year, {MAX_BALANCE} AS credit_period, {MAX_JOBS} AS jobs_period FROM v36"""
_in_place = "place_id IN (SELECT place_id FROM place)"
_firm_years = f"(SELECT place_id, year, {exact('companies')} AS companies FROM place_company WHERE {_in_place} GROUP BY 1, 2)"
_people = f"(SELECT * FROM population_ref WHERE {_in_place})"
SQL["D8_place_histories"] = " UNION ALL ".join(
    [
        _aligned("place_id", f"(SELECT * FROM place_gdp WHERE {_in_place})", AXES["gdp"], {"gdp": "hist_gdp"}, "year"),
        _aligned("place_id", "v22", AXES["credit"], {"credit_total": "hist_credit"}),
        _aligned("place_id", "v27", AXES["jobs"], {"net_12m": "hist_jobs"}),
        _aligned("place_id", _firm_years, AXES["companies"], {"companies": "hist_companies"}, "year"),
        _aligned("place_id", _people, AXES["population"], {"population": "hist_population"}, "year"),
        _aligned("place_id", _people, AXES["gdp"], {"population": "hist_population_gdp"}, "year"),
    ]
)
SQL["D8_place_profile"] = """SELECT r.*, p.lat, p.lng, p.name_key, s.gdp_band, s.population_band
FROM v36 r JOIN place p USING (place_id) LEFT JOIN v20 s USING (place_id)"""
SQL["D8_place_activities"] = f"""SELECT place_id, section, section_name, companies, CAST(row_number() OVER w AS INTEGER) AS position
FROM v29 WHERE year = {MAX_COMPANY} AND companies IS NOT NULL
WINDOW w AS (PARTITION BY place_id ORDER BY companies DESC, section) QUALIFY row_number() OVER w <= 6"""
SQL["D8_place_products"] = _products("v22", "place_id")


def _sizes(key: str, base: str, histories: dict[str, str], lists: dict[str, str], extra: str = "") -> str:
    """Element counts of the nested panel: histories are as long as their axis."""
    cols = [f"p.{key}{extra}"]
    joins = []
    for i, (out, axis) in enumerate(histories.items()):
        joins.append(
            f"LEFT JOIN (SELECT DISTINCT {key}, CAST((SELECT count(*) FROM {AXES[axis]}) AS INTEGER) AS n "
            f"FROM ({base}) WHERE series = '{out}') h{i} ON h{i}.{key} = p.{key}"
        )
        cols.append(f"h{i}.n AS n_{out}")
    for i, (out, sql) in enumerate(lists.items()):
        joins.append(
            f"LEFT JOIN (SELECT {key}, CAST(count(*) AS INTEGER) AS n FROM ({sql}) GROUP BY 1) l{i} ON l{i}.{key} = p.{key}"
        )
        cols.append(f"l{i}.n AS n_{out}")
    return f"SELECT {', '.join(cols)} FROM {{first}} p {' '.join(joins)}"


SQL["D8_place_panel"] = _sizes(
    "place_id", SQL["D8_place_histories"], D.PLACE_HISTORIES,
    {"activities": SQL["D8_place_activities"], "products": SQL["D8_place_products"]}, ", p.gdp_band",
).format(first="(SELECT place_id, gdp_band FROM place LEFT JOIN v20 USING (place_id))")
_state_firms = f"""(SELECT p.state, c.year, {exact('c.companies')} AS companies FROM place_company c JOIN place p USING (place_id) GROUP BY 1, 2)"""
_state_people = f"""(SELECT p.state, r.year, {exact('r.population')} AS population FROM population_ref r JOIN place p USING (place_id) GROUP BY 1, 2)"""
SQL["D9_state_histories"] = " UNION ALL ".join(
    [
        _aligned("state", "v33", AXES["gdp"], {"gdp": "hist_gdp", "population": "hist_population_gdp"}, "year"),
        _aligned("state", _state_people, AXES["population"], {"population": "hist_population"}, "year"),
        _aligned("state", "v23", AXES["credit"], {"credit_total": "hist_credit"}),
        _aligned("state", "v28", AXES["jobs"], {"net_12m": "hist_jobs"}),
        _aligned("state", _state_firms, AXES["companies"], {"companies": "hist_companies"}, "year"),
        _aligned("state", "v17", AXES["insolvency"], {c: f"hist_{c}" for c in C.INSOLVENCY_COLUMNS}),
    ]
)
SQL["D9_state_profile"] = f"""SELECT s.*, h.pct_agri, h.pct_industry, h.pct_services FROM v32 s
LEFT JOIN v33 h ON h.state = s.state AND h.year = (SELECT max(year) FROM place_gdp WHERE va_agri IS NOT NULL)"""
SQL["D9_regional_balances"] = """SELECT s.state, b.code, b.client, b.size, b.value
FROM (SELECT DISTINCT state, replace(upper(region), '-', '_') AS region FROM place) s
JOIN v12 b ON b.region = s.region AND b.period = (SELECT max(period) FROM v12) AND b.value IS NOT NULL"""
SQL["D10_activities"] = "SELECT section, section_name, companies, companies_share_pct, net_12m FROM v34"
SQL["D10_state_activities"] = """SELECT state, section, section_name, companies, CAST(row_number() OVER w AS INTEGER) AS position
FROM v35 WHERE companies IS NOT NULL
WINDOW w AS (PARTITION BY state ORDER BY companies DESC, section) QUALIFY row_number() OVER w <= 8"""
SQL["D9_state_panel"] = _sizes(
    "state", SQL["D9_state_histories"], D.STATE_HISTORIES,
    {
        "activities": SQL["D10_state_activities"], "products": _products("v23", "state"),
        "balances": SQL["D9_regional_balances"],
    },
).format(first="v32")
SQL["D11_insolvency_ranking"] = f"""SELECT u.*, {', '.join(f'n.{c} AS national_{c}, {ratio("u." + c, "n." + c, "1e2", 1)} AS {c}_share_pct' for c in C.INSOLVENCY_COLUMNS)}
FROM v17 u JOIN v18 n ON n.period = u.period WHERE u.period = (SELECT max(period) FROM insolvency)"""
SQL["D12_credit_gdp_history"] = "SELECT period, credit_gdp_pct FROM v2 WHERE credit_gdp_pct IS NOT NULL"
SQL["D14_gdp_sectors"] = _aligned(
    "sector, sector_group, level", f"(SELECT * FROM quarter_gdp JOIN {CLASS_TABLE} USING (sector))", _quarters,
    D.GDP_SERIES, "quarter",
)
SQL["D15_insolvency_states"] = "SELECT x.*, r.region FROM (" + _aligned(
    "state", "v17", _all_months, {c: f"hist_{c}" for c in C.INSOLVENCY_COLUMNS}
) + ") x LEFT JOIN (SELECT DISTINCT state, region FROM place) r USING (state)"
MAX_INST = "(SELECT max(period) FROM institution)"
_bn = f"{rnd(exact('d.total_assets') + ' / 1e6', 2)} AS assets_bn"
SQL["D16_segments"] = f"""SELECT i.segment, count(d.total_assets) AS institutions, {_bn}
FROM institution i LEFT JOIN {_assets} d ON d.inst_id = i.inst_id AND d.period = i.period
WHERE i.period = {MAX_INST} AND i.status = 'A' GROUP BY 1"""
SQL["D16_evolution"] = f"""SELECT i.period, count(DISTINCT CASE WHEN d.total_assets IS NOT NULL THEN i.inst_id END) AS institutions, {_bn}
FROM institution i LEFT JOIN {_assets} d ON d.inst_id = i.inst_id AND d.period = i.period
WHERE i.status = 'A' AND i.period IN (SELECT p FROM {_last('institution', 20)}) GROUP BY 1"""
_active = f"""(SELECT inst_id, name, segment, state, total_assets, net_income, {_roa} AS roa FROM v13
  WHERE period = {MAX_INST} AND status = 'A' AND total_assets IS NOT NULL)"""
SQL["D16_institutions"] = f"SELECT * FROM {_active}"
SQL["D16_leaders"] = f"""SELECT *, CAST(row_number() OVER w AS INTEGER) AS position FROM {_active} WHERE segment IS NOT NULL
WINDOW w AS (PARTITION BY segment ORDER BY total_assets DESC, inst_id) QUALIFY row_number() OVER w <= 10"""
_scoped = f"(SELECT * FROM {_metrics('v13')} WHERE inst_id IN {SCOPE} AND period IN (SELECT p FROM {_last('statement_value', 48)}))"
_attributes = f"""(SELECT inst_id, name, segment, state, status FROM {_scoped}
  QUALIFY row_number() OVER (PARTITION BY inst_id ORDER BY period DESC) = 1)"""
SQL["D17_statement_history"] = f"SELECT a.name, a.segment, a.state, a.status, x.* FROM (" + _aligned(
    "inst_id", _scoped, _last("statement_value", 48), {c: f"hist_{c}" for c in D.STATEMENT_FIELDS}
) + f") x JOIN {_attributes} a USING (inst_id)"
SQL["D17_statement_ranking"] = f"""SELECT a.inst_id, a.name, a.segment, a.state, {', '.join('l.' + c for c in D.STATEMENT_FIELDS)}
FROM {_attributes} a LEFT JOIN (SELECT * FROM {_scoped} WHERE period = (SELECT max(period) FROM statement_value)) l USING (inst_id)"""
SQL["D18_portfolio_totals"] = f"SELECT * FROM {_firm_total}"


def _cut_of(view: str, cut: str, label: str, where: str) -> str:
    return f"""SELECT inst_id, '{cut}' AS cut, {label} AS label, value FROM {view}
WHERE period = (SELECT max(period) FROM {view}) AND {where} AND inst_id IN (SELECT inst_id FROM {_firm_total})"""


SQL["D18_portfolio_cells"] = " UNION ALL ".join(
    [
        _cut_of("v14", "modality", "modality", "client = 'PJ' AND bucket = 'Total'"),
        _cut_of("v14", "overdue", "modality", "client = 'PJ' AND bucket = 'Vencido a Partir de 15 Dias'"),
        _cut_of("v15", "activity", "activity", "bucket = 'Total'"),
        _cut_of("v16", "size", "size", "size <> 'Total da Carteira de Pessoa Jurídica'"),
    ]
)
SQL["D19_rates_now"] = f"""SELECT *, rank() OVER (PARTITION BY modality ORDER BY year_rate NULLS LAST) AS position
FROM ({RATES_NOW})"""

_recent = "(SELECT period, net_12m FROM v30 WHERE net_12m IS NOT NULL ORDER BY period DESC LIMIT 26)"


def _steps(source: str, value: str, name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}_{k}' AS figure, period, CAST(value AS DOUBLE) AS value, change_{k}_pct AS change_pct FROM ({_exact_changes(source, value)})"
        for k in ("month", "december", "year")
    )


def _yearly(table: str, value: str, name: str) -> str:
    source = f"(SELECT * FROM {table} WHERE {_in_place})"
    return f"SELECT '{name}', year, value, change_pct FROM ({_previous_year(source, value)})"


SQL["D20_figures"] = " UNION ALL ".join(
    [
        """SELECT 'gdp_vs_prev_quarter' AS figure, quarter AS period, rate_vs_prev_quarter AS value, CAST(NULL AS DOUBLE) AS change_pct
FROM (SELECT * FROM quarter_gdp WHERE sector = 'PIB a preços de mercado' AND rate_vs_prev_quarter IS NOT NULL ORDER BY quarter DESC LIMIT 1)""",
        _steps("v2", "balance_total", "credit"),
        """SELECT 'credit_gdp_record', period, credit_gdp_pct, NULL
FROM (SELECT * FROM v2 WHERE credit_gdp_pct IS NOT NULL ORDER BY credit_gdp_pct DESC, period LIMIT 1)""",
        _yearly("population_ref", "population", "population"),
        _yearly("place_company", "companies", "companies"),
        _steps(_recent, "net_12m", "jobs_12m"),
    ]
)
_sector_last = f"""(SELECT sector, max_by(rate_vs_prev_year_quarter, quarter) AS value FROM quarter_gdp JOIN {CLASS_TABLE} USING (sector)
  WHERE sector_group <> 'AGREGADO' GROUP BY 1)"""
_courts = "(SELECT state, CAST(judicial AS DOUBLE) AS judicial FROM v17 WHERE period = (SELECT max(period) FROM insolvency) AND judicial > 0)"
SQL["D20_highlights"] = " UNION ALL ".join(
    f"SELECT *, '{name}' AS measure FROM ({_extremes(source, key, metric)})"
    for source, key, metric, name in (
        (_sector_last, "sector", "value", "gdp_sector"),
        ("v32", "state", "credit_gdp_pct", "state_credit_gdp"),
        ("v36", "place_id", "gdp_per_capita", "place_gdp_per_capita"),
        (_courts, "state", "judicial", "state_judicial"),
    )
)

# --- checks and incremental ------------------------------------------------------------------

SQL["Q1_duplicate_keys"] = """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1"""
SQL["Q2_without_partner"] = SQL["J9_anti_join"]
SQL["Q3_broken_totals"] = f"""SELECT inst_id, period, gap FROM (
  SELECT inst_id, period, {rnd('abs(total_revenue - total_cost - net_income)', 2)} AS gap FROM {_metrics('v13')}) WHERE gap > 1"""
SQL["Q4_unclassified"] = f"SELECT DISTINCT sector FROM quarter_gdp WHERE sector NOT IN (SELECT sector FROM {CLASS_TABLE})"
SQL["Q6_broken_identities"] = " UNION ALL ".join(
    f"""SELECT inst_id, period, '{total}' AS total, {rnd(f"abs({total} - ({_sum0(parts)}))", 2)} AS gap FROM v13
WHERE interbank_income IS NOT NULL AND {rnd(f"abs({total} - ({_sum0(parts)}))", 2)} > 0.01"""
    for total, parts in C.STATEMENT_IDENTITIES.items()
)
SQL["ST1_new_inputs_only"] = f"""SELECT {month('l_shipdate')} AS period, l_returnflag,
  {long("SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * 100)")} AS cents, count(*) AS rows FROM lineitem GROUP BY 1, 2"""
SQL["ST3_calendar_months"] = f"""SELECT {month('ts')} AS period, event_type AS class, count(*) AS cases
FROM events GROUP BY 1, 2"""
SQL["ST3_streamed_months"] = SQL["ST3_calendar_months"]
SQL["ST4_latest_release"] = f"""SELECT o_orderkey % 400 AS key, {month('o_orderdate')} AS period, o_orderkey AS release,
  o_totalprice AS value FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderkey % 400, {month('o_orderdate')} ORDER BY o_orderkey DESC) = 1"""


def oracle_sql() -> dict[str, str]:
    return {key: with_blocks(sql) for key, sql in SQL.items()} | ROUND_TRIP_SQL

