"""Base tables in DuckDB SQL, written apart from the Spark adapter."""

from __future__ import annotations

from contract import adapter as A
from regiostat import constants as C


def money(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def exact(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,6))) AS DOUBLE)"


def rnd(x: str, digits: int) -> str:
    """Half-up on the printed decimal, as Spark rounds doubles."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)"


def ratio(num: str, den: str, scale: str = "1e2", digits: int | None = None) -> str:
    x = f"{scale} * ({num}) / NULLIF(CAST({den} AS DOUBLE), 0)"
    return f"({x})" if digits is None else rnd(x, digits)


def change(now: str, before: str, digits: int = 2) -> str:
    return rnd(f"1e2 * ({now}) / NULLIF(CAST({before} AS DOUBLE), 0) - 1e2", digits)


def long(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def text(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def nth(values, index: str) -> str:
    cases = " ".join(
        f"WHEN {i} THEN {v if isinstance(v, int) else text(v)}" for i, v in enumerate(values)
    )
    return f"CASE {index} {cases} END"


def month(d: str) -> str:
    return f"CAST(year({d}) * 100 + month({d}) AS INTEGER)"


def qend(d: str) -> str:
    return f"CAST(year({d}) * 100 + quarter({d}) * 3 AS INTEGER)"


def place_id(pl: str = "pl") -> str:
    return f"lpad(CAST({pl} AS VARCHAR), 6, '0') || CAST({pl} % 10 AS VARCHAR)"


def iso_month(p: str = "period") -> str:
    return f"substr(CAST({p} AS VARCHAR), 1, 4) || '-' || substr(CAST({p} AS VARCHAR), 5, 2) || '-01'"


def values_table(rows, columns: str) -> str:
    body = ", ".join(
        "(" + ", ".join(str(v) if isinstance(v, int) else text(v) for v in r) + ")" for r in rows
    )
    return f"SELECT * FROM (VALUES {body}) v({columns})"


_series_rows = (
    [(c, n, "CREDITO_MACRO", None, None, None, "R$ milhões") for n, c in C.CREDIT_MACRO_SERIES.items()]
    + [(c, n, "ATIVIDADE", None, None, None, "índice") for c, n in A.ACTIVITY_SERIES]
    + [(c, n, "CREDITO_SETOR", lv, s, sub, "R$ milhões") for c, n, lv, s, sub in A.SECTOR_SERIES]
    + [(c, f"Taxa {c}", "JUROS", None, None, None, "%") for c in A.RATE_SERIES]
)

_leaf = A.LEAF_ACCOUNTS
_k = "141825,141830,141835,141836,141837,141842,141847,141848,141849,141850"
_l = "141852,141853,141854"
_v = "141856,141857,141858,141859,141860,141862,141863,141864,141865"


def _member(accounts: str) -> str:
    return f"leaf IN ({', '.join(text(a) for a in accounts.split(','))})"


TABLES: dict[str, str] = {}

TABLES["place"] = f"""
SELECT {place_id()} AS place_id, lpad(CAST(pl AS VARCHAR), 6, '0') AS place_id6, p.name,
       upper(trim(p.name)) AS name_key, n.n_name AS state, CAST(pl % 25 AS VARCHAR) AS state_code,
       CASE n.n_regionkey WHEN 0 THEN 'Norte' WHEN 1 THEN 'Nordeste' WHEN 2 THEN 'Sudeste'
            WHEN 3 THEN 'Sul' WHEN 4 THEN 'Centro-Oeste' END AS region,
       CASE WHEN pl % 40 <> 0 THEN pl / 4e0 - 3e1 END AS lat,
       CASE WHEN pl % 40 <> 0 THEN pl / 8e0 - 6e1 END AS lng,
       pl < 25 AS is_capital
FROM (SELECT c_custkey % 200 AS pl, min(c_name) AS name FROM customer GROUP BY 1) p
JOIN nation n ON n.n_nationkey = pl % 25
WHERE pl % 50 <> 49"""

TABLES["series"] = values_table(_series_rows, "code, name, family, level, sector, subsector, unit")

TABLES["series_value"] = f"""
SELECT code, period, {iso_month()} AS date, value FROM (
  SELECT {nth(A.SERIES_CODES, 'o_orderkey % 40')} AS code, {month('o_orderdate')} AS period,
         {money('o_totalprice')} AS value
  FROM orders GROUP BY 1, 2)"""

TABLES["order_lines"] = f"""
SELECT l.*, o.o_custkey % 200 AS pl, {month('o.o_orderdate')} AS order_period
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey"""

TABLES["place_balance"] = f"""
SELECT period, {place_id()} AS place_id, account,
       CASE WHEN account = 174 THEN -1 ELSE 1 END * (total / 1e3) AS amount
FROM (SELECT order_period AS period, pl, {nth(C.BALANCE_ACCOUNTS, 'l_partkey % 16')} AS account,
             {money('l_extendedprice')} AS total
      FROM order_lines GROUP BY 1, 2, 3)"""

TABLES["place_presence"] = f"""
SELECT order_period AS period, {place_id()} AS place_id,
       count(DISTINCT l_suppkey) AS institutions, sum(l_quantity) AS branches
FROM order_lines GROUP BY order_period, pl"""

TABLES["job_movement"] = f"""
SELECT {month('l_shipdate')} AS period, lpad(CAST(pl AS VARCHAR), 6, '0') AS place_id6,
       lpad(CAST(l_partkey % 99 + 1 AS VARCHAR), 2, '0') AS division,
       CAST(CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE -1 END AS BIGINT) AS movement,
       CASE WHEN l_partkey % 11 <> 0 THEN l_extendedprice END AS wage,
       CASE WHEN l_linenumber <= 4 THEN 'MOV' WHEN l_linenumber <= 6 THEN 'FOR' ELSE 'EXC' END AS kind
FROM order_lines"""

TABLES["job_sums"] = f"""
SELECT period, place_id6, division,
       {long("SUM(sgn * CASE WHEN movement > 0 THEN 1 ELSE 0 END)")} AS hires,
       {long("SUM(sgn * CASE WHEN movement < 0 THEN 1 ELSE 0 END)")} AS leavers,
       {long("SUM(sgn * movement)")} AS net,
       CAST(COALESCE(SUM(CASE WHEN movement > 0 THEN sgn * CAST(wage AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS wage_sum,
       {long("SUM(CASE WHEN movement > 0 AND wage IS NOT NULL THEN sgn ELSE 0 END)")} AS wage_count
FROM (SELECT *, CASE kind WHEN 'EXC' THEN -1 ELSE 1 END AS sgn FROM job_movement)
GROUP BY 1, 2, 3"""

TABLES["place_jobs"] = f"""
SELECT j.period, p.place_id, j.division, j.hires, j.leavers, j.net,
       {rnd('j.wage_sum / NULLIF(CAST(j.wage_count AS DOUBLE), 0)', 2)} AS mean_wage
FROM job_sums j JOIN place p ON p.place_id6 = j.place_id6"""

TABLES["division"] = """
SELECT lpad(CAST(d AS VARCHAR), 2, '0') AS division, chr(CAST(65 + d % 21 AS INTEGER)) AS section,
       'Seção ' || chr(CAST(65 + d % 21 AS INTEGER)) AS section_name,
       'Divisão ' || CAST(d AS VARCHAR) AS name
FROM (SELECT unnest(range(1, 100)) AS d) WHERE d % 33 <> 0"""

_company = """count(DISTINCT l_suppkey)::DOUBLE AS {c}, sum(l_quantity) AS staff,
       sum(CASE WHEN l_returnflag <> 'N' THEN l_quantity END) AS paid_staff"""

TABLES["place_company"] = f"""
SELECT {place_id()} AS place_id, CAST(year(l_shipdate) AS INTEGER) AS year,
       chr(CAST(65 + (l_partkey % 99 + 1) % 21 AS INTEGER)) AS section,
       {_company.format(c='companies')}, {money('l_extendedprice')} / 1e3 AS wages
FROM order_lines GROUP BY pl, 2, 3"""

TABLES["place_company_total"] = f"""
SELECT place_id, year, local_units, active_companies, staff, paid_staff, w / 1e3 AS wages,
       {ratio('w', 'paid_staff', '1e0', 2)} AS mean_wage
FROM (SELECT {place_id()} AS place_id, CAST(year(l_shipdate) AS INTEGER) AS year,
             count(*)::DOUBLE AS local_units, {_company.format(c='active_companies')},
             {money('l_extendedprice')} AS w
      FROM order_lines GROUP BY pl, 2)"""


def _va(i: int) -> str:
    return (
        "CAST(COALESCE(SUM(CASE WHEN o_orderkey % 4 = "
        f"{i} THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0) AS DOUBLE) / 1e3"
    )


TABLES["place_gdp"] = f"""
SELECT {place_id('o_custkey % 200')} AS place_id, CAST(year(o_orderdate) AS INTEGER) AS year,
       {money('o_totalprice')} / 1e3 AS gdp,
       CAST(COALESCE(SUM(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0) AS DOUBLE) / 1e3 AS taxes,
       {money('o_totalprice')} / 1e3 AS va_total,
       {_va(0)} AS va_agri, {_va(1)} AS va_industry, {_va(2)} AS va_services, {_va(3)} AS va_public
FROM orders GROUP BY o_custkey % 200, 2"""

TABLES["quarter_gdp"] = f"""
SELECT CAST(year(o_orderdate) * 100 + quarter(o_orderdate) AS INTEGER) AS quarter,
       CASE o_orderpriority {' '.join(f"WHEN {text(k)} THEN {text(v)}" for k, v in A.QUARTER_SECTORS.items())} END AS sector,
       {money('o_totalprice')} AS volume_index,
       1e2 * count(*) FILTER (o_orderstatus = 'F') / count(*) AS rate_vs_prev_year_quarter,
       1e2 * count(*) FILTER (o_orderstatus = 'O') / count(*) AS rate_4q,
       1e2 * count(*) FILTER (o_orderstatus = 'P') / count(*) AS rate_ytd,
       NULLIF(1e2 * count(*) FILTER (o_orderkey % 3 = 0) / count(*), 0) AS rate_vs_prev_quarter
FROM orders GROUP BY 1, 2"""

TABLES["population_a"] = f"""
SELECT {place_id()} AS place_id, year, total / 1e2 AS population
FROM (SELECT o_custkey % 200 AS pl, CAST(year(o_orderdate) AS INTEGER) AS year,
             {money('o_totalprice')} AS total FROM orders GROUP BY 1, 2)
WHERE year <> 1998 AND NOT (year = 1995 AND pl % 7 = 0)"""

TABLES["population_b"] = f"""
SELECT {place_id()} AS place_id, CAST(y AS INTEGER) AS year, CAST(1000 + pl * 3 + y AS DOUBLE) AS population
FROM (SELECT DISTINCT c_custkey % 200 AS pl FROM customer), (SELECT unnest(range(1993, 1997)) AS y)"""

TABLES["population_merged"] = """
SELECT place_id, year, population FROM population_a
UNION ALL
SELECT place_id, year, population FROM population_b b
WHERE NOT EXISTS (SELECT 1 FROM population_a a WHERE a.place_id = b.place_id AND a.year = b.year)"""

TABLES["population_ref"] = """
SELECT place_id, year, population FROM (
  SELECT g.place_id, g.year,
         COALESCE(last_value(m.population IGNORE NULLS) OVER (PARTITION BY g.place_id ORDER BY g.year
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                  first_value(m.population IGNORE NULLS) OVER (PARTITION BY g.place_id ORDER BY g.year
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS population
  FROM (SELECT p.place_id, CAST(y.year AS INTEGER) AS year
        FROM (SELECT DISTINCT place_id FROM population_merged) p
        CROSS JOIN (SELECT unnest(range(min(year), max(year) + 1)) AS year FROM population_merged) y) g
  LEFT JOIN population_merged m ON m.place_id = g.place_id AND m.year = g.year)
WHERE population IS NOT NULL"""

TABLES["national_jobs"] = """
SELECT s.period, e.era, s.hires, s.leavers, s.net
FROM (SELECT period, sum(hires)::DOUBLE AS hires, sum(leavers)::DOUBLE AS leavers, sum(net)::DOUBLE AS net
      FROM place_jobs GROUP BY 1) s
JOIN (VALUES ('CAGED_ANTIGO', 0, 199812), ('NOVO_CAGED', 199807, 999999)) e(era, first, last)
  ON s.period BETWEEN e.first AND e.last"""

TABLES["credit_series"] = f"""
SELECT code, 'Série ' || CAST(code AS VARCHAR) AS title,
       CASE WHEN code % 23 <> 0 THEN {nth(A.METRICS, 'code % 8')} END AS metric,
       {nth(['PJ', 'PF', 'MEI', None], 'code % 5')} AS client,
       {nth(['MICRO', 'PEQUENO', None], 'code % 3')} AS size,
       {nth(['LIVRE', 'DIRECIONADO', None], '(code // 3) % 3')} AS origin,
       {nth(['NORTE', 'NORDESTE', 'CENTRO_OESTE', 'SUDESTE', 'SUL'], 'code % 7')} AS region,
       {nth(A.PRODUCTS, '(code // 2) % 11')} AS modality,
       CASE WHEN code % 3 = 0 THEN 'TRIMESTRAL' ELSE 'MENSAL' END AS frequency,
       'R$ milhões' AS unit,
       CASE WHEN code % 8 = 7 THEN 'Concessões de crédito' ELSE 'Saldo da carteira de crédito' END AS search,
       CASE WHEN code % 23 = 0 THEN 'NAO_PARSEADO' ELSE 'OK' END AS parse_status
FROM (SELECT DISTINCT CAST(p_partkey % 200 AS INTEGER) AS code FROM part)"""

TABLES["credit_value"] = f"""
SELECT code, period, {iso_month()} AS date, value FROM (
  SELECT CAST(l_partkey % 200 AS INTEGER) AS code, {month('l_shipdate')} AS period,
         {money('l_extendedprice')} AS value FROM lineitem GROUP BY 1, 2)
WHERE code % 3 <> 0 OR period % 100 % 3 = 0"""

_prefixes = [p[0] for p in A.TITLE_PATTERNS] + ["Título desconhecido"]
TABLES["catalogue_hits"] = f"""
WITH named AS (
  SELECT p_partkey, p_name, p_brand, {nth(_prefixes, 'p_partkey % 36')} AS prefix FROM part),
first_search AS (
  SELECT CAST(p_partkey AS INTEGER) AS code,
         prefix || CASE WHEN right(prefix, 1) = '-' THEN ' ' ELSE ' - ' END
         || {nth(['', 'microempresa - ', 'Pessoas jurídicas - recursos livres - ',
                  'Crédito direcionado - Pessoas físicas - ', 'Centro-Oeste - '],
                 '(p_partkey // 36) % 5')}
         || CASE WHEN p_partkey % 6 = 0 THEN 'Total' WHEN p_partkey % 2 = 1 THEN p_name || ' - ' || p_brand
                 ELSE p_name END AS title,
         CASE WHEN p_partkey % 3 = 0 THEN 'trimestral' ELSE ' Mensal ' END AS frequency,
         '%' AS unit, 'busca 1' AS search, 1 AS search_order FROM named)
SELECT * FROM first_search
UNION ALL
SELECT code, 'Título repetido', frequency, unit, 'busca 2', 2 FROM first_search WHERE code % 4 = 0"""

TABLES["institution"] = f"""
SELECT CAST(s.s_suppkey AS VARCHAR) AS inst_id, q.period, s.s_name AS name,
       CASE WHEN s.s_suppkey % 17 <> 0 THEN 'S' || CAST(1 + s.s_suppkey % 5 AS VARCHAR) END AS segment,
       n.n_name AS state, 'CITY_' || CAST(s.s_suppkey % 7 AS VARCHAR) AS city,
       CASE WHEN s.s_suppkey % 13 = 0 THEN 'I' ELSE 'A' END AS status, 1 AS consolidation,
       CAST(NULL AS VARCHAR) AS fin_group_id, CAST(NULL AS VARCHAR) AS prud_group_id
FROM (SELECT DISTINCT l_suppkey, {qend('l_shipdate')} AS period FROM lineitem) q
JOIN supplier s ON s.s_suppkey = q.l_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey"""

TABLES["statement_leaf"] = f"""
SELECT l_suppkey, {qend('l_shipdate')} AS period, {nth(_leaf, 'l_partkey % 24')} AS leaf,
       l_partkey % 24 AS i,
       SUM(CAST(l_extendedprice AS DECIMAL(18,2))
           * CASE WHEN l_partkey % 24 BETWEEN 9 AND 17 THEN -1
                  WHEN l_partkey % 24 >= 18 AND (l_partkey % 24 + l_suppkey) % 2 = 1 THEN -1 ELSE 1 END) AS amount,
       SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS gross
FROM lineitem GROUP BY 1, 2, 3, 4"""

TABLES["statement_value"] = f"""
WITH tree AS (
  SELECT l_suppkey, period, SUM(gross) AS gross, SUM(amount) AS z,
         COALESCE(SUM(amount) FILTER ({_member(_k)}), 0) AS k,
         COALESCE(SUM(amount) FILTER ({_member(_l)}), 0) AS l,
         COALESCE(SUM(amount) FILTER ({_member(_v)}), 0) AS v,
         SUM(amount) FILTER (leaf = '141835') AS credit, SUM(amount) FILTER (leaf = '141842') AS loss
  FROM statement_leaf GROUP BY 1, 2),
entries AS (
  SELECT l_suppkey, period,
         CASE WHEN period >= 199901 THEN leaf WHEN leaf = '141835' THEN '78203'
              WHEN leaf = '141842' THEN '78213' ELSE '783' || lpad(CAST(i AS VARCHAR), 2, '0') END AS account,
         amount FROM statement_leaf
  UNION ALL
  SELECT l_suppkey, period, CASE WHEN period < 199901 THEN '78187' ELSE '141870' END,
         z + CASE WHEN l_suppkey % 19 = 0 THEN 5 ELSE 0 END FROM tree
  UNION ALL SELECT l_suppkey, period, '141851', k FROM tree WHERE period >= 199901
  UNION ALL SELECT l_suppkey, period, '141855', l FROM tree WHERE period >= 199901
  UNION ALL SELECT l_suppkey, period, '141866', v FROM tree WHERE period >= 199901
  UNION ALL SELECT l_suppkey, period, '141867', k + l + v + CASE WHEN l_suppkey % 29 = 0 THEN 7 ELSE 0 END
            FROM tree WHERE period >= 199901
  UNION ALL SELECT l_suppkey, period, '141831', credit FROM tree WHERE period >= 199901 AND credit IS NOT NULL
  UNION ALL SELECT l_suppkey, period, '141840', loss FROM tree WHERE period >= 199901 AND loss IS NOT NULL
  UNION ALL SELECT l_suppkey, period, '140220', CASE WHEN l_suppkey % 23 = 0 THEN 0 ELSE gross * 10 END
            FROM tree WHERE period >= 199901 AND l_suppkey % 9 <> 4)
SELECT CAST(l_suppkey AS VARCHAR) AS inst_id, period, account, CAST(amount AS DOUBLE) AS value FROM entries"""

TABLES["portfolio_value"] = f"""
WITH cells AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS inst_id, {qend('l_shipdate')} AS period,
         CASE WHEN l_linenumber <= 2 THEN '11' WHEN l_linenumber <= 4 THEN '13'
              WHEN l_linenumber = 5 THEN '12' ELSE '14' END AS report,
         CASE WHEN l_linenumber <= 5 THEN 'Grupo ' || CAST(l_partkey % 6 AS VARCHAR) END AS "group",
         CASE WHEN l_linenumber <= 5 THEN {nth(A.BUCKETS, 'CAST(floor(l_quantity / 8) AS INTEGER)')}
              ELSE {nth(A.SIZES, 'CAST(floor(l_quantity / 8) AS INTEGER)')} END AS column_name,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount
  FROM lineitem GROUP BY 1, 2, 3, 4, 5),
every AS (
  SELECT * FROM cells
  UNION ALL
  SELECT inst_id, period, report, "group",
         CASE report WHEN '14' THEN 'Total da Carteira de Pessoa Jurídica' ELSE 'Total' END, SUM(amount)
  FROM cells GROUP BY 1, 2, 3, 4)
SELECT inst_id, period, report, "group",
       report || '|' || COALESCE("group", '-') || '|' || column_name AS account, column_name,
       CAST(amount AS DOUBLE) AS value FROM every"""

TABLES["lending_rate"] = f"""
SELECT {iso_month()} AS start_date, lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS tax_id8,
       'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS institution,
       CASE l_linestatus WHEN 'O' THEN 'Pessoa Física' ELSE 'Pessoa Jurídica' END AS segment,
       {nth(A.MODALITIES, 'm')} AS modality,
       CAST(d AS DOUBLE) / n AS month_rate, CAST(x AS DOUBLE) / n AS year_rate
FROM (SELECT {month('l_shipdate')} AS period, l_suppkey, l_linestatus, l_partkey % 6 AS m,
             SUM(CAST(round(l_discount * 100) AS BIGINT)) AS d, SUM(CAST(round(l_tax * 100) AS BIGINT)) AS x,
             count(*) AS n FROM lineitem GROUP BY 1, 2, 3, 4)
WHERE m <> 0 OR period % 2 = 0"""

TABLES["insolvency"] = f"""
SELECT 'NATION_' || CAST(o_custkey % 200 % 25 AS VARCHAR) AS state,
       'court_' || CAST(o_custkey % 200 % 25 AS VARCHAR) AS court, {month('o_orderdate')} AS period,
       CASE o_orderstatus WHEN 'P' THEN 'RECUPERACAO_JUDICIAL' WHEN 'O' THEN 'RECUPERACAO_EXTRAJUDICIAL'
            ELSE 'FALENCIA' END AS class, count(*) AS cases
FROM orders GROUP BY 1, 2, 3, 4"""

TABLES["sector_map"] = values_table(
    [
        ("AGROPECUARIA", "AGROPECUARIA", "A", "AGRO"),
        ("INDUSTRIA", "INDUSTRIA", "B,C, D,E,F", "INDUSTRIA"),
        ("SERVICOS", "SERVICOS", "G,H,I,J,K,L,M,N,R,S", "SERVICOS"),
        ("ADM_PUBLICA", None, "O,P,Q", "ADM_PUBLICA"),
        ("OUTROS", "OUTROS", "T,U", None),
    ],
    "sector, series_sector, sections, value_added_sector",
)
