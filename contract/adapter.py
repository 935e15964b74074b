"""Base tables of the engine derived from the driver's order, line, customer and supplier tables.

Every fact is reduced to its own grain right after the scan (partial aggregates before the
shuffle); dimensions are joined to the reduced rows only. Amounts are summed as integer cents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat import constants as C
from regiostat.functions import clean as X
from regiostat.functions import metrics as M
from regiostat.functions import periods as P
from regiostat.operators.crosswalk import extend_code
from regiostat.operators.population import reference_population
from regiostat.operators.titles import CLIENT_TOKENS, TITLE_PATTERNS
from regiostat.plans.catalogue import VIEWS
from regiostat.sources.movements import finish_jobs, signed_jobs
from regiostat.session import work_folder
from regiostat.tables import TableSet

PLACES = 200
SERIES = 200
NEW_ERA_CUT = 199901

# Sector and activity series with their labels.
SECTOR_SERIES = [
    (22027, "Agropecuária", "SETOR", "AGROPECUARIA", None),
    (22043, "Indústria total", "SETOR", "INDUSTRIA", None),
    (22044, "Serviços total", "SETOR", "SERVICOS", None),
    (22042, "Outros", "SETOR", "OUTROS", None),
    (22030, "Indústria de construção", "SUBSETOR", "INDUSTRIA", "CONSTRUCAO"),
    (22034, "Utilidade pública", "SUBSETOR", "INDUSTRIA", "SIUP"),
    (27722, "Química e farmacêutica", "SUBSETOR", "INDUSTRIA", "TRANSFORMACAO"),
    (22036, "Comércio", "SUBSETOR", "SERVICOS", "COMERCIO"),
    (22037, "Transportes", "SUBSETOR", "SERVICOS", "TRANSPORTES"),
    (22039, "Administração pública", "SUBSETOR", "SERVICOS", "ADM_PUBLICA"),
    (27742, "Serviços financeiros", "SUBSETOR", "SERVICOS", "OUTROS_SERVICOS"),
]
ACTIVITY_SERIES = [
    (24363, "Atividade"), (24364, "Atividade com ajuste"), (25406, "Atividade Norte"),
    (25388, "Atividade Nordeste"), (25393, "Atividade Sudeste"), (25400, "Atividade Sul"),
    (25381, "Atividade Centro-Oeste"),
]
RATE_SERIES = [C.INVOICE_RATE_YEARLY, C.INVOICE_RATE_MONTHLY, C.TOTAL_RATE_MONTHLY]
SERIES_CODES = (
    list(C.CREDIT_MACRO_SERIES.values())
    + [r[0] for r in ACTIVITY_SERIES]
    + [r[0] for r in SECTOR_SERIES]
    + RATE_SERIES
)
QUARTER_SECTORS = {
    "1-URGENT": "PIB a preços de mercado",
    "2-HIGH": "Agropecuária - total",
    "3-MEDIUM": "Indústria - total",
    "4-NOT SPECIFIED": "Serviços - total",
    "5-LOW": "Setor sem classe",
}
LEAF_ACCOUNTS = [
    "141825", "141830", "141835", "141836", "141837", "141852", "141856", "141857", "141864",
    "141842", "141847", "141848", "141853", "141858", "141859", "141860", "141862", "141865",
    "141849", "141850", "141854", "141863", "141868", "141869",
]
BUCKETS = [f"A vencer {i}" for i in range(1, 7)] + [C.BUCKET_OVERDUE]
SIZES = ["Micro", "Pequena", "Média", "Grande", "Indisponível", "Rural", "Outros portes"]
MODALITIES = [
    "FINANCIAMENTO IMOBILIARIO", "Capital de giro", "Cheque especial", "Consignado",
    "Conta garantida", "Veículos",
]
METRICS = [
    "SALDO", "TAXA_JUROS", "TAXA_INADIMPLENCIA", "ICC", "SPREAD_ICC", "PRAZO_MEDIO_CARTEIRA",
    "PRAZO_MEDIO_CONCESSAO", "CONCESSAO",
]
PRODUCTS = [
    None, "Rotativo", "Cartão de crédito total", "Série encadeada ao crédito referencial",
    "ARO - adiantamento de receitas", "Capital de giro total", "Cheque especial",
    "Conta garantida", "Desconto de duplicatas", "Vendor", "Comércio exterior total",
]


def pick(values, index: Column) -> Column:
    """The index-th of a few literal values."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _code6(n: Column) -> Column:
    return F.lpad(n.cast("string"), 6, "0")


def _read(name: str):
    return lambda t: t.spark.read.parquet(f"{t.folder}/{name}.parquet")


def _orders(t) -> DataFrame:
    return t["orders"].select(
        "o_orderkey", (F.col("o_custkey") % PLACES).alias("pl"), "o_orderstatus", "o_totalprice",
        "o_orderdate", "o_orderpriority", P.month_of(F.col("o_orderdate")).alias("period"),
        F.year("o_orderdate").alias("year"),
    )


def _place(pl: str = "pl") -> Column:
    return F.concat(_code6(F.col(pl)), (F.col(pl) % 10).cast("string")).alias("place_id")


def place(t) -> DataFrame:
    rows = (
        t["customer"].groupBy((F.col("c_custkey") % PLACES).alias("pl"))
        .agg(F.min("c_name").alias("name"))
        .filter(F.col("pl") % 50 != 49)
    )
    states = t["nation"].select(
        F.col("n_nationkey").cast("long").alias("_state"), F.col("n_name").alias("state"),
        X.region_label(F.col("n_regionkey") + 1).alias("region"),
    )
    far = F.col("pl") % 40 == 0
    return (
        rows.withColumn("_state", F.col("pl") % 25)
        .join(states, "_state")
        .select(
            _place(), _code6(F.col("pl")).alias("place_id6"), "name",
            X.name_key(F.col("name")).alias("name_key"), "state",
            F.col("_state").cast("string").alias("state_code"), "region",
            F.when(~far, F.col("pl") / F.lit(4.0) - F.lit(30.0)).alias("lat"),
            F.when(~far, F.col("pl") / F.lit(8.0) - F.lit(60.0)).alias("lng"),
            (F.col("pl") < 25).alias("is_capital"),
        )
    )


def series(t) -> DataFrame:
    rows = [(c, n, "CREDITO_MACRO", None, None, None, "R$ milhões") for n, c in C.CREDIT_MACRO_SERIES.items()]
    rows += [(c, n, C.FAMILY_ACTIVITY, None, None, None, "índice") for c, n in ACTIVITY_SERIES]
    rows += [(c, n, C.FAMILY_SECTOR, lv, s, sub, "R$ milhões") for c, n, lv, s, sub in SECTOR_SERIES]
    rows += [(c, f"Taxa {c}", "JUROS", None, None, None, "%") for c in RATE_SERIES]
    return t.spark.createDataFrame(
        rows,
        "code int, name string, family string, level string, sector string, subsector string, "
        "unit string",
    )


def series_value(t) -> DataFrame:
    code = pick(SERIES_CODES, F.col("o_orderkey") % len(SERIES_CODES)).alias("code")
    sums = _orders(t).groupBy(code, "period").agg(M.money_sum(F.col("o_totalprice")).alias("value"))
    return sums.select("code", "period", P.iso_month_start(F.col("period")).alias("date"), "value")


def _lines(t, *line_columns: str) -> DataFrame:
    """Lines with the place and month of their order: the one large join of the adapter."""
    orders = t["orders"].select(
        F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % PLACES).alias("pl"),
        P.month_of(F.col("o_orderdate")).alias("period"),
    )
    return t["lineitem"].select("l_orderkey", *line_columns).join(orders, "l_orderkey")


def place_balance(t) -> DataFrame:
    n = len(C.BALANCE_ACCOUNTS)
    sums = (
        _lines(t, "l_partkey", "l_extendedprice")
        .groupBy("period", "pl", (F.col("l_partkey") % n).alias("a"))
        .agg(M.money_sum(F.col("l_extendedprice")).alias("money"))
    )
    account = pick(C.BALANCE_ACCOUNTS, F.col("a"))
    amount = X.thousands(F.col("money"))
    return sums.select(
        "period", _place(), account.alias("account"),
        F.when(account == 174, -amount).otherwise(amount).alias("amount"),
    )


def place_presence(t) -> DataFrame:
    return (
        _lines(t, "l_suppkey", "l_quantity").groupBy("period", "pl")
        .agg(
            F.count_distinct("l_suppkey").alias("institutions"),
            F.sum("l_quantity").alias("branches"),
        )
        .select("period", _place(), "institutions", "branches")
    )


def _moves(t) -> DataFrame:
    """Movements with plain numbers as keys; codes are formatted on the reduced rows."""
    orders = t["orders"].select(
        F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % PLACES).alias("pl")
    )
    lines = t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )
    part, number = F.col("l_partkey"), F.col("l_linenumber")
    return lines.join(orders, "l_orderkey").select(
        P.month_of(F.col("l_shipdate")).alias("period"), "pl", (part % 99 + 1).alias("d"),
        F.when(part % 2 == 0, 1).otherwise(-1).cast("long").alias("movement"),
        F.when(part % 11 != 0, F.col("l_extendedprice")).alias("wage"),
        F.when(number <= 4, "MOV").when(number <= 6, "FOR").otherwise("EXC").alias("kind"),
    )


def _move_codes() -> list[Column]:
    return [
        _code6(F.col("pl")).alias("place_id6"),
        F.lpad(F.col("d").cast("string"), 2, "0").alias("division"),
    ]


def job_movement(t) -> DataFrame:
    """Raw movements: one row per line, with the kind of file it came in."""
    return _moves(t).select("period", *_move_codes(), "movement", "wage", "kind")


def place_jobs(t) -> DataFrame:
    sums = finish_jobs(signed_jobs(_moves(t), ["period", "pl", "d"]))
    coded = sums.select("period", *_move_codes(), "hires", "leavers", "net", "mean_wage")
    matched, _ = extend_code(coded, t["place"])
    return matched.select(
        "period", "place_id", "division", "hires", "leavers", "net", "mean_wage"
    )


def division(t) -> DataFrame:
    d = F.col("id")
    section = F.chr(65 + d % 21)
    return t.spark.range(1, 100).filter(d % 33 != 0).select(
        F.lpad(d.cast("string"), 2, "0").alias("division"), section.alias("section"),
        F.concat(F.lit("Seção "), section).alias("section_name"),
        F.concat(F.lit("Divisão "), d.cast("string")).alias("name"),
    )


def _company_lines(t) -> DataFrame:
    orders = t["orders"].select(
        F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % PLACES).alias("pl")
    )
    return (
        t["lineitem"].select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_returnflag", F.year("l_shipdate").alias("year"),
        )
        .join(orders, "l_orderkey")
        .withColumn("s", (F.col("l_partkey") % 99 + 1) % 21)
        .withColumn("paid", F.when(F.col("l_returnflag") != "N", F.col("l_quantity")))
    )


def place_company(t) -> DataFrame:
    return (
        _company_lines(t).groupBy("pl", "year", "s")
        .agg(
            F.count_distinct("l_suppkey").cast("double").alias("companies"),
            F.sum("l_quantity").alias("staff"),
            F.sum("paid").alias("paid_staff"),
            M.money_sum(F.col("l_extendedprice")).alias("wages"),
        )
        .select(
            _place(), "year", F.chr(65 + F.col("s")).alias("section"), "companies", "staff",
            "paid_staff", X.thousands(F.col("wages")).alias("wages"),
        )
    )


def place_company_total(t) -> DataFrame:
    sums = _company_lines(t).groupBy("pl", "year").agg(
        F.count(F.lit(1)).cast("double").alias("local_units"),
        F.count_distinct("l_suppkey").cast("double").alias("active_companies"),
        F.sum("l_quantity").alias("staff"),
        F.sum("paid").alias("paid_staff"),
        M.money_sum(F.col("l_extendedprice")).alias("wages"),
    )
    return sums.select(
        _place(), "year", "local_units", "active_companies", "staff", "paid_staff",
        X.thousands(F.col("wages")).alias("wages"),
        M.ratio(F.col("wages"), F.col("paid_staff"), 1.0, 2).alias("mean_wage"),
    )


def place_gdp(t) -> DataFrame:
    total = F.col("o_totalprice")

    def part(condition: Column) -> Column:
        cents = F.sum(F.when(condition, F.rint(total * 100).cast("long")))
        return X.thousands(F.coalesce(cents, F.lit(0)) / F.lit(100.0))

    quarter = [part(F.col("o_orderkey") % 4 == i) for i in range(4)]
    return (
        _orders(t).groupBy("pl", "year")
        .agg(
            X.thousands(M.money_sum(total)).alias("gdp"),
            part(F.col("o_orderstatus") == "P").alias("taxes"),
            X.thousands(M.money_sum(total)).alias("va_total"),
            quarter[0].alias("va_agri"), quarter[1].alias("va_industry"),
            quarter[2].alias("va_services"), quarter[3].alias("va_public"),
        )
        .select(
            _place(), "year", "gdp", "taxes", "va_total", "va_agri", "va_industry",
            "va_services", "va_public",
        )
    )


def quarter_gdp(t) -> DataFrame:
    rows = t["orders"].select(
        P.quarter_of(F.col("o_orderdate")).alias("quarter"),
        X.label_of(F.col("o_orderpriority"), QUARTER_SECTORS).alias("sector"),
        "o_totalprice", "o_orderstatus", "o_orderkey",
    )
    n = F.count(F.lit(1))

    def rate(condition: Column) -> Column:
        return F.lit(100.0) * F.count(F.when(condition, 1)) / n

    return rows.groupBy("quarter", "sector").agg(
        M.money_sum(F.col("o_totalprice")).alias("volume_index"),
        rate(F.col("o_orderstatus") == "F").alias("rate_vs_prev_year_quarter"),
        rate(F.col("o_orderstatus") == "O").alias("rate_4q"),
        rate(F.col("o_orderstatus") == "P").alias("rate_ytd"),
        F.nullif(rate(F.col("o_orderkey") % 3 == 0), F.lit(0.0)).alias("rate_vs_prev_quarter"),
    )


def population_a(t) -> DataFrame:
    gap = (F.col("year") == 1998) | ((F.col("year") == 1995) & (F.col("pl") % 7 == 0))
    return (
        _orders(t).filter(~gap).groupBy("pl", "year")
        .agg((M.money_sum(F.col("o_totalprice")) / F.lit(100.0)).alias("population"))
        .select(_place(), "year", "population")
    )


def population_b(t) -> DataFrame:
    places = t["customer"].select((F.col("c_custkey") % PLACES).alias("pl")).distinct()
    return places.select("pl", F.explode(F.sequence(F.lit(1993), F.lit(1996))).alias("year")).select(
        _place(), "year", (1000 + F.col("pl") * 3 + F.col("year")).cast("double").alias("population")
    )


def population_ref(t) -> DataFrame:
    return reference_population(t["population_a"], t["population_b"])


def national_jobs(t) -> DataFrame:
    sums = t["place_jobs"].groupBy("period").agg(
        *[F.sum(c).cast("double").alias(c) for c in ["hires", "leavers", "net"]]
    )
    eras = F.array_compact(
        F.array(
            F.when(F.col("period") <= 199812, C.ERA_OLD), F.when(F.col("period") >= 199807, C.ERA_NEW)
        )
    )
    return sums.select("period", F.explode(eras).alias("era"), "hires", "leavers", "net")


def credit_series(t) -> DataFrame:
    """200 series that the part keys fall into."""
    codes = t["part"].select((F.col("p_partkey") % SERIES).cast("int").alias("code")).distinct()
    code = F.col("code")
    unparsed = code % 23 == 0
    metric = F.when(~unparsed, pick(METRICS, code % 8))
    return codes.select(
        "code",
        F.concat(F.lit("Série "), code.cast("string")).alias("title"),
        metric.alias("metric"),
        pick(["PJ", "PF", "MEI", None], code % 5).alias("client"),
        pick(["MICRO", "PEQUENO", None], code % 3).alias("size"),
        pick(["LIVRE", "DIRECIONADO", None], F.floor(code / 3) % 3).alias("origin"),
        pick(["NORTE", "NORDESTE", "CENTRO_OESTE", "SUDESTE", "SUL", None, None], code % 7).alias("region"),
        pick(PRODUCTS, F.floor(code / 2) % len(PRODUCTS)).alias("modality"),
        F.when(code % 3 == 0, C.QUARTERLY).otherwise(C.MONTHLY).alias("frequency"),
        F.lit("R$ milhões").alias("unit"),
        F.when(code % 8 == 7, C.SEARCH_LENDING).otherwise(C.SEARCH_BALANCE).alias("search"),
        F.when(unparsed, C.UNPARSED).otherwise(C.PARSED).alias("parse_status"),
    )


def credit_value(t) -> DataFrame:
    sums = (
        t["lineitem"].groupBy(
            (F.col("l_partkey") % SERIES).cast("int").alias("code"),
            P.month_of(F.col("l_shipdate")).alias("period"),
        )
        .agg(M.money_sum(F.col("l_extendedprice")).alias("value"))
        .filter((F.col("code") % 3 != 0) | (F.col("period") % 100 % 3 == 0))
    )
    return sums.select("code", "period", P.iso_month_start(F.col("period")).alias("date"), "value")


def catalogue_hits(t) -> DataFrame:
    """Catalogue search results: two searches per part, the second one repeats codes."""
    key = F.col("p_partkey")
    prefixes = [p[0] for p in TITLE_PATTERNS] + ["Título desconhecido"]
    clients = list(CLIENT_TOKENS)
    prefix = pick(prefixes, key % len(prefixes))
    segments = pick(
        [
            "", "microempresa - ", f"{clients[0].capitalize()} - recursos livres - ",
            f"Crédito direcionado - {clients[1].capitalize()} - ", "Centro-Oeste - ",
        ],
        F.floor(key / 36) % 5,
    )
    modality = F.when(key % 6 == 0, F.lit("Total")).when(
        key % 2 == 1, F.concat(F.col("p_name"), F.lit(" - "), F.col("p_brand"))
    ).otherwise(F.col("p_name"))
    glue = F.when(F.endswith(prefix, F.lit("-")), F.lit(" ")).otherwise(F.lit(" - "))
    first = t["part"].select(
        key.cast("int").alias("code"), F.concat(prefix, glue, segments, modality).alias("title"),
        F.when(key % 3 == 0, "trimestral").otherwise(" Mensal ").alias("frequency"),
        F.lit("%").alias("unit"), F.lit("busca 1").alias("search"), F.lit(1).alias("search_order"),
    )
    second = first.filter(F.col("code") % 4 == 0).select(
        "code", F.lit("Título repetido").alias("title"), "frequency", "unit",
        F.lit("busca 2").alias("search"), F.lit(2).alias("search_order"),
    )
    return first.unionByName(second)


def institution(t) -> DataFrame:
    """Registry rows of the quarters in which a supplier shipped anything."""
    seen = t["lineitem"].select(
        F.col("l_suppkey").alias("s_suppkey"), P.quarter_end_of(F.col("l_shipdate")).alias("period")
    ).distinct()
    nations = t["nation"].select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("state"))
    key = F.col("s_suppkey")
    return (
        seen.join(t["supplier"].select("s_suppkey", "s_name", "s_nationkey"), "s_suppkey")
        .join(nations, "s_nationkey")
        .select(
            key.cast("string").alias("inst_id"), "period", F.col("s_name").alias("name"),
            F.when(key % 17 != 0, F.concat(F.lit("S"), (1 + key % 5).cast("string"))).alias("segment"),
            "state", F.concat(F.lit("CITY_"), (key % 7).cast("string")).alias("city"),
            F.when(key % 13 == 0, "I").otherwise("A").alias("status"),
            F.lit(1).alias("consolidation"),
            F.lit(None).cast("string").alias("fin_group_id"),
            F.lit(None).cast("string").alias("prud_group_id"),
        )
    )


def statement_value(t) -> DataFrame:
    """Leaf accounts, tree totals with planted breaks, assets and sub-lines; two schemes."""
    leaves = len(LEAF_ACCOUNTS)
    cents = F.rint(F.col("l_extendedprice") * 100).cast("long")
    index = F.col("l_partkey") % leaves
    key = F.col("l_suppkey")
    either = (index >= 18) & ((index + key) % 2 == 1)
    cost = (index >= 9) & (index < 18)
    signed = F.when(cost | either, -cents).otherwise(cents)
    wide = (
        t["lineitem"].groupBy(key, P.quarter_end_of(F.col("l_shipdate")).alias("period"))
        .agg(
            *[F.sum(F.when(index == i, signed)).alias(f"a{i}") for i in range(leaves)],
            F.sum(cents).alias("gross"),
        )
    )

    def total(*accounts: str) -> Column:
        parts = [F.coalesce(F.col(f"a{LEAF_ACCOUNTS.index(a)}"), F.lit(0)) for a in accounts]
        return reduce(lambda x, y: x + y, parts)

    k = total(
        "141825", "141830", "141835", "141836", "141837", "141842", "141847", "141848", "141849",
        "141850",
    )
    pay = total("141852", "141853", "141854")
    rest = total(
        "141856", "141857", "141858", "141859", "141860", "141862", "141863", "141864", "141865"
    )
    before_tax = k + pay + rest
    net = before_tax + total("141868", "141869")
    old = F.col("period") < 199901

    def entry(account, value) -> Column:
        return F.struct(account.alias("account"), value.cast("long").alias("cents"))

    old_names = {"141835": "78203", "141842": "78213"}
    entries = [
        entry(
            F.when(old, old_names.get(a, f"783{i:02d}")).otherwise(a),
            F.col(f"a{i}"),
        )
        for i, a in enumerate(LEAF_ACCOUNTS)
    ]
    planted_net = net + F.when(key % 19 == 0, 500).otherwise(0)
    planted_before = before_tax + F.when(key % 29 == 0, 700).otherwise(0)
    entries.append(entry(F.when(old, "78187").otherwise("141870"), planted_net))
    new_only = {
        "141851": k, "141855": pay, "141866": rest, "141867": planted_before,
        "141831": F.col("a2"), "141840": F.col("a9"),
        C.TOTAL_ASSETS_ACCOUNT: F.when(
            key % 9 != 4, F.when(key % 23 == 0, 0).otherwise(F.col("gross") * 10)
        ),
    }
    entries += [entry(F.lit(a), F.when(~old, v)) for a, v in new_only.items()]
    return (
        wide.select(key.cast("string").alias("inst_id"), "period", F.explode(F.array(*entries)).alias("e"))
        .filter(F.col("e.cents").isNotNull())
        .select("inst_id", "period", F.col("e.account").alias("account"),
                (F.col("e.cents") / F.lit(100.0)).alias("value"))
    )


def portfolio_value(t) -> DataFrame:
    """Bucket rows of four reports plus a total row per group."""
    number = F.col("l_linenumber")
    report = F.when(number <= 2, 11).when(number <= 4, 13).when(number == 5, 12).otherwise(14)
    cells = (
        t["lineitem"].groupBy(
            "l_suppkey", P.quarter_end_of(F.col("l_shipdate")).alias("period"),
            report.alias("r"), F.when(number <= 5, F.col("l_partkey") % 6).alias("g"),
            F.floor(F.col("l_quantity") / 8).cast("int").alias("b"),
        )
        .agg(M.cents_sum(F.col("l_extendedprice")).alias("cents"))
    )
    totals = cells.groupBy("l_suppkey", "period", "r", "g").agg(F.sum("cents").alias("cents"))
    rows = cells.unionByName(totals.withColumn("b", F.lit(None).cast("int")))
    by_size = F.col("r") == 14
    column = (
        F.when(F.col("b").isNull(), F.when(by_size, C.FIRM_PORTFOLIO_TOTAL).otherwise(C.BUCKET_TOTAL))
        .when(by_size, pick(SIZES, F.col("b")))
        .otherwise(pick(BUCKETS, F.col("b")))
    )
    named = rows.select(
        F.col("l_suppkey").cast("string").alias("inst_id"), "period",
        F.col("r").cast("string").alias("report"),
        F.concat(F.lit("Grupo "), F.col("g").cast("string")).alias("group"),
        column.alias("column_name"), (F.col("cents") / F.lit(100.0)).alias("value"),
    )
    account = F.concat_ws("|", "report", F.coalesce("group", F.lit("-")), "column_name")
    return named.withColumn("account", account)


def lending_rate(t) -> DataFrame:
    cells = t["lineitem"].groupBy(
        P.month_of(F.col("l_shipdate")).alias("period"), "l_suppkey", "l_linestatus",
        (F.col("l_partkey") % 6).alias("m"),
    ).agg(
        F.sum(F.rint(F.col("l_discount") * 100).cast("long")).alias("d"),
        F.sum(F.rint(F.col("l_tax") * 100).cast("long")).alias("x"),
        F.count(F.lit(1)).alias("n"),
    )
    housing = F.col("m") == 0
    kept = cells.filter(~housing | (F.col("period") % 2 == 0))
    return kept.select(
        P.iso_month_start(F.col("period")).alias("start_date"),
        F.lpad(F.col("l_suppkey").cast("string"), 8, "0").alias("tax_id8"),
        F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("institution"),
        F.when(F.col("l_linestatus") == "O", C.SEGMENT_HOUSEHOLD).otherwise("Pessoa Jurídica").alias("segment"),
        pick(MODALITIES, F.col("m")).alias("modality"),
        (F.col("d") / F.col("n").cast("double")).alias("month_rate"),
        (F.col("x") / F.col("n").cast("double")).alias("year_rate"),
    )


def insolvency(t) -> DataFrame:
    state_key = F.col("pl") % 25
    named = (
        F.when(F.col("o_orderstatus") == "P", C.INSOLVENCY_CLASSES[129])
        .when(F.col("o_orderstatus") == "O", C.INSOLVENCY_CLASSES[128])
        .otherwise(C.INSOLVENCY_CLASSES[108])
    )
    counts = _orders(t).groupBy(state_key.alias("s"), "period", named.alias("class")).agg(
        F.count(F.lit(1)).alias("cases")
    )
    return counts.select(
        F.concat(F.lit("NATION_"), F.col("s").cast("string")).alias("state"),
        F.concat(F.lit("court_"), F.col("s").cast("string")).alias("court"),
        "period", "class", "cases",
    )


def sector_map(t) -> DataFrame:
    return t.spark.createDataFrame(
        [
            ("AGROPECUARIA", "AGROPECUARIA", "A", "AGRO"),
            ("INDUSTRIA", "INDUSTRIA", "B,C, D,E,F", "INDUSTRIA"),
            ("SERVICOS", "SERVICOS", "G,H,I,J,K,L,M,N,R,S", "SERVICOS"),
            ("ADM_PUBLICA", None, "O,P,Q", "ADM_PUBLICA"),
            ("OUTROS", "OUTROS", "T,U", None),
        ],
        "sector string, series_sector string, sections string, value_added_sector string",
    )


SOURCE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
]
BASE_TABLES = [
    place, series, series_value, place_balance, place_presence, job_movement, place_jobs, division,
    place_company, place_company_total, place_gdp, quarter_gdp, population_a, population_b,
    population_ref, national_jobs, credit_series, credit_value, catalogue_hits, institution,
    statement_value, portfolio_value, lending_rate, insolvency, sector_map,
]


class DriverTables(TableSet):
    """Table set over one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str, staging: bool = True):
        builders = {name: _read(name) for name in SOURCE_TABLES}
        builders.update({f.__name__: f for f in BASE_TABLES})
        builders.update(VIEWS)
        builders["national_employment"] = lambda t: VIEWS["national_employment"](t, NEW_ERA_CUT)
        super().__init__(spark, builders, work_folder(spark, "contract") if staging else None)
        self.folder = folder
