"""The load job: raw folders and seeds to base tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat import constants as C
from regiostat.functions import clean as X
from regiostat.functions import periods as P
from regiostat.operators.crosswalk import extend_code
from regiostat.operators.pivot import pivot_first
from regiostat.operators.population import reference_population
from regiostat.plans.catalogue import VIEWS
from regiostat.session import work_folder
from regiostat.sources import banks, institutions, movements, rates
from regiostat.sources.files import (
    file_stem,
    good,
    or_empty,
    read_coordinates,
    read_envelope,
    read_header_row_json,
    read_json,
    read_seed,
    rejects,
)
from regiostat.sources.ledger import Ledger
from regiostat.tables import TableSet

# Label fragments of the statistics tables.
PLACE_LABEL = "Município (Código)"
VARIABLE_LABEL = "Variável (Código)"
YEAR_LABEL = "Ano (Código)"
QUARTER_LABEL = "Trimestre (Código)"
SECTOR_LABEL = "Setores e subsetores"
ACTIVITY_LABEL = "Classificação Nacional de Atividades"
# Variable code -> column.
GDP_VARIABLES = {
    "gdp": 37, "taxes": 543, "va_total": 498, "va_agri": 513, "va_industry": 517,
    "va_services": 6575, "va_public": 525,
}
QUARTER_VARIABLES = {
    "volume_index": 583, "rate_vs_prev_year_quarter": 6561, "rate_4q": 6562, "rate_ytd": 6563,
    "rate_vs_prev_quarter": 6564,
}
COMPANY_VARIABLES = {"companies": 2585, "staff": 707, "paid_staff": 708, "wages": 662}
COMPANY_TOTAL_VARIABLES = {
    "local_units": 706, "active_companies": 367, "staff": 707, "paid_staff": 708, "wages": 662,
    "mean_wage": 10143,
}
# National employment series -> (column, era).
JOB_SERIES = {
    "CAGED12_ADMIS": ("hires", C.ERA_OLD), "CAGED12_DESLIG": ("leavers", C.ERA_OLD),
    "CAGED12_SALDO12": ("net", C.ERA_OLD), "CAGED12_ADMISN12": ("hires", C.ERA_NEW),
    "CAGED12_DESLIGN12": ("leavers", C.ERA_NEW), "CAGED12_SALDON12": ("net", C.ERA_NEW),
}
PLACE_LEVEL = "Municípios"
FIRST_GDP_YEAR = 2010
# State -> its court.
STATE_COURTS = {
    "AC": "tjac", "AL": "tjal", "AM": "tjam", "AP": "tjap",
    "BA": "tjba", "CE": "tjce", "DF": "tjdft", "ES": "tjes",
    "GO": "tjgo", "MA": "tjma", "MG": "tjmg", "MS": "tjms",
    "MT": "tjmt", "PA": "tjpa", "PB": "tjpb", "PE": "tjpe",
    "PI": "tjpi", "PR": "tjpr", "RJ": "tjrj", "RN": "tjrn",
    "RO": "tjro", "RR": "tjrr", "RS": "tjrs", "SC": "tjsc",
    "SE": "tjse", "SP": "tjsp", "TO": "tjto",
}


def read_places(spark: SparkSession, path: str, coordinates: str) -> DataFrame:
    fields = {
        "municipio-id": "place_id", "municipio-nome": "name", "UF-id": "state_code",
        "UF-sigla": "state", "regiao-id": "region_code",
    }
    schema = ", ".join(f"`{c}` string" for c in fields)
    raw = good(read_json(spark, path, schema)).withColumnsRenamed(fields)
    places = raw.select(
        "place_id", X.prefix(F.col("place_id"), 6).alias("place_id6"), "name",
        X.name_key(F.col("name")).alias("name_key"), "state", "state_code",
        X.region_label(F.col("region_code")).alias("region"),
    )
    return places.join(read_coordinates(spark, coordinates), "place_id", "left")


def _header_table(
    spark: SparkSession, path: str, keys: dict[str, str], as_label: tuple[str, ...] = ()
) -> DataFrame:
    return read_header_row_json(spark, path, keys, as_label)[0]


def _number(c: str) -> Column:
    return X.lenient_int(F.col(c)).alias(c)


def read_population(spark: SparkSession, path: str) -> DataFrame:
    rows = _header_table(spark, path, {"place_id": PLACE_LABEL, "year": YEAR_LABEL})
    return rows.select("place_id", _number("year"), F.col("value").alias("population")).dropna()


def _wide(rows: DataFrame, keys: list[str], variables: dict[str, int], number: str) -> DataFrame:
    typed = rows.withColumns({c: X.lenient_int(F.col(c)) for c in (number, "variable")})
    return pivot_first(typed, keys, "variable", "value", variables)


def read_place_gdp(spark: SparkSession, path: str) -> DataFrame:
    labels = {"place_id": PLACE_LABEL, "variable": VARIABLE_LABEL, "year": YEAR_LABEL}
    rows = _header_table(spark, path, labels)
    wide = _wide(rows, ["place_id", "year"], GDP_VARIABLES, "year")
    return wide.filter(F.col("year") >= FIRST_GDP_YEAR)


def read_quarter_gdp(spark: SparkSession, path: str) -> DataFrame:
    labels = {"variable": VARIABLE_LABEL, "quarter": QUARTER_LABEL, "sector": SECTOR_LABEL}
    rows = _header_table(spark, path, labels, as_label=("sector",))
    return _wide(rows, ["quarter", "sector"], QUARTER_VARIABLES, "quarter")


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    labels = {
        "place_id": PLACE_LABEL, "variable": VARIABLE_LABEL, "year": YEAR_LABEL,
        "label": ACTIVITY_LABEL,
    }
    rows = _header_table(spark, path, labels, as_label=("label",))
    rows = rows.withColumn("section", X.section_of_label(F.col("label")))
    return _wide(rows, ["place_id", "year", "section"], COMPANY_VARIABLES, "year")


def read_company_totals(spark: SparkSession, path: str) -> DataFrame:
    labels = {"place_id": PLACE_LABEL, "variable": VARIABLE_LABEL, "year": YEAR_LABEL}
    rows = _header_table(spark, path, labels)
    return _wide(rows, ["place_id", "year"], COMPANY_TOTAL_VARIABLES, "year")


def _research(spark: SparkSession, path: str) -> DataFrame:
    fields = {"TERCODIGO": "place_id", "NIVNOME": "level", "VALDATA": "date", "VALVALOR": "value"}
    rows = read_envelope(spark, path, fields)
    return rows.select(
        F.trim(F.coalesce("place_id", F.lit(""))).alias("place_id"), "level",
        P.year_of_iso(F.col("date")).alias("year"), P.month_of_iso(F.col("date")).alias("period"),
        X.lenient_number(F.col("value")).alias("value"), "stem",
    ).filter(F.col("value").isNotNull())


def read_past_population(spark: SparkSession, path: str) -> DataFrame:
    rows = _research(spark, path).filter(F.col("level") == PLACE_LEVEL)
    return rows.select("place_id", "year", F.col("value").alias("population"))


def read_national_jobs(spark: SparkSession, path: str) -> DataFrame:
    column = X.label_of(F.col("stem"), {k: v[0] for k, v in JOB_SERIES.items()})
    era = X.label_of(F.col("stem"), {k: v[1] for k, v in JOB_SERIES.items()})
    rows = _research(spark, path).withColumns({"column": column, "era": era})
    names = {c: c for c in ("hires", "leavers", "net")}
    return pivot_first(rows, ["period", "era"], "column", "value", names)


def read_series_values(spark: SparkSession, path: str) -> DataFrame:
    """One file per series; the code is the file name. Error bodies and empty lists give no row."""
    raw = good(read_json(spark, path, "data string, valor string")).filter("data is not null")
    return raw.select(
        F.col("stem").try_cast("int").alias("code"), P.month_of_dmy(F.col("data")).alias("period"),
        P.iso_of_dmy(F.col("data")).alias("date"), X.lenient_number(F.col("valor")).alias("value"),
    ).filter(F.col("value").isNotNull())


def read_insolvency(spark: SparkSession, path: str) -> DataFrame:
    """Month buckets with class sub-buckets; unknown classes are dropped."""
    schema = (
        "aggregations struct<por_mes:struct<buckets:array<struct<key:string,"
        "por_classe:struct<buckets:array<struct<key:int,doc_count:bigint>>>>>>>"
    )
    raw = good(read_json(spark, path, schema))
    months = raw.select("stem", F.explode("aggregations.por_mes.buckets").alias("m"))
    cells = months.select("stem", "m.key", F.explode("m.por_classe.buckets").alias("k"))
    labels = {str(k): v for k, v in C.INSOLVENCY_CLASSES.items()}
    state = F.col("stem")
    court = F.coalesce(X.label_of(state, STATE_COURTS), state)
    return cells.select(
        state.alias("state"), court.alias("court"), F.col("key").try_cast("int").alias("period"),
        X.label_of(F.col("k.key").cast("string"), labels).alias("class"),
        F.col("k.doc_count").alias("cases"),
    ).filter(F.col("class").isNotNull())


def read_outlines(spark: SparkSession, path: str) -> DataFrame:
    """Geometry of the first feature of each file; files without one are skipped."""
    files = spark.read.text(path, wholetext=True)
    geometry = F.get_json_object("value", "$.features[0].geometry")
    return files.select(file_stem().alias("state"), geometry.alias("geometry")).filter(
        F.col("geometry").isNotNull()
    )


def raw_rejects(spark: SparkSession, raw: str, layout: Mapping[str, str] | None = None) -> DataFrame:
    """Corrupt files of every JSON source that exists."""
    found = spark.createDataFrame([], "file string, reason string")
    for pattern in {**LAYOUT, **(layout or {})}.values():
        if not pattern.endswith(".json"):
            continue
        try:
            found = found.unionByName(rejects(spark, f"{raw}/{pattern}"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


SEED_SCHEMAS = {
    "division": "division string, section string, section_name string, name string",
    "account": "account string, name string, account_group string",
    "series": (
        "code string, name string, family string, level string, sector string, subsector string, "
        "unit string"
    ),
    "sector_map": "sector string, series_sector string, sections string, value_added_sector string",
    "credit_series": (
        "code string, title string, metric string, client string, size string, origin string, "
        "region string, modality string, frequency string, unit string, search string, "
        "parse_status string"
    ),
}
SEED_NUMBERS = {"series": "code", "credit_series": "code", "account": "account"}

# Where each source lies below the raw folder; every entry can be replaced by the caller.
LAYOUT = {
    "places": "places.json",
    "population": "population/*.json",
    "past_population": "research/population/*.json",
    "national_jobs": "research/jobs/*.json",
    "series": "series/*.json",
    "credit_series": "credit_series/*.json",
    "place_gdp": "place_gdp/*.json",
    "quarter_gdp": "quarter_gdp/*.json",
    "companies": "companies/*.json",
    "company_totals": "company_totals/*.json",
    "balances": "balances/*.zip",
    "movements": "movements/*",
    "registry": "institutions/registry/*.json",
    "statements": "institutions/statements/*.json",
    "portfolios": "institutions/portfolios/*.json",
    "weekly_rates": "rates/weekly/*.json",
    "monthly_rates": "rates/monthly/*.json",
    "insolvency": "insolvency/*.json",
    "outlines": "outlines/*.json",
}


def raw_tables(
    spark: SparkSession,
    raw: str,
    seeds: str,
    layout: Mapping[str, str] | None = None,
    seed_files: Mapping[str, str] | None = None,
    work: str | None = None,
    state: str | None = None,
) -> TableSet:
    """Base tables and views over a raw folder; ``seeds`` holds one ``<table>.csv`` per seed.

    ``work`` is the folder for tables that a view reads several times (see ``TableSet``). ``state`` is the folder of the
    ledgers of archives and microdata: with it, only files that are new or have changed are read, each once, when a
    table that needs them is planned first. Without it they are read whole each time.
    ``seed_files`` maps a seed (or ``coordinates``) to another file name. A source without files
    becomes an empty typed table; the others go on. ``load_rejects`` says what was left out.
    """
    at = _paths(raw, layout)
    seed_at = _seed_paths(seeds, seed_files)

    def seed(table: str) -> DataFrame:
        df = read_seed(spark, seed_at[table], SEED_SCHEMAS[table])
        number = SEED_NUMBERS.get(table)
        return df.withColumn(number, X.lenient_int(F.col(number))) if number else df

    def balance_cells() -> DataFrame:
        return banks.balance_cells(banks.read_zipped_lines(spark, at["balances"]))

    def archives() -> Ledger:
        return banks.update_balances(spark, at["balances"], f"{state}/balances", changed=True)

    def balances(t: TableSet) -> DataFrame:
        if state:
            amounts = banks.ledger_amounts(archives())
        else:
            amounts = banks.place_amounts(balance_cells())
        kept = amounts.join(t["place"].select("place_id"), "place_id", "left_semi")
        return kept.join(t["account"].select("account"), "account", "left_semi").select(
            "period", "place_id", "account", "amount"
        )

    def presence(t: TableSet) -> DataFrame:
        if state:
            rows = banks.ledger_presence(archives())
        else:
            rows = banks.place_presence(balance_cells())
        return rows.join(t["place"].select("place_id"), "place_id", "left_semi")

    def jobs(t: TableSet) -> DataFrame:
        if state:
            sums = movements.update_jobs(spark, at["movements"], f"{state}/movements", changed=True)
        else:
            raw_rows = movements.read_movements(spark, at["movements"])
            sums = movements.signed_jobs(raw_rows, movements.SUM_KEYS)
        return extend_code(movements.finish_jobs(sums), t["place"])[0]

    loaders = {name: (lambda t, n=name: seed(n)) for name in SEED_SCHEMAS}
    loaders.update(
        {
            "place": lambda t: read_places(spark, at["places"], seed_at["coordinates"]),
            "population_a": lambda t: read_population(spark, at["population"]),
            "population_b": lambda t: read_past_population(spark, at["past_population"]),
            "national_jobs": lambda t: read_national_jobs(spark, at["national_jobs"]),
            "series_value": lambda t: read_series_values(spark, at["series"]),
            "credit_value": lambda t: read_series_values(spark, at["credit_series"]),
            "place_gdp": lambda t: read_place_gdp(spark, at["place_gdp"]),
            "quarter_gdp": lambda t: read_quarter_gdp(spark, at["quarter_gdp"]),
            "place_company": lambda t: read_companies(spark, at["companies"]),
            "place_company_total": lambda t: read_company_totals(spark, at["company_totals"]),
            "place_balance": balances,
            "place_presence": presence,
            "place_jobs": jobs,
            "institution": lambda t: institutions.read_registry(spark, at["registry"]),
            "statement_value": lambda t: institutions.read_statements(spark, at["statements"]),
            "portfolio_value": lambda t: institutions.read_portfolios(spark, at["portfolios"]),
            "lending_rate": lambda t: rates.read_lending_rates(
                spark, at["weekly_rates"], at["monthly_rates"]
            ),
            "insolvency": lambda t: read_insolvency(spark, at["insolvency"]),
            "state_outline": lambda t: read_outlines(spark, at["outlines"]),
        }
    )

    def safe(name: str, build):
        return lambda t: or_empty(spark, name, lambda: build(t))

    builders = {name: safe(name, build) for name, build in loaders.items()}
    builders["population_ref"] = lambda t: reference_population(t["population_a"], t["population_b"])
    return TableSet(spark, {**builders, **VIEWS}, work)


def _paths(raw: str, layout: Mapping[str, str] | None) -> dict[str, str]:
    return {name: f"{raw}/{pattern}" for name, pattern in {**LAYOUT, **(layout or {})}.items()}


def _seed_paths(seeds: str, seed_files: Mapping[str, str] | None) -> dict[str, str]:
    names = {name: f"{name}.csv" for name in [*SEED_SCHEMAS, "coordinates"]} | dict(seed_files or {})
    return {name: f"{seeds}/{file}" for name, file in names.items()}


# Labels that a file of each header-in-first-row source must have.
HEADER_LABELS = {
    "population": [PLACE_LABEL, YEAR_LABEL],
    "place_gdp": [PLACE_LABEL, VARIABLE_LABEL, YEAR_LABEL],
    "quarter_gdp": [VARIABLE_LABEL, QUARTER_LABEL, SECTOR_LABEL],
    "companies": [PLACE_LABEL, VARIABLE_LABEL, YEAR_LABEL, ACTIVITY_LABEL],
    "company_totals": [PLACE_LABEL, VARIABLE_LABEL, YEAR_LABEL],
}
REJECTS = "source string, file string, reason string, rows bigint"


def load_rejects(
    spark: SparkSession,
    raw: str,
    seeds: str,
    layout: Mapping[str, str] | None = None,
    seed_files: Mapping[str, str] | None = None,
    state: str | None = None,
) -> DataFrame:
    """(source, file, reason, rows) of everything that the load leaves out.

    Files that are no JSON or lack a label, archives that cannot be read, lines that do not fit their
    header, microdata files without a needed column, and rows whose place or account is unknown. Archives and
    microdata come from the ledgers in ``state``, which good and bad lines enter in one scan; without it, from a
    ledger of this call alone.
    """
    at = _paths(raw, layout)
    t = raw_tables(spark, raw, seeds, layout, seed_files)
    state = state or work_folder(spark, "load-state")
    archives = banks.update_balances(spark, at["balances"], f"{state}/balances", changed=True)
    movements.update_jobs(spark, at["movements"], f"{state}/movements", changed=True)
    microdata = movements.jobs_ledger(spark, f"{state}/movements")

    def labels(name: str) -> DataFrame:
        wanted = {f"l{k}": label for k, label in enumerate(HEADER_LABELS[name])}
        found = read_header_row_json(spark, at[name], wanted)[1]
        found = found.filter("reason <> 'corrupt'").select(F.col("stem").alias("file"), "reason")
        return found.withColumn("rows", F.lit(1).cast("long"))

    def unknown(rows: DataFrame, known: DataFrame, key: str, reason: str) -> DataFrame:
        left_out = rows.join(known.select(key), key, "left_anti")
        return left_out.groupBy("file", F.lit(reason).alias("reason")).agg(F.sum("rows").alias("rows"))

    present = archives.part("presence").filter("problem IS NULL")
    sums = archives.part("amounts").withColumn("rows", F.lit(1).cast("long"))
    jobs = microdata.part("cells").filter("problem IS NULL")
    steps = {("json", "raw"): lambda: raw_rejects(spark, raw, layout).withColumn("rows", F.lit(1).cast("long"))}
    steps |= {(name, "labels"): (lambda n=name: labels(n)) for name in HEADER_LABELS}
    steps |= {
        ("balances", "lines"): lambda: banks.ledger_rejects(archives),
        ("balances", "places"): lambda: unknown(present, t["place"], "place_id", "unknown place"),
        ("balances", "accounts"): lambda: unknown(sums, t["account"], "account", "unknown account"),
        ("movements", "lines"): lambda: movements.ledger_rejects(microdata),
        ("movements", "places"): lambda: unknown(jobs, t["place"], "place_id6", "unknown place"),
    }
    found = spark.createDataFrame([], REJECTS)
    for (source, _), step in steps.items():
        try:
            part = step()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found = found.union(part.select(F.lit(source).alias("source"), "file", "reason", "rows"))
    return found


def with_fallback(t: TableSet, folder: str, quarters: Sequence[int]) -> TableSet:
    """Fill quarters (of a portfolio report) that the main source has no rows of.

    ``folder`` holds one sub-folder per quarter; delivered quarters are never replaced.
    """
    groups = {
        "institution": ["period"], "statement_value": ["period"],
        "portfolio_value": ["period", "report"],
    }
    parts = [institutions.read_fallback(t.spark, f"{folder}/{q}", q) for q in quarters]

    def filled(i: int, name: str, group: list[str]):
        spare = reduce(DataFrame.unionByName, [p[i] for p in parts])
        return lambda _: institutions.fill_from_fallback(t[name], spare, *group)

    return t.extended({n: filled(i, n, g) for i, (n, g) in enumerate(groups.items())})
