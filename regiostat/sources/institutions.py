"""Institution registry, statements and portfolios: main API files and the fallback shards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat import constants as C
from regiostat.functions import clean as X
from regiostat.operators.latest import fill_missing_groups, first_by_precedence
from regiostat.sources.files import good, read_envelope, read_json

# Fields of the main API.
REGISTRY_FIELDS = {
    "CodInst": "inst_id", "Data": "period", "NomeInstituicao": "name", "Sr": "segment",
    "Uf": "state", "Municipio": "city", "Situacao": "status", "Tc": "consolidation",
    "CodConglomeradoFinanceiro": "fin_group_id", "CodConglomeradoPrudencial": "prud_group_id",
}
STATEMENT_FIELDS = {"CodInst": "inst_id", "AnoMes": "period", "Conta": "account", "Saldo": "value"}
PORTFOLIO_FIELDS = {
    "CodInst": "inst_id", "AnoMes": "period", "NumeroRelatorio": "report", "Grupo": "group",
    "Conta": "account", "NomeColuna": "column_name", "Saldo": "value",
}
PORTFOLIO_REPORTS = [
    C.REPORT_HOUSEHOLD_AGING, C.REPORT_FIRM_ACTIVITY, C.REPORT_FIRM_AGING, C.REPORT_FIRM_SIZE,
]
# Fields of the fallback registry.
FALLBACK_REGISTRY = {
    "c0": "inst_id", "c2": "name", "c12": "segment", "c10": "state", "c11": "city",
    "c4": "consolidation",
}


def _typed(rows: DataFrame) -> DataFrame:
    """Codes stay text whatever the source wrote; money to thousands, once."""
    out = rows.withColumn("period", X.lenient_int(F.col("period")))
    if "value" in rows.columns:
        out = out.withColumn("value", X.thousands(X.lenient_number(F.col("value"))))
        out = out.filter(F.col("value").isNotNull())
    return out


def _first(rows: DataFrame, *keys: str) -> DataFrame:
    """First file in name order wins; the remaining columns break ties."""
    rest = [F.col(f"`{c}`") for c in rows.columns if c not in (*keys, "stem")]
    return first_by_precedence(rows, list(keys), [F.col("stem"), *rest]).drop("stem")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return _first(_typed(read_envelope(spark, path, REGISTRY_FIELDS)), "inst_id", "period")


def read_statements(spark: SparkSession, path: str) -> DataFrame:
    rows = _typed(read_envelope(spark, path, STATEMENT_FIELDS))
    return _first(rows, "inst_id", "period", "account")


def read_portfolios(spark: SparkSession, path: str) -> DataFrame:
    rows = _typed(read_envelope(spark, path, PORTFOLIO_FIELDS))
    return _first(rows, "inst_id", "period", "report", "account")


def read_fallback_registry(spark: SparkSession, path: str, period: int) -> DataFrame:
    """Registry of the fallback site; only reporting institutions are listed, so all are active."""
    fields = ", ".join(f"{c} string" for c in FALLBACK_REGISTRY)
    rows = good(read_json(spark, path, fields)).withColumnsRenamed(FALLBACK_REGISTRY)
    blank = ("segment", "state", "city")
    return rows.withColumns({c: X.null_if_blank(F.col(c)) for c in blank}).select(
        "inst_id", F.lit(period).alias("period"), "name", "segment", "state", "city",
        F.lit("A").alias("status"), "consolidation",
        F.lit(None).cast("string").alias("fin_group_id"),
        F.lit(None).cast("string").alias("prud_group_id"),
    )


def read_shards(
    spark: SparkSession, path: str, entities: DataFrame, accounts: DataFrame
) -> DataFrame:
    """``{values: [{e, v: [{i, v}]}]}`` cells of known institutions and accounts."""
    schema = "values array<struct<e:string,v:array<struct<i:string,v:double>>>>"
    raw = good(read_json(spark, path, schema))
    cells = raw.select(F.explode("values").alias("x")).select(
        F.col("x.e").alias("inst_id"), F.explode("x.v").alias("c")
    ).select("inst_id", F.col("c.i").alias("account"), F.col("c.v").alias("value"))
    return cells.join(entities.select("inst_id"), "inst_id", "left_semi").join(
        accounts.select("account").distinct(), "account", "left_semi"
    )


def column_dictionary(report: DataFrame, names: DataFrame) -> DataFrame:
    """account -> (group, column name) from a report definition and the name catalogue.

    ``report`` has ``c: array<struct<ifd, sc: array<struct<ifd>>>>``, ``names`` (id, n, lid).
    Columns with sub-columns give group and column; flat ones only a column. Entries without a
    valid account are dropped.
    """
    columns = report.select(F.explode("c").alias("c")).select(
        F.col("c.ifd").alias("top"), F.explode_outer("c.sc").alias("s")
    )
    cells = columns.select(
        F.coalesce("s.ifd", "top").alias("id"),
        F.when(F.col("s").isNotNull(), F.col("top")).alias("group_id"),
    )
    known = names.filter(F.col("lid") > -1).select(
        "id", F.col("lid").cast("string").alias("account"), F.col("n").alias("column_name")
    )
    groups = names.select(F.col("id").alias("group_id"), F.col("n").alias("group"))
    return cells.join(known, "id").join(groups, "group_id", "left").select(
        "account", "group", "column_name"
    )


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return good(read_json(spark, path, "c array<struct<ifd:int,sc:array<struct<ifd:int>>>>"))


def read_names(spark: SparkSession, path: str) -> DataFrame:
    return good(read_json(spark, path, "id int, n string, lid int")).select("id", "n", "lid")


def fallback_portfolio(cells: DataFrame, dictionary: DataFrame, period: int) -> DataFrame:
    """Shard cells named by the reports' dictionary, in the shape of the main API, in thousands."""
    return cells.join(dictionary, "account").select(
        "inst_id", F.lit(period).alias("period"), "report", "group",
        "account", "column_name", X.thousands(F.col("value")).alias("value"),
    )


def fallback_statement(cells: DataFrame, period: int) -> DataFrame:
    return cells.select(
        "inst_id", F.lit(period).alias("period"), "account",
        X.thousands(F.col("value")).alias("value"),
    )


def read_fallback(
    spark: SparkSession, folder: str, period: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(registry, statements, portfolios) of one quarter of the fallback site.

    Each institution's shard cells are kept only for listed institutions and known accounts. The
    portfolio shard is read once for all reports.
    """
    registry = read_fallback_registry(spark, f"{folder}/registry.json", period)
    names = read_names(spark, f"{folder}/names.json")
    cells = read_shards(spark, f"{folder}/statements.json", registry, statement_accounts(spark))
    columns = reduce(
        DataFrame.unionByName,
        [
            column_dictionary(read_report(spark, f"{folder}/report_{r}.json"), names).withColumn(
                "report", F.lit(r)
            )
            for r in PORTFOLIO_REPORTS
        ],
    )
    values = read_shards(spark, f"{folder}/portfolios.json", registry, columns)
    return registry, fallback_statement(cells, period), fallback_portfolio(values, columns, period)


def fill_from_fallback(main: DataFrame, fallback: DataFrame, *group: str) -> DataFrame:
    """Never replaces a period (of a report) that the main API delivered."""
    return fill_missing_groups(main, fallback, list(group))


def statement_accounts(spark: SparkSession) -> DataFrame:
    """Accounts of the new scheme that the fallback delivers."""
    new = [(accounts[0],) for accounts in C.STATEMENT_COLUMNS.values()]
    return spark.createDataFrame(new, "account string")
