"""Generic readers: seeds, OData envelopes, header-in-first-row JSON, rejects, empty tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.functions import clean as X
from regiostat.schemas import TABLE_SCHEMAS

#: Fixed value: stands in no file, so a file is not cut into records.
NO_SEPARATOR = "\0regiostat: no end of a record\0"


def file_stem() -> Column:
    """File name without its extension."""
    return F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLE_SCHEMAS[table])


def or_empty(spark: SparkSession, table: str, read: Callable[[], DataFrame]) -> DataFrame:
    """The table, or an empty typed one where the source has no files."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, table)


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Hand-kept ``;`` file: comment lines, quoted cells, all text; empty cells are NULL."""
    return (
        spark.read.option("mode", "FAILFAST")
        .schema(schema)
        .csv(path, sep=";", header=True, comment="#", encoding="UTF-8")
    )


def read_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """Place coordinates; the code stays text."""
    raw = spark.read.schema(
        "codigo_ibge string, latitude double, longitude double, capital string"
    ).csv(path, header=True)
    flag = F.lower(F.trim("capital")).isin("1", "1.0", "true")
    return raw.withColumnsRenamed(
        {"codigo_ibge": "place_id", "latitude": "lat", "longitude": "lng"}
    ).withColumn("is_capital", flag).drop("capital")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole JSON files (an array gives one row per element) with ``stem`` and ``corrupt``.

    A file is one record, of less than 2 GB, whatever its lines. With ``multiLine`` instead, Spark opens the file
    again for every number that becomes text. In UTF-16, which JSON forbids and ``rejects`` names, such a number
    gives an empty text.
    """
    raw = spark.read.schema(f"{schema}, corrupt string").json(
        path, lineSep=NO_SEPARATOR, mode="PERMISSIVE", columnNameOfCorruptRecord="corrupt"
    )
    return raw.select("*", file_stem().alias("stem"))


def good(df: DataFrame) -> DataFrame:
    return df.filter(F.col("corrupt").isNull()).drop("corrupt")


def rejects(spark: SparkSession, path: str) -> DataFrame:
    """Files that are no JSON at all (error pages): named for a report, never deleted."""
    files = spark.read.text(path, wholetext=True)
    return files.filter(F.try_parse_json("value").isNull()).select(
        F.col("_metadata.file_path").alias("file"), F.lit("corrupt").alias("reason")
    )


def read_envelope(spark: SparkSession, path: str, fields: Mapping[str, str]) -> DataFrame:
    """``{"value": [{...}]}`` files: one row per record, all fields as text, renamed."""
    struct = ", ".join(f"`{source}`: string" for source in fields)
    raw = good(read_json(spark, path, f"value array<struct<{struct}>>"))
    records = raw.select("stem", F.explode("value").alias("r"))
    return records.select(
        *[F.col(f"r.`{source}`").alias(name) for source, name in fields.items()], "stem"
    )


def read_header_row_json(
    spark: SparkSession,
    path: str,
    wanted: Mapping[str, str],
    as_label: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Tables whose first JSON element maps column codes to labels.

    ``wanted`` maps our name to a fragment of the label (case-insensitive). For the names in
    ``as_label`` the label column beside the code column is read. A file without one of the
    labels is skipped and reported. Returns (rows with ``value`` and ``_order``, rejects).
    """
    # A row of its own for the items: a file is parsed once, however many columns and filters read them.
    items = F.from_json("value", "array<map<string,string>>")
    files = spark.read.text(path, wholetext=True).select(
        file_stem().alias("stem"), F.explode(F.array(items)).alias("items")
    )
    header = F.element_at("items", 1)

    def code_of(name: str, fragment: str) -> Column:
        hits = F.map_filter(
            F.col("header"), lambda _, label: F.contains(F.lower(label), F.lit(fragment.lower()))
        )
        code = F.get(F.map_keys(hits), F.lit(0))
        return F.regexp_replace(code, "C$", "N") if name in as_label else code

    filled = files.filter(F.size("items") > 1).withColumn("header", header)
    coded = filled.withColumns({f"_{n}": code_of(n, f) for n, f in wanted.items()})
    complete = F.lit(True)
    for name in wanted:
        complete = complete & F.col(f"_{name}").isNotNull()

    rows = (
        coded.filter(complete)
        .select("stem", *[f"_{n}" for n in wanted], F.posexplode("items").alias("_pos", "row"))
        .filter(F.col("_pos") > 0)
        .select(
            *[F.try_element_at("row", F.col(f"_{n}")).alias(n) for n in wanted],
            X.lenient_number(F.try_element_at("row", F.lit("V"))).alias("value"),
            F.struct("stem", "_pos").alias("_order"),
        )
    )
    skipped = coded.filter(~complete).select("stem", F.lit("label missing").alias("reason"))
    broken = files.filter(F.col("items").isNull()).select("stem", F.lit("corrupt").alias("reason"))
    return rows, skipped.unionByName(broken)
