"""Bank balance sheets by place: zipped wide CSV files."""

from __future__ import annotations

import io
import itertools
import lzma
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.functions import clean as X
from regiostat.session import ship_package
from regiostat.sources.ledger import Ledger

# Layout of the balance file.
JUNK_LINES = 2
ACCOUNT_PATTERN = r"VERBETE_(\d{3})"
BATCH_LINES = 50_000


LINES = "path string, header string, line string, problem string"
BAD_ARCHIVE = "bad archive"
RAGGED = "other number of cells than the header"
NO_COLUMN = "column missing"
NO_PERIOD = "period missing"
PERIOD, PLACE = "#DATA_BASE", "CODMUN_IBGE"
#: What a damaged archive may raise, whatever its compression.
DAMAGE = (
    zipfile.BadZipFile, zlib.error, lzma.LZMAError, struct.error, EOFError, OSError, NotImplementedError,
    RuntimeError, ValueError,
)


def _lines_of_zips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unzip each file inside the task and hand its lines on in bounded batches.

    Beside the batch that Spark sends, one archive is held at a time. An archive is tested whole, checksums included, before its first line goes on: one that cannot be read costs
    only itself and gives one row with the problem and no other.
    """
    for files in batches:
        for path, cell in zip(files.column("path").to_pylist(), files.column("content"), strict=True):
            content = cell.as_py()
            if not _sound(content):
                yield _batch(path, None, [None], BAD_ARCHIVE)
                continue
            for header, lines in _members(content):
                yield _batch(path, header, lines, None)


def _batch(path: str | None, header: str | None, lines: list[str | None], problem: str | None) -> pa.RecordBatch:
    n = len(lines)
    columns = [[path] * n, [header] * n, lines, [problem] * n]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["path", "header", "line", "problem"])


def _sound(content: bytes) -> bool:
    """Whether every member can be unpacked and has its checksum."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            return archive.testzip() is None
    except DAMAGE:
        return False


def _members(content: bytes) -> Iterator[tuple[str, list[str]]]:
    """Header and some lines of each member, again and again until all lines are read."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for member in archive.namelist():
            with archive.open(member) as raw:
                text = io.TextIOWrapper(raw, encoding="latin-1", newline=None)
                for _ in range(JUNK_LINES):
                    text.readline()
                header = text.readline().rstrip("\n")
                while lines := [x.rstrip("\n") for x in itertools.islice(text, BATCH_LINES)]:
                    yield header, lines


def read_zipped_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(path, header, line, problem): Spark has no zip codec, so one small Python step unpacks."""
    files = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    return unzipped(files.select(F.col("_metadata.file_path").alias("path"), "content"))


def unzipped(files: DataFrame) -> DataFrame:
    """Lines of archives given as (path, content)."""
    ship_package(files.sparkSession)
    return files.select("path", "content").mapInArrow(_lines_of_zips, LINES)


def split_cells(c: Column) -> Column:
    """Cells of a ``;`` line; a separator inside quotes is text, quotes around a cell go."""
    plain = F.split(c, ";")
    quoted = F.transform(
        F.split(c, r';(?=(?:[^"]*"[^"]*")*[^"]*$)'),
        lambda x: F.replace(F.regexp_replace(x, '^"(.*)"$', "$1"), F.lit('""'), F.lit('"')),
    )
    return F.when(F.contains(c, F.lit('"')), quoted).otherwise(plain)


def tagged_balances(lines: DataFrame) -> DataFrame:
    """Every line: (file, problem, period, place_id, tax_id, branches, accounts); blank lines are none.

    ``problem`` says why a line is left out, NULL for a good one. Named cells are a map, so files may differ in
    their value columns.
    """
    cells = lines.filter("problem IS NOT NULL OR line <> ''").select(
        F.col("path").alias("file"), "problem", split_cells(F.col("header")).alias("names"),
        split_cells(F.col("line")).alias("cells"),
    )
    named = F.array_contains("names", PERIOD) & F.array_contains("names", PLACE)
    problem = F.coalesce(
        "problem", F.when(~named, F.lit(NO_COLUMN)),
        F.when(F.size("names") != F.size("cells"), F.lit(RAGGED)),
    )
    tagged = cells.withColumn("problem", problem)
    mapped = F.when(F.col("problem").isNull(), F.map_from_arrays("names", "cells"))
    typed = tagged.withColumn("c", mapped).select(
        "file", "problem",
        X.lenient_int(F.col("c")[PERIOD]).alias("period"),
        F.trim(F.coalesce(F.col("c")[PLACE], F.lit(""))).alias("place_id"),
        F.col("c")["CNPJ"].alias("tax_id"),
        X.lenient_number(F.col("c")["AGEN_PROCESSADAS"]).alias("branches"),
        F.map_filter("c", lambda k, _: F.regexp_extract(k, ACCOUNT_PATTERN, 1) != "").alias("accounts"),
    )
    missing = F.when(F.col("period").isNull(), F.lit(NO_PERIOD))
    return typed.withColumn("problem", F.coalesce("problem", missing))


def balance_cells(lines: DataFrame) -> DataFrame:
    """The good lines; ``balance_rejects`` counts the others."""
    return tagged_balances(lines).filter("problem IS NULL").drop("file", "problem")


def balance_rejects(lines: DataFrame) -> DataFrame:
    """(file, reason, rows): archives that cannot be read, and lines that do not fit their header."""
    bad = tagged_balances(lines).filter("problem IS NOT NULL")
    return bad.groupBy("file", F.col("problem").alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


def _account_sums(cells: DataFrame, *keys: str) -> DataFrame:
    """Sums of the accounts, as decimals, so that they add up exactly in any order."""
    long = cells.select(*keys, F.explode("accounts").alias("name", "text")).select(
        *keys, F.regexp_extract("name", ACCOUNT_PATTERN, 1).try_cast("int").alias("account"),
        X.lenient_number(F.col("text")).cast("decimal(28,6)").alias("value"),
    )
    return long.dropna(subset=["value"]).groupBy(*keys, "account").agg(F.sum("value").alias("value"))


def place_amounts(cells: DataFrame) -> DataFrame:
    """(period, place, account) sums in thousands, one decimal; every account is kept."""
    return _in_thousands(_account_sums(cells, "period", "place_id"))


def _in_thousands(sums: DataFrame) -> DataFrame:
    return sums.withColumn("amount", X.thousands(F.col("value").cast("double"), 1)).drop("value")


def place_presence(cells: DataFrame) -> DataFrame:
    """Distinct institutions and branches; all-missing branches add up to zero."""
    return cells.groupBy("period", "place_id").agg(
        F.count_distinct("tax_id").alias("institutions"),
        F.coalesce(F.sum("branches"), F.lit(0.0)).alias("branches"),
    )


#: What the ledger keeps of archives. Institutions are counted once a place, so their ids stay.
BALANCE_PARTS = {
    "amounts": "period int, place_id string, account int, value decimal(38,6)",
    "presence": "problem string, period int, place_id string, tax_id string, branches decimal(38,6), rows long",
}


def balance_parts(spark: SparkSession, files: Sequence[str], work: str) -> dict[str, DataFrame]:
    """Sums, institutions and rejects by file; the archives are unpacked once, into ``work``."""
    path = f"{work}/unpacked-{uuid.uuid4().hex}"
    read_zipped_lines(spark, files).write.parquet(path)
    tagged = tagged_balances(spark.read.schema(LINES).parquet(path))
    keys = ["period", "place_id", "tax_id"]
    presence = tagged.withColumns({c: F.when(F.col("problem").isNull(), F.col(c)) for c in keys})
    return {
        "amounts": _account_sums(tagged.filter("problem IS NULL"), "file", "period", "place_id"),
        "presence": presence.groupBy("file", "problem", *keys).agg(
            F.sum(F.col("branches").cast("decimal(28,6)")).alias("branches"), F.count(F.lit(1)).alias("rows")
        ),
    }


def balance_ledger(spark: SparkSession, folder: str) -> Ledger:
    """The archives read so far."""
    return Ledger(spark, folder, BALANCE_PARTS)


def update_balances(
    spark: SparkSession, path: str | Sequence[str], folder: str, changed: bool = False
) -> Ledger:
    """Unpacks the archives that no earlier call has unpacked, and no others.

    See ``Ledger.add`` for ``changed``.
    """
    ledger = balance_ledger(spark, folder)
    ledger.add(path, lambda files: balance_parts(spark, files, f"{folder}/work"), changed)
    return ledger


def ledger_amounts(ledger: Ledger) -> DataFrame:
    """``place_amounts`` of all archives of a ledger."""
    keys = ["period", "place_id", "account"]
    return _in_thousands(ledger.part("amounts").groupBy(*keys).agg(F.sum("value").alias("value")))


def ledger_presence(ledger: Ledger) -> DataFrame:
    """``place_presence`` of all archives of a ledger."""
    good = ledger.part("presence").filter("problem IS NULL")
    return good.groupBy("period", "place_id").agg(
        F.count_distinct("tax_id").alias("institutions"),
        F.coalesce(F.sum("branches").cast("double"), F.lit(0.0)).alias("branches"),
    )


def ledger_rejects(ledger: Ledger) -> DataFrame:
    """(file, reason, rows) of what a ledger's archives hold beside the sums."""
    bad = ledger.part("presence").filter("problem IS NOT NULL")
    return bad.groupBy("file", F.col("problem").alias("reason")).agg(F.sum("rows").alias("rows"))
