"""Employment movements: microdata text files and the retraction-aware aggregate."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.functions import clean as X
from regiostat.functions import metrics as M
from regiostat.session import ship_package
from regiostat.sources.banks import RAGGED, split_cells
from regiostat.sources.ledger import Ledger

# Columns of the microdata after folding the header.
MOVEMENT_COLUMNS = ["competenciamov", "municipio", "subclasse", "saldomovimentacao", "salario"]
# Kind of file -> sign (on time, late, retracted).
KIND_SIGNS = {"MOV": 1, "FOR": 1, "EXC": -1}
#: The header is looked for in so many lines of a file.
HEAD_LINES = 64
INCOMPLETE = "period, place or activity missing"


def fold_header(name: str) -> str:
    """Plain lower-case form of one header cell (headers only)."""
    table = str.maketrans(X.ACCENTED, X.PLAIN)
    return name.translate(table).encode("ascii", "ignore").decode().lower()


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Header among the first lines of one file; what follows is not read."""
    for batch in batches:
        lines = batch.column("value").to_pylist()
        header = next((x for x in lines if MOVEMENT_COLUMNS[0] in fold_header(x)), None)
        found = [batch.column("file")[:1], pa.array([header], pa.string()), pa.array([len(lines)], pa.int64())]
        yield pa.RecordBatch.from_arrays(found, ["file", "header", "lines"])
        return


def first_lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(file, header, lines) of every file that is not empty: ``lines`` lines were looked at.

    Each file is one partition of a task that stops after its first ``HEAD_LINES`` lines, so the bytes read
    do not depend on the size of the files.
    """
    ship_package(spark)
    # Settings of a session of its own: files are neither split nor put together.
    session = spark.newSession()
    for name in ("maxPartitionBytes", "openCostInBytes"):
        session.conf.set(f"spark.sql.files.{name}", str(1 << 42))
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(HEAD_LINES))
    lines = session.read.text(list(files)).select(F.col("_metadata.file_path").alias("file"), "value")
    return lines.mapInArrow(_first_lines, "file string, header string, lines long")


def file_headers(
    spark: SparkSession, files: Sequence[str]
) -> list[tuple[str, str | None, str | None]]:
    """(file, kind, header line) of every file; NULL for a name without kind or a file without header.

    The header is the line that names the period column, among the first ``HEAD_LINES``.
    """
    if not files:
        return []
    # One row for each file; the driver lists the files anyway.
    headers = {r["file"]: r["header"] for r in first_lines(spark, files).collect()}
    return [(file, kind_of(file), headers.get(file)) for file in sorted(files)]


def files_of(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Names of the files of a path; fails where nothing matches."""
    paths = [path] if isinstance(path, str) else list(path)
    found = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file"))
    return [r["file"] for r in found.orderBy("file").collect()]


def kind_of(file: str) -> str | None:
    """Kind of a microdata file by its name."""
    match = re.search(r"(?:^|CAGED|[^A-Za-z])(MOV|FOR|EXC)(?![A-Za-z])", file.rsplit("/", 1)[-1])
    return match[1] if match else None


def columns_of(header: str | None) -> list[str]:
    """Folded column names of a header line."""
    return [fold_header(c.strip().strip('"')) for c in (header or "").lstrip("\ufeff").split(";")]


def _problem(kind: str | None, header: str | None) -> str | None:
    if kind is None:
        return "unknown kind of file"
    missing = [c for c in MOVEMENT_COLUMNS if c not in columns_of(header)]
    return f"column missing: {', '.join(missing)}" if missing else None


def tagged_movements(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Every line of the files: (file, problem, period, place_id6, division, movement, wage, kind).

    ``problem`` says why a line is left out, NULL for a good one. A file that cannot be read at all gives one row. Files
    of one header are read together and by that header, so files may differ in their columns; header and
    blank lines are no rows. Spark splits large files itself.
    """
    layouts: dict[tuple[str, str], list[str]] = {}
    unread = []
    for file, kind, header in file_headers(spark, files):
        problem = _problem(kind, header)
        if problem:
            unread.append((file, problem))
        else:
            layouts.setdefault((kind, header), []).append(file)
    parts = [_read_layout(spark, found, *layout) for layout, found in sorted(layouts.items())]
    bad = spark.createDataFrame(unread, "file string, problem string")
    for c in (*MOVEMENT_COLUMNS, "kind"):
        bad = bad.withColumn(c, F.lit(None).cast("string"))
    rows = reduce(DataFrame.unionByName, parts, bad)
    typed = rows.select("file", "problem", *_typed())
    key = F.col("period").isNull() | F.col("place_id6").isNull() | F.col("division").isNull()
    return typed.withColumn("problem", F.coalesce("problem", F.when(key, F.lit(INCOMPLETE))))


def _read_layout(spark: SparkSession, files: list[str], kind: str, header: str) -> DataFrame:
    names = columns_of(header)
    lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), "value")
    lines = lines.filter((F.trim("value") != "") & (F.col("value") != F.lit(header)))
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"')))
    # A row of its own for the cells: a line is split once, however many columns and filters read them.
    cells = lines.select("*", F.explode(F.array(split_cells(F.col("value")))).alias("cells"))
    fits = (F.size("cells") == len(names)) & (quotes % 2 == 0)
    cell = lambda c: F.nullif(F.get("cells", F.lit(names.index(c))), F.lit(""))
    return cells.select(
        "file", F.when(~fits, F.lit(RAGGED)).alias("problem"),
        *[F.when(fits, cell(c)).alias(c) for c in MOVEMENT_COLUMNS], F.lit(kind).alias("kind"),
    )


def read_movements(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Microdata as typed movements, the good lines only; ``movement_rejects`` counts the others."""
    return tagged_movements(spark, files_of(spark, path)).filter("problem IS NULL").drop("file", "problem")


def movement_rejects(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, reason, rows) of the files and lines that ``read_movements`` leaves out."""
    bad = tagged_movements(spark, files_of(spark, path)).filter("problem IS NOT NULL")
    return bad.groupBy("file", F.col("problem").alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


def type_movements(raw: DataFrame) -> DataFrame:
    """Text columns to (period, place_id6, division, movement, wage, kind)."""
    return raw.select(*_typed())


def _typed() -> list[Column]:
    return [
        X.lenient_int(F.col("competenciamov")).alias("period"),
        F.col("municipio").alias("place_id6"),
        X.prefix(F.col("subclasse"), 2).alias("division"),
        X.count_or_zero(F.col("saldomovimentacao")).alias("movement"),
        X.decimal_comma(F.col("salario")).alias("wage"),
        F.col("kind"),
    ]


def _signed_sums() -> list[Column]:
    """Additive sums of movements: on time + late - retracted; wages, in cents, of hires only."""
    sign = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in KIND_SIGNS.items()])
    sign = sign.cast("long")
    move = F.col("movement")
    hire = move > 0
    cents = F.rint(F.col("wage") * 100).cast("long")
    return [
        F.sum(F.when(hire, sign).otherwise(0)).alias("hires"),
        F.sum(F.when(move < 0, sign).otherwise(0)).alias("leavers"),
        F.sum(sign * move).alias("net"),
        F.coalesce(F.sum(F.when(hire, sign * cents)), F.lit(0)).alias("wage_cents"),
        F.sum(F.when(hire & F.col("wage").isNotNull(), sign).otherwise(0)).alias("wage_count"),
    ]


def _in_money(sums: DataFrame) -> DataFrame:
    """Cents to money, in the place of the column."""
    columns = [c if c != "wage_cents" else (F.col(c) / F.lit(100.0)).alias("wage_sum") for c in sums.columns]
    return sums.select(*columns)


def signed_jobs(movements: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hires, leavers, net and hiring wages by event month: on time + late - retracted.

    All sums are additive, so Spark combines them before the shuffle and late or retracted
    records correct a month whenever they arrive.
    """
    return _in_money(movements.dropna(subset=list(keys)).groupBy(*keys).agg(*_signed_sums()))


def finish_jobs(sums: DataFrame) -> DataFrame:
    """Mean hiring wage; NULL where no hire with a wage is left."""
    wage = M.ratio(F.col("wage_sum"), F.col("wage_count"), 1.0, 2)
    return sums.withColumn("mean_wage", wage).drop("wage_sum", "wage_count")


SUM_KEYS = ["period", "place_id6", "division"]
#: What the ledger keeps: one row for each key of a file, or for each problem.
CELLS = (
    "problem string, period int, place_id6 string, division string, hires long, leavers long, net long, "
    "wage_cents long, wage_count long, rows long"
)


def movement_cells(spark: SparkSession, files: Sequence[str]) -> dict[str, DataFrame]:
    """Sums of the good lines and counts of the others, by file, in one scan."""
    lines = tagged_movements(spark, files)
    lines = lines.withColumns({c: F.when(F.col("problem").isNull(), F.col(c)) for c in SUM_KEYS})
    sums = [*_signed_sums(), F.count(F.lit(1)).alias("rows")]
    return {"cells": lines.groupBy("file", "problem", *SUM_KEYS).agg(*sums)}


def jobs_ledger(spark: SparkSession, folder: str) -> Ledger:
    """The microdata files read so far, their sums and their rejects."""
    return Ledger(spark, folder, {"cells": CELLS})


def ledger_jobs(ledger: Ledger) -> DataFrame:
    """Signed sums of all files of a ledger."""
    good = ledger.part("cells").filter("problem IS NULL")
    added = ["hires", "leavers", "net", "wage_cents", "wage_count"]
    return _in_money(good.groupBy(*SUM_KEYS).agg(*[F.sum(c).alias(c) for c in added]))


def ledger_rejects(ledger: Ledger) -> DataFrame:
    """(file, reason, rows) of what a ledger's files hold beside the sums."""
    bad = ledger.part("cells").filter("problem IS NOT NULL")
    return bad.groupBy("file", F.col("problem").alias("reason")).agg(F.sum("rows").alias("rows"))


def update_jobs(
    spark: SparkSession, path: str | Sequence[str], folder: str, changed: bool = False
) -> DataFrame:
    """Signed sums of all microdata files, reading only those that no earlier call has read.

    See ``Ledger.add`` for ``changed``.
    """
    ledger = jobs_ledger(spark, folder)
    ledger.add(path, lambda files: movement_cells(spark, files), changed)
    return ledger_jobs(ledger)
