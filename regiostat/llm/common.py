"""Helpers shared by the operators: tables, staging, folds."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark so that any file system it knows will do."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for intermediate tables; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="regiostat-llm-")
    return _own_folders[context.applicationId]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: work done once, lineage cut there."""
    spark = df.sparkSession
    ship_package(spark)
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(column: str, parts: int) -> Column:
    """crc32 of an id as text modulo the number of folds; NULL for a NULL id."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(parts))


def byte_size(text: str) -> Column:
    """UTF-8 bytes of a text, none for NULL."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


#: Labels are broadcast to the documents up to so many rows; beyond that Spark shuffles the texts.
BROADCAST_LABELS = 500_000


def labelled(documents: DataFrame, labels: DataFrame, label: str, learnable: Column) -> DataFrame:
    """(doc_id, text, label 0 or 1) of the learnable documents that have a label.

    Label rows without an id or with another value than 0 or 1 are left out; of several rows for
    one id the highest counts.
    """
    wanted = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & learnable)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    wanted = staged(wanted, "labels")
    if wanted.count() <= BROADCAST_LABELS:
        wanted = F.broadcast(wanted)
    return documents.select("doc_id", "text").join(wanted, "doc_id")


def slices(texts: Iterable[str | None], limit: int = 1 << 19) -> Iterator[tuple[int, list[bytes]]]:
    """(first position, encoded texts) in runs of about ``limit`` bytes; NULL is an empty text."""
    first, run, total = 0, [], 0
    for k, text in enumerate(texts):
        data = text.encode("utf-8", "replace") if isinstance(text, str) else b""
        run.append(data)
        total += len(data)
        if total >= limit:
            yield first, run
            first, run, total = k + 1, [], 0
    if run:
        yield first, run


def logistic(x: float) -> float:
    """1 / (1 + e^-x) without overflow."""
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))
