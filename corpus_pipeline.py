"""Training corpus: quality, near duplicates, benchmark leaks, source mix, shards.

Each stage takes all rows that the one before it kept; its result is written as Parquet to the shared
folder and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.llm.common import staged, table
from regiostat.llm.decontaminate import without_leaks
from regiostat.llm.mixing import mixed
from regiostat.llm.near_dups import one_of_each
from regiostat.llm.quality import good_documents
from regiostat.llm.sharding import OLD_SHARDS, resharded, text_hash


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice."""
    return mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row, in shards of near equal bytes."""
    return resharded(docs, F.pmod(text_hash(), F.lit(OLD_SHARDS)))


STAGES = [
    ("quality", quality),
    ("near_dups", near_dups),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: A fitted classifier and hashed sampling are not SQL; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
