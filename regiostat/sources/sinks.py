"""Sinks: tables, materialised views, report sheets, JSON payloads, generated seeds."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from regiostat.operators.quality import duplicate_keys
from regiostat.plans.catalogue import MATERIALISED
from regiostat.schemas import TABLE_KEYS
from regiostat.sources.versions import commit, latest, remove_old
from regiostat.tables import TableSet

# Facts are split by period on disk, so a latest-position filter reads one folder.
PERIOD_COLUMNS = ("period", "year", "quarter")


def period_column(df: DataFrame) -> str | None:
    return next((c for c in PERIOD_COLUMNS if c in df.columns), None)


def write_table(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Full refresh. Rows of a period are brought together to get few files; a period that holds
    a large part of all rows is split again by the rebalance step."""
    if partition is None:
        df.write.mode("overwrite").parquet(path)
        return
    df.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(path)


def replace_periods(df: DataFrame, path: str, partition: str = "period") -> None:
    """Overwrite only the periods present in ``df``; a revised period replaces the old one."""
    writer = df.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def write_version(
    df: DataFrame, folder: str, name: str, keys: Sequence[str] = (), partition: str | None = None,
    after: int | None = None,
) -> DataFrame:
    """Write a table beside its earlier versions, check it, then make it the current one.

    Readers follow ``current_version``; a failed write or check leaves the former table as it was,
    and a table may be computed from its own current version. ``after`` is the number of the version that ``df``
    was computed from (now, if not given): if another writer has committed since, this one fails with
    ``VersionConflict``. The data of old versions are removed, but of the last few.
    """
    spark, home = df.sparkSession, f"{folder}/{name}"
    base = latest(spark, home)[0] if after is None else after
    path = f"{home}/v-{uuid.uuid4().hex}"
    write_table(df, path, partition)
    stored = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    if keys and not duplicate_keys(stored, keys).isEmpty():
        raise ValueError(f"duplicate keys in {name}: {', '.join(keys)}")
    commit(spark, home, {"paths": [path]}, base)
    remove_old(spark, home)
    return stored


def current_version(spark: SparkSession, folder: str, name: str) -> str:
    """Folder of the version that was committed last."""
    entry = latest(spark, f"{folder}/{name}")[1]
    if entry is None:
        raise FileNotFoundError(f"{folder}/{name} has no version")
    return entry["paths"][0]


def write_base_tables(t: TableSet, folder: str) -> None:
    """Write every base table, fail on duplicate keys, and read them back from then on."""
    for name, keys in TABLE_KEYS.items():
        if name in t:
            t.repoint(name, write_version(t[name], folder, name, keys, period_column(t[name])))


def materialise(t: TableSet, folder: str, names: list[str] | None = None) -> None:
    """Write the heavy views in dependency order; each name then stands for its table."""
    for name in names or MATERIALISED:
        t.repoint(name, write_version(t[name], folder, name))


def write_datasets(
    t: TableSet, datasets: Mapping[str, Callable[[TableSet], DataFrame]], folder: str
) -> None:
    """The dashboard datasets (``plans.datasets.DATASETS``), one JSON folder each."""
    for name, dataset in datasets.items():
        write_payload(dataset(t), f"{folder}/{name}")


def write_sheets(
    t: TableSet, sheets: Mapping[str, Callable[[TableSet], DataFrame]], folder: str
) -> dict[str, int]:
    """One folder per sheet; row counts come from the write itself."""
    counts = {}
    for name, sheet in sheets.items():
        seen = Observation(name)
        df = sheet(t).observe(seen, F.count(F.lit(1)).alias("rows"))
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
        counts[name] = seen.get["rows"]
    return counts


def write_payload(df: DataFrame, path: str) -> None:
    """Nested dataset as JSON, one entity per line."""
    df.write.mode("overwrite").json(path)


def write_seed(df: DataFrame, path: str, key: str) -> None:
    """Generated seed, sorted; a catalogue of series is small, so one file."""
    df.orderBy(key).coalesce(1).write.mode("overwrite").csv(path, sep=";", header=True)


def unprocessed(inputs: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """Inputs that no earlier run has aggregated."""
    return inputs.join(done.select(key), key, "left_anti")
