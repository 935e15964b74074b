"""Ledger of the files that have been read, and what was kept of them.

A load adds files to the ledger once. What it keeps of a file (sums, keys, rejects) goes to one table for each
kind, a *part*, and every row names its file; so parts of many loads merge, and a file that has
changed since replaces what was kept of its former content. The list of files is itself a version (see
``versions``): a load that is cut off or loses against another one leaves the former state.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.sources.versions import commit, latest, remove_old

FILES = "file string, size long, modified timestamp, batch string"
#: Loads whose parts are kept side by side before they are put together.
MOST_BATCHES = 16

Build = Callable[[list[str]], Mapping[str, DataFrame]]


def listing(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, size, modified) of files, without reading them; no row where nothing matches.

    Files without a byte are not listed: there is nothing in them to read or to reject.
    """
    paths = [path] if isinstance(path, str) else list(path)
    try:
        found = spark.read.format("binaryFile").load(paths)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file string, size long, modified timestamp")
    return found.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


class Ledger:
    """State of a source below ``folder``; ``parts`` names the schema of each part, without file."""

    def __init__(self, spark: SparkSession, folder: str, parts: Mapping[str, str]):
        self.spark, self.folder, self.parts = spark, folder, dict(parts)

    def _state(self) -> tuple[int, dict]:
        number, entry = latest(self.spark, self.folder)
        return number, entry or {"paths": [], "files": None, "batches": []}

    def _files(self, entry: Mapping) -> DataFrame:
        if entry["files"] is None:
            return self.spark.createDataFrame([], FILES)
        return self.spark.read.schema(FILES).parquet(entry["files"])

    def files(self) -> DataFrame:
        """(file, size, modified, batch) of every file read so far, in its present content."""
        return self._files(self._state()[1])

    def part(self, name: str) -> DataFrame:
        """What was kept of all files, with ``file``."""
        return self._part(name, self._state()[1]).drop("batch")

    def _part(self, name: str, entry: Mapping) -> DataFrame:
        schema = f"file string, batch string, {self.parts[name]}"
        if not entry["batches"]:
            return self.spark.createDataFrame([], schema)
        stored = self.spark.read.schema(schema).parquet(*[self._at(name, b) for b in entry["batches"]])
        # Rows of a file that has been read again since are not the file's any more.
        return stored.join(self._files(entry).select("file", "batch"), ["file", "batch"], "left_semi")

    def _at(self, name: str, batch: str) -> str:
        return f"{self.folder}/{batch}/{name}"

    def add(self, path: str | Sequence[str], build: Build, changed: bool = False) -> list[str]:
        """Reads the files that are new; returns them.

        ``build`` gives the parts of a list of files. The files are as many as the driver lists anyway. With ``changed`` a
        known file of another size or time is read again and replaces what was kept of it.
        """
        number, entry = self._state()
        known = self._files(entry)
        found = listing(self.spark, path)
        new = found.join(known, ["file", "size", "modified"] if changed else "file", "left_anti").orderBy("file").collect()
        if not new:
            return []
        names = [r["file"] for r in new]
        batch = f"batch-{uuid.uuid4().hex}"
        for name, df in build(names).items():
            rows = df.withColumn("batch", F.lit(batch)).to(self._schema(name))
            rows.write.parquet(self._at(name, batch))
        added = self.spark.createDataFrame([(*r, batch) for r in new], FILES)
        kept = known.join(added.select("file"), "file", "left_anti")
        entry = self._commit(kept.union(added), [*entry["batches"], batch], number)
        if len(entry["batches"]) > MOST_BATCHES:
            self.compact()
        return names

    def _schema(self, name: str):
        return self.spark.createDataFrame([], f"file string, batch string, {self.parts[name]}").schema

    def _commit(self, files: DataFrame, batches: list[str], after: int) -> dict:
        path = f"{self.folder}/files-{uuid.uuid4().hex}"
        files.coalesce(1).write.parquet(path)
        entry = {
            "paths": [path, *[f"{self.folder}/{b}" for b in batches]], "files": path, "batches": batches,
        }
        commit(self.spark, self.folder, entry, after)
        remove_old(self.spark, self.folder)
        return entry

    def compact(self) -> None:
        """Puts the parts of all loads together; rows of changed files go. Sums stay the same."""
        number, entry = self._state()
        batch = f"batch-{uuid.uuid4().hex}"
        for name in self.parts:
            rows = self._part(name, entry).withColumn("batch", F.lit(batch))
            rows.hint("rebalance").write.parquet(self._at(name, batch))
        self._commit(self._files(entry).withColumn("batch", F.lit(batch)), [batch], number)
