"""New files only, late and retracted records, calendar months, revised history.

All jobs run with ``availableNow`` from a checkpoint: a restart after a lost executor or driver
repeats at most the last batch, and every batch writes to a folder named after it, so repeating
it changes nothing. For large states use the RocksDB state store of the session.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.functions.periods import month_of
from regiostat.sources.movements import (
    jobs_ledger,
    ledger_jobs,
    movement_cells,
    read_movements,
    signed_jobs,
)
from regiostat.sources.versions import commit, latest, names_in, remove, remove_old


def file_stream(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Stream over the Parquet files of a folder whose name matches ``pattern``."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def raw_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Stream of the names of new raw files (``file``), of any format: their content is not read here."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern)
    return reader.load(folder).select(F.col("path").alias("file"))


def _drain(stream: DataFrame, write: Callable, checkpoint: str, mode: str) -> None:
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


#: Batches that lie side by side before they are put together.
MOST_BATCHES = 16


class Batches:
    """Results of batches below ``out``, one folder each, put together when there are many.

    A batch that is repeated after a restart replaces its folder. What has been put together is named by a version
    (see ``versions``) with the number of its last batch; folders up to that number do not count any more and go.
    """

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out

    def _pending(self, upto: int) -> list[str]:
        names = [n for n in names_in(self.spark, self.out) if n.startswith("batch-")]
        return [n for n in names if int(n.removeprefix("batch-")) > upto]

    def _state(self) -> tuple[int, dict]:
        number, entry = latest(self.spark, self.out)
        return number, entry or {"paths": [], "upto": -1}

    def write(self, rows: DataFrame, number: int) -> None:
        rows = rows.withColumn("batch", F.lit(number).cast("long"))
        rows.write.mode("overwrite").parquet(f"{self.out}/batch-{number:012d}")
        if len(self._pending(self._state()[1]["upto"])) > MOST_BATCHES:
            self.compact()

    def read(self) -> DataFrame:
        """All rows, each with the number of its ``batch``."""
        entry = self._state()[1]
        paths = [*entry["paths"], *[f"{self.out}/{n}" for n in self._pending(entry["upto"])]]
        return self.spark.read.parquet(*paths)

    def compact(self) -> None:
        """One folder for all batches so far; the rows stay as they are."""
        number, entry = self._state()
        pending = self._pending(entry["upto"])
        if not pending:
            return
        path = f"{self.out}/merged-{uuid.uuid4().hex}"
        self.read().hint("rebalance").write.parquet(path)
        upto = int(pending[-1].removeprefix("batch-"))
        commit(self.spark, self.out, {"paths": [path], "upto": upto}, number)
        remove_old(self.spark, self.out)
        # Readers that looked before the former compaction may still use its batches, not older ones.
        for name in names_in(self.spark, self.out):
            if name.startswith("batch-") and int(name.removeprefix("batch-")) <= entry["upto"]:
                remove(self.spark, f"{self.out}/{name}")


def aggregate_new_files(
    stream: DataFrame, reduce: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> DataFrame:
    """Reduce only unseen files; keep one additive partial per batch. Returns all partials."""
    batches = Batches(stream.sparkSession, out)
    _drain(stream, lambda batch, number: batches.write(reduce(batch), number), checkpoint, "append")
    return batches.read()


def aggregate_new_text(
    spark: SparkSession, folder: str, pattern: str, reduce: Callable[[DataFrame], DataFrame], out: str,
    checkpoint: str,
) -> DataFrame:
    """``aggregate_new_files`` over microdata text: each file is read by its own header inside its batch."""
    batches = Batches(spark, out)

    def write(files: DataFrame, number: int) -> None:
        # As many rows as the batch has files.
        names = sorted(r["file"] for r in files.collect())
        batches.write(reduce(read_movements(spark, names)), number)

    _drain(raw_files(spark, folder, pattern), write, checkpoint, "append")
    return batches.read()


def stream_raw_jobs(
    spark: SparkSession, folder: str, pattern: str, state: str, checkpoint: str
) -> DataFrame:
    """Signed sums of microdata text by event month, late and retracted records included.

    The stream finds the new files and the ledger in ``state`` reads them, so a batch that is repeated
    adds nothing, and a file that is sent again replaces its former content.
    """
    ledger = jobs_ledger(spark, state)

    def add(files: DataFrame, number: int) -> None:
        names = sorted(r["file"] for r in files.collect())
        if names:
            ledger.add(names, lambda new: movement_cells(spark, new))

    _drain(raw_files(spark, folder, pattern), add, checkpoint, "append")
    return ledger_jobs(ledger)


def add_up(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge additive partials."""
    sums = [c for c in partials.columns if c not in (*keys, "batch")]
    return partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def newest_release(df: DataFrame, keys: Sequence[str], release: str) -> DataFrame:
    """The row of the highest release per key; value columns break ties."""
    rest = [c for c in df.columns if c not in (*keys, release)]
    row = F.max(F.struct(release, *rest)).alias("r")
    return df.groupBy(*keys).agg(row).select(*keys, "r.*").select(*df.columns)


def stream_signed_totals(
    movements: DataFrame, keys: Sequence[str], out: str, checkpoint: str
) -> DataFrame:
    """Running totals of on-time + late - retracted records by event month.

    State is one row per key. There is no watermark: a late record must correct its month
    whenever it arrives. Each batch writes the keys it changed; the newest row per key is final.
    """
    totals = signed_jobs(movements, keys)
    batches = Batches(movements.sparkSession, out)
    _drain(totals, batches.write, checkpoint, "update")
    return newest_release(batches.read(), list(keys), "batch").drop("batch")


def monthly_counts(df: DataFrame, time: str, label: str) -> DataFrame:
    """Calendar months are no fixed window, so the month is a grouping column."""
    return df.groupBy(month_of(F.col(time)).alias("period"), F.col(label).alias("class")).agg(
        F.count(F.lit(1)).alias("cases")
    )


def stream_daily_counts(
    stream: DataFrame, time: str, label: str, out: str, checkpoint: str
) -> DataFrame:
    """Calendar days per class of every file seen so far; roll them up with ``months_of_days``.

    Counts add up, so each batch writes its own and no state or watermark is needed: an event counts
    whenever it arrives. The day is the event time, cut in the session's time zone, so it is the same day
    that a batch job sees.
    """
    day = F.to_date(F.col(time).cast("timestamp")).alias("day")

    def count(batch: DataFrame) -> DataFrame:
        return batch.groupBy(day, F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("cases"))

    return add_up(aggregate_new_files(stream, count, out, checkpoint), ["day", "class"])


def months_of_days(days: DataFrame) -> DataFrame:
    period: Column = month_of(F.col("day")).alias("period")
    return days.groupBy(period, "class").agg(F.sum("cases").alias("cases"))
