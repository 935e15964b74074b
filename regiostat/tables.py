"""A lazy name -> DataFrame catalogue shared by base tables and views."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[["TableSet"], DataFrame]


class TableSet:
    """Base tables and the views built on them, each planned on first use.

    A builder receives the set itself, so a view asks for its inputs by name and never knows
    whether they are lazy plans, raw files or tables written by ``regiostat.sources.sinks``.
    """

    def __init__(
        self, spark: SparkSession, builders: Mapping[str, Builder], work: str | None = None
    ):
        """``work`` is a folder that every executor reaches, for tables read several times; without
        it nothing is staged and planning a view starts no job."""
        self.spark = spark
        self.work = work
        self._builders = dict(builders)
        self._planned: dict[str, DataFrame] = {}
        self._stored: set[str] = set()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._planned:
            self._planned[name] = self._builders[name](self)
        return self._planned[name]

    def __contains__(self, name: str) -> bool:
        return name in self._builders

    def names(self) -> list[str]:
        return list(self._builders)

    def extended(self, builders: Mapping[str, Builder]) -> TableSet:
        return TableSet(self.spark, {**self._builders, **builders}, self.work)

    def repoint(self, name: str, df: DataFrame) -> None:
        """Make ``name`` stand for ``df``; views planned before are planned again on next use."""
        self._builders[name] = lambda _: df
        self._planned.clear()
        self._stored.add(name)

    def stage(self, *names: str) -> None:
        """Write tables that a query reads several times to the work folder, once.

        Without a work folder this does nothing: the views are one lazy plan.
        A name that already stands for a written table is left alone. The tables of one call are
        written side by side, so they must not build on each other. A written table cuts the
        lineage: a lost executor re-reads it instead of repeating the scan and join behind it.
        """
        if self.work is None:
            return
        todo = {
            name: (self[name], f"{self.work}/{name}-{uuid.uuid4().hex}")
            for name in dict.fromkeys(names)
            if name not in self._stored
        }
        if not todo:
            return
        with ThreadPoolExecutor(max_workers=len(todo)) as jobs:
            list(jobs.map(lambda job: job[0].write.parquet(job[1]), todo.values()))
        for name, (df, path) in todo.items():
            self.repoint(name, self.spark.read.schema(df.schema).parquet(path))

    def register(self, names: Iterable[str] | None = None) -> None:
        """Expose tables to ``spark.sql`` as temporary views."""
        for name in names or self.names():
            self[name].createOrReplaceTempView(name)
