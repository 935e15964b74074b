"""The whole load: raw files to base tables, views, datasets, sheets and a table of rejects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from regiostat.plans.datasets import DATASETS
from regiostat.plans.reports import WORKBOOKS
from regiostat.sources.load import load_rejects, raw_tables, with_fallback
from regiostat.sources.sinks import (
    materialise,
    write_base_tables,
    write_datasets,
    write_sheets,
    write_version,
)
from regiostat.tables import TableSet


def run_load(
    spark: SparkSession,
    raw: str,
    seeds: str,
    lake: str,
    layout: Mapping[str, str] | None = None,
    seed_files: Mapping[str, str] | None = None,
    fallback: str | None = None,
    quarters: Sequence[int] = (),
    datasets: Sequence[str] | None = None,
    workbooks: Sequence[str] | None = None,
) -> TableSet:
    """Loads what is new in ``raw`` and writes everything that follows from it below ``lake``.

    ``state`` (ledgers), ``base``, ``views``, ``datasets``, ``sheets`` and ``rejects`` are the folders. ``fallback`` and
    ``quarters`` fill quarters the main source lacks; ``datasets`` and ``workbooks`` choose some by name, all if not
    given. A run that is cut off can be repeated: tables change by versions, archives and microdata are read once.
    """
    state = f"{lake}/state"
    t = raw_tables(spark, raw, seeds, layout, seed_files, state=state)
    if fallback:
        t = with_fallback(t, fallback, quarters)
    write_base_tables(t, f"{lake}/base")
    materialise(t, f"{lake}/views")
    write_datasets(t, {n: DATASETS[n] for n in (DATASETS if datasets is None else datasets)}, f"{lake}/datasets")
    for book in WORKBOOKS if workbooks is None else workbooks:
        write_sheets(t, WORKBOOKS[book], f"{lake}/sheets/{book}")
    write_version(load_rejects(spark, raw, seeds, layout, seed_files, state), lake, "rejects")
    return t
