"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(
    cores: str = "8",
    shuffle_partitions: int = 8,
    work: str | None = None,
    more: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    shared = work or tempfile.mkdtemp(prefix="regiostat-")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("regiostat")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", shared)
        .config(map=dict(more or {}))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one the cluster names in ``spark.checkpoint.dir``.

    Where that setting is missing, only a local master may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="regiostat-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application.

    Workers import the functions they run; without this they find the package only where it is
    installed or lies in their working folder. A package loaded from an archive came by
    ``--py-files`` and is there already.
    """
    context = spark.sparkContext
    package = Path(__file__).resolve().parent
    if context.applicationId in _shipped or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="regiostat-package-")) / "regiostat.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
