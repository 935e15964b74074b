"""Numbered versions of a table: one small file for each commit, written once and never replaced.

A commit creates the file with the next number and fails if it is there already, so of two writers one wins and
the other one learns of it; no clock is asked. Readers take the highest number whose file is
complete. The file system must create files exclusively, as HDFS and object stores with conditional writes do.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

VERSIONS = "_versions"
#: Former versions that stay for readers that have already looked them up.
KEPT = 3


class VersionConflict(RuntimeError):
    """Another writer has committed in between."""


def _at(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, as Spark itself reads and writes."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(context._jsc.hadoopConfiguration()), where


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none where there is no folder."""
    fs, path = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Gives a file another name, in a folder that is made if need be."""
    fs, path = _at(spark, old)
    target = _at(spark, new)[1]
    fs.mkdirs(target.getParent())
    if not fs.rename(path, target):
        raise OSError(f"{old} cannot be renamed to {new}")


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder that this library has written and no version names any more."""
    fs, where = _at(spark, path)
    fs.delete(where, True)


def _entry(spark: SparkSession, folder: str, number: int) -> dict | None:
    """What a commit says, None while it is being written."""
    fs, path = _at(spark, f"{folder}/{VERSIONS}/{number:012d}.json")
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        return json.loads(text)
    except ValueError:
        return None
    finally:
        stream.close()


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    names = names_in(spark, f"{folder}/{VERSIONS}")
    return [int(m[1]) for m in (re.fullmatch(r"(\d+)\.json", n) for n in names) if m]


def latest(spark: SparkSession, folder: str) -> tuple[int, dict | None]:
    """(highest number, what the newest complete commit says); (0, None) without one."""
    numbers = _numbers(spark, folder)
    for number in reversed(numbers):
        entry = _entry(spark, folder, number)
        if entry is not None:
            return numbers[-1], entry
    return (numbers[-1] if numbers else 0), None


def commit(spark: SparkSession, folder: str, entry: Mapping, after: int) -> int:
    """Makes ``entry`` the version that follows number ``after``; fails if there is one already."""
    number = after + 1
    fs, path = _at(spark, f"{folder}/{VERSIONS}/{number:012d}.json")
    try:
        out = fs.create(path, False)
    except Py4JJavaError as e:
        if "AlreadyExists" not in str(e.java_exception):
            raise
        raise VersionConflict(f"version {number} of {folder} is taken") from None
    out.write(bytearray(json.dumps(dict(entry)).encode()))
    out.close()
    return number


def remove_old(spark: SparkSession, folder: str, keep: int = KEPT) -> list[str]:
    """Removes the data of all but the last ``keep`` versions; returns the paths removed.

    What a kept version names stays, and folders that no version names are left alone: they may be a
    write under way.
    """
    entries = [(n, e) for n in _numbers(spark, folder) if (e := _entry(spark, folder, n))]
    kept = {path for _, e in entries[-keep:] for path in e.get("paths", [])}
    gone = []
    for number, entry in entries[:-keep]:
        for path in entry.get("paths", []):
            if path not in kept and path not in gone:
                remove(spark, path)
                gone.append(path)
        remove(spark, f"{folder}/{VERSIONS}/{number:012d}.json")
    return gone
