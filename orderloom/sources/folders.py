"""Folders on any storage Spark can write to, listed and removed from the driver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    """A child of a folder."""

    path: str
    name: str
    is_folder: bool
    modified: datetime


def _storage(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def children(spark: SparkSession, path: str) -> list[Entry]:
    """What lies directly in a folder, by name; nothing where there is no such folder."""
    storage, at = _storage(spark, path)
    if not storage.exists(at):
        return []
    found = []
    for status in storage.listStatus(at):
        when = datetime.fromtimestamp(status.getModificationTime() / 1000, timezone.utc)
        name = status.getPath().getName()
        found.append(Entry(f"{path.rstrip('/')}/{name}", name, status.isDirectory(), when))
    return sorted(found, key=lambda entry: entry.name)


def partitions_of(spark: SparkSession, path: str, column: str) -> list[str]:
    """The partition folders of a written table, as ``column=value``."""
    return [e.name for e in children(spark, path) if e.is_folder and e.name.startswith(f"{column}=")]


def remove(spark: SparkSession, paths: Sequence[str]) -> None:
    for path in paths:
        storage, at = _storage(spark, path)
        storage.delete(at, True)


def is_older(entry: Entry, age: timedelta) -> bool:
    return datetime.now(timezone.utc) - entry.modified >= age
