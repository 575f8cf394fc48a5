"""Written tables: loads that are counted, and runs that are published at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderloom.sources import folders


@dataclass(frozen=True)
class Load:
    """Rows handed to the writer and rows found in the table afterwards."""

    table: str
    path: str
    expected: int
    actual: int

    @property
    def status(self) -> str:
        return "OK" if self.expected == self.actual else "MISMATCH"


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path``. Writing the same rows twice leaves them once."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def written(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` and read it back: what follows starts from the files, not from ``df``."""
    write_table(df, path, partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_table(df: DataFrame, table: str, path: str, delivered: int | None = None) -> Load:
    """Write ``df`` and count it on the way, so the input is read once.

    ``delivered`` is the number of rows the source says it holds; without it
    the rows handed to the writer are expected. Their count is taken in the writing stage itself, whose tasks count once even
    when they are repeated after a lost executor.
    """
    counter = Observation(f"rows of {table}")
    write_table(df.observe(counter, F.count(F.lit(1)).alias("rows")), path)
    actual = df.sparkSession.read.schema(df.schema).parquet(path).count()
    expected = counter.get["rows"] if delivered is None else delivered
    return Load(table, path, expected, actual)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Gather rows of the same ``columns`` values for a partitioned write.

    Partitions are sized at run time: a value that holds a third of all rows is
    split into many files, small ones share a task.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


_LOG = "_published"
_LOG_SCHEMA = (
    "version long, run_id string, published_at timestamp_ntz, table_name string, path string, partitions array<string>"
)


@dataclass(frozen=True)
class Part:
    """A written folder that belongs to a table: all of it, or the named partition folders in it."""

    path: str
    partitions: tuple[str, ...] | None = None


def _log(spark: SparkSession, root: str) -> DataFrame:
    """Every part of every published run; a compacted log may hold a row twice for a moment."""
    if not folders.children(spark, f"{root}/{_LOG}"):
        return spark.createDataFrame([], _LOG_SCHEMA)
    return spark.read.schema(_LOG_SCHEMA).parquet(f"{root}/{_LOG}").distinct()


def publish(spark: SparkSession, root: str, run_id: str, tables: Mapping[str, str | Sequence[Part]]) -> int:
    """Make the tables of a run, given as paths or parts, the current ones, all at once; returns the new version.

    Appends one file to the log of runs. Readers see the run before or after
    that file appears, never a mix; the tables themselves are not copied, and a
    table may go on using parts that earlier runs have written. Runs of one ``root`` publish one after another.
    """
    newest = max((row["version"] for row in published_runs(spark, root).collect()), default=None)
    version = 1 if newest is None else newest + 1
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [
        (version, run_id, now, name, part.path, None if part.partitions is None else list(part.partitions))
        for name, parts in tables.items()
        for part in ([Part(parts)] if isinstance(parts, str) else parts)
    ]
    spark.createDataFrame(rows, _LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/{_LOG}")
    return version


def published_runs(spark: SparkSession, root: str) -> DataFrame:
    """``version, run_id, published_at``: the runs that can still be read, the newest version being the current one."""
    return _log(spark, root).select("version", "run_id", "published_at").distinct()


def published_tables(spark: SparkSession, root: str) -> set[str]:
    return {row[0] for row in _log(spark, root).select("table_name").distinct().collect()}


def published_parts(spark: SparkSession, root: str, table: str, run_id: str | None = None) -> list[Part]:
    """What a published table consists of, now or as the last publication of ``run_id`` left it."""
    log = _log(spark, root).filter(F.col("table_name") == table)
    if run_id is not None:
        log = log.filter(F.col("run_id") == run_id)
    newest = log.agg(F.max("version")).first()[0]
    if newest is None:
        raise LookupError(f"no published table {table!r} under {root}" + ("" if run_id is None else f" of run {run_id!r}"))
    rows = log.filter(F.col("version") == newest).orderBy("path").collect()
    return [Part(r["path"], None if r["partitions"] is None else tuple(r["partitions"])) for r in rows]


def read_parts(spark: SparkSession, parts: Sequence[Part]) -> DataFrame:
    """The rows of all parts. Filters on the partition column reach the folders of each."""
    found = []
    for part in parts:
        if part.partitions is None:
            found.append(spark.read.parquet(part.path))
        elif part.partitions:
            folders = [f"{part.path}/{p}" for p in part.partitions]
            found.append(spark.read.option("basePath", part.path).parquet(*folders))
    if not found:
        # Without a live partition the files still tell the columns.
        return spark.read.parquet(parts[0].path).limit(0)
    return reduce(DataFrame.unionByName, found)


def read_published(spark: SparkSession, root: str, table: str, run_id: str | None = None) -> DataFrame:
    """The current version of a published table, or that of an earlier run."""
    return read_parts(spark, published_parts(spark, root, table, run_id))


def compact_log(spark: SparkSession, root: str, keep_versions: int) -> int:
    """Keep the last ``keep_versions`` publications in one file of the log; returns how many were dropped.

    The new file appears before the old ones go. Readers in between see rows twice, which they
    count once; after a failure in between the next call removes what is left.
    """
    if keep_versions < 1:
        raise ValueError("the current version has to stay")
    before = folders.children(spark, f"{root}/{_LOG}")
    log = _log(spark, root)
    versions = sorted(r[0] for r in log.select("version").distinct().collect())
    kept = log.filter(F.col("version").isin(versions[-keep_versions:])).collect()
    spark.createDataFrame(kept, _LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/{_LOG}")
    folders.remove(spark, [e.path for e in before if not e.name.startswith(("_", "."))])
    return max(0, len(versions) - keep_versions)


def unreferenced(spark: SparkSession, root: str, older_than: timedelta) -> list[str]:
    """Folders below ``root`` that no publication in the log uses, unchanged for ``older_than``.

    These are attempts (``root/run/attempt``) of which nothing is in use, failed ones too, and in the others
    partition folders that later runs have replaced everywhere. An attempt that is still running is
    spared as long as ``older_than`` is longer than a run.
    """
    used: dict[str, set[str] | None] = {}
    for row in _log(spark, root).select("path", "partitions").distinct().collect():
        have = used.get(row["path"], set())
        used[row["path"]] = None if have is None or row["partitions"] is None else have | set(row["partitions"])
    found = []
    for run in folders.children(spark, root):
        if not run.is_folder or run.name.startswith(("_", ".")):
            continue
        for attempt in folders.children(spark, run.path):
            # Names of attempts are unique, so it does not matter how a path spells its root.
            live = [path for path in used if f"/{run.name}/{attempt.name}/" in path]
            if not live and folders.is_older(attempt, older_than):
                found.append(attempt.path)
            for path in live:
                if used[path] is not None:
                    dead = [e for e in folders.children(spark, path) if "=" in e.name and e.name not in used[path]]
                    found += [e.path for e in dead if folders.is_older(e, older_than)]
    return found


def remove_unreferenced(spark: SparkSession, root: str, older_than: timedelta) -> list[str]:
    """Remove what :func:`unreferenced` finds, and return it."""
    found = unreferenced(spark, root, older_than)
    folders.remove(spark, found)
    return found
