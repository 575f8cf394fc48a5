"""Session defaults, and the shared folder a cluster names for written tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import SparkSession

from orderloom.sources import folders

# Settings the plans rely on. All but the time zone and the last two are Spark 4
# defaults, stated here because correctness at scale depends on them: skewed
# join partitions are split at run time, and small ones are merged.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins whose build side turns out small in every partition skip the sort of
    # the large side. Decided from measured shuffle sizes, never from estimates.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "orderloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{key.replace("__", "."): value for key, value in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_PARTITIONS = "spark.sql.shuffle.partitions"

# A raw order as a shuffled row, and how much of a shuffle one task should sort.
ROW_BYTES = 128
PARTITION_BYTES = 256 * 1024 * 1024

# Beyond this many partitions the driver's map of shuffle blocks is the bottleneck;
# partitions then grow, and their sorts spill.
MOST_PARTITIONS = 100_000


@contextmanager
def sized_shuffles(spark: SparkSession, rows: int, row_bytes: int = ROW_BYTES) -> Iterator[int]:
    """Enough shuffle partitions for ``rows`` while the block runs.

    Adaptive execution merges small partitions but cannot add any, so the number
    to start from must fit the data. It is only ever raised here.
    """
    before = int(spark.conf.get(_PARTITIONS))
    needed = min(-(-rows * row_bytes // PARTITION_BYTES), MOST_PARTITIONS)
    spark.conf.set(_PARTITIONS, str(max(before, needed)))
    try:
        yield max(before, needed)
    finally:
        spark.conf.set(_PARTITIONS, str(before))


# Bytes of whole texts that go to a Python worker at once, and the setting that says so.
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of ``BATCH_BYTES`` while the block runs; workers and executors hold each several times over."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


# Bytes of input for one file of what is written on the way, and files at least.
FILE_BYTES, LEAST_FILES = 8 << 20, 12


def files_for(size: int) -> int:
    """How many files to write, at most, from ``size`` bytes of input; for ``coalesce``, which keeps fewer as they are.

    Without Hadoop's native library an executor calls ``chmod`` for each file on a local disk, and that process counts
    with all the executor's memory until it has started.
    """
    return max(LEAST_FILES, -(-size // FILE_BYTES))


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder path every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder; on a cluster a missing setting is an error,
    because a machine-local folder would be lost with its machine.
    """
    return f"{_shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="orderloom-")
    return root.rstrip("/")


def remove_shared_dirs(spark: SparkSession, older_than: timedelta) -> list[str]:
    """Remove folders that :func:`shared_dir` named and nothing has changed for ``older_than``; returns them.

    A result that is still to be read may lie in one, so choose a time no job takes.
    """
    ours = re.compile(r".+-[0-9a-f]{32}")
    entries = folders.children(spark, _shared_root(spark))
    found = [e.path for e in entries if e.is_folder and ours.fullmatch(e.name) and folders.is_older(e, older_than)]
    folders.remove(spark, found)
    return found
