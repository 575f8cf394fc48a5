"""Event-driven load: pick up what has arrived since the last run, then stop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from orderloom.operators.dedup import dedup_earliest
from orderloom.operators.lookup import BROADCAST_LIMIT
from orderloom.sources.csv_files import CSV_OPTIONS, stamped
from orderloom.sources.folders import children
from orderloom.sources.tables import spread

# The folder level of a landed table, and into how many a new one is dealt.
BUCKET = "bucket"
BUCKETS = 16

# Of a key in memory, besides its text.
_KEY_BYTES = 64


def stream_csv(
    spark: SparkSession, folder: str, schema: T.StructType, max_files: int | None = None, check_header: bool = True
) -> DataFrame:
    """A folder of CSV files as a stream, read as the batch loader reads them.

    ``max_files`` bounds a micro-batch, so that a long backlog is loaded in many
    steps and a failure repeats one of them. Renamed or moved columns fail.
    """
    reader = spark.readStream.schema(schema).options(**CSV_OPTIONS).option("enforceSchema", not check_header)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(folder)


def load_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived to the table at ``path``, once, and stop.

    The checkpoint remembers which files were loaded; with it a repeated or
    restarted run adds nothing twice. Both paths belong in a shared folder.
    """
    return (
        stamped(stream)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def bucket_of(key: str, buckets: int) -> Column:
    """The folder a key lands in. It depends on the key alone, so every feed looks for it in the same place."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def land_new_keys(
    batch: DataFrame,
    path: str,
    key: str,
    arrival: str,
    buckets: int = BUCKETS,
    limit_bytes: int = BROADCAST_LIMIT,
) -> None:
    """Append to the landed table at ``path`` the earliest row of every key it does not hold yet.

    The table is dealt to folders by the hash of its key. Only the folders of the batch's keys are read, and of
    them the key column alone. While the batch's keys are few by measure, they are sent to the landed files; the landed table
    itself is then not shuffled, and what is found there is no larger than the batch.

    Nothing that has landed is rewritten or removed. A batch that is repeated, wholly or in part, finds its rows
    landed and adds the others. Batches of one table must come one after another.
    """
    spark = batch.sparkSession
    first = dedup_earliest(batch, [key], arrival).withColumn(BUCKET, bucket_of(key, buckets))
    # Kept for the visits below; an executor that is lost computes its part again.
    first = first.persist()
    try:
        size = F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) + F.lit(_KEY_BYTES)
        met = first.agg(F.collect_set(BUCKET).alias("buckets"), F.sum(size).alias("bytes")).first()
        landed = T.StructType([*stamped(batch).schema.fields, T.StructField(BUCKET, T.IntegerType())])
        new = first
        if met["buckets"] and children(spark, path):
            seen = spark.read.schema(landed).parquet(path).filter(F.col(BUCKET).isin(met["buckets"]))
            # What has landed of the batch's keys is no larger than these, so both go the same way.
            send = F.broadcast if met["bytes"] <= limit_bytes else lambda df: df
            wanted = send(first.select(F.col(BUCKET).alias("_bucket"), F.col(key).alias("_key")))

            def same() -> Column:
                return (F.col(BUCKET) == F.col("_bucket")) & F.col(key).eqNullSafe(F.col("_key"))

            known = seen.select(BUCKET, key).join(wanted, same(), "left_semi")
            known = send(known.select(F.col(BUCKET).alias("_bucket"), F.col(key).alias("_key")))
            new = first.join(known, same(), "left_anti")
        rows = stamped(new.drop(BUCKET)).withColumn(BUCKET, bucket_of(key, buckets))
        spread(rows, BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)
    finally:
        first.unpersist()


def load_without_retries(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "order_id",
    arrival: str = "load_timestamp",
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Like :func:`load_available`, with each key landed once, however late its repeats are.

    A micro-batch keeps the earliest row of every key, combined before the
    shuffle, and of these the keys that have not landed (:func:`land_new_keys`). There is no
    watermark, so no row is dropped for being late, and no state to outgrow
    memory: what was seen is the landed table itself. It may be fed by several streams, each with a checkpoint
    of its own, one at a time, and a lost or replaced checkpoint loads the same files again without landing a row twice.
    Of repeats in different batches the one loaded first stays. ``buckets`` must not change while a table lives.
    """

    def land(batch: DataFrame, number: int) -> None:
        land_new_keys(batch, path, key, arrival, buckets)

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def finish(query: StreamingQuery) -> None:
    """Wait for a load to end, and fail if it failed."""
    query.awaitTermination()
