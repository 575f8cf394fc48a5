"""CSV feeds that may hold rows which do not fit: good and rejected rows of one pass, with a limit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schemas import LOADED_AT
from orderloom.sources.csv_files import CSV_OPTIONS, stamped

RECORD, FILE, REJECTED = "_record", "_file", "rejected"


class TooManyRejects(RuntimeError):
    """More rows than allowed do not fit their schema."""


@dataclass(frozen=True)
class Landed:
    """A feed that was loaded: its table, what was left out and why, and how many rows of each there are."""

    good: DataFrame
    rejects: DataFrame
    good_rows: int
    rejected_rows: int


def read_permissive(spark: SparkSession, path: str, schema: T.StructType, check_header: bool = True) -> DataFrame:
    """A CSV feed with every row: ``_record`` is the text of a row that does not fit, else NULL; ``_file`` its file."""
    whole = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    options = CSV_OPTIONS | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    rows = spark.read.schema(whole).options(**options).option("enforceSchema", not check_header).csv(path)
    return rows.withColumn(FILE, F.col("_metadata.file_path"))


def reasons(rejects: DataFrame, schema: T.StructType) -> DataFrame:
    """``file, record, reason``: why each rejected record does not fit, the first column at fault."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(RECORD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD, "nullValue": "\u0000", "escape": '"'}
    parsed = rejects.withColumn("_fields", F.from_csv(RECORD, texts.toDDL(), options))
    faults = []
    for field in schema.fields:
        value = F.col("_fields").getField(field.name)
        if not isinstance(field.dataType, T.StringType):
            wrong = value.isNotNull() & value.try_cast(field.dataType).isNull()
            faults.append(F.when(wrong, F.lit(f"{field.name} is no {field.dataType.simpleString()}")))
    length = F.when(F.col("_fields").getField(RECORD).isNotNull(), F.lit(f"not {len(schema.fields)} fields"))
    reason = F.coalesce(length, *faults, F.lit("does not fit"))
    return parsed.select(F.col(FILE).alias("file"), F.col(RECORD).alias("record"), reason.alias("reason"))


def load_with_rejects(feed: DataFrame, schema: T.StructType, path: str, most: int) -> Landed:
    """Write a feed of :func:`read_permissive` in one pass, good and rejected rows to folders of their own.

    More than ``most`` rejected rows raise :class:`TooManyRejects`; what was written then stays for a look at it,
    and nothing else has seen it. Good rows get the load time, as in any load.
    """
    spark = feed.sparkSession
    marked = stamped(feed).withColumn(REJECTED, F.col(RECORD).isNotNull())
    marked.write.mode("overwrite").partitionBy(REJECTED).parquet(path)
    stored = T.StructType([f for f in marked.schema.fields if f.name != REJECTED])
    landed = spark.read.schema(T.StructType([*stored.fields, T.StructField(REJECTED, T.BooleanType())])).parquet(path)
    counts = {row[REJECTED]: row["count"] for row in landed.groupBy(REJECTED).count().collect()}
    good, bad = counts.get(False, 0), counts.get(True, 0)
    if bad > most:
        raise TooManyRejects(f"{bad} of {good + bad} rows do not fit, {most} are allowed; see {path}")
    fitting = landed.filter(~F.col(REJECTED)).select(*schema.names, LOADED_AT)
    return Landed(fitting, reasons(landed.filter(REJECTED).select(FILE, RECORD), schema), good, bad)
