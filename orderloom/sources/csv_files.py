"""CSV feeds into typed raw tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schemas import LOADED_AT

# How a bulk load reads CSV: an unquoted empty field is NULL, a quoted one is the
# empty string, and a quote inside quotes is written twice. Spark tells the two
# empty fields apart once its NULL token is one that text cannot contain.
CSV_OPTIONS = {"header": True, "mode": "FAILFAST", "nullValue": "\u0000", "escape": '"'}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multiline: bool = False,
    check_header: bool = True,
) -> DataFrame:
    """A CSV feed with a header line, in the declared types.

    A row that does not fit the schema fails the job that reads the offending
    column, so a load, which reads all of them, is all or nothing. A missing
    path fails at once. ``multiline`` accepts quoted line breaks, but a file can then not be
    split among tasks; leave it off for feeds without them. Renamed or moved
    columns fail too; without ``check_header`` they are taken by position.
    """
    reader = spark.read.schema(schema).options(**CSV_OPTIONS)
    return reader.options(multiLine=multiline, enforceSchema=not check_header).csv(path)


def read_header(spark: SparkSession, path: str) -> T.StructType:
    """The header's columns, all as text, for a drift report on the delivered names."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).schema


def delivered_rows(spark: SparkSession, path: str) -> int:
    """Records that a CSV feed delivers: those of its files, less a header each.

    Counted in the text itself, so that rows which the CSV reader leaves out show up in a reconciliation.
    A line break between quotes ends no record; quotes stand around whole fields, and twice inside one.
    """
    return records_by_file(spark, path).agg(F.coalesce(F.sum(F.col("records") - 1), F.lit(0))).first()[0]


def records_by_file(spark: SparkSession, path: str) -> DataFrame:
    """``file, lines, records``: how many lines and records each file has, header included.

    Files are read in pieces, by many tasks. A line with an odd number of quotes opens a record of several lines or
    closes it, in turns. The lines inside such records are then a sum over these lines of their number in the file,
    with a minus where they open. Each piece takes the sum as if it began outside of a record; how many
    such lines stand before it says whether the sign turns. So only these lines are shuffled, by piece, and
    a row for each piece. A record that is never closed ends with its file.
    """
    text = spark.read.text(path)
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("piece"),
        F.monotonically_increasing_id().alias("at"),
        (quotes % 2 == 1).alias("turns"),
    )
    keys = ["file", "piece"]
    pieces = lines.groupBy(*keys).agg(F.count("*").alias("lines"), F.min("at").alias("first"))
    order = Window.partitionBy(*keys).orderBy("at")
    turning = lines.filter("turns").withColumn("turn", F.row_number().over(order))
    sign = F.when(F.col("turn") % 2 == 1, -1).otherwise(1)
    sums = turning.groupBy(*keys).agg(
        F.count("*").alias("turns"), F.sum(sign * F.col("at")).alias("ids"), F.sum(sign).alias("signs")
    )
    none = F.lit(0).cast("long")
    found = pieces.join(sums, keys, "left").na.fill(0, ["turns", "ids", "signs"])
    # A file has a piece for each 128 MB or so.
    before = Window.partitionBy("file").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.withColumns(
        {f"{c}_before": F.coalesce(F.sum(c).over(before), none) for c in ("lines", "turns")}
    )
    # The number of a line in its file: the lines before its piece, and its place in the piece.
    inside = F.col("ids") + F.col("signs") * (F.col("lines_before") - F.col("first") + 1)
    turned = F.when(F.col("turns_before") % 2 == 1, -inside).otherwise(inside)
    per_file = placed.groupBy("file").agg(
        F.sum("lines").alias("lines"), F.sum("turns").alias("turns"), F.sum(turned).alias("inside")
    )
    open_end = F.when(F.col("turns") % 2 == 1, F.col("lines")).otherwise(0)
    return per_file.select("file", "lines", (F.col("lines") - F.col("inside") - open_end).alias("records"))


class CsvFeeds(dict):
    """Feeds by table, read from CSV files whose lines can be counted apart from the reader."""

    def __init__(self, feeds: Mapping[str, DataFrame], paths: Mapping[str, str], most_rejects: int | None = None):
        super().__init__(feeds)
        self.paths, self.most_rejects = dict(paths), most_rejects

    def delivered(self, spark: SparkSession) -> dict[str, int]:
        """Rows that the files hold."""
        return {name: delivered_rows(spark, path) for name, path in self.paths.items()}


def stamped(df: DataFrame) -> DataFrame:
    """Add the load time; one value for all rows of a load."""
    return df.withColumn(LOADED_AT, F.localtimestamp())
