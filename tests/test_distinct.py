"""Distinct counts from bitmaps against counts of the values themselves."""

import random

from pyspark.sql import functions as F

from orderloom.operators.distinct import distinct_bitmaps, rolled_up
from orderloom.session import shared_dir


def test_any_roll_up_is_exact(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "hot", *map(str, range(300))]), rng.randint(1, 24), rng.choice(["N", "S", None])) for _ in range(5000)]
    rows += [("hot", m, "N") for m in range(1, 25)] * 50
    df = spark.createDataFrame(rows, "id string, month int, region string")
    bitmaps = distinct_bitmaps(df, "id", ["month", "region"], shared_dir(spark, "bitmaps"))
    year = F.ceil(F.col("month") / 12).alias("year")
    for by, source in ((["month", "region"], bitmaps), (["year"], bitmaps.withColumn("year", year)), (["region"], bitmaps)):
        want = df.withColumn("year", year).groupBy(*by).agg(F.count_distinct("id").alias("ids"))
        assert sorted(map(str, rolled_up(source, by, "ids").collect())) == sorted(map(str, want.collect()))
    assert rolled_up(bitmaps, [], "ids").first()["ids"] == len({r[0] for r in rows if r[0]})


def test_more_values_than_one_bitmap(spark):
    df = spark.range(100_000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3).alias("g"))
    bitmaps = distinct_bitmaps(df.unionAll(df.filter("g = 1").withColumn("g", F.lit(2).cast("long"))), "id", ["g"], shared_dir(spark, "b"))
    assert sorted(map(tuple, rolled_up(bitmaps, ["g"], "n").collect())) == [(0, 33_334), (1, 33_333), (2, 66_666)]
    assert rolled_up(bitmaps, [], "n").first()[0] == 100_000


def test_nothing_to_count(spark):
    df = spark.createDataFrame([(None, 1)], "id string, g int")
    bitmaps = distinct_bitmaps(df, "id", ["g"], shared_dir(spark, "b"))
    assert rolled_up(bitmaps, ["g"], "n").collect() == []
    assert rolled_up(bitmaps, [], "n").first()[0] == 0
