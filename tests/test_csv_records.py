"""Records of CSV files, counted in pieces, against a CSV parser that reads each file at once."""

import csv
import random

import pytest

from orderloom.sources.csv_files import delivered_rows, records_by_file


@pytest.fixture
def pieces(spark):
    """Files are cut into pieces of a few lines."""
    key, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key), spark.conf.get(cost)
    spark.conf.set(key, "61")
    spark.conf.set(cost, "0")
    yield
    spark.conf.set(key, before[0])
    spark.conf.set(cost, before[1])


def test_records_of_many_pieces(spark, tmp_path, pieces):
    rng = random.Random(4)
    words = ["a", "b,c", 'say "x"', "two\nlines", '"\n"', "\n\n", "", "plain text", "é\r\nü"]
    want = {}
    for k in range(6):
        path = tmp_path / f"{k}.csv"
        rows = [["id", "text"]] + [[i, "".join(rng.choices(words, k=rng.randint(0, 4)))] for i in range(rng.randint(0, 60))]
        with open(path, "w", newline="") as file:
            csv.writer(file, lineterminator="\n").writerows(rows)
        with open(path, newline="") as file:
            want[path.name] = sum(1 for _ in csv.reader(file))
        assert want[path.name] == len(rows)
    (tmp_path / "empty.csv").write_text("")
    found = records_by_file(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert {r.file.split("/")[-1]: r.records for r in found.collect()} == want
    assert delivered_rows(spark, str(tmp_path)) == sum(n - 1 for n in want.values())


def test_a_record_that_is_never_closed(spark, tmp_path, pieces):
    (tmp_path / "a.csv").write_text('id,t\n1,x\n2,"open\nstill\nto the end\n')
    assert records_by_file(spark, str(tmp_path)).first()["records"] == 3
    (tmp_path / "a.csv").write_text("id,t\n\n1,x\n")
    assert delivered_rows(spark, str(tmp_path)) == 2
