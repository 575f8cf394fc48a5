import pathlib
import random

import pytest

from orderloom.schemas import LOADED_AT, RAW_ORDERS
from orderloom.streaming import arrivals

HEADER = "order_id,customer_id,product_id,quantity,order_date,load_timestamp,source_system\n"


def line(order_id, load, quantity=1):
    return f"{order_id},c1,p1,{quantity},01/05/2024,{load},legacy_pos\n"


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()

    def deliver(name, *lines):
        (folder / name).write_text(HEADER + "".join(lines))

    deliver.path, deliver.target, deliver.marks = str(folder), str(tmp_path / "landed"), str(tmp_path / "marks")
    return deliver


def load(spark, feed, dedup, max_files=None, folder=None, marks=None):
    stream = arrivals.stream_csv(spark, folder or feed.path, RAW_ORDERS, max_files)
    start = arrivals.load_without_retries if dedup else arrivals.load_available
    arrivals.finish(start(stream, feed.target, marks or feed.marks))
    return spark.read.parquet(feed.target)


def test_only_new_files_are_loaded(spark, feed):
    feed("a.csv", line("1", "2024-01-05 10:00:00"), line("2", "2024-01-05 10:00:00"))
    assert load(spark, feed, dedup=False).count() == 2
    assert load(spark, feed, dedup=False).count() == 2
    feed("b.csv", line("3", "2024-01-05 10:00:00"))
    landed = load(spark, feed, dedup=False)
    assert landed.count() == 3 and landed.filter(f"{LOADED_AT} is null").count() == 0


def test_retries_are_dropped_within_and_across_batches(spark, feed):
    retries = [line("1", f"2024-01-05 10:00:{s:02d}") for s in range(40)] + [line("1", "2024-01-05 10:00:00")] * 40
    feed("a.csv", *retries, line("2", "2024-01-05 10:00:00"))
    feed("b.csv", line("2", "2024-01-05 10:00:09"))
    load(spark, feed, dedup=True)
    feed("c.csv", line("1", "2024-01-05 10:01:10"), line("3", "2024-01-05 10:01:00"))
    landed = load(spark, feed, dedup=True)
    assert sorted(r.order_id for r in landed.collect()) == ["1", "2", "3"]
    assert [f.name for f in landed.schema][:7] == RAW_ORDERS.names
    assert dict(landed.dtypes)["load_timestamp"] == "timestamp_ntz"
    assert landed.filter(f"{LOADED_AT} is null").count() == 0


def test_no_row_is_lost_to_the_order_of_arrival(spark, feed):
    """Files far out of order, one to a batch, and retries behind all of them."""
    days = ["2024-06-01", "2024-01-05", "2024-03-01", "2023-12-31", "2024-01-04"]
    for k, day in enumerate(days):
        feed(f"{k}.csv", *[line(f"{k}-{i}", f"{day} 00:00:0{i}") for i in range(5)], line("0-0", f"{day} 10:00:00"))
    landed = load(spark, feed, dedup=True, max_files=1)
    assert sorted(r.order_id for r in landed.collect()) == sorted(f"{k}-{i}" for k in range(5) for i in range(5))
    assert load(spark, feed, dedup=True, max_files=1).count() == 25


def ids(landed):
    return sorted(r.order_id for r in landed.collect())


def test_two_feeds_and_a_replaced_checkpoint_keep_every_order_once(spark, feed, tmp_path):
    """Ten orders of one feed, seven of another with a checkpoint of its own, two of them in both."""
    feed("a.csv", *[line(f"a{i}", "2024-01-05 10:00:00") for i in range(10)])
    other = tmp_path / "other"
    other.mkdir()
    lines = [line(f"b{i}", "2024-01-05 10:00:00") for i in range(5)] + [line(f"a{i}", "2024-01-05 09:00:00") for i in range(2)]
    (other / "b.csv").write_text(HEADER + "".join(lines))
    want = sorted([f"a{i}" for i in range(10)] + [f"b{i}" for i in range(5)])
    assert load(spark, feed, dedup=True).count() == 10
    assert ids(load(spark, feed, dedup=True, folder=str(other), marks=str(tmp_path / "marks-2"))) == want
    assert ids(load(spark, feed, dedup=True, marks=str(tmp_path / "marks-3"))) == want
    feed("c.csv", line("b0", "2024-01-05 08:00:00"), line("c", "2024-01-05 08:00:00"))
    assert ids(load(spark, feed, dedup=True)) == [*want, "c"]


def test_a_batch_that_failed_half_way_is_completed(spark, feed, monkeypatch):
    feed("a.csv", *[line(str(i), "2024-01-05 10:00:00") for i in range(30)])
    land = arrivals.land_new_keys

    def broken(batch, *how):
        land(batch.filter("quantity = 1 AND order_id < '2'"), *how)
        raise RuntimeError("lost")

    monkeypatch.setattr(arrivals, "land_new_keys", broken)
    with pytest.raises(Exception, match="lost|STREAM_FAILED"):
        load(spark, feed, dedup=True)
    some = spark.read.parquet(feed.target).count()
    assert 0 < some < 30
    monkeypatch.setattr(arrivals, "land_new_keys", land)
    assert ids(load(spark, feed, dedup=True)) == sorted(str(i) for i in range(30))


def test_only_touched_buckets_are_read(spark, feed):
    """The files of all other buckets may even be unreadable."""
    feed("a.csv", *[line(str(i), "2024-01-05 10:00:00") for i in range(40)])
    load(spark, feed, dedup=True)
    target = pathlib.Path(feed.target)
    key = spark.createDataFrame([("3",)], "order_id string")
    bucket = key.select(arrivals.bucket_of("order_id", arrivals.BUCKETS)).first()[0]
    for part in target.glob("bucket=*/*.parquet"):
        if part.parent.name != f"bucket={bucket}":
            (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
            part.write_bytes(b"no parquet file")
    feed("b.csv", line("3", "2024-01-05 11:00:00"))
    load_only = arrivals.stream_csv(spark, feed.path, RAW_ORDERS)
    arrivals.finish(arrivals.load_without_retries(load_only, feed.target, feed.marks))
    assert spark.read.parquet(f"{feed.target}/bucket={bucket}").filter("order_id = '3'").count() == 1


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_random_batches_against_brute_force(spark, tmp_path, limit):
    rng = random.Random(5)
    path, seen = str(tmp_path / "landed"), {}
    for number in range(5):
        rows = [(rng.choice([None, *map(str, range(40))]), rng.choice([None, *range(6)]), number) for _ in range(30)]
        batch = spark.createDataFrame(rows, "k string, at int, n int")
        arrivals.land_new_keys(batch, path, "k", "at", 4, limit)
        first = {}
        for k, at, n in rows:
            place = (at is None, at or 0, n)
            first[k] = min(first.get(k, place), place)
        for k, (missing, at, n) in first.items():
            seen.setdefault(k, (None if missing else at, n))
    landed = spark.read.parquet(path).collect()
    assert sorted(map(str, ((r.k, (r.at, r.n)) for r in landed))) == sorted(map(str, seen.items()))


@pytest.mark.parametrize("dedup", [False, True])
def test_moved_columns_fail_the_load(spark, feed, tmp_path, dedup):
    swapped = HEADER.replace("customer_id,product_id", "product_id,customer_id")
    (tmp_path / "feed" / "a.csv").write_text(swapped + line("1", "2024-01-05 10:00:00"))
    with pytest.raises(Exception, match="header|HEADER|STREAM_FAILED"):
        load(spark, feed, dedup=dedup)


def test_malformed_row_fails_the_load(spark, feed):
    feed("a.csv", line("1", "2024-01-05 10:00:00", quantity="2.5"))
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE|STREAM_FAILED"):
        load(spark, feed, dedup=False)
