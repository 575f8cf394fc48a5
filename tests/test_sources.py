from unittest import mock

import pytest
from frames import dec, ts

from orderloom.schemas import LOADED_AT, RAW, RAW_CUSTOMERS, RAW_ORDERS, RAW_PRODUCTS
from orderloom.session import shared_dir
from orderloom.sources import jdbc
from orderloom.sources.csv_files import read_csv, read_header, stamped
from orderloom.sources.tables import load_table, publish, read_published, spread, write_table

HEADER = "order_id,customer_id,product_id,quantity,order_date,load_timestamp,source_system\n"
GOOD = "1,c1,p1,2,01/05/2024,2024-01-05 10:00:00,legacy_pos\n"


def feed(tmp_path, text, name="feed.csv"):
    path = tmp_path / name
    path.write_text(text, newline="")
    return str(path)


def test_csv_in_declared_types(spark, tmp_path):
    df = read_csv(spark, feed(tmp_path, HEADER + GOOD), RAW_ORDERS)
    assert df.schema == RAW_ORDERS
    assert tuple(df.first()) == ("1", "c1", "p1", 2, "01/05/2024", ts("2024-01-05 10:00:00"), "legacy_pos")


def test_csv_empty_and_null_differ(spark, tmp_path):
    df = read_csv(spark, feed(tmp_path, HEADER + '"",,p1,,"",,\n'), RAW_ORDERS)
    assert tuple(df.first()) == ("", None, "p1", None, "", None, None)


def test_csv_quotes_and_line_ends(spark, tmp_path):
    text = 'product_id,product_name,category,unit_cost,unit_price\r\np1,"Lamp, ""big""",Home,36.0,1\r\n'
    row = read_csv(spark, feed(tmp_path, text), RAW_PRODUCTS).first()
    assert tuple(row) == ("p1", 'Lamp, "big"', "Home", dec("36.0"), dec("1"))


def test_csv_quoted_line_break_is_one_record(spark, tmp_path):
    text = "customer_id,first_name,last_name,email,region,signup_date\nc1,\"a\nb\",l,e,r,2024-01-01\n"
    path = feed(tmp_path, text)
    rows = read_csv(spark, path, RAW_CUSTOMERS, multiline=True).collect()
    assert [r.first_name for r in rows] == ["a\nb"]
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        read_csv(spark, path, RAW_CUSTOMERS).collect()


@pytest.mark.parametrize(
    "line",
    [
        "1,c1,p1,2.5,01/05/2024,2024-01-05 10:00:00,legacy_pos\n",
        "1,c1,p1,2,01/05/2024,soon,legacy_pos\n",
        "1,c1,p1\n",
        GOOD.strip() + ",more\n",
    ],
)
def test_csv_bad_rows_fail_the_load(spark, tmp_path, line):
    df = read_csv(spark, feed(tmp_path, HEADER + GOOD + line), RAW_ORDERS)
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE|TASK_WRITE_FAILED"):
        load_table(stamped(df), "orders_raw", str(tmp_path / "t"))


def test_csv_header_check(spark, tmp_path):
    path = feed(tmp_path, HEADER.replace("quantity", "qty") + GOOD)
    assert read_csv(spark, path, RAW_ORDERS, check_header=False).first().quantity == 2
    with pytest.raises(Exception, match="CSV header|FAILED_READ_FILE"):
        read_csv(spark, path, RAW_ORDERS).collect()
    assert "qty" in read_header(spark, path).names


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_csv(spark, str(tmp_path / "none.csv"), RAW_ORDERS)


def test_stamp_is_one_time_without_zone(spark):
    stamps = {r[LOADED_AT] for r in stamped(spark.range(100).repartition(4)).collect()}
    assert len(stamps) == 1 and None not in stamps
    assert dict(stamped(spark.range(1)).dtypes)[LOADED_AT] == "timestamp_ntz"


def test_load_counts_and_reload_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        load = load_table(spark.range(1000).repartition(7), "t", path)
        assert (load.expected, load.actual, load.status) == (1000, 1000, "OK")
    assert spark.read.parquet(path).distinct().count() == 1000


def test_failed_load_keeps_published_data(spark, tmp_path):
    root = str(tmp_path)
    write_table(spark.range(3), f"{root}/r1/t")
    publish(spark, root, "r1", {"t": f"{root}/r1/t"})
    bad = read_csv(spark, feed(tmp_path, HEADER + "1,c1,p1,x,d,t,s\n"), RAW_ORDERS)
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE|TASK_WRITE_FAILED"):
        load_table(bad, "t", f"{root}/r2/t")
    assert read_published(spark, root, "t").count() == 3


def test_publishing_replaces_what_readers_see(spark, tmp_path):
    root = str(tmp_path)
    for run, rows in (("r1", 3), ("r2", 5)):
        write_table(spark.range(rows), f"{root}/{run}/t")
        publish(spark, root, run, {"t": f"{root}/{run}/t"})
        assert read_published(spark, root, "t").count() == rows
    with pytest.raises(LookupError, match="other"):
        read_published(spark, root, "other")


def test_partitioned_write_splits_hot_values(spark, tmp_path):
    """A month that holds most rows is written by many tasks; rare ones share a task."""
    df = spark.range(200_000).selectExpr("id", "uuid() AS pad", "if(id % 10 < 9, 1, id % 7) AS month")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_table(spread(df.repartition(8), "month"), str(tmp_path / "t"), ["month"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {m: len(list((tmp_path / "t" / f"month={m}").glob("*.parquet"))) for m in range(7)}
    assert files[1] > 2 and min(files.values()) == 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_shared_dir_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(f"{root}/x-") and first != second


def test_shared_dir_must_be_set_on_a_cluster():
    session = mock.Mock()
    session.conf.get.return_value = None
    session.sparkContext.master = "yarn"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session, "x")


# JDBC is checked up to the options handed to Spark; no database runs here.


def test_connection_settings():
    env = {"PGHOST": "db", "PGDATABASE": "shop", "PGUSER": "me", "PGPASSWORD": "s3cret"}
    connection = jdbc.Connection.from_environment(env)
    assert connection.options() == {
        "url": "jdbc:postgresql://db:5432/shop",
        "driver": "org.postgresql.Driver",
        "user": "me",
        "password": "s3cret",
    }
    assert "s3cret" not in repr(connection)
    assert jdbc.Connection.from_environment({}).url == "jdbc:postgresql://localhost:5432/postgres"


def reader_options(**how):
    session = mock.Mock()
    jdbc.read_table(session, jdbc.Connection("jdbc:x:y", "a.Driver"), "marts.fct", **how)
    return session.read


def test_jdbc_read_options():
    read = reader_options(split=jdbc.Split("order_date", "2024-01-01", "2026-06-30", 64))
    read.format.assert_called_once_with("jdbc")
    assert read.format.return_value.options.call_args.kwargs == {
        "dbtable": "marts.fct",
        "url": "jdbc:x:y",
        "driver": "a.Driver",
        "fetchsize": "10000",
        "partitionColumn": "order_date",
        "lowerBound": "2024-01-01",
        "upperBound": "2026-06-30",
        "numPartitions": "64",
    }


def test_jdbc_hash_split():
    read = reader_options(split=jdbc.hash_predicates("h(order_id)", 3))
    args, kwargs = read.jdbc.call_args
    assert args == ("jdbc:x:y", "marts.fct")
    assert kwargs["properties"] == {"driver": "a.Driver", "fetchsize": "10000"}
    assert len(kwargs["predicates"]) == 3


def test_hash_predicates_cover_every_row_once(spark):
    df = spark.createDataFrame([(v,) for v in [None, -7, -3, -1, 0, 1, 2, 3, 2**31 - 1]], "h bigint")
    counts = [df.filter(p).count() for p in jdbc.hash_predicates("h", 4)]
    assert sum(counts) == 9
    hits = df.selectExpr(*[f"cast(coalesce({p}, false) as int)" for p in jdbc.hash_predicates("h", 4)])
    assert all(sum(r) == 1 for r in hits.collect())


def test_jdbc_write_keeps_the_table():
    df = mock.Mock()
    jdbc.write_table(df, jdbc.Connection("jdbc:x:y", "a.Driver", "me", "pw"), "marts.trends")
    options = df.write.format.return_value.options.call_args.kwargs
    assert options["truncate"] == "true" and options["dbtable"] == "marts.trends" and options["user"] == "me"
    df.write.format.return_value.options.return_value.mode.assert_called_once_with("overwrite")


@pytest.mark.parametrize("fails", [None, "write", "fill"])
def test_jdbc_replacement_is_one_transaction(fails):
    """The database is stood in for: which statements it gets, in what order, and what happens when one fails."""
    df, steps = mock.Mock(columns=["day", "sum"]), []
    session = df.sparkSession.sparkContext._jvm.java.sql.DriverManager.getConnection.return_value

    def execute(text):
        steps.append(text)
        if fails == "fill" and text.startswith("INSERT"):
            raise RuntimeError(fails)

    def save():
        steps.append("rows")
        if fails == "write":
            raise RuntimeError(fails)

    session.createStatement.return_value.execute = execute
    session.commit, session.rollback = lambda: steps.append("commit"), lambda: steps.append("rollback")
    writer = df.write.format.return_value.options
    writer.return_value.mode.return_value.save = save
    replace = lambda: jdbc.replace_table(df, jdbc.Connection("jdbc:x:y", "a.Driver", "me", "pw"), "marts.trends")
    if fails:
        with pytest.raises(RuntimeError, match=fails):
            replace()
    else:
        replace()
    beside = ["DROP TABLE IF EXISTS marts.trends_next", "CREATE TABLE marts.trends_next (LIKE marts.trends)", "commit", "rows"]
    fill = 'INSERT INTO marts.trends ("day", "sum") SELECT "day", "sum" FROM marts.trends_next'
    swap = ["DELETE FROM marts.trends", fill]
    after = {None: [*swap, "DROP TABLE marts.trends_next", "commit"], "write": [], "fill": [*swap, "rollback"]}
    assert steps == beside + after[fails]
    assert writer.call_args.kwargs["dbtable"] == "marts.trends_next" and "truncate" not in writer.call_args.kwargs
    assert session.close.called


def test_declared_raw_tables():
    assert list(RAW) == ["customers", "products", "orders_raw"]
