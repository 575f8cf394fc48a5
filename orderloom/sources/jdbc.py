"""Database tables over JDBC, read and written by many tasks."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Connection:
    """Where a database is. The driver class comes from the jar on the class path."""

    url: str
    driver: str
    user: str | None = None
    password: str = field(default="", repr=False)

    @classmethod
    def from_environment(cls, env: Mapping[str, str] | None = None) -> Connection:
        """PostgreSQL settings from the usual ``PG*`` variables, with local defaults."""
        env = os.environ if env is None else env
        host = env.get("PGHOST", "localhost")
        port = env.get("PGPORT", "5432")
        database = env.get("PGDATABASE", "postgres")
        return cls(
            url=f"jdbc:postgresql://{host}:{port}/{database}",
            driver="org.postgresql.Driver",
            user=env.get("PGUSER", env.get("USER")),
            password=env.get("PGPASSWORD", ""),
        )

    def options(self) -> dict[str, str]:
        settings = {"url": self.url, "driver": self.driver}
        if self.user:
            settings |= {"user": self.user, "password": self.password}
        return settings


@dataclass(frozen=True)
class Split:
    """How a read is divided: ``tasks`` ranges of a numeric, date or timestamp column.

    Rows outside the bounds are read too, by the first and last range. Where one
    value holds much of the table, split on an even column such as a surrogate
    key, or give ``hash_predicates`` instead.
    """

    column: str
    lower: str
    upper: str
    tasks: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.tasks),
        }


def hash_predicates(hashed: str, tasks: int) -> list[str]:
    """One condition per task over an integer SQL expression such as ``hashtext(order_id)``.

    The double remainder keeps negative hashes in range; the first condition also
    takes NULLs, so every row is read exactly once.
    """
    bucket = f"mod(mod({hashed}, {tasks}) + {tasks}, {tasks})"
    first = f"({bucket} = 0 or {bucket} is null)"
    return [first] + [f"{bucket} = {task}" for task in range(1, tasks)]


def read_table(
    spark: SparkSession,
    connection: Connection,
    table: str,
    split: Split | list[str] | None = None,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """A database table. Without ``split`` one task reads it all: small tables only."""
    options = connection.options() | {"fetchsize": str(fetch_rows)}
    if isinstance(split, list):
        url = options.pop("url")
        return spark.read.jdbc(url, table, predicates=split, properties=options)
    if split is not None:
        options |= split.options()
    return spark.read.format("jdbc").options(dbtable=table, **options).load()


def write_table(
    df: DataFrame, connection: Connection, table: str, connections: int = 16, batch_rows: int = 10_000
) -> None:
    """Replace the rows of a table and keep its definition and grants. Readers may see it empty meanwhile."""
    options = connection.options() | {
        "truncate": "true",
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
    }
    df.write.format("jdbc").options(dbtable=table, **options).mode("overwrite").save()


def replace_table(
    df: DataFrame, connection: Connection, table: str, connections: int = 16, batch_rows: int = 10_000
) -> None:
    """Replace the rows of a table so that it is never seen empty or in part.

    The rows go to ``<table>_next`` first, over many connections. Only when all of them are there, one transaction
    empties the table and fills it from that one, inside the database; it fails as a whole or not at all. Definition,
    grants and views of the table stay. A failed write leaves the table as it was, and the next run starts anew.
    """
    beside = f"{table}_next"
    spark = df.sparkSession
    in_one_transaction(spark, connection, [f"DROP TABLE IF EXISTS {beside}", f"CREATE TABLE {beside} (LIKE {table})"])
    options = connection.options() | {"batchsize": str(batch_rows), "numPartitions": str(connections)}
    df.write.format("jdbc").options(dbtable=beside, **options).mode("append").save()
    names = ", ".join(f'"{name}"' for name in df.columns)
    in_one_transaction(
        spark,
        connection,
        [
            f"DELETE FROM {table}",
            f"INSERT INTO {table} ({names}) SELECT {names} FROM {beside}",
            f"DROP TABLE {beside}",
        ],
    )


def in_one_transaction(spark: SparkSession, connection: Connection, statements: list[str]) -> None:
    """Run a few statements from the driver, all or none."""
    jvm = spark.sparkContext._jvm
    settings = jvm.java.util.Properties()
    for name, value in connection.options().items():
        if name in ("user", "password"):
            settings.setProperty(name, value)
    # Drivers of added jars are known to Spark's class loader only; this makes them known to the driver manager.
    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(connection.driver)
    session = jvm.java.sql.DriverManager.getConnection(connection.url, settings)
    try:
        session.setAutoCommit(False)
        try:
            statement = session.createStatement()
            for text in statements:
                statement.execute(text)
            session.commit()
        except Exception:
            session.rollback()
            raise
    finally:
        session.close()
