"""Deliveries whose schema changes: versions, the changes between them, and all deliveries as one table."""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.sources import folders
from orderloom.sources.tables import write_table

_LOG = "_schemas"
_CHANGE = "struct<kind:string,column_name:string,detail:string>"
_LOG_SCHEMA = (
    "delivery long, version long, path string, delivered_rows long, "
    f"columns array<struct<name:string,type:string,delivered_as:string>>, changes array<{_CHANGE}>"
)


@dataclass(frozen=True)
class Change:
    """``kind`` is added, removed, renamed, moved or retyped."""

    kind: str
    column_name: str
    detail: str


class SchemaChanged(RuntimeError):
    """A delivery that cannot be merged with those before; it was not landed."""


def _in_order(positions: Sequence[int]) -> set[int]:
    """A longest increasing subsequence: the columns that stay when as few as possible move."""
    tails: list[int] = []
    lengths = []
    for p in positions:
        at = bisect_left(tails, p)
        tails[at : at + 1] = [p]
        lengths.append(at)
    wanted, stay = len(tails) - 1, set()
    for p, length in zip(reversed(positions), reversed(lengths), strict=True):
        if length == wanted and (not stay or p < min(stay)):
            stay.add(p)
            wanted -= 1
    return stay


def changes(before: T.StructType, after: T.StructType) -> list[Change]:
    """What became of a schema.

    A column of another name is a removed and an added one: only who delivers it can say that both mean the same.
    Moved are as few columns as explain the new order of those that both have.
    """
    had = {f.name: f.dataType.simpleString() for f in before.fields}
    have = {f.name: f.dataType.simpleString() for f in after.fields}
    found = [Change("added", name, kind) for name, kind in have.items() if name not in had]
    found += [Change("removed", name, kind) for name, kind in had.items() if name not in have]
    found += [Change("retyped", n, f"{had[n]} to {kind}") for n, kind in have.items() if n in had and had[n] != kind]
    places = {name: place for place, name in enumerate(had, 1)}
    stay = _in_order([places[name] for name in have if name in had])
    moved = [name for name in have if name in had and places[name] not in stay]
    return found + [Change("moved", name, f"from place {places[name]}") for name in moved]


def land(df: DataFrame, root: str, table: str, renames: Mapping[str, str] | None = None) -> list[Change]:
    """Write a delivery beside the earlier ones and log its schema; returns what changed since the one before.

    ``renames`` has the names that columns go by here, and what they were called when they first came, which they keep.
    New columns are NULL in earlier deliveries, and left out ones in this one. A column with another type
    than in any earlier delivery raises :class:`SchemaChanged` before anything is written. What readers see is the
    log, appended last, so a failed landing leaves no trace but an unused folder. One writer at a time.
    """
    spark, renames = df.sparkSession, dict(renames or {})
    unknown = [new for new in renames if new not in df.columns]
    if unknown:
        raise ValueError(f"renamed but not delivered: {', '.join(unknown)}")
    rows = df.withColumnsRenamed(renames)
    if len(set(rows.columns)) < len(rows.columns):
        raise ValueError("a column is delivered under its older and its new name")
    log = _entries(spark, root, table)
    known = merged_schema([_schema(entry["columns"]) for entry in log])
    wrong = [c for c in changes(known, rows.schema) if c.kind == "retyped"]
    if wrong:
        raise SchemaChanged("; ".join(f"{table}.{c.column_name}: {c.detail}" for c in wrong))
    delivered_as = {renames.get(name, name): name for name in df.columns}
    found: list[Change] = []
    if log:
        before = {c["name"]: c["delivered_as"] for c in log[-1]["columns"]}
        renamed = [name for name, now in delivered_as.items() if before.get(name, now) != now]
        found = [Change("renamed", name, f"delivered as {delivered_as[name]}") for name in renamed]
        found += changes(_schema(log[-1]["columns"]), rows.schema)
    version = log[-1]["version"] + bool(found) if log else 1
    path = f"{root}/{table}/{uuid.uuid4().hex}"
    counter = Observation(f"delivery of {table}")
    write_table(rows.observe(counter, F.count(F.lit(1)).alias("rows")), path)
    columns = [(f.name, f.dataType.simpleString(), delivered_as[f.name]) for f in rows.schema.fields]
    kept = [(c.kind, c.column_name, c.detail) for c in found]
    entry = (len(log) + 1, version, path, counter.get["rows"], columns, kept)
    one = spark.createDataFrame([entry], _LOG_SCHEMA).coalesce(1)
    one.write.mode("append").parquet(f"{root}/{table}/{_LOG}")
    return found


def merged_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns that any of the schemas has, in order of their first appearance, all nullable."""
    fields = {f.name: T.StructField(f.name, f.dataType) for schema in reversed(schemas) for f in schema.fields}
    names = dict.fromkeys(f.name for schema in schemas for f in schema.fields)
    return T.StructType([fields[name] for name in names])


def read_landed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All deliveries with all columns. One scan by the logged schema: no file footers are gone through for it."""
    log = _entries(spark, root, table)
    if not log:
        raise ValueError(f"nothing has been landed as {table}")
    schema = merged_schema([_schema(entry["columns"]) for entry in log])
    return spark.read.schema(schema).parquet(*[entry["path"] for entry in log])


def drift_report(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One row per change: ``version, kind, column_name, detail, delivered_rows`` of the delivery that brought it."""
    log = spark.read.schema(_LOG_SCHEMA).parquet(f"{root}/{table}/{_LOG}")
    return log.select("version", "delivered_rows", F.inline("changes")).select(
        "version", "kind", "column_name", "detail", "delivered_rows"
    )


def _entries(spark: SparkSession, root: str, table: str) -> list:
    """The log by delivery: a row for each, so it grows with deliveries and not with their rows."""
    path = f"{root}/{table}/{_LOG}"
    if not folders.children(spark, path):
        return []
    return spark.read.schema(_LOG_SCHEMA).parquet(path).orderBy("delivery").collect()


def _schema(columns: Sequence) -> T.StructType:
    return T.StructType([T.StructField(c["name"], T.DataType.fromDDL(c["type"])) for c in columns])
