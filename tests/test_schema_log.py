"""Schemas that change from one delivery to the next."""

import itertools

import pytest
from pyspark.sql import types as T

from orderloom.sources import schema_log
from orderloom.sources.schema_log import Change


def schema(text):
    return T.StructType([T.StructField(*part) for part in ((n, T.DataType.fromDDL(t)) for n, t in (p.split() for p in text.split(",")))])


def test_changes():
    before = schema("a int,b string,c date")
    assert schema_log.changes(before, before) == []
    assert schema_log.changes(before, schema("a long,c date,d int")) == [
        Change("added", "d", "int"), Change("removed", "b", "string"), Change("retyped", "a", "int to bigint"),
    ]
    assert schema_log.changes(before, schema("c date,a int,b string")) == [Change("moved", "c", "from place 3")]


def test_as_few_columns_as_can_be_are_moved():
    for order in itertools.permutations(range(5)):
        before, after = (schema(",".join(f"c{i} int" for i in places)) for places in (range(5), order))
        moved = [c.column_name for c in schema_log.changes(before, after)]
        longest = max(n for n in range(6) for kept in itertools.combinations(order, n) if list(kept) == sorted(kept))
        assert len(moved) == 5 - longest
        left = [f"c{i}" for i in order if f"c{i}" not in moved]
        assert left == sorted(left)


def test_deliveries_as_one_table(spark, tmp_path):
    root = str(tmp_path)
    land = lambda rows, columns, **how: schema_log.land(spark.createDataFrame(rows, columns), root, "t", **how)
    assert land([(1, "x")], "id int, name string") == []
    assert land([(2, "y")], "id int, name string") == []
    assert land([(7, 3, "z")], "extra int, id int, title string", renames={"title": "name"}) == [
        Change("renamed", "name", "delivered as title"), Change("added", "extra", "int"),
    ]
    assert land([(8, 4, "w")], "extra int, id int, title string", renames={"title": "name"}) == []
    assert land([(5,)], "id int") == [Change("removed", "extra", "int"), Change("removed", "name", "string")]
    with pytest.raises(schema_log.SchemaChanged, match="id: int to string"):
        land([("6",)], "id string")
    with pytest.raises(schema_log.SchemaChanged, match="extra"):
        land([(6, "e")], "id int, extra string")
    with pytest.raises(ValueError, match="not delivered"):
        land([(6,)], "id int", renames={"label": "name"})
    with pytest.raises(ValueError, match="older and its new"):
        land([("a", "b")], "name string, title string", renames={"title": "name"})
    merged = schema_log.read_landed(spark, root, "t")
    assert merged.columns == ["id", "name", "extra"]
    assert sorted(map(tuple, merged.collect())) == [(1, "x", None), (2, "y", None), (3, "z", 7), (4, "w", 8), (5, None, None)]
    report = schema_log.drift_report(spark, root, "t").collect()
    assert sorted((r.version, r.kind, r.column_name) for r in report) == [
        (2, "added", "extra"), (2, "renamed", "name"), (3, "removed", "extra"), (3, "removed", "name"),
    ]
    with pytest.raises(ValueError, match="nothing"):
        schema_log.read_landed(spark, root, "none")
    assert schema_log.land(spark.createDataFrame([], "id int"), root, "empty") == []
    assert schema_log.read_landed(spark, root, "empty").count() == 0
