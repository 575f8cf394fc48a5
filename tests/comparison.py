"""Run a registered query and its SQL oracle and compare names, types and values."""

import datetime
import decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_rows(sf_dir, sql):
    db = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    return names, [str(d[1]) for d in result.description], result.fetchall()


# One kind per pair of types that hold the same values.
_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def _plain(value):
    if isinstance(value, decimal.Decimal):
        raise AssertionError("decimals must leave as doubles")
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(table, key=repr)


def differences(df, sf_dir, sql):
    """A list of problems, empty when both sides agree exactly; and the row count."""
    names, kinds, expected = oracle_rows(sf_dir, sql)
    actual = [tuple(r) for r in df.collect()]
    problems = []
    have = {f.name: _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    want = dict(zip(names, kinds, strict=True))
    if have != want:
        problems.append(f"schema {sorted(set(have.items()) ^ set(want.items()))}")
    else:
        _, left = _sorted(df.columns, actual)
        _, right = _sorted(names, expected)
        if left != right:
            only_left, only_right = set(left) - set(right), set(right) - set(left)
            problems.append(
                f"{len(left)} rows against {len(right)}; "
                f"only here {sorted(only_left, key=repr)[:3]}, only oracle {sorted(only_right, key=repr)[:3]}"
            )
    return problems, len(actual)
