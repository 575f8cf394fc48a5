"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def text_of(column: str) -> Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def text_bytes(df: DataFrame, column: str) -> int:
    """The bytes of all texts of a column, measured by one job."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.col(f"`{column}`")).cast("long")), F.lit(0))).first()[0]


def visit(function: Callable, kind: str) -> Callable[..., Column]:
    """A function over Arrow batches that is called once per row.

    Filters on its result would otherwise be pushed below it with a second call
    inside, in a second set of Python workers; Spark does not copy what it
    takes for nondeterministic.
    """
    return F.arrow_udf(function, kind).asNondeterministic()


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes ``starts[i] .. starts[i] + lengths[i] - 1`` of all ranges, one after another."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def offsets_of(lengths: Sequence[int] | np.ndarray) -> np.ndarray:
    """Where each of consecutive runs starts, and the end of the last."""
    return np.concatenate(([0], np.cumsum(np.asarray(lengths, dtype=np.int64))))


def list_array(lengths: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from the lengths of its rows and all their values."""
    offsets = pa.array(offsets_of(lengths).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
