"""Trailing sums and averages over an ordered series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators.numbering import numbered
from pyspark.sql.window import WindowSpec


def _added(measure: str, specs: Mapping[str, WindowSpec], names: tuple[str, str]) -> list[Column]:
    """All sums, then all averages."""
    value = F.col(measure)
    sums = [F.sum(value).over(spec).alias(names[0].format(suffix)) for suffix, spec in specs.items()]
    return sums + [F.round(F.avg(value).over(spec), 2).alias(names[1].format(suffix)) for suffix, spec in specs.items()]


def rolling_rows(
    df: DataFrame,
    order: str,
    measure: str,
    frames: Mapping[str, int],
    names: tuple[str, str],
    partition: Sequence[str] = (),
) -> DataFrame:
    """Trailing sum and average over the last n rows, for each frame ``suffix -> n``.

    ``names`` are the sum and average column names with ``{}`` for the suffix.
    Frames at the start average over the rows present. All frames share one
    ordering, so Spark evaluates them in one window pass.
    """
    base = Window.partitionBy(*partition).orderBy(order)
    specs = {suffix: base.rowsBetween(1 - rows, Window.currentRow) for suffix, rows in frames.items()}
    return df.select("*", *_added(measure, specs, names))


# Rows of a frame without a partition that one task sees, beside the few it borrows from the piece before.
PIECE_ROWS = 1 << 20


def rolling_rows_in_pieces(
    df: DataFrame,
    order: Sequence[str],
    measure: str,
    frames: Mapping[str, int],
    names: tuple[str, str],
    folder: str,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """:func:`rolling_rows` over one ordering of all rows, by many tasks.

    Rows are numbered in ``order``, by ranges, and cut into pieces of ``piece_rows``. A piece also gets the last rows of the
    one before it, as many as the longest frame reaches back, so each frame lies in one piece; they
    are dropped behind the window. ``order`` must tell rows apart. The numbered rows are written to ``folder``.
    """
    reach = max(frames.values()) - 1
    if piece_rows < max(reach, 1):
        raise ValueError(f"pieces of {piece_rows} rows are shorter than a frame")
    place, piece, into = "_place", "_piece", "_into"
    placed = numbered(df, list(order), folder, place).withColumn(piece, F.floor(F.col(place) / piece_rows))
    borrowed = F.col(place) % piece_rows >= piece_rows - reach
    both = F.when(borrowed, F.array(F.col(piece), F.col(piece) + 1)).otherwise(F.array(piece))
    dealt = placed.withColumn(into, F.explode(both))
    base = Window.partitionBy(into).orderBy(place)
    specs = {suffix: base.rowsBetween(1 - rows, Window.currentRow) for suffix, rows in frames.items()}
    rolled = dealt.select("*", *_added(measure, specs, names))
    return rolled.filter(F.col(piece) == F.col(into)).drop(place, piece, into)


def rolling_days(
    df: DataFrame,
    order: str,
    measure: str,
    frames: Mapping[str, int],
    names: tuple[str, str],
    partition: Sequence[str] = (),
) -> DataFrame:
    """The same over the last n calendar days, whether or not each has a row.

    Averages are over the days present in the frame, as in ``rolling_rows``.
    """
    day = "_day_number"
    numbered = df.withColumn(day, F.unix_date(F.col(order)))
    base = Window.partitionBy(*partition).orderBy(day)
    specs = {suffix: base.rangeBetween(1 - days, Window.currentRow) for suffix, days in frames.items()}
    return numbered.select("*", *_added(measure, specs, names)).drop(day)
