"""De-duplication: the last row wins.

All of these are aggregates with a map-side part, so a time that occurs a million times in
one file reaches the shuffle once per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsnorm.functions.values import value_query


def last_wins(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Column) -> DataFrame:
    """One row per key with ``columns`` of the row that is last in ``order``, missing or not."""
    if len(columns) == 1:
        return df.groupBy(*keys).agg(F.max_by(columns[0], order).alias(columns[0]))
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("last"))
    return last.select(*keys, *[F.col("last")[c].alias(c) for c in columns])


def append_series(
    readings: DataFrame, keys: Sequence[str] = (), query: str | None = None, unique: bool = False
) -> DataFrame:
    """One value per (instrument, ts) from readings with ``series`` and ``ord``.

    Missing values go first. Each series keeps its last value of a time and is then filtered,
    so a value the filter rejects does not bring back an earlier one of its series. Of the
    series of one instrument the last wins. Without a filter both steps are one aggregate.
    """
    ids = [*keys, "instrument", "ts"]
    rows = readings.where("value is not null and ts is not null")
    if unique:
        rows = rows.select(*ids, "value")
        return rows if query is None else rows.where(value_query(query))
    if query is not None:
        last = rows.groupBy(*ids, "series").agg(F.max_by("value", "ord").alias("value"), F.max("ord").alias("ord"))
        rows = last.where(value_query(query))
    return last_wins(rows, ids, ["value"], F.col("ord"))


def replace_series(readings: DataFrame, new: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Readings with every instrument that occurs in ``new`` replaced by its rows there."""
    ids = [*keys, "instrument"]
    named = new.select(*ids).distinct()
    return readings.join(named, ids, "left_anti").unionByName(new)
