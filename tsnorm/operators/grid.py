"""Regular time grids."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsnorm.functions.times import floor_us

# Grid points produced from one row at a time.
CHUNK_POINTS = 4096


class GridTooLarge(ValueError):
    """The grid has more cells than the caller allows."""


@dataclass(frozen=True)
class Grid:
    """The one grid of a run. Runs of many files have these three as columns instead."""

    grid_start: int
    period_us: int
    points: int


GRID_COLUMNS = ["grid_start", "period_us", "points"]


def grid_columns(grid: Grid | None) -> dict[str, Column]:
    """The grid as expressions: literals of ``grid``, or the columns of each row."""
    return {c: F.col(c) if grid is None else F.lit(getattr(grid, c)).cast("bigint") for c in GRID_COLUMNS}


def grid_bounds(
    first_us: Column, last_us: Column, period_us: Column, start_us: int | None = None, end_us: int | None = None
) -> list[Column]:
    """Grid of data bounds and requested bounds: ``grid_start, period_us, points``.

    The start is floored to the period, the end is not; an empty range has no points.
    """
    low = first_us if start_us is None else F.greatest(first_us, F.lit(start_us))
    high = last_us if end_us is None else F.least(last_us, F.lit(end_us))
    start = floor_us(low, period_us)
    points = F.when(high >= low, (high - start - F.pmod(high - start, period_us)) / period_us + 1).otherwise(0)
    return [start.alias("grid_start"), period_us.alias("period_us"), points.cast("bigint").alias("points")]


def one_grid(first_us: int, last_us: int, period_us: int, start_us: int | None = None, end_us: int | None = None) -> Grid:
    """:func:`grid_bounds` of one run whose bounds are known."""
    low = first_us if start_us is None else max(first_us, start_us)
    high = last_us if end_us is None else min(last_us, end_us)
    start = low - low % period_us
    return Grid(start, period_us, (high - start) // period_us + 1 if high >= low else 0)


def expand_points(rows: DataFrame, low: Column, high: Column, name: str, chunk: int = CHUNK_POINTS) -> DataFrame:
    """One row per whole number from ``low`` to ``high``, both included; none when low > high.

    Two steps, so that no array is longer than the range / ``chunk`` or ``chunk`` elements, with
    a shuffle of the block rows between them, so that one row's range is not one task's work.
    """
    blocks = rows.withColumn("_lo", low).withColumn("_hi", high).where("_lo <= _hi")
    n_blocks = F.floor((F.col("_hi") - F.col("_lo")) / chunk)
    blocks = blocks.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), n_blocks)))
    blocks = blocks.repartition("_block", *rows.columns)
    first = F.col("_lo") + F.col("_block") * chunk
    last = F.least(first + (chunk - 1), F.col("_hi"))
    return blocks.withColumn(name, F.explode(F.sequence(first, last))).drop("_lo", "_hi", "_block")


def time_grid(grids: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Grid times ``timestamp`` of every ``grid_start, period_us, points`` row."""
    points = expand_points(grids, F.lit(0).cast("bigint"), F.col("points") - 1, "point")
    at = F.timestamp_micros(F.col("grid_start") + F.col("point") * F.col("period_us"))
    return points.select(*keys, at.alias("timestamp"))


def spine(grids: DataFrame, instruments: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every grid time of every instrument: ``instrument, timestamp``.

    Expanded per instrument, so the work spreads over instruments before it grows.
    """
    named = instruments.join(grids, list(keys)) if keys else instruments.crossJoin(grids)
    return time_grid(named, [*keys, "instrument"])
