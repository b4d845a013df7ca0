"""Alignment on a grid: every grid time takes the last row at or before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsnorm.operators.grid import CHUNK_POINTS, GRID_COLUMNS, Grid, grid_columns


def carried_rows(
    labelled: DataFrame,
    instruments: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] = (),
    grid: Grid | None = None,
    chunk_points: int = CHUNK_POINTS,
) -> DataFrame:
    """Rows by grid point, with one extra row at each chunk start that holds the carried-in values.

    ``labelled`` has ``instrument, point, <values>``, one row per point. Every instrument of
    ``instruments`` gets rows, also one that has none in ``labelled``. Without ``grid`` both
    have the grid as columns. Gives ``chunk, point, real, <values>`` such that a chunk
    (``chunk_points`` grid points) of an instrument can be filled on its own: no step looks at
    all points of an instrument at once, only at one row per chunk.
    """
    named = [*keys, "instrument"]
    carried_grid = [] if grid is not None else GRID_COLUMNS
    points = grid_columns(grid)["points"]
    size = F.lit(chunk_points).cast("bigint")
    rows = labelled.select(*named, *carried_grid, F.floor(F.col("point") / size).alias("chunk"), "point", *values)
    last = rows.groupBy(*named, "chunk").agg(*[F.max_by(v, "point").alias(v) for v in values])
    before = instruments.select(*named, F.lit(-1).cast("bigint").alias("chunk"), *carried_grid)
    by_chunk = Window.partitionBy(*named).orderBy("chunk")
    steps = before.unionByName(last, allowMissingColumns=True).select(
        *named, "chunk", *values,
        F.lead("chunk").over(by_chunk).alias("next_chunk"),
        # the grid comes with the row before the first chunk
        *[F.first(g, ignorenulls=True).over(by_chunk).alias(g) for g in carried_grid],
    )
    # a row is carried through the chunks after its own up to the next one with rows
    steps = steps.withColumn("to_chunk", F.coalesce("next_chunk", F.floor((points - 1) / size)))
    steps = steps.where((F.col("chunk") + 1 <= F.col("to_chunk")) & (points > 0))
    carried = steps.withColumn("chunk", F.explode(F.sequence(F.col("chunk") + 1, F.col("to_chunk"))))
    carried = carried.select(
        *named, *carried_grid, "chunk", (F.col("chunk") * size).alias("point"), F.lit(0).alias("real"), *values)
    return rows.withColumn("real", F.lit(1)).unionByName(carried)


def fill_chunks(
    rows: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] = (),
    grid: Grid | None = None,
    chunk_points: int = CHUNK_POINTS,
) -> DataFrame:
    """All grid points from :func:`carried_rows`: each row is repeated up to the next one."""
    named = [*keys, "instrument"]
    of = grid_columns(grid)
    in_chunk = Window.partitionBy(*named, "chunk").orderBy("point", "real")
    end = F.least((F.col("chunk") + 1) * F.lit(chunk_points).cast("bigint"), of["points"])
    stop = F.coalesce(F.lead("point").over(in_chunk), end)
    filled = rows.withColumn("stop", stop).where("point < stop")
    filled = filled.withColumn("point", F.explode(F.sequence(F.col("point"), F.col("stop") - 1)))
    at = F.timestamp_micros(of["grid_start"] + F.col("point") * of["period_us"])
    return filled.select(*named, "chunk", at.alias("timestamp"), *values)


def align(
    labelled: DataFrame,
    instruments: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] = (),
    grid: Grid | None = None,
    chunk_points: int = CHUNK_POINTS,
) -> DataFrame:
    """Long aligned table ``instrument, timestamp, <values>``; no row before means NULL."""
    rows = carried_rows(labelled, instruments, values, keys, grid, chunk_points)
    return fill_chunks(rows, values, keys, grid, chunk_points).drop("chunk")


def locf(
    rows: DataFrame, ids: Sequence[str], order: str, value: str, chunk_us: int
) -> DataFrame:
    """Last observation carried forward: NULLs of ``value`` take the last value before them.

    ``order`` is a timestamp, unique per group. Filled within chunks of time; the value
    carried into a chunk comes from a window over one row per chunk.
    """
    us = F.unix_micros(F.col(order).cast("timestamp"))
    chunked = rows.withColumn("_chunk", us - F.pmod(us, F.lit(chunk_us)))
    last = chunked.groupBy(*ids, "_chunk").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_last"))
    by_chunk = Window.partitionBy(*ids).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*ids, "_chunk", F.last("_last", ignorenulls=True).over(by_chunk).alias("_carry"))
    inside = Window.partitionBy(*ids, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = chunked.withColumn(value, F.last(value, ignorenulls=True).over(inside))
    joined = filled.join(carry, [*ids, "_chunk"])
    return joined.withColumn(value, F.coalesce(value, "_carry")).drop("_chunk", "_carry", "_last")


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing numbers become 0.0."""
    return df.fillna(0.0, subset=list(columns))
