"""The run: de-duplicate, filter, resample, align on one grid, reshape."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tsnorm.functions.times import end_bound, parse_period, start_bound
from tsnorm.operators.dedupe import append_series
from tsnorm.operators.fill import carried_rows, fill_chunks, fill_zero
from tsnorm.operators.filters import time_range
from tsnorm.operators.grid import CHUNK_POINTS, GRID_COLUMNS, Grid, GridTooLarge, grid_bounds, one_grid
from tsnorm.operators.period import common_period
from tsnorm.operators.quality import duplicate_names, shared_names
from tsnorm.operators.resample import label_us, parse_stats, resample_with_bounds, series_bounds, series_modes
from tsnorm.operators.reshape import wide_columns, wide_pivot
from tsnorm.session import Scratch, Small
from tsnorm.sources.read import read
from tsnorm.sources.scan import CsvOptions, NoData, Readings, Source

# Cells (grid times x instruments) one task should produce.
TASK_CELLS = 1_000_000
# Cells of one time chunk of the wide table, which one task holds sorted.
WIDE_CHUNK_CELLS = 1_000_000


@dataclass(frozen=True)
class Report:
    """What a run met in its files.

    ``rows``: how many rows were read (``n_rows``; cells with a time in the trend layout), time cells that are no time
    (``bad_times``), value cells that are no number (``bad_values``), and readings ``kept`` after filters and removal of
    duplicates. ``missing`` paths do not exist; ``left_out`` files have no usable header. ``repeated_names`` are names a file has
    more than once (``source_file, name, n``), ``shared_names`` those several files have (``name, n_files``).
    """

    rows: dict[str, int]
    missing: list[str]
    left_out: DataFrame
    repeated_names: DataFrame
    shared_names: DataFrame


@dataclass
class Aligned:
    """An aligned data set, or one per source file.

    ``sampled`` has one row per instrument and non-empty period, with its grid ``point``;
    ``instruments`` one row per instrument. They are the small tables everything below is
    made from.
    """

    sampled: DataFrame
    instruments: DataFrame
    listed: list[dict] | None
    grid: Grid | None
    stats: list[str]
    keys: tuple[str, ...]
    cells: int
    scratch: Scratch
    source: Source | None = None
    kept: Observation | None = None

    @property
    def time_format(self) -> str | None:
        """How times are written in the source; None if it is no file."""
        return None if self.source is None else self.source.time_format

    @property
    def tasks(self) -> int:
        """Tasks for filling gaps. Rows multiply after that shuffle, so its size in bytes is no guide."""
        return max(1, min(self.cells // TASK_CELLS, 2**31 - 1))

    def long(self) -> DataFrame:
        """``[source_file,] instrument, timestamp, <statistics>``: one row per grid time."""
        rows = carried_rows(self.sampled, self.instruments, self.stats, self.keys, self.grid)
        rows = rows.repartition(self.tasks, *self.keys, "instrument", "chunk")
        return fill_zero(fill_chunks(rows, self.stats, self.keys, self.grid).drop("chunk"), self.stats)

    def wide(self) -> DataFrame:
        """``timestamp, value_<instrument>...``: partitions are in time order, rows in them not sorted.

        Everything of a chunk of time is brought together once, before the gaps are filled;
        filling and pivoting then need no further shuffle.
        """
        if self.keys:
            raise ValueError("the wide table is for one data set; use long() for many files")
        # the names are columns of the plan, however many they are
        listed = self.listed or self.instruments.select("instrument", "down").toArrow().to_pylist()
        single = {m["instrument"] for m in listed if m["down"] is False}
        columns = wide_columns([m["instrument"] for m in listed], self.stats, single)
        chunk = max(1, min(CHUNK_POINTS, WIDE_CHUNK_CELLS // len(listed), self.grid.points // 64))
        rows = carried_rows(self.sampled, self.instruments, self.stats, (), self.grid, chunk)
        # equal spans of time make equal numbers of rows, wherever the readings are
        n_chunks = -(-self.grid.points // chunk)
        rows = rows.withColumn("part", F.floor(F.col("chunk") * self.tasks / n_chunks).cast("int"))
        rows = fill_chunks(rows.repartitionById(self.tasks, "part"), self.stats, ("part",), self.grid, chunk)
        return wide_pivot(rows, columns, clustered=["part", "chunk"])

    def wide_files(self) -> Iterator[DataFrame]:
        """Wide tables of a batch, ``source_file, timestamp, value_<instrument>...``: one for each set of columns, with
        all files that have it.

        Chunks of all its files are numbered through, so a table's partitions are in the order of file and time, of equal
        size however long or short the files are, and nothing is shuffled after the gaps are filled.
        """
        if not self.keys:
            raise ValueError("one data set has one wide table; use wide()")
        column = F.struct("instrument", F.coalesce(~F.col("down"), F.lit(False)).alias("single"))
        signed = self.instruments.groupBy(*self.keys).agg(
            F.sort_array(F.collect_list(column)).alias("columns"), F.first("points").alias("points"))
        signed = self.scratch.table(signed.withColumn("kind", F.sha2(F.to_json("columns"), 256)), f"kinds-{uuid.uuid4().hex}")
        # columns are part of a plan, so there is a plan for each set of them
        kinds = signed.groupBy("kind").agg(F.first("columns").alias("columns")).orderBy("kind").collect()
        for kind in kinds:
            named = [c["instrument"] for c in kind.columns]
            columns = wide_columns(named, self.stats, {c["instrument"] for c in kind.columns if c["single"]})
            chunk = max(1, min(CHUNK_POINTS, WIDE_CHUNK_CELLS // len(named)))
            files = signed.where(F.col("kind") == kind.kind).select(*self.keys, F.ceil(F.col("points") / chunk).alias("chunks"))
            # one row a file
            before = F.sum("chunks").over(Window.orderBy(*self.keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("chunks")
            files = files.withColumn("before", before)
            total = files.agg(F.sum("chunks")).first()[0]
            if not total:
                continue
            tasks = max(1, min(total, total * chunk * len(named) // TASK_CELLS, 2**31 - 1))
            keyed = list(self.keys)
            of_kind = files.select(*keyed)
            rows = carried_rows(
                self.sampled.join(of_kind, keyed, "left_semi"), self.instruments.join(of_kind, keyed, "left_semi"), self.stats, self.keys, None, chunk)
            rows = rows.join(files.select(*keyed, "before"), keyed)
            rows = rows.withColumn("part", F.floor((F.col("before") + F.col("chunk")) * tasks / F.lit(total)).cast("int")).drop("before")
            rows = fill_chunks(rows.repartitionById(tasks, "part"), self.stats, ("part", *self.keys), None, chunk)
            yield wide_pivot(rows, columns, (*self.keys, "timestamp"), clustered=["part", "chunk"])

    def report(self) -> Report:
        """What the run met in its files. Rows were counted while they were read, so this is no further pass."""
        if self.source is None or self.kept is None:
            raise ValueError("ask for a report when the run is made: normalize_files(..., report=True)")
        rows = dict(self.source.parsed.get) | dict(self.kept.get)
        files, names = self.source.files, self.source.names
        used = self.instruments.select("source_file").distinct() if self.keys else names.select("source_file").distinct()
        left_out = files.frame.select("source_file").distinct().join(used, "source_file", "left_anti")
        return Report(rows, files.missing, left_out, duplicate_names(names), shared_names(names))

    def close(self) -> None:
        """Remove the intermediate tables; the tables above cannot be read after it."""
        self.scratch.close()


def normalize(
    readings: Readings,
    *,
    period: str | None = None,
    stats: str = "m",
    query: str | None = None,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    gap: str = "carry",
    max_cells: int | None = None,
    scratch: Scratch | None = None,
    kept: Observation | None = None,
) -> Aligned:
    """Align readings on one regular grid.

    ``period`` is a sampling period such as ``5S`` (default: the smallest sample period found),
    ``stats`` statistics letters, ``query`` a filter over ``val``, ``start`` and ``end``
    inclusive bounds. ``gap='zero'`` writes 0.0 for a period without readings instead of
    carrying the last row on.
    """
    if gap not in ("carry", "zero"):
        raise ValueError("gap must be carry or zero")
    keys = readings.keys
    named = [*keys, "instrument"]
    chosen = parse_stats(stats)
    period_us = parse_period(period)
    start_us, end_us = start_bound(start), end_bound(end)
    scratch = scratch or Scratch(readings.frame.sparkSession)

    # time is a grouping key of the de-duplication: these bounds are pushed below it
    rows = time_range(readings.frame, start_us, end_us)
    rows = append_series(rows, keys, query, readings.unique)
    if kept is not None:
        rows = rows.observe(kept, F.count(F.lit(1)).alias("kept"))
    if period_us is not None:
        rows = rows.withColumn("period_us", F.lit(period_us).cast("bigint"))
    else:
        rows = scratch.table(rows, "readings")
        found = common_period(rows, keys)
        if keys:
            rows = rows.join(found, list(keys))
        else:
            rows = rows.withColumn("period_us", F.lit(found.first()[0]).cast("bigint"))

    sampled = scratch.table(resample_with_bounds(rows, chosen, keys), "sampled")
    bounds = Small(series_bounds(sampled, keys), scratch, "bounds")
    if bounds.rows is not None and all(b["fullest"] >= 2 for b in bounds.rows):
        modes = bounds.extended("down", "boolean", lambda b: True, F.lit(True))
        mixed = False
    else:
        modes = Small(series_modes(sampled, keys), scratch, "modes")
        mixed = modes.rows is None or not all(m["down"] for m in modes.rows)
    filtered = query is not None or start_us is not None or end_us is not None
    named_all = readings.instruments is not None and (filtered or not readings.from_data)
    listed = None
    if keys:
        grid = None
        ends = modes.frame.groupBy(*keys).agg(
            F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"), F.first("period_us").alias("period_us"))
        grids = ends.where("first_us is not null").select(
            *keys, *grid_bounds(F.col("first_us"), F.col("last_us"), F.col("period_us"), start_us, end_us))
        grids = Small(grids, scratch, "grids").frame
        seeds = modes.frame.select(*named, "down")
        if named_all:
            seeds = readings.instruments.join(seeds, named, "left")
        seeds = seeds.join(grids, list(keys))
        total = seeds.agg(F.sum("points")).first()[0]
        sampled = sampled.drop("period_us").join(grids, list(keys))
    else:
        if modes.rows is not None:
            first, last = (f((m[c] for m in modes.rows), default=None) for f, c in ((min, "first_us"), (max, "last_us")))
            step = modes.rows[0]["period_us"] if modes.rows else None
        else:
            first, last, step = modes.frame.agg(F.min("first_us"), F.max("last_us"), F.first("period_us")).first()
        if first is None:
            raise NoData("no data found: no reading has a valid time and value")
        grid = one_grid(first, last, step, start_us, end_us)
        seeds, listed = modes.frame.select("instrument", "down"), modes.rows
        if named_all:
            small = Small(readings.instruments.join(seeds, named, "left"), scratch, "instruments")
            seeds, listed = small.frame, small.rows
        total = grid.points * (len(listed) if listed is not None else seeds.count())
    modes = modes.frame
    if total is None:
        raise NoData("no data found: no reading has a valid time and value")
    if max_cells is not None and total > max_cells:
        raise GridTooLarge(f"{total} grid cells; choose a longer period or a shorter range, or raise max_cells")

    sampled = _labelled(sampled, modes if mixed else None, keys, grid, chosen, gap)
    return Aligned(sampled, seeds, listed, grid, chosen, keys, total, scratch, readings.source, kept)


def _labelled(
    sampled: DataFrame, modes: DataFrame | None, keys: Sequence[str], grid: Grid | None, stats: Sequence[str], gap: str
) -> DataFrame:
    """Sampled rows with the grid ``point`` from which each is valid; upsampled ones keep the raw value.

    ``modes`` says which are upsampled; None when none is.
    """
    named = [*keys, "instrument"]
    if modes is None:
        rows = sampled.withColumn("down", F.lit(True))
    else:
        rows = sampled.join(modes.select(*named, "down"), named)
    start = F.col("grid_start") if grid is None else F.lit(grid.grid_start)
    step = F.col("period_us") if grid is None else F.lit(grid.period_us)
    points = F.col("points") if grid is None else F.lit(grid.points)
    label = label_us(F.col("down"), F.col("bucket_us"), F.col("first_us"), step)
    values = [F.when(F.col("down"), F.col(s)).otherwise(F.col("raw")).alias(s) for s in stats]
    out = rows.select(
        *named, *([] if grid is not None else GRID_COLUMNS), "down",
        ((label - start) / step).cast("bigint").alias("point"), *values)
    if gap == "zero":
        # an empty period after a downsampled row ends it; where the next row has that point it wins
        after = out.where("down").select(
            *[c for c in out.columns if c not in ("point", *stats)], (F.col("point") + 1).alias("point"),
            *[F.lit(0.0).alias(s) for s in stats])
        both = out.withColumn("real", F.lit(1)).unionByName(after.withColumn("real", F.lit(0)))
        ids = [*named, *([] if grid is not None else GRID_COLUMNS), "point"]
        out = both.groupBy(*ids).agg(*[F.max_by(s, "real").alias(s) for s in stats])
    return out.where((F.col("point") >= 0) & (F.col("point") < points)).drop("down")


def normalize_files(
    spark: SparkSession,
    layout: str,
    paths: str | Sequence[str],
    *,
    sep: str = ",",
    encoding: str = "utf_8",
    time_format: str | None = None,
    per_file: bool = False,
    report: bool = False,
    long_rows: str = "raise",
    quoted_breaks: bool = True,
    **options,
) -> Aligned:
    """:func:`normalize` on files of one layout, merged or, with ``per_file``, each on its own.

    With ``report`` rows are counted as they are read, for :meth:`Aligned.report`; ``long_rows`` and ``quoted_breaks`` are those of
    :class:`CsvOptions`.
    """
    scratch = Scratch(spark)
    opts = CsvOptions(sep=sep, encoding=encoding, time_format=time_format, long_rows=long_rows, quoted_breaks=quoted_breaks)
    try:
        parsed, kept = (Observation(), Observation()) if report else (None, None)
        readings = read(spark, layout, paths, opts, per_file=per_file, scratch=scratch, parsed=parsed)
        return normalize(readings, scratch=scratch, kept=kept, **options)
    except BaseException:
        scratch.close()
        raise
