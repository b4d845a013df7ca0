"""Data-quality reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_names(cells: DataFrame) -> DataFrame:
    """Names one file uses more than once, from ``source_file, name`` rows: ``source_file, name, n``."""
    return cells.groupBy("source_file", "name").agg(F.count("*").alias("n")).where("n > 1")


def shared_names(cells: DataFrame) -> DataFrame:
    """Names used by more than one file, from ``source_file, name`` rows: ``name, n_files``."""
    used = cells.select("source_file", "name").distinct()
    return used.groupBy("name").agg(F.count("*").alias("n_files")).where("n_files > 1")


def quality_report(
    rows: DataFrame, keys: Sequence[str], ids: Sequence[str], text_ts: Column, ts: Column, text_value: Column, value: Column
) -> DataFrame:
    """Rows lost on the way to readings, per group of ``keys``.

    ``n_rows``; ``bad_times``, time cells that are no time; ``bad_values``, cells that are not
    empty and no number; ``duplicates``, rows beyond the first of an (ids, time).
    """
    typed = rows.select(
        *keys, *ids, ts.alias("_ts"),
        (text_ts.isNotNull() & ts.isNull()).alias("_bad_ts"),
        (text_value.isNotNull() & value.isNull()).alias("_bad_value"),
    )
    # one row per (ids, time) first: counts of copies, not sets of them, reach the second shuffle
    per_time = typed.groupBy(*keys, *ids, "_ts").agg(
        F.count("*").alias("n"), F.count_if("_bad_ts").alias("bad_ts"), F.count_if("_bad_value").alias("bad_value"))
    return per_time.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"),
        F.sum("bad_ts").alias("bad_times"),
        F.sum("bad_value").alias("bad_values"),
        F.sum(F.when(F.col("_ts").isNotNull(), F.col("n") - 1).otherwise(0)).alias("duplicates"),
    )
