"""Sample periods, bounds and summaries of instruments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsnorm.functions.times import ONE_SECOND_US, floor_us

# Times are whole milliseconds, so a chunk of one instrument holds 600,000 distinct times at most.
CHUNK_US = 600_000_000


def min_gap(times: DataFrame, ids: Sequence[str], chunk_us: int = CHUNK_US) -> DataFrame:
    """Smallest positive gap between consecutive times ``us`` of every group: ``gap_us``.

    Groups without two distinct times are absent. A busy instrument is not one window
    partition: gaps are taken within chunks of time, then between the ends of neighbouring
    chunks, which leaves one row per chunk for the window over the whole instrument.
    """
    chunk = floor_us(F.col("us"), chunk_us).alias("chunk")
    distinct = times.select(*ids, "us", chunk).distinct()
    inner = Window.partitionBy(*ids, "chunk").orderBy("us")
    gaps = distinct.withColumn("gap", F.col("us") - F.lag("us").over(inner))
    ends = gaps.groupBy(*ids, "chunk").agg(
        F.min("gap").alias("gap"), F.min("us").alias("lo"), F.max("us").alias("hi"))
    outer = Window.partitionBy(*ids).orderBy("chunk")
    joined = ends.withColumn("gap", F.least("gap", F.col("lo") - F.lag("hi").over(outer)))
    return joined.groupBy(*ids).agg(F.min("gap").alias("gap_us")).where("gap_us is not null")


def sample_period(readings: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sample period of every instrument: ``instrument, gap_us``."""
    times = readings.where("value is not null").select(*keys, "instrument", F.unix_micros("ts").alias("us"))
    return min_gap(times, [*keys, "instrument"])


def common_period(readings: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Smallest sample period of all instruments; one second when none has two samples."""
    gaps = sample_period(readings, keys)
    if keys:
        named = readings.select(*keys).distinct()
        gaps = named.join(gaps.groupBy(*keys).agg(F.min("gap_us").alias("gap_us")), list(keys), "left")
        return gaps.select(*keys, F.coalesce("gap_us", F.lit(ONE_SECOND_US)).alias("period_us"))
    return gaps.agg(F.coalesce(F.min("gap_us"), F.lit(ONE_SECOND_US)).alias("period_us"))


def global_bounds(readings: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """First and last time with a value: ``start_ts, end_ts``."""
    rows = readings.where("value is not null")
    aggregates = [F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts")]
    return rows.groupBy(*keys).agg(*aggregates) if keys else rows.agg(*aggregates)


def instrument_summary(readings: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Name, start, end, count, sample period and empty flag of every instrument."""
    named = [*keys, "instrument"]
    at = F.when(F.col("value").isNotNull(), F.col("ts"))
    totals = readings.groupBy(*named).agg(
        F.min(at).alias("start_ts"), F.max(at).alias("end_ts"), F.count("value").alias("n"))
    return totals.join(sample_period(readings, keys), named, "left").select(
        *named, "start_ts", "end_ts", "n",
        F.col("gap_us").alias("period_us"), (F.col("n") == 0).alias("is_empty"))
