"""Down- and upsampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsnorm.functions.times import ceil_us, floor_us
from tsnorm.operators.period import min_gap

# The statistics letters and the statistic each selects.
STATISTICS = {"v": "val", "i": "min", "x": "max", "a": "mean", "m": "mean", "s": "std", "d": "std"}
ORDER = ["val", "min", "max", "mean", "std"]


def parse_stats(letters: str) -> list[str]:
    """Statistics selected by a string of letters, in output order."""
    unknown = set(letters.lower()) - set(STATISTICS)
    if unknown or not letters:
        raise ValueError(f"statistics are letters of {''.join(STATISTICS)}, not {letters!r}")
    chosen = {STATISTICS[c] for c in letters.lower()}
    return [s for s in ORDER if s in chosen]


def _aggregate(stat: str, tie: Column) -> Column:
    value = F.col("value")
    return {
        "val": F.min_by(value, tie),
        "min": F.min(value),
        "max": F.max(value),
        "mean": F.avg(value),
        "std": F.stddev_samp(value),
    }[stat].alias(stat)


def resample(
    readings: DataFrame,
    period_us: Column | int,
    stats: Sequence[str] = ("mean",),
    keys: Sequence[str] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """Statistics per instrument and period: ``instrument, bucket, <stats>``.

    ``bucket`` is the start of the period; periods are closed on the left. The first value of
    a period is the one with the smallest ``ts``, then ``order``.
    """
    bucket = F.timestamp_micros(floor_us(F.unix_micros("ts"), period_us)).alias("bucket")
    tie = F.struct("ts", *order) if order else F.col("ts")
    return readings.groupBy(*keys, "instrument", bucket).agg(*[_aggregate(s, tie) for s in stats])


def resample_with_bounds(readings: DataFrame, stats: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """:func:`resample` in microseconds plus what later steps need of the raw times.

    Readings have one value per instrument and time, and a ``period_us`` column. Adds ``n``,
    ``first_us``, ``last_us`` and ``raw``, the first value, so that bounds, up/down decision and
    forward fill all come from this much smaller table and the source is read once.
    """
    us = F.unix_micros("ts")
    rows = readings.select(
        *keys, "instrument", "value", "period_us", us.alias("us"), floor_us(us, F.col("period_us")).alias("bucket_us"))
    return rows.groupBy(*keys, "instrument", "period_us", "bucket_us").agg(
        *[_aggregate(s, F.col("us")) for s in stats],
        F.min_by("value", "us").alias("raw"),
        F.count("value").alias("n"),
        F.min("us").alias("first_us"),
        F.max("us").alias("last_us"),
    )


def series_bounds(sampled: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """First and last time of every instrument and ``fullest``, the readings of its fullest period."""
    return sampled.groupBy(*keys, "instrument", "period_us").agg(
        F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"),
        F.max("n").alias("fullest"),
    )


def series_modes(sampled: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """:func:`series_bounds` with ``down``: whether an instrument is downsampled.

    It is when the period is at least its smallest sample gap. Two readings in one period prove
    that; else every period has one reading and the gaps between periods are all gaps there are.
    An instrument with a single reading has no gap; filled forward it could start after the
    grid's end, so it counts as downsampled.
    """
    named = [*keys, "instrument"]
    gaps = min_gap(sampled.select(*named, F.col("first_us").alias("us")), named)
    down = (F.col("fullest") >= 2) | F.coalesce(F.col("gap_us") <= F.col("period_us"), F.lit(True))
    return series_bounds(sampled, keys).join(gaps, named, "left").select(
        *named, "period_us", "first_us", "last_us", down.alias("down"))


def label_us(down: Column, bucket: Column, first: Column, period_us: Column) -> Column:
    """Grid time from which a period's row is valid.

    Downsampled: the period start. Upsampled (one reading in the period at most): the first
    grid time at or after the reading.
    """
    return F.when(down, bucket).otherwise(ceil_us(first, period_us))
