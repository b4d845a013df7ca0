"""Row filters on readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def time_range(readings: DataFrame, start_us: int | None = None, end_us: int | None = None) -> DataFrame:
    """Readings from start to end, both included. The bounds fold to literals and reach the scan."""
    out = readings
    if start_us is not None:
        out = out.where(F.col("ts") >= F.timestamp_micros(F.lit(start_us)))
    if end_us is not None:
        out = out.where(F.col("ts") <= F.timestamp_micros(F.lit(end_us)))
    return out
