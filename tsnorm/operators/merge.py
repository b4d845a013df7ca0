"""Merging inputs: rows of later inputs win where both have a value of one time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, columns by name; a column some lack is missing there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_rows(frames: Sequence[DataFrame], order: str = "ord") -> DataFrame:
    """Rows of all frames with ``order`` extended by the position of their frame, which comes first."""
    return union_all([
        f.withColumn(order, F.struct(F.lit(entry).alias("entry"), F.col(order).alias("within")))
        for entry, f in enumerate(frames)
    ])
