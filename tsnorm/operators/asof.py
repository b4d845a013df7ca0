"""Backward as-of join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Chunks of 10 seconds hold 10 million microseconds at most, spans of them 10,000 chunks, whatever the data.
CHUNK_US = 10_000_000
SPAN_CHUNKS = 10_000


def asof_times(times: DataFrame, by: Sequence[str], chunk_us: int = CHUNK_US) -> DataFrame:
    """Time of the last right row at or before every wanted time: ``by, at, match_at``.

    ``times`` has ``by, at, wanted, known``: times asked for and times of right rows. Within a chunk of time that is a running
    maximum. The last time of a chunk is carried into the next ones of its span (``SPAN_CHUNKS`` chunks), and the last
    one of a span into the next spans. So only keys and times move, and no window holds all of a key, however many rows fall in
    one second: times are distinct by then, and a chunk has room for so many only. Nothing about the data is asked first.
    """
    distinct = times.where("at is not null").groupBy(*by, "at").agg(
        F.max("wanted").alias("wanted"), F.max("known").alias("known"))
    us = F.unix_micros(F.col("at").cast("timestamp"))
    distinct = distinct.withColumn("chunk", F.floor(us / F.lit(chunk_us)))
    known_at = F.when(F.col("known"), F.col("at"))
    inside = Window.partitionBy(*by, "chunk").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = distinct.withColumn("match_at", F.max(known_at).over(inside)).where("wanted")

    def earlier(partition: Sequence[str], order: str) -> Column:
        return F.max("last").over(Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))

    chunks = distinct.groupBy(*by, "chunk").agg(F.max(known_at).alias("last"))
    chunks = chunks.withColumn("span", F.floor(F.col("chunk") / F.lit(SPAN_CHUNKS)))
    spans = chunks.groupBy(*by, "span").agg(F.max("last").alias("last"))
    spans = spans.select(*by, "span", earlier(by, "span").alias("of_spans"))
    carry = chunks.withColumn("carry", earlier([*by, "span"], "chunk")).join(spans, [*by, "span"])
    carry = carry.select(*by, "chunk", F.coalesce("carry", "of_spans").alias("carry"))
    return seen.join(carry, [*by, "chunk"]).select(*by, "at", F.coalesce("match_at", "carry").alias("match_at"))


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    order: Sequence[str] = (),
    chunk_us: int = CHUNK_US,
) -> DataFrame:
    """Each left row with the columns of the last right row of its key at or before its time.

    Exact matches count; of right rows with one time the last in ``order`` is taken; without a
    match the right columns are NULL. A right row is a match whatever its values are.

    Neither a busy key nor many rows of one time end in one task: times are matched as in
    :func:`asof_times`, the rest are equality joins, which AQE splits when skewed. No job runs while the plan is built.
    """
    payload = [c for c in right.columns if c not in (*by, right_on)]
    tie = F.struct(*order) if order else F.struct(*payload)
    rights = right.where(F.col(right_on).isNotNull()).groupBy(*by, F.col(right_on).alias("match_at")).agg(
        F.max_by(F.struct(*payload), tie).alias("match"))
    times = left.select(*by, F.col(left_on).alias("at"), F.lit(True).alias("wanted"), F.lit(False).alias("known"))
    times = times.unionByName(
        right.select(*by, F.col(right_on).alias("at"), F.lit(False).alias("wanted"), F.lit(True).alias("known")))
    found = asof_times(times, by, chunk_us).where("match_at is not null")
    found = found.join(rights, [*by, "match_at"]).withColumnRenamed("at", left_on)
    joined = left.join(found, [*by, left_on], "left")
    return joined.select(
        *left.columns, F.col("match_at").alias(right_on), *[F.col("match")[c].alias(c) for c in payload])
