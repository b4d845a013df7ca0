"""Shards by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tsnorm.llm import common

RING = 1 << 31  # places of the ring
SECTORS = 1 << 12  # equal parts of the ring, by which a place finds its arc
CELL = 4096  # rows that are numbered by one group, on average


def virtual_nodes(spark, shards: int, nodes: int) -> list[tuple[int, int]]:
    """Places of the ring in clockwise order with their shard: ``shards * nodes`` rows."""
    place = F.pmod(F.xxhash64(F.lit("node"), F.col("shard"), F.col("node")), F.lit(RING))
    rows = (
        spark.range(shards).select(F.col("id").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))).alias("node"))
        .select(place.alias("place"), "shard").toArrow().to_pylist())
    return sorted({r["place"]: r["shard"] for r in sorted(rows, key=lambda r: -r["shard"])}.items())


def flow(counts: list[int], shard_of: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Where the rows of each arc go: (arc, first rank, end rank, shard, first slot). Every arc first fills
    the shard of its node; what is over goes clockwise to the next shards with room. Works on
    the arcs' counts alone."""
    room, taken, out = list(room), [0] * len(room), []
    left = []
    for arc, (n, shard) in enumerate(zip(counts, shard_of, strict=True)):
        fit = min(n, room[shard])
        if fit:
            out.append((arc, 0, fit, shard, taken[shard]))
            room[shard] -= fit
            taken[shard] += fit
        if n > fit:
            left.append((arc, fit, n))
    for arc, done, n in left:
        at = arc
        while done < n:
            at = (at + 1) % len(shard_of)
            shard = shard_of[at]
            fit = min(n - done, room[shard])
            if fit:
                out.append((arc, done, done + fit, shard, taken[shard]))
                room[shard] -= fit
                taken[shard] += fit
                done += fit
    return out


def shard(rows: DataFrame, key: str, shards: int = 16, nodes: int = 64, load: float = 1.0) -> DataFrame:
    """All rows with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    A key's place on the ring (a hash) belongs to the next virtual node clockwise. A shard takes at
    most its bound: ``load`` times the mean, and with load 1 the mean itself, so counts are at most one
    apart. Rows over the bound of a full shard go on clockwise to the next shard with room. More
    slack moves fewer rows when the number of shards changes.

    Only counts of arcs (shards * nodes, a bounded table) are looked at together. Rows within an arc
    are numbered in cells of about ``CELL`` rows, dealt by a hash of a staged row number, so a key
    that repeats, even in a third of all rows, is spread over many cells; a cell's first rank is a
    running sum over the cells of its arc. No UDF is used. Null keys share one place; repeated rows are
    placed one by one; an empty table stays empty. Columns shard and slot of the input are replaced.
    """
    spark = rows.sparkSession
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    inner = {c: common.free_name(rows, c) for c in ("row", "place", "sector", "arc", "cell", "rank", "low", "high", "cells", "before", "first")}
    row, place, sector, arc, cell, rank, low, high, cells, before, first = inner.values()
    table = virtual_nodes(spark, shards, nodes)
    places, shard_of = [p for p, _ in table], [s for _, s in table]
    # arc i: places after node i - 1 up to node i; the last one goes on to node 0
    width, parts = RING // SECTORS, []
    for i in range(len(places) + 1):
        begin, end = (places[i - 1] + 1 if i else 0), (places[i] + 1 if i < len(places) else RING)
        while begin < end:
            stop = min(end, (begin // width + 1) * width)
            parts.append((begin // width, begin, stop, i % len(places)))
            begin = stop
    arcs = literal(spark, [sector, low, high, arc], parts)
    placed = rows.select(*names, common.row_id().alias(row), F.pmod(F.xxhash64(F.lit("key"), key), F.lit(RING)).alias(place))
    placed = placed.withColumn(sector, F.floor(F.col(place) / width)).join(F.broadcast(arcs), sector)  # SECTORS + shards * nodes rows
    placed = placed.filter((F.col(place) >= F.col(low)) & (F.col(place) < F.col(high)))
    placed = common.stage(placed.select(*names, row, arc), "placed")
    by_arc = {r[arc]: r["n"] for r in placed.groupBy(arc).agg(F.count(F.lit(1)).alias("n")).toArrow().to_pylist()}
    counts = [by_arc.get(i, 0) for i in range(len(places))]
    total = sum(counts)
    if load <= 1:
        room = [total // shards + (s < total % shards) for s in range(shards)]
    else:
        room = [int(-(-total * load // shards))] * shards
    runs = flow(counts, shard_of, room)
    n_cells = literal(spark, [arc, cells], [(i, -(-n // CELL)) for i, n in enumerate(counts) if n])
    celled = placed.join(F.broadcast(n_cells), arc).withColumn(cell, F.pmod(F.xxhash64(row), cells))
    sums = (
        celled.groupBy(arc, cell).agg(F.count(F.lit(1)).alias("n"))
        .withColumn(before, F.sum("n").over(Window.partitionBy(arc).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)))
        .select(arc, cell, F.coalesce(before, F.lit(0)).alias(before)))
    ranked = (
        celled.withColumn(rank, F.row_number().over(Window.partitionBy(arc, cell).orderBy(row)))
        .join(sums, [arc, cell]).withColumn(rank, F.col(before) + F.col(rank) - 1))
    dealt = literal(spark, [arc, low, high, "shard", first], runs)
    return (
        ranked.join(F.broadcast(dealt), arc).filter((F.col(rank) >= F.col(low)) & (F.col(rank) < F.col(high)))
        .select(*names, F.col("shard").cast("int").alias("shard"), (F.col(first) + F.col(rank) - F.col(low)).alias("slot")))


def literal(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small table of longs that is part of the plan."""
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return spark.createDataFrame(pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)}))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its rows in files by slot; a shard is written by several tasks where it is large."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").option("compression", "zstd").parquet(path))
