"""Exact top-k search by inner product: norm buckets, pruned by length or by coordinates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tsnorm.llm import common

BUCKET, QUERIES = 2048, 256  # vectors of a bucket, queries of a block
COORDINATES = 6  # coordinates that a coordinate-pruned query looks at
PRUNE_FROM = 0.6  # local cosine threshold from which coordinates prune better than lengths
SALTS = 64
PACKED = "block long, dims int, longest double, n int, ids binary, rows binary, data binary, lengths binary"


def packed(vectors: DataFrame, size: int, total: int) -> DataFrame:
    """Blocks of up to ``size`` vectors of near length, one row each, longest first; staged. Vectors are
    dealt by ranges of (dims, length), so no group is ever gathered by key."""

    @common.tidy
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            dims, at = batch.column("dims").to_numpy(), 0
            while at < len(batch):
                end = min(at + size, at + int(np.argmax(np.append(dims[at:] != dims[at], True))))
                part = batch.slice(at, end - at)
                ids = part.column("vec_id").fill_null(2**63 - 1).to_numpy()
                flat = part.column("vec").flatten().to_numpy()
                yield pa.RecordBatch.from_pydict({
                    "block": [block], "dims": pa.array([int(dims[at])], pa.int32()), "longest": [part.column("length")[0].as_py()],
                    "n": pa.array([end - at], pa.int32()), "ids": [ids.tobytes()], "rows": [part.column("row").to_numpy().tobytes()],
                    "data": [flat.tobytes()], "lengths": [part.column("length").to_numpy().tobytes()]})
                block, at = block + 1, end

    order = ["dims", F.desc("length"), "row"]
    ranged = vectors.repartitionByRange(max(1, -(-total // size)), *order).sortWithinPartitions(*order)
    return common.stage(ranged.mapInArrow(pack, PACKED), "blocks")


def block_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(row["data"], np.int64).reshape(row["n"], row["dims"])
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["rows"], np.int64), data, np.frombuffer(row["lengths"], np.float64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products; in doubles where no sum can pass 2**53."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, own: int, least: float, k: int) -> np.ndarray:
    """Places of the k highest scores of at least ``least``, ties to the smaller id; not the own row."""
    at = np.flatnonzero((scores >= least) & (rows != own))
    if len(at) > 4 * k:
        bound = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= bound]
    return at[np.lexsort((rows[at], ids[at], -scores[at]))][:k]


def coordinate_range(cosine: float, threshold: float) -> tuple[float, float]:
    """Between which a unit vector's coordinate lies if its cosine with the query, whose own
    coordinate is ``cosine``, is at least ``threshold``: angles differ by at most the threshold's."""
    to_axis, apart = np.arccos(np.clip(cosine, -1, 1)), np.arccos(np.clip(threshold, -1, 1))
    return np.cos(min(np.pi, to_axis + apart)) - 1e-9, np.cos(max(0.0, to_axis - apart)) + 1e-9


def search_block(query: dict, least: np.ndarray, bucket: dict, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every query of a block, its best vectors of a bucket: query place, bucket places, scores.
    Each query's threshold and the bucket's longest vector give a local cosine threshold. Above 1 the
    bucket is skipped; where it is high, only vectors whose coordinates can reach it are verified;
    else only those long enough."""
    _, q_rows, q, q_len = block_of(query)
    ids, rows, v, v_len = block_of(bucket)
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(least > 0, least / q_len, 0.0)  # length below which no vector can score enough
        local = np.where(least > 0, need / max(bucket["longest"], 1e-300), -1.0)
    need = np.where(np.isnan(need), np.inf, need)
    local = np.where(np.isnan(local), np.inf, local)
    open_ = local <= 1 + 1e-9
    by_length = np.flatnonzero(open_ & (local < PRUNE_FROM))
    if len(by_length):
        long_enough = np.searchsorted(-v_len, -(need[by_length] * (1 - 1e-9)), "right")
        most = int(long_enough.max())
        scores = products(q[by_length], v[:most])
        for i, s, n in zip(by_length.tolist(), scores, long_enough.tolist(), strict=True):
            at = best(s[:n], ids[:n], rows[:n], q_rows[i], least[i], k)
            yield i, at, s[at]
    by_coordinate = np.flatnonzero(open_ & (local >= PRUNE_FROM))
    if len(by_coordinate):
        unit = v / np.maximum(v_len, 1e-300)[:, None]
        for i in by_coordinate.tolist():
            direction = q[i] / q_len[i]
            at = np.arange(int(np.searchsorted(-v_len, -(need[i] * (1 - 1e-9)), "right")))
            for f in np.argsort(-np.abs(direction))[:COORDINATES].tolist():
                low, high = coordinate_range(direction[f], local[i] * (1 - 1e-9))
                c = unit[at, f]
                at = at[(c >= low) & (c <= high)]
            s = products(q[i:i + 1], v[at])[0]
            top = best(s, ids[at], rows[at], q_rows[i], least[i], k)
            yield i, at[top], s[top]


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """For every query row its k vectors of highest inner product: query_id, rank, vec_id, score.

    ``vectors`` has vec_id (long) and vec (array of long); ``queries`` are some of its rows, told
    apart by row, a staged number. Vectors of other dimension than the query take no part. Ties go to the smaller vec_id;
    a null vec_id comes last among them. Repeated vec_ids and equal vectors are separate rows, and only the
    query's own row is left out. Fewer than k other rows give all of them, no row none.

    Vectors are packed into buckets of near length. The bucket of the longest vectors gives every query
    a first threshold, its k-th best score there. Pairs of query block and bucket that lengths rule out
    are not formed; the rest are searched with length or coordinate pruning and verified by products.
    Each pair yields at most k rows a query, cut again to k before the final shuffle.
    """
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    measured = [c.withColumns({"dims": F.size("vec"), "length": length}).select("row", "vec_id", "vec", "dims", "length") for c in (vectors, queries)]
    buckets = packed(measured[0], BUCKET, vectors.count())
    blocks = packed(measured[1], QUERIES, queries.count())
    tops = buckets.groupBy("dims").agg(F.min("block").alias("block"))  # longest first: one row per dimension
    # every block of queries meets the one longest bucket, of which each salt has a copy: no key has all blocks
    copies = buckets.join(tops, ["dims", "block"], "left_semi").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    first = (
        blocks.select(F.struct(*blocks.columns).alias("q"), "dims", F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int").alias("salt"))
        .join(copies.select("dims", "salt", F.struct(*buckets.columns).alias("b")), ["dims", "salt"]))

    @common.tidy
    def thresholds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query, bucket in zip(batch.column("q").to_pylist(), batch.column("b").to_pylist(), strict=True):
                least = np.full(query["n"], -np.inf)
                for i, _, scores in search_block(query, least.copy(), bucket, k):
                    if len(scores) == k:
                        least[i] = scores[-1]
                lengths = np.frombuffer(query["lengths"], np.float64)
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where(least > 0, least / lengths, 0.0)
                yield pa.RecordBatch.from_pydict({
                    "block": [query["block"]], "need": [float(need.min())], "least": [least.tobytes()]})

    least = common.stage(first.select("q", "b").mapInArrow(thresholds, "block long, need double, least binary"), "least")
    asked = blocks.select("block", "dims").join(least.select("block", "need"), "block").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    pairs = (
        buckets.select(F.col("block").alias("bucket"), "dims", "longest", F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int").alias("salt"))
        .join(asked, ["dims", "salt"]).filter(F.col("longest") >= F.col("need") * (1 - 1e-9)).select("bucket", "block"))
    rows = (
        pairs.join(blocks.select("block", F.struct(*blocks.columns).alias("q")), "block").join(least.select("block", "least"), "block")
        .join(buckets.select(F.col("block").alias("bucket"), F.struct(*buckets.columns).alias("b")), "bucket"))

    @common.tidy
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(len(batch)):
                query, bucket = batch.column("q")[n].as_py(), batch.column("b")[n].as_py()
                q_ids, q_rows, _, _ = block_of(query)
                ids, v_rows, _, _ = block_of(bucket)
                out = [[], [], [], [], []]
                for i, at, scores in search_block(query, np.frombuffer(batch.column("least")[n].as_py(), np.float64), bucket, k):
                    for column, values in zip(out, (np.full(len(at), q_rows[i]), np.full(len(at), q_ids[i]), v_rows[at], ids[at], scores), strict=True):
                        column.append(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out], ["query", "query_id", "row", "vec_id", "score"])

    found = rows.select("q", "least", "b").mapInArrow(search, "query long, query_id long, row long, vec_id long, score long")
    w = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        .select("query_id", "rank", F.nullif("vec_id", F.lit(2**63 - 1)).alias("vec_id"), "score"))
