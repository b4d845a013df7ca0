"""Hard-negative mining: a secondary sort brings each anchor's scores in falling order, windows are opened as they pass."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsnorm.llm import common
from tsnorm.llm.search import products

BLOCK, ANCHORS = 1024, 256  # vectors of a block, anchors of a block
SALTS = 1024  # parts of the vectors, each of which meets every block of anchors, at most
PARTITION = 200_000  # scores that one task of the sort should take
PACKED = "block long, dims int, n int, ids binary, rows binary, labels binary, data binary"
KEY = struct.Struct(">QQBQQ")  # anchor, falling score, positive or negative, id, row: sorted as bytes they sort as numbers
FLIP = 1 << 63
POSITIVE, NEGATIVE = 0, 1
NO_ID = 2**63 - 1  # stands for a null vec_id, behind all others


def packed(rows: DataFrame, size: int, total: int) -> DataFrame:
    """Vectors in blocks of up to ``size``, one row each; staged. Nothing is shuffled; small tasks are run together."""

    @common.tidy
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            order = np.argsort(dims, kind="stable")
            edges = np.flatnonzero(np.diff(dims[order])) + 1
            for same in np.split(order, edges):
                for lo in range(0, len(same), size):
                    part = batch.take(pa.array(same[lo:lo + size]))
                    yield pa.RecordBatch.from_pydict({
                        "block": [block], "dims": pa.array([int(dims[same[0]])], pa.int32()), "n": pa.array([len(part)], pa.int32()),
                        "ids": [part.column("vec_id").fill_null(NO_ID).to_numpy().tobytes()], "rows": [part.column("row").to_numpy().tobytes()],
                        "labels": [part.column("label").to_numpy().tobytes()], "data": [part.column("vec").flatten().to_numpy().tobytes()]})
                    block += 1

    return common.stage(rows.coalesce(max(1, total // size)).mapInArrow(pack, PACKED), "blocks")


def arrays(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, rows, labels and vectors of a block."""
    ids, rows, labels = (np.frombuffer(block[c], np.int64) for c in ("ids", "rows", "labels"))
    return ids, rows, labels, np.frombuffer(block["data"], np.int64).reshape(block["n"], block["dims"])


def first(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the places ``at`` the k of highest score, ties by id, then row."""
    if len(at) > 4 * k:
        at = at[scores[at] >= np.partition(scores[at], len(at) - k)[len(at) - k]]
    return at[np.lexsort((rows[at], ids[at], -scores[at]))][:k]


def windows(scores: Iterable[int]) -> list[tuple[int, int]]:
    """Lowest and highest negative score of each positive's window; distinct ones, without those that no score fits."""
    return sorted({(-((-80 * s) // 100), s) for s in scores if -((-80 * s) // 100) <= s})


class Best:
    """For every anchor of a block, the first rows so far in each of its lists: one of positives, or one for each window."""

    def __init__(self, anchors: dict, k: int, bounds: list[list[tuple[int, int]]] | None):
        self.ids, self.rows, self.labels, self.data = arrays(anchors)
        self.dims, self.k, self.bounds = anchors["dims"], k, bounds
        lists = [1] * len(self.ids) if bounds is None else [len(b) for b in bounds]
        self.held = [[np.zeros((0, 3), np.int64)] * n for n in lists]  # score, id, row

    def look_at(self, block: dict) -> None:
        ids, rows, labels, data = arrays(block)
        scores = products(self.data, data)
        for i in range(len(self.ids)):
            same = labels == self.labels[i]
            if self.bounds is None:
                self.take(i, 0, scores[i], ids, rows, np.flatnonzero(same & (rows != self.rows[i])))
            else:
                for j, (low, high) in enumerate(self.bounds[i]):
                    self.take(i, j, scores[i], ids, rows, np.flatnonzero(~same & (scores[i] >= low) & (scores[i] <= high)))

    def take(self, i: int, j: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, at: np.ndarray) -> None:
        if len(at):
            at = first(scores, ids, rows, at, self.k)
            both = np.concatenate((self.held[i][j], np.stack((scores[at], ids[at], rows[at]), axis=1)))
            self.held[i][j] = both[np.lexsort((both[:, 2], both[:, 1], -both[:, 0]))][:self.k]

    def found(self, block: int) -> pa.RecordBatch:
        """All rows held, each once: block, anchor, anchor_id, score, id, row."""
        out = [np.unique(np.concatenate(lists), axis=0) if lists else np.zeros((0, 3), np.int64) for lists in self.held]
        n = [len(o) for o in out]
        flat = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
        columns = [np.full(len(flat), block), np.repeat(self.rows, n), np.repeat(self.ids, n), flat[:, 0], flat[:, 1], flat[:, 2]]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["block", "anchor", "anchor_id", "score", "id", "row"])


def meet(anchors: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Candidates of every anchor: block, anchor, anchor_id, score, id, row. ``anchors`` are blocks, with ``positives`` (anchor and
    score) where windows are wanted. Vectors are dealt to parts, and every block of anchors goes to every part; a task keeps the
    first rows of an anchor over the blocks of its part, so what it hands on does not grow with the part."""
    spark = anchors.sparkSession
    parts = max(1, min(SALTS, blocks.count()))
    asked = anchors.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = blocks.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))
    pairs = asked.select("salt", "dims", F.struct(*anchors.columns).alias("a")).hint("shuffle_merge").join(
        dealt.select("salt", "dims", F.struct(*blocks.columns).alias("b")), ["salt", "dims"])
    with_windows = "positives" in anchors.columns

    @common.tidy
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, key = None, None
        for batch in batches:
            for n in range(len(batch)):
                salt, block = batch.column("salt")[n].as_py(), batch.column("a")[n]["block"].as_py()
                if (salt, block) != key:
                    if best is not None:
                        yield best.found(key[1])
                    a, key = batch.column("a")[n].as_py(), (salt, block)
                    bounds = None
                    if with_windows:
                        scores = {}
                        for p in a["positives"] or ():
                            scores.setdefault(p["anchor"], []).append(p["score"])
                        bounds = [windows(scores.get(r, ())) for r in np.frombuffer(a["rows"], np.int64).tolist()]
                    best = Best(a, k, bounds)
                best.look_at(batch.column("b")[n].as_py())
        if best is not None:
            yield best.found(key[1])

    return pairs.select("salt", "a", "b").mapInArrow(search, "block long, anchor long, anchor_id long, score long, id long, row long")


def key_of(anchor: int, score: int, kind: int, id_: int, row: int) -> bytes:
    return KEY.pack(anchor + FLIP, FLIP - 1 - score, kind, id_ + FLIP, row + FLIP)


def sorted_keys(rows: DataFrame):
    """All rows (anchor, anchor_id, score, kind, id, row) as packed keys with the anchor's id; an anchor's are in one partition,
    and each partition is in the order of (anchor, falling score, positives first, id). An anchor has a bounded number of rows."""
    n = max(1, -(-rows.count() // PARTITION))
    keys = rows.rdd.map(lambda r: (key_of(r.anchor, r.score, r.kind, r.id, r.row), r.anchor_id))
    return keys.repartitionAndSortWithinPartitions(n, lambda key: zlib.crc32(key[:8]))


def first_positives(rows: Iterable[tuple[bytes, int]], k: int) -> Iterator[tuple[int, int, int, int, int]]:
    """The first k of every anchor: anchor, anchor_id, score, id, row."""
    last, n = None, 0
    for key, anchor_id in rows:
        anchor, score, _, id_, row = KEY.unpack(key)
        n = n + 1 if anchor == last else 1
        last = anchor
        if n <= k:
            yield anchor - FLIP, anchor_id, FLIP - 1 - score, id_ - FLIP, row - FLIP


def mined(rows: Iterable[tuple[bytes, int]], k: int) -> Iterator[tuple[int | None, int | None, int, int | None, int, int]]:
    """Negatives of every positive, from keys in order. A positive opens its window when it passes; a negative goes to all open
    windows; a window is closed by its k-th negative, by a score below it, or by the next anchor. Only open windows are held."""
    last, open_ = None, []
    for key, anchor_id in rows:
        anchor, score, kind, id_, _ = KEY.unpack(key)
        score, id_ = FLIP - 1 - score, id_ - FLIP
        if anchor != last:
            last, open_ = anchor, []
        if kind == POSITIVE:
            open_.append([id_, score, 0])
            continue
        open_ = [w for w in open_ if w[2] < k and 80 * w[1] <= 100 * score]
        for window in open_:
            window[2] += 1
            yield tuple(None if i == NO_ID else i for i in (anchor_id, window[0])) + (window[2], None if id_ == NO_ID else id_, window[1], score)


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5) -> DataFrame:
    """For each anchor and each of its positives, the hardest negatives: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    ``rows`` is staged and has row (a number of its own), vec_id (long), label (long) and vec (array of long); ``anchors`` are some of
    its rows. Scores are inner products, the highest first, ties by vec_id (null last), then row. Positives are the first other
    rows of the anchor's label; a positive's negatives are the first rows of other labels that score between 80 and 100 percent of it. An
    anchor without positives, and a positive whose window holds nothing, have no rows; a window below zero holds nothing.
    Rows with a null label or vec take no part, nor do vectors of another dimension than the anchor's. Repeated rows and vec_ids
    are rows of their own; only the anchor's own row is left out. Without rows or anchors the result is empty.

    Anchors meet all rows in blocks, twice: first for positives, then for what lies in the windows these open. Each task
    hands on the first rows of an anchor and window only. Packed keys (anchor, falling score, kind, id) are sorted
    within partitions by the shuffle, and one pass over a partition opens windows at positives and deals negatives to them.
    """
    spark = rows.sparkSession
    complete = F.col("vec").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0)
    narrow = [d.filter(complete).select("row", "vec_id", "label", "vec", F.size("vec").alias("dims")) for d in (rows, anchors)]
    blocks = packed(narrow[0], BLOCK, rows.count())
    asked = packed(narrow[1], ANCHORS, anchors.count())
    near = common.stage(meet(asked, blocks, positives), "near")
    kept = sorted_keys(near.withColumn("kind", F.lit(POSITIVE))).mapPartitions(lambda part: first_positives(part, positives))
    kept = common.stage(spark.createDataFrame(kept, "anchor long, anchor_id long, score long, id long, row long"), "positives")
    block = near.select("anchor", "block").distinct()  # of the anchor
    scores = kept.join(block, "anchor").groupBy("block").agg(F.collect_list(F.struct("anchor", "score")).alias("positives"))  # ANCHORS x positives at most
    far = common.stage(meet(asked.join(scores, "block"), blocks, negatives), "far")
    both = kept.withColumn("kind", F.lit(POSITIVE)).unionByName(far.drop("block").withColumn("kind", F.lit(NEGATIVE)))
    found = sorted_keys(both).mapPartitions(lambda part: mined(part, negatives))
    return spark.createDataFrame(
        found, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
