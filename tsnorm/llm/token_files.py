"""Token files: ORC with run-length coded ids, row indexes and Bloom filters on document ids."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsnorm.llm import common
from tsnorm.llm.packing import id_type
from tsnorm.llm.tokens import encode_column, gathered

FILE = "part int, doc_id long, before long, n_tokens long, ids array<int>"
OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(32 << 20),
}


def write(docs: DataFrame, path: str, tokenizer: str, end: int, options: dict[str, str] | None = None) -> None:
    """Encode whole texts and write them in ascending order of doc_id.

    Texts are encoded where they lie; what is dealt by ranges of doc_id and sorted within a task are ids, of two or four bytes each
    by the vocabulary. Each task writes one file. A file holds, for every document, its range (part), doc_id, the ids of this file
    before it, their number with the end id, and the ids; ORC codes the integers in runs, keeps an index for
    every 1,000 rows and Bloom filters on doc_id, and stripes are read in parallel. Null texts are
    empty. Rows with one doc_id stand together, those of fewer ids first; null doc_ids come first. A
    number of the row is the last key of the range, so however often a row is repeated, its copies are dealt to several tasks.
    """

    @common.tidy
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = id_type(tokenizer, end)
        for batch in gathered(batches, 1):
            ids, bounds = encode_column(tokenizer, batch.column(1), end)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(bounds)), common.binary(ids.astype(kind), bounds)], ["doc_id", "n_tokens", "ids"])

    @common.tidy
    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, kind = TaskContext.get().partitionId(), 0, id_type(tokenizer, end)
        for batch in batches:
            column = batch.column("ids").cast(pa.large_binary())
            bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
            ids = np.frombuffer(column.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]].view(kind).astype(np.int32)
            bounds = (bounds - bounds[0]) // np.dtype(kind).itemsize
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(batch), part, np.int32)), batch.column("doc_id"), pa.array(before + bounds[:-1]), batch.column("n_tokens"),
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))], ["part", "doc_id", "before", "n_tokens", "ids"])
            before += int(bounds[-1])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = common.stage(slim.mapInArrow(encode, "doc_id long, n_tokens long, ids binary"), "token_ids")
    keys = [F.col("doc_id").asc_nulls_first(), "n_tokens", F.xxhash64("ids"), "row"]
    ordered = rows.withColumn("row", common.row_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.select("doc_id", "n_tokens", "ids").mapInArrow(lists, FILE).write.options(**OPTIONS | (options or {})).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All documents of the files: FILE's columns. A filter on doc_id skips stripes and row groups."""
    return spark.read.schema(FILE).orc(path)


def with_starts(files: DataFrame) -> DataFrame:
    """Adds start, the ids of all documents before: totals of the files (one row each), summed in
    their order, plus the count within the file."""
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").toArrow()
    n = totals["n"].to_numpy()
    starts = pa.table({"part": totals["part"].cast(pa.int32()), "first": np.cumsum(n) - n if len(n) else np.zeros(0, np.int64)})
    first = files.sparkSession.createDataFrame(starts)
    return files.join(F.broadcast(first), "part").withColumn("start", F.col("first") + F.col("before")).drop("first")


def digests(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (over unsigned 32-bit little-endian ids) of every document read."""

    @common.tidy
    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            bounds = lists.offsets.to_numpy()
            raw = memoryview(lists.values.to_numpy().astype("<u4", copy=False).tobytes())
            sums = [zlib.crc32(raw[a * 4:b * 4]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    return with_starts(files).select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
