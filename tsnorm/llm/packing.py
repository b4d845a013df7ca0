"""Packing of token streams: concatenate all documents and cut windows of a fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsnorm.llm import common
from tsnorm.llm.tokens import encode_column, gathered, loaded

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, `offset` long"
STAGED = "doc_id long, ids binary, doc_tokens long, part int, before long"


def tokenized(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """First pass: ids of every document (two or four bytes each, by the vocabulary), and how many
    ids its task has before it. Staged, so that both are fixed for the second pass."""

    @common.tidy
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        kind = id_type(tokenizer, end)
        for batch in gathered(batches, 1):
            ids, bounds = encode_column(tokenizer, batch.column(1), end)
            counts = np.diff(bounds)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), common.binary(ids.astype(kind), bounds), pa.array(counts), pa.array(np.full(len(batch), part, np.int32)),
                pa.array(before + bounds[:-1])], ["doc_id", "ids", "doc_tokens", "part", "before"])
            before += int(bounds[-1])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return common.stage(slim.mapInArrow(encode, STAGED), "token_ids")


def id_type(tokenizer: str, end: int) -> type:
    return np.uint16 if max(loaded(tokenizer).tokenizer.get_vocab_size(), end + 1) <= 1 << 16 else np.uint32


def pack(docs: DataFrame, tokenizer: str, length: int = 1024, end: int = 0) -> DataFrame:
    """Pieces of all documents in sequences of ``length`` ids; only the last sequence can be shorter.

    Two passes. The first one encodes and stages every document with the ids its task has before
    it; the totals of the tasks (one row for each) are summed up to offsets. The second one cuts
    every document where its place in the whole stream crosses a multiple of ``length``. Nothing
    is shuffled but the totals, and a document of any length or a task of any size is only cut.

    Columns: doc_id; start (ids of the document before the piece); length; ids (binary, unsigned
    32-bit little-endian); doc_tokens (with the end id); sequence_id; offset (in the sequence).
    Null and empty texts are the end id alone. Repeated rows and doc_ids are packed as often as
    they occur; null doc_ids are kept. Other columns are not carried. Without rows there are no pieces.
    """
    staged = tokenized(docs, tokenizer, end)
    totals = staged.groupBy("part").agg(F.sum("doc_tokens").alias("n")).toArrow()  # one row a task
    order = np.argsort(totals["part"].to_numpy())
    parts, counts = totals["part"].to_numpy()[order], totals["n"].to_numpy()[order]
    offsets = dict(zip(parts.tolist(), np.concatenate(([0], np.cumsum(counts)[:-1])).tolist(), strict=True)) if len(parts) else {}
    shared = docs.sparkSession.sparkContext.broadcast(offsets)

    @common.tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = id_type(tokenizer, end)
        for batch in batches:
            size = np.frombuffer(batch.column("ids").cast(pa.large_binary()).buffers()[1], np.int64)
            base = batch.column("ids").offset
            bounds = size[base:base + len(batch) + 1] // np.dtype(kind).itemsize
            for lo, hi in common.slices(bounds, 1 << 20):
                yield pieces(batch.slice(lo, hi - lo), shared.value, kind, length)

    return staged.mapInArrow(cut, PIECES)


def pieces(batch: pa.RecordBatch, offsets: dict[int, int], kind: type, length: int) -> pa.RecordBatch:
    """Cuts of the documents of a batch at the multiples of ``length`` in the whole stream."""
    column = batch.column("ids").cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    ids = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0]:bounds[-1]].view(kind).astype("<u4")
    counts = batch.column("doc_tokens").to_numpy()
    first = batch.column("before").to_numpy() + np.array([offsets[p] for p in batch.column("part").to_pylist()], np.int64)
    n = (first + counts - 1) // length - first // length + 1  # every document holds its end id
    row = np.repeat(np.arange(len(batch)), n)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    sequence = first[row] // length + nth
    begin = np.maximum(first[row], sequence * length)
    size = np.minimum(first[row] + counts[row], (sequence + 1) * length) - begin
    ends = np.concatenate(([0], np.cumsum(size)))
    return pa.RecordBatch.from_arrays([
        batch.column("doc_id").take(pa.array(row)), pa.array(begin - first[row]), pa.array(size),
        common.binary(ids, ends), pa.array(counts[row]), pa.array(sequence), pa.array(begin - sequence * length),
    ], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences that the pieces make: sequence_id, ids (binary as in the pieces), n_ids,
    boundaries (doc_id, start and offset of every piece, in order). A group is one sequence, at
    most its length in ids."""
    piece = F.struct("offset", "doc_id", "start", "ids")
    at = F.array_sort(F.collect_list(piece))
    return (
        packed.groupBy("sequence_id").agg(at.alias("at"), F.sum("length").alias("n_ids"))
        .select(
            "sequence_id", F.aggregate("at", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"), "n_ids",
            F.transform("at", lambda x: F.struct(x["doc_id"], x["start"], x["offset"])).alias("boundaries"),
        )
    )
