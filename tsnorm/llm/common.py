"""Helpers of the text operators: staged tables, text batches as arrays, hashes, bit filters."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MADE: list[tuple[SparkSession, str]] = []
# Arrow batches of these sizes at most, unless the session says otherwise: rows may hold whole texts or sets
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, a local session gets a
    temporary one; a session on a cluster must name one, as executors do not share local folders."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-stage-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder; its files are removed when the driver ends. Every operator with
    work in Python starts by staging a table, so the session's batches are bounded here."""
    for key, value in BATCHES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    _MADE.append((spark, path))
    return path


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back. This cuts the lineage, so a lost
    executor costs a re-read, and it fixes values such as row ids for all later readers. The
    files are removed when the driver ends."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.options(**({"compression": "zstd"} | options)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for spark, path in _MADE:
        try:
            remove(spark, path.rpartition("/")[0])
        except Exception:  # the session has ended; its owner clears the folder
            return


def row_id() -> Column:
    """A number for every row, to be staged before it is used twice."""
    return F.monotonically_increasing_id()


def with_row(docs: DataFrame, name: str = "row") -> DataFrame:
    """The rows with a number each, a long that is the same in every later scan: the place of its Parquet file among the
    files' names, and its place in the file. A frame that is no plain scan of Parquet files is written first."""
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    except AnalysisException:
        return with_row(stage(docs, "rows"), name)
    names = sorted(r[0] for r in placed.select("_file").distinct().collect())  # one row a file
    files = docs.sparkSession.createDataFrame(pa.table({"_file": pa.array(names, pa.string()), "_no": pa.array(range(len(names)), pa.int64())}))
    return placed.join(files, "_file").withColumn(name, F.shiftleft("_no", 40) + F.col("_index")).drop("_file", "_index", "_no")


def free_name(df: DataFrame, name: str) -> str:
    """A column name near ``name`` that the frame does not have (names differ in case only count as one)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same work on batches; at its end the memory it freed goes back to the system. Python workers
    are kept for later tasks, and what each of them holds on to adds up in an executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            release()

    return run


def release() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


# Text batches as arrays

def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``most`` bytes, at least one row each: memory follows the longest text."""
    begin, rows = 0, len(offsets) - 1
    while begin < rows:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1)
        yield begin, min(end, rows)
        begin = min(end, rows)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_table(wanted) -> np.ndarray:
    return np.array([wanted(b) for b in range(256)])


SPACED_WORD = byte_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
PLAIN_WORD = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for every row (and one more) the index of its first word."""
    inside = table[data]
    filled = offsets[1:] > offsets[:-1]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[offsets[:-1][filled]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[offsets[1:][filled] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 256), 0x9FB21C651E98DF25, np.uint64)
        steps[0] = 1
        _POWERS = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, spelled: np.ndarray = LOWER) -> np.ndarray:
    """64-bit hashes of the words, A-Z as a-z unless other bytes are given for them; equal in all batches."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    chars = spelled[data[place + np.repeat(starts, lengths)]].astype(np.uint64)
    chars += np.uint64(1)
    chars *= _powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(chars, first))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of ``k`` consecutive words, by the index of their first word; they do not heed row ends."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0xA0761D6478BD642F) + hashes[i:i + n]
    return mix(out + np.uint64(k))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def ragged(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary column whose rows are runs of an array; offsets count its elements."""
    size = values.dtype.itemsize
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets * size, np.int64)), pa.py_buffer(np.ascontiguousarray(values))],
    ).cast(pa.binary())


# A filter of fixed size: which hashes may be in a table

def bit_filter(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bits of a Bloom filter with two probes over a long column, at most ``bits / 64`` rows on
    the driver. It only saves work: what passes is joined exactly, and a full filter passes all."""
    assert bits & (bits - 1) == 0 and bits >= 64
    h, low = F.col(column), F.lit(bits - 1).cast("long")
    places = F.explode(F.array(h.bitwiseAND(low), F.shiftrightunsigned(h, 32).bitwiseAND(low)))
    rows = (
        hashes.select(places.alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint64)


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    low = np.uint64(len(bits) * 64 - 1)

    def probe(place: np.ndarray) -> np.ndarray:
        return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)

    return (probe(hashes & low) & probe((hashes >> np.uint64(32)) & low)) == 1


def filter_size(rows: int, most: int) -> int:
    """Bits for about 16 a row, a power of two up to ``most``."""
    return min(most, 1 << max(10, (16 * max(1, rows) - 1).bit_length()))


def divide(df: DataFrame, key: Column, keys: DataFrame, most: int = 1 << 27) -> tuple[DataFrame, DataFrame]:
    """Rows whose key (a long) is surely not among the keys (one long column), and all others. Only the
    others need to be shuffled to a join with what the keys stand for; wide rows without partner stay put.
    ``keys`` is read twice and should be staged."""
    bits = df.sparkSession.sparkContext.broadcast(
        bit_filter(keys, keys.columns[0], filter_size(keys.count(), most)))

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        return pd.Series(may_hold(bits.value, h.to_numpy().view(np.uint64)))

    return df.filter(~maybe(key)), df.filter(maybe(key))
