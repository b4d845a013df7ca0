"""The files of a source: which there are, in which order, and the lines each begins with."""

from __future__ import annotations

import codecs
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tsnorm.session import Scratch, Small

HEAD_BYTES = 64 << 10  # read of a file at a time until its first record is whole
MOST_HEAD_BYTES = 64 << 20  # a first record is not longer
FILES_PER_TASK = 16
FEW_FILES = 256  # looked up one by one; more are listed by a scan


class NoData(ValueError):
    """The input holds nothing to process."""


@dataclass(frozen=True)
class Files:
    """Files in the order in which they are merged.

    ``frame`` has ``file_no`` (0, 1, ... by entry, then name), ``entry`` (the place among the paths asked for),
    ``source_file`` and ``file_size``; a file two entries name is there twice. ``rows`` are its rows where they are
    few. ``roots`` are the files and folders to scan, ``missing`` the paths that do not exist.
    """

    frame: DataFrame
    rows: list[dict] | None
    roots: list[str]
    missing: list[str]
    n: int
    smallest: int
    largest: int
    total: int
    scratch: Scratch


def list_files(spark: SparkSession, paths: Sequence[str], scratch: Scratch, skip_missing: bool = False) -> Files:
    """All files of ``paths``, each a file, a folder or a pattern.

    Paths are looked up in their file systems, which tells all there is to know of a few single files. Else one scan of
    names and sizes lists everything, and a join on the folders above each file tells its entries. There
    is no plan or job for a single path.
    """
    path_class = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    found, missing = [], []
    for entry, text in enumerate(paths):
        path = path_class(text)
        statuses = path.getFileSystem(conf).globStatus(path)
        if not statuses:
            missing.append(text)
            continue
        found.extend((entry, status.getPath().toString(), status) for status in statuses)
    if missing and not skip_missing:
        raise FileNotFoundError(f"{len(missing)} of {len(paths)} paths do not exist: {', '.join(missing[:20])}")
    if not found:
        raise NoData("no data found: none of the paths exists")
    roots = sorted({name for _, name, _ in found})
    if len(found) <= FEW_FILES and all(status.isFile() for _, _, status in found):
        # a path without a host has one slash in what Spark tells of a row's file
        rows = sorted({(entry, status.getPath().toUri().toString().replace(":///", ":/", 1), status.getLen()) for entry, _, status in found})
        rows = pa.table({
            "file_no": pa.array(range(len(rows)), pa.int32()), "entry": pa.array([r[0] for r in rows], pa.int32()),
            "source_file": [r[1] for r in rows], "file_size": pa.array([r[2] for r in rows], pa.int64())})
        frame, rows = spark.createDataFrame(rows), rows.to_pylist()
    else:
        small = Small(_listed(spark, roots, [(entry, name) for entry, name, _ in found]), scratch, "files")
        frame, rows = small.frame, small.rows
    if rows is not None:
        sizes = [r["file_size"] for r in rows]
        totals = len(sizes), min(sizes, default=0), max(sizes, default=0), sum(sizes)
    else:
        totals = frame.agg(F.count("*"), F.min("file_size"), F.max("file_size"), F.sum("file_size")).first()
    return Files(frame, rows, roots, missing, *totals, scratch)


def _listed(spark: SparkSession, roots: list[str], entries: list[tuple[int, str]]) -> DataFrame:
    # the bytes of a file are a column of this source that is not asked for
    listed = spark.read.format("binaryFile").load(roots).select(
        F.split("path", "/").alias("parts"), F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_size").alias("file_size"))
    above = F.transform(F.sequence(F.lit(1), F.size("parts")), lambda i: F.array_join(F.slice("parts", 1, i), "/"))
    named = spark.createDataFrame(pa.table({"entry": pa.array([e for e, _ in entries], pa.int32()), "root": [r for _, r in entries]}))
    frame = listed.select("source_file", "file_size", F.explode(above).alias("root")).join(named, "root")
    frame = frame.select("entry", "source_file", "file_size").distinct()
    # one row a file, never a row of one
    place = F.row_number().over(Window.orderBy("entry", "source_file")) - 1
    return frame.select(place.alias("file_no"), "entry", "source_file", "file_size")


def head_lines(files: Files, encoding: str) -> DataFrame:
    """``file_no, entry, source_file, lines``: the first lines of every file that are not blank, up to one after which the quotes so far
    are paired.

    Tasks take a few files each and read only their beginnings, so the bytes read do not depend on the sizes of the files.
    ``lines`` is NULL for files in a store that Python cannot open, and empty for files without a line.
    """

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [read_head(url, encoding) for url in batch.column("source_file").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lines, pa.list_(pa.string()))], ["file_no", "entry", "source_file", "lines"])

    asked = files.frame.select("file_no", "entry", "source_file")
    if files.rows is None:  # else they are dealt to all cores already
        asked = asked.repartition(-(-files.n // FILES_PER_TASK))
    return asked.mapInArrow(heads, "file_no int, entry int, source_file string, lines array<string>")


def read_head(url: str, encoding: str) -> list[str] | None:
    try:
        if url.startswith("file:"):
            system, path = pyarrow.fs.LocalFileSystem(), "/" + unquote(url[5:]).lstrip("/")
        else:
            system, path = pyarrow.fs.FileSystem.from_uri(url)
        source = system.open_input_stream(path)
    except (OSError, ValueError, NotImplementedError):
        return None
    decoder = codecs.getincrementaldecoder(encoding)(errors="replace")
    text, size = "", 0
    with source:
        while True:
            data = source.read(HEAD_BYTES)
            size += len(data)
            text += decoder.decode(data, final=not data)
            lines = whole_head(text, ended=not data)
            if lines is not None:
                return lines
            if size > MOST_HEAD_BYTES:
                raise ValueError(f"{url}: its first record is longer than {MOST_HEAD_BYTES} bytes")


def whole_head(text: str, ended: bool) -> list[str] | None:
    """Lines up to one after which quotes are paired; None if more text is needed for that."""
    out, quotes = [], 0
    lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    for line in lines if ended else lines[:-1]:
        if out or line.strip("﻿ \t\0"):
            out.append(line)
            quotes += line.count('"')
            if quotes % 2 == 0:
                return out
    return out if ended else None
