"""One ordered CSV file from parts that tasks write side by side."""

from __future__ import annotations

import codecs
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUFFER = 4 << 20


def quoted_line(spark: SparkSession, cells: Sequence[str], options: dict) -> str:
    """Cells as a line of the CSV writer."""
    row = F.struct(*[F.lit(c).alias(f"_{i}") for i, c in enumerate(cells)])
    return spark.range(1).select(F.to_csv(row, {k: v for k, v in options.items() if k in ("sep", "escape", "emptyValue")})).first()[0]


def write_one_file(ordered: DataFrame, path: str, options: dict, notice: Sequence[str] = ()) -> dict:
    """Write rows whose partitions are in order to the file ``path``, ``notice`` lines and the header on top.

    Tasks write their partitions as headless parts beside it, in parallel. A manifest then names the parts with their lengths, and
    they are joined in that order: by the file system, where it can put files together, else by copying bytes, never rows. The
    file takes its name once its length is that of the manifest, so there is the old file or the whole new one. Returns
    the manifest.
    """
    spark = ordered.sparkSession
    name = codecs.lookup(options["encoding"]).name
    wide_code = name in ("utf-16", "utf-32")  # read by a mark on top, which parts must not have
    encoding = f"{name}-be" if wide_code else name
    of_parts = {"utf-16": "UTF-16BE", "utf-32": "UTF-32"}.get(name, options["encoding"])
    lines = [*notice, quoted_line(spark, ordered.columns, options)]
    head = ("﻿" if wide_code else "").encode(encoding) + "".join(line + "\n" for line in lines).encode(encoding)

    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    target = hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    parts_at = hadoop.fs.Path(f"{path}.parts-{uuid.uuid4().hex}")
    parts_options = options | {"header": False, "encoding": of_parts}
    ordered.write.options(**parts_options).csv(parts_at.toString())

    found = sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(parts_at) if s.getPath().getName().startswith("part-"))
    manifest = {"head": len(head), "parts": [{"name": n, "length": size} for n, size in found if size]}
    _put(fs, hadoop.fs.Path(parts_at, "_manifest.json"), json.dumps(manifest).encode())

    joined = hadoop.fs.Path(parts_at, "_joined")
    out = fs.create(joined, True)
    try:
        out.write(head)
        parts = [hadoop.fs.Path(parts_at, p["name"]) for p in manifest["parts"]]
        together = fs.hasPathCapability(joined, "fs.capability.paths.concat")
        for part in () if together else parts:
            source = fs.open(part)
            try:
                hadoop.io.IOUtils.copyBytes(source, out, BUFFER, False)
            finally:
                source.close()
    finally:
        out.close()
    if together and parts:
        array = spark.sparkContext._gateway.new_array(hadoop.fs.Path, len(parts))
        for i, part in enumerate(parts):
            array[i] = part
        fs.concat(joined, array)
    want, got = len(head) + sum(p["length"] for p in manifest["parts"]), fs.getFileStatus(joined).getLen()
    if want != got:
        raise OSError(f"{joined.toString()} has {got} bytes, its manifest {want}")
    fs.delete(target, True)
    if not fs.rename(joined, target):
        raise OSError(f"{joined.toString()} could not be renamed to {path}")
    fs.delete(parts_at, True)
    return manifest


def _put(fs, path, data: bytes) -> None:
    out = fs.create(path, True)
    out.write(data)
    out.close()
