"""Session settings, scratch tables and size-checked small tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from copy import copy

from pyspark.sql import Column, DataFrame, SparkSession

# Settings the engine wants; everything else is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # instrument names that differ only in case are different instruments
    "spark.sql.caseSensitive": "true",
}

# A table of at most this many rows is handed on as a literal relation (and may be broadcast).
SMALL_ROWS = 20_000


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def require_utc(spark: SparkSession) -> None:
    """Logger times carry no zone; periods are counted on UTC wall clocks."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC (it is {zone})")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, named by ``spark.checkpoint.dir``. A local session may
    leave it unset and gets a temporary one; on a cluster executors could not see that."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tsnorm-scratch-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A place of its own in the shared folder."""
    return f"{scratch_root(spark)}/tsnorm-{uuid.uuid4().hex}/{name}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if there is one."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


class Scratch:
    """Intermediate parquet tables of one run, removed together by :meth:`close`.

    Writing a table cuts the lineage: a lost executor later costs a re-read of the table, not
    a second pass over the source.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._path: str | None = None

    def table(self, df: DataFrame, name: str) -> DataFrame:
        if self._path is None:
            self._path = f"{scratch_root(self._spark)}/tsnorm-{uuid.uuid4().hex}"
        target = f"{self._path}/{name}"
        df.write.parquet(target)
        return self._spark.read.schema(df.schema).parquet(target)

    def close(self) -> None:
        if self._path is not None:
            remove_path(self._spark, self._path)
            self._path = None


class Small:
    """A table expected to be small, computed once.

    Up to ``limit`` rows it becomes a literal relation with its rows on the driver, small enough
    for the planner to broadcast. Beyond that it is a scratch table, ``rows`` is None and joins
    with it are shuffled.
    """

    def __init__(self, df: DataFrame, scratch: Scratch, name: str, limit: int = SMALL_ROWS):
        head = df.limit(limit + 1).toArrow()
        if head.num_rows <= limit:
            self.rows = head.to_pylist()
            self.frame = df.sparkSession.createDataFrame(head, df.schema)
        else:
            self.rows = None
            self.frame = scratch.table(df, name)

    def where(self, keep: Callable[[dict], bool], condition: Column) -> Small:
        """Some of the rows, told twice: for those on the driver and for the frame."""
        out = copy(self)
        out.rows = None if self.rows is None else [r for r in self.rows if keep(r)]
        out.frame = self.frame.where(condition)
        return out

    def extended(self, name: str, kind: str, value: Callable[[dict], object], column: Column) -> Small:
        """With a further column, told twice like the rows of :meth:`where`."""
        out = copy(self)
        out.rows = None if self.rows is None else [r | {name: value(r)} for r in self.rows]
        out.frame = self.frame.withColumn(name, column.cast(kind))
        return out
