"""Stored series: readings in chunks of time, of which an append or a replacement rewrites only those it touches."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tsnorm.functions.times import floor_us
from tsnorm.operators.dedupe import append_series, last_wins
from tsnorm.operators.period import min_gap
from tsnorm.session import Scratch, remove_path

DAY_US = 86_400_000_000
ROWS = "instrument string, ts timestamp, value double, version string, chunk bigint"
STATES = "instrument string, chunk bigint, version string, n bigint, first_us bigint, last_us bigint, gap_us bigint"


class Stale(RuntimeError):
    """The store has changed since it was opened."""


class SeriesStore:
    """One value per instrument and time under ``path``.

    Rows lie in ``data/version=.../chunk=...``, a chunk being a span of time of all instruments. A manifest, numbered anew with every change,
    has a row for each instrument and chunk: the version that holds it, and its number of values, first and last time and least gap. Files are
    never changed: a change writes its chunks under a version of its own, then a manifest that names them, so readers see all
    of it or none, and an executor lost on the way leaves the store as it was. :meth:`vacuum` removes versions that no manifest names.
    """

    def __init__(self, spark: SparkSession, path: str, chunk_us: int = DAY_US):
        self.spark, self.path, self.chunk_us = spark, path.rstrip("/"), chunk_us

    def manifests(self) -> list[int]:
        """Numbers of the whole manifests; a folder without the mark of its end is that of a failed change."""
        path_class = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        pattern = path_class(f"{self.path}/manifests/*/_SUCCESS")
        found = pattern.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).globStatus(pattern) or ()
        names = (re.search(r"/manifests/(\d+)/_SUCCESS$", s.getPath().toString()) for s in found)
        return sorted(int(n[1]) for n in names if n)

    def states(self, number: int | None = None) -> DataFrame:
        """The manifest of that number, or the last one: one row for each instrument and chunk. There is nothing before number 0."""
        if number is None:
            number = self._last()
        if number < 0:
            return self.spark.createDataFrame([], STATES)
        return self.spark.read.schema(STATES).parquet(f"{self.path}/manifests/{number}")

    def _last(self) -> int:
        return (self.manifests() or [-1])[-1]

    def _rows(self, number: int, chunks: DataFrame | None = None) -> DataFrame:
        """Rows with their chunk, of all chunks or of those given; folders of others are not read."""
        if number < 0:
            return self.spark.createDataFrame([], ROWS).drop("version")
        held = self.states(number).select("version", "chunk").distinct()
        if chunks is not None:
            held = held.join(chunks, "chunk", "left_semi")
        rows = self.spark.read.schema(ROWS).parquet(f"{self.path}/data")
        return rows.join(held, ["version", "chunk"], "left_semi").select("instrument", "ts", "value", "chunk")

    def read(self) -> DataFrame:
        """All readings: ``instrument, ts, value``."""
        return self._rows(self._last()).drop("chunk")

    def append(self, readings: DataFrame) -> int:
        """Add readings (``instrument, ts, value, series, ord``); where there is a value of one time, the new one takes its place.
        Returns the number of chunks written."""
        return self._change(readings, replace=False)

    def replace(self, readings: DataFrame) -> int:
        """Put readings in the place of all there are of the instruments that occur in them. Returns the number of chunks written."""
        return self._change(readings, replace=True)

    def _change(self, readings: DataFrame, replace: bool) -> int:
        scratch = Scratch(self.spark)
        try:
            number = self._last()
            us = F.unix_micros("ts")
            new = append_series(readings).withColumn("chunk", floor_us(us, self.chunk_us))
            new = scratch.table(new.select("instrument", "ts", "value", "chunk"), "new")
            named = new.select("instrument").distinct()
            chunks = new.select("chunk")
            if replace:
                chunks = chunks.unionByName(self.states(number).join(named, "instrument", "left_semi").select("chunk"))
            chunks = scratch.table(chunks.distinct(), "chunks")
            old = self._rows(number, chunks)
            if replace:
                merged = old.join(named, "instrument", "left_anti").unionByName(new)
            else:
                both = old.withColumn("ord", F.lit(0)).unionByName(new.withColumn("ord", F.lit(1)))
                merged = last_wins(both, ["instrument", "ts", "chunk"], ["value"], F.col("ord"))
            version = uuid.uuid4().hex
            # a chunk is one task's work unless it is large; then it is split
            spread = merged.select("instrument", "ts", "value", "chunk").hint("rebalance", F.col("chunk"))
            spread.sortWithinPartitions("chunk", "instrument", "ts").write.partitionBy("chunk").parquet(f"{self.path}/data/version={version}")

            written = self.spark.read.schema("instrument string, ts timestamp, value double, chunk bigint").parquet(
                f"{self.path}/data/version={version}")
            at = ["instrument", "chunk"]
            totals = written.groupBy(*at).agg(F.count("value").alias("n"), F.min(us).alias("first_us"), F.max(us).alias("last_us"))
            gaps = min_gap(written.select(*at, us.alias("us")).withColumnRenamed("chunk", "span"), ["instrument", "span"])
            fresh = totals.join(gaps.withColumnRenamed("span", "chunk"), at, "left").withColumn("version", F.lit(version))
            kept = self.states(number).join(chunks, "chunk", "left_anti")
            columns = [c.split(" ")[0] for c in STATES.split(", ")]
            every = kept.select(columns).unionByName(fresh.select(columns))
            if self._last() != number:
                raise Stale(f"{self.path} was changed by another writer; try again")
            every.write.parquet(f"{self.path}/manifests/{number + 1}")
            return chunks.count()
        finally:
            scratch.close()

    def summary(self) -> DataFrame:
        """Every instrument with its first and last time, number of values and sample period (the smallest gap between two of its times),
        from the manifest alone: ``instrument, start_ts, end_ts, n, period_us``."""
        by_time = Window.partitionBy("instrument").orderBy("chunk")
        across = F.col("first_us") - F.lag("last_us").over(by_time)
        rows = self.states().withColumn("gap_us", F.least("gap_us", across))
        return rows.groupBy("instrument").agg(
            F.timestamp_micros(F.min("first_us")).alias("start_ts"), F.timestamp_micros(F.max("last_us")).alias("end_ts"),
            F.sum("n").alias("n"), F.min("gap_us").alias("period_us"))

    def vacuum(self) -> list[str]:
        """Remove all manifests but the last and the versions it does not name. No reader or writer may be at work."""
        numbers = self.manifests()
        if not numbers:
            return []
        named = {r.version for r in self.states(numbers[-1]).select("version").distinct().collect()}  # one row a change
        path_class = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        pattern = path_class(f"{self.path}/data/version=*")
        found = pattern.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).globStatus(pattern) or ()
        gone = [v for v in (s.getPath().getName().removeprefix("version=") for s in found) if v not in named]
        for v in gone:
            remove_path(self.spark, f"{self.path}/data/version={v}")
        for n in numbers[:-1]:
            remove_path(self.spark, f"{self.path}/manifests/{n}")
        return gone
