"""Wide CSV of one data set; long CSV per source file of many."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsnorm.functions.times import DEFAULT_FORMATS, format_ts
from tsnorm.plans.normalize import Aligned
from tsnorm.session import remove_path
from tsnorm.sinks.one_file import write_one_file


def _options(sep: str, encoding: str) -> dict:
    return {"header": True, "sep": sep, "encoding": encoding.replace("_", "-"), "escape": '"', "emptyValue": ""}


def write_wide(
    wide: DataFrame,
    path: str,
    *,
    sep: str = ",",
    encoding: str = "utf_8",
    time_format: str = DEFAULT_FORMATS["normalized"],
    notice: Sequence[str] = (),
    single_file: bool = False,
    time_ordered: bool = False,
) -> None:
    """Folder of CSV parts in time order, each with a header; an existing one is overwritten.

    ``notice`` lines go to a text folder ``<path>.notice``, so that the parts stay readable as
    input; one of an earlier run is removed. With ``single_file`` the path is one file, the notice above its header; it is
    still written in parts, which are joined. With ``time_ordered`` the partitions are in time order already, as those of a
    run are, and rows are sorted where they are.
    """
    ordered = wide.sortWithinPartitions("timestamp") if time_ordered else wide.orderBy("timestamp")
    shown = ordered.withColumn("timestamp", format_ts(F.col("timestamp"), time_format))
    options = _options(sep, encoding)
    beside = f"{path}.notice"
    if single_file:
        write_one_file(shown, path, options, notice)
        notice = ()
    else:
        shown.write.mode("overwrite").options(**options).csv(path)
    spark = wide.sparkSession
    if notice:
        lines = spark.createDataFrame([(line,) for line in notice], "value string")
        lines.coalesce(1).write.mode("overwrite").text(beside)
    else:
        remove_path(spark, beside)


def export_name(source_file):
    """Folder value of a source file: its base name without extension, plus ``_ForExport``."""
    name = F.regexp_replace(F.regexp_extract(source_file, r"([^/]*)$", 1), r"\.[^.]*$", "")
    return F.concat(name, F.lit("_ForExport"))


def check_names(files: DataFrame) -> None:
    """Refuse source files that would share a folder; ``files`` has one row or more per source file."""
    clashing = (
        files.select("source_file").distinct().groupBy(export_name(F.col("source_file")).alias("name"))
        .agg(F.count("*").alias("n"), F.min("source_file").alias("first"), F.max("source_file").alias("last")).where("n > 1"))
    shown = clashing.orderBy("name").limit(20).collect()
    if shown:
        listed = "; ".join(f"{r['name']}: {r['n']} files, such as {r['first']} and {r['last']}" for r in shown)
        raise ValueError(f"{clashing.count()} folder names would hold several source files: {listed}")


def write_files(
    long: DataFrame,
    path: str,
    *,
    files: DataFrame | None = None,
    sep: str = ",",
    encoding: str = "utf_8",
    time_format: str = DEFAULT_FORMATS["normalized"],
) -> None:
    """One folder ``source_file=<name>_ForExport`` per source file under ``path``.

    Rows are rebalanced by source file, which splits a big file over tasks and packs small
    ones, and sorted by time and instrument in each part. Files of one base name in several
    folders would be mixed, so they are refused before anything is written. ``files`` is a small
    table with the source files, such as ``instruments`` of a run; without it, ``long`` is gone
    through once more for them.
    """
    check_names(long if files is None else files)
    shown = long.withColumn("source_file", export_name(F.col("source_file")))
    parts = shown.hint("rebalance", F.col("source_file"))
    parts = parts.sortWithinPartitions("source_file", "timestamp", "instrument")
    parts = parts.withColumn("timestamp", format_ts(F.col("timestamp"), time_format))
    parts.write.mode("overwrite").partitionBy("source_file").options(**_options(sep, encoding)).csv(path)


def write_run(
    run: Aligned,
    path: str,
    *,
    sep: str = ",",
    encoding: str = "utf_8",
    time_format: str | None = None,
    notice: Sequence[str] = (),
    single_file: bool = False,
) -> None:
    """Write a run as wide CSV, times as in its source unless a format is given.

    One data set: as :func:`write_wide`. A batch: a folder ``source_file=<name>_ForExport`` per source file under ``path``,
    with that file's columns, parts in time order. Files of equal columns are pivoted and written together, so there
    are as many writes as there are sets of columns. Files of one base name are refused before anything is written.
    """
    if time_format is None:
        time_format = run.time_format or DEFAULT_FORMATS["normalized"]
    if not run.keys:
        write_wide(
            run.wide(), path, sep=sep, encoding=encoding, time_format=time_format, notice=notice, single_file=single_file, time_ordered=True)
        return
    if notice or single_file:
        raise ValueError("notice and single_file are for one data set")
    check_names(run.instruments)
    remove_path(run.instruments.sparkSession, path)
    for frame in run.wide_files():
        parts = frame.withColumn("source_file", export_name(F.col("source_file"))).sortWithinPartitions("source_file", "timestamp")
        parts = parts.withColumn("timestamp", format_ts(F.col("timestamp"), time_format))
        parts.write.mode("append").partitionBy("source_file").options(**_options(sep, encoding)).csv(path)
