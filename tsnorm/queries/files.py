"""Queries that write a driver table as logger files and run on those."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsnorm.operators.merge import union_all
from tsnorm.plans import normalize, normalize_files
from tsnorm.queries.tables import query, rounded
from tsnorm.session import Scratch, scratch_folder
from tsnorm.sinks.store import DAY_US, SeriesStore
from tsnorm.sources.scan import CsvOptions, Readings, read_cells, read_headers

CSV = {"header": True, "escape": '"', "quoteAll": True}


def archive_files(table, per_type: bool) -> str:
    """events as archive files: one value per type and millisecond, some cells that are no time or no number."""
    at = F.date_trunc("millisecond", "ts")
    rows = table("events").groupBy("event_type", at.alias("at")).agg(F.max("value").alias("value"))
    second = F.second("at")
    rows = rows.select(
        "event_type", F.lit(1).alias("TagId"), F.concat(F.lit("tag."), "event_type").alias("TagName"),
        F.when(second == 7, F.lit("no time")).otherwise(F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSS")).alias("TimeStamp"),
        F.lit("two\nlines, one cell").alias("DataSource"),
        F.when(second == 9, F.lit("no \"number\"\n")).otherwise(F.col("value").cast("string")).alias("Value"), F.lit(128).alias("Quality"))
    folder = scratch_folder(rows.sparkSession, "archive")
    if not per_type:
        rows = rows.withColumn("TagId", F.xxhash64("event_type")).drop("event_type")
        rows.write.options(**CSV).csv(folder)
    else:
        rows.write.partitionBy("event_type").options(**CSV).csv(folder)
    return folder


@query
def csv_records(table):
    """Whole texts with line breaks and quotes, written as CSV and read back record by record."""
    docs = table("documents").select(F.col("doc_id").cast("string").alias("t"), "text")
    spark = docs.sparkSession
    folder, scratch = scratch_folder(spark, "texts"), Scratch(spark)
    docs.write.options(**CSV).csv(folder)
    headers = read_headers(spark, [folder], CsvOptions(), scratch)
    cells = read_cells(spark, headers, CsvOptions(), scratch)
    return cells.select(F.col("_c0").cast("bigint").alias("doc_id"), F.length("_c1").alias("n_chars"), F.md5("_c1").alias("digest"))


@query
def archive_run(table):
    run = normalize_files(table("events").sparkSession, "archive", archive_files(table, per_type=False), period="1H", stats="x")
    return run.long()


@query
def archive_report(table):
    """What is counted while the files of a batch are read; one of the paths does not exist."""
    spark = table("events").sparkSession
    folder = archive_files(table, per_type=True)
    paths = [f"{folder}/event_type={t}" for t in ("click", "view", "error", "gone")]
    report = normalize_files(spark, "archive", paths, per_file=True, period="1H", report=True).report()
    counts = [F.lit(v).cast("bigint").alias(n) for n, v in report.rows.items()]
    return spark.range(1).select(*counts, F.lit(len(report.missing)).alias("missing"))


@query
def batch_wide(table):
    """The wide tables of a batch, brought to one shape: each file's columns are those of its own instruments."""
    frame = table("orders").where("o_orderpriority <> '5-LOW' or o_orderstatus <> 'P'").select(
        F.col("o_orderpriority").alias("source_file"), F.col("o_orderstatus").alias("instrument"),
        F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("value"),
        F.lit(0).alias("series"), F.col("o_orderkey").alias("ord"))
    run = normalize(Readings(frame, ("source_file",), None, False), period="7D")

    def melted(wide: DataFrame) -> DataFrame:
        values = [c for c in wide.columns if c not in ("source_file", "timestamp")]
        return wide.unpivot(["source_file", "timestamp"], values, "name", "mean")

    return rounded(union_all([melted(w) for w in run.wide_files()]))


def event_store(table) -> SeriesStore:
    """Events of even number, then those of odd number appended, then clicks of high value in the place of all."""
    events = table("events").select(
        F.col("event_type").alias("instrument"), "ts", "value", F.lit(0).alias("series"), F.col("event_id").alias("ord"))
    store = SeriesStore(events.sparkSession, scratch_folder(events.sparkSession, "store"), chunk_us=7 * DAY_US)
    store.append(events.where("ord % 2 = 0"))
    store.append(events.where("ord % 2 = 1"))
    store.replace(events.where("instrument = 'click' and value > 50"))
    return store


@query
def stored_series(table):
    return event_store(table).read()


@query
def stored_summary(table):
    return event_store(table).summary()
