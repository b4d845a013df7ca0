"""Historical-trend layout: independent (time, value) column pairs, one per tag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tsnorm.functions.names import sanitize_name, trend_name
from tsnorm.functions.times import DEFAULT_FORMATS, parse_ts, round_ms
from tsnorm.functions.values import lenient_double
from tsnorm.session import Scratch, Small
from tsnorm.sources.scan import (
    CsvOptions,
    NoData,
    Readings,
    Source,
    header_cells,
    observed,
    one_layout,
    read_cells,
    read_headers,
    series_count,
    value_columns,
)


def trend_unpivot(
    rows: DataFrame, id_columns: Sequence[str | Column], pairs: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """Column pairs to long: one row per (instrument, time column, value column) given."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(i).alias("series"), F.lit(name).alias("instrument"),
                 F.col(t).alias("ts"), F.col(v).alias("value"))
        for i, (name, t, v) in enumerate(pairs)
    ])).alias("cell")
    return rows.select(*id_columns, cells).select(*id_columns, "cell.*").where("ts is not null")


def read_trend(
    spark: SparkSession, paths: Sequence[str], opts: CsvOptions, per_file: bool, scratch: Scratch, parsed: Observation | None = None
) -> Readings:
    headers = read_headers(spark, paths, opts, scratch, per_file)
    pairs = headers.frame.select("file_no", "source_file", "width", F.posexplode("names").alias("pos", "raw")).where(
        "raw is not null and pos % 2 = 0 and pos + 1 < width"
    )
    pairs = pairs.withColumn("instrument", sanitize_name(trend_name(F.col("raw")))).drop("width")
    cols = Small(value_columns(pairs, per_file, by_name=False), scratch, "columns")
    if cols.rows is not None and not cols.rows:
        raise NoData("no data found: no file with a time and a value column")

    fmt = opts.time_format or DEFAULT_FORMATS["trend"]
    keys = ("source_file",) if per_file else ()
    ids = ["source_file", "block", "row"]
    n_series = series_count(cols)
    cells = read_cells(spark, headers, opts, scratch)
    shared = one_layout(cols)
    if shared is not None:
        long = trend_unpivot(
            cells, ids, [(c["instrument"], f"_c{c['pos']}", f"_c{c['pos'] + 1}") for c in shared]
        ).withColumn("series", F.get(F.array(*[F.lit(c["series"]) for c in shared]), F.col("series")))
    else:
        named = cells.join(cols.frame.select("source_file", "cols"), "source_file")
        row = F.array(*[F.col(f"_c{i}") for i in range(headers.width)])
        picked = F.transform("cols", lambda c: F.struct(
            c["series"].alias("series"), c["instrument"].alias("instrument"),
            F.get(F.col("cells"), c["pos"]).alias("ts"), F.get(F.col("cells"), c["pos"] + 1).alias("value")))
        long = named.withColumn("cells", row).select(*ids, F.explode(picked).alias("cell")).select(
            *ids, "cell.*").where("ts is not null")
    # parsed below the explode: one expression, not one per pair
    long = long.select(
        *keys, "instrument",
        round_ms(parse_ts(F.col("ts"), fmt), F.col("ts")).alias("ts"),
        lenient_double(F.col("value")).alias("value"),
        *([F.col("ts").alias("time"), F.col("value").alias("number")] if parsed is not None else []),
        "series",
        # a series is one pair of one file, so the place in the file decides within it
        headers.order.of(False, F.col("series"), n_series).alias("ord"),
    )
    long = observed(long, parsed, F.expr("time is not null and ts is null"), F.expr("number is not null and value is null"))
    out = long.where("ts is not null and value is not null").drop("time", "number")
    instruments = cols.frame.select(*keys, F.explode("cols.instrument").alias("instrument")).distinct()
    return Readings(out, keys, instruments, False, source=Source(headers.files, fmt, header_cells(headers.frame), parsed))
