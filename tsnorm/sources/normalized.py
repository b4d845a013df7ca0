"""Time-normalized layout: a time column, a bias column and one column per instrument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tsnorm.functions.names import BIAS_NAMES, sanitize_name
from tsnorm.functions.times import DEFAULT_FORMATS, parse_ts, round_ms
from tsnorm.functions.values import lenient_double
from tsnorm.operators.dedupe import last_wins
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
    reject_duplicates,
    value_columns,
    without_duplicates,
)


def wide_unpivot(
    rows: DataFrame, id_columns: Sequence[str | Column], values: Sequence[tuple[str, str]]
) -> DataFrame:
    """Wide rows to long: one row per (source column, instrument) pair given, missing cells dropped."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(name).alias("instrument"), F.col(column).cast("double").alias("value"))
        for column, name in values
        if name not in BIAS_NAMES
    ])).alias("cell")
    return rows.select(*id_columns, cells).select(*id_columns, "cell.*").where("value is not null")


def explode_values(rows: DataFrame, cols: Small, id_columns: Sequence[str]) -> DataFrame:
    """Rows with a ``vals`` array to one row per value: ``instrument, series, value``.

    When all files share their columns the names are literals and ``vals`` holds
    just those; otherwise names are joined by file and ``vals`` holds every cell. ``id_columns`` have ``file_no``, or the
    ``source_file`` where no file is there twice.
    """
    shared = one_layout(cols)
    if shared is not None:
        names = F.array(*[F.lit(c["instrument"]) for c in shared])
        series = F.array(*[F.lit(c["series"]) for c in shared])
        return rows.select(*id_columns, F.posexplode("vals").alias("at", "value")).where(
            "value is not null"
        ).select(
            *id_columns,
            F.get(names, F.col("at")).alias("instrument"),
            F.get(series, F.col("at")).alias("series"),
            "value",
        )
    by = "file_no" if "file_no" in id_columns else "source_file"
    named = rows.join(cols.frame.select(by, "cols"), by)
    cells = F.transform("cols", lambda c: F.struct(
        c["instrument"].alias("instrument"), c["series"].alias("series"),
        F.get(F.col("vals"), c["pos"]).alias("value")))
    return named.select(*id_columns, F.explode(cells).alias("cell")).select(
        *id_columns, "cell.*").where("value is not null")


def value_array(cols: Small, width: int) -> Column:
    """The number cells of a row that :func:`explode_values` expects."""
    shared = one_layout(cols)
    places = [c["pos"] for c in shared] if shared is not None else range(width)
    return F.array(*[lenient_double(F.col(f"_c{p}")) for p in places])


def with_bad_cells(rows: DataFrame, cols: Small, width: int, by: str) -> DataFrame:
    """Adds ``bad_cells``, how many of a row's value cells are neither empty nor a number."""
    shared = one_layout(cols)
    if shared is not None:
        places = F.array(*[F.lit(c["pos"]) for c in shared])
        rows = rows.withColumn("_places", places)
    else:
        rows = rows.join(cols.frame.select(by, F.col("cols.pos").alias("_places")), by, "left")
    cells = F.array(*[F.col(f"_c{i}") for i in range(width)])

    def bad(place: Column) -> Column:
        cell = F.get(cells, place)
        return cell.isNotNull() & lenient_double(cell).isNull()

    return rows.withColumn("bad_cells", F.coalesce(F.size(F.filter("_places", bad)), F.lit(0))).drop("_places")


def no_name_twice(cols: Small) -> bool:
    """No file has two columns for one instrument."""
    return cols.rows is not None and all(
        len({c["instrument"] for c in r["cols"]}) == len(r["cols"]) for r in cols.rows
    )


def read_normalized(
    spark: SparkSession, paths: Sequence[str], opts: CsvOptions, per_file: bool, scratch: Scratch, parsed: Observation | None = None
) -> Readings:
    headers = read_headers(spark, paths, opts, scratch, per_file)
    frame = headers.frame
    if per_file:
        frame = without_duplicates(headers)
    else:
        reject_duplicates(headers)
    cells = frame.select("file_no", "source_file", F.posexplode("names").alias("pos", "raw")).where(
        F.col("raw").isNotNull() & ~F.col("raw").isin(BIAS_NAMES) & (F.col("pos") > 0)
    )
    cells = cells.withColumn("instrument", sanitize_name(F.col("raw")))
    cols = Small(value_columns(cells, per_file, by_name=True), scratch, "columns")
    if cols.rows is not None and not cols.rows:
        raise NoData("no data found: no file with a time and an instrument column")

    fmt = opts.time_format or DEFAULT_FORMATS["normalized"]
    keys = ("source_file",) if per_file else ()
    merged = not per_file and headers.files.n > 1
    cells = read_cells(spark, headers, opts, scratch)
    if merged:
        cells = cells.join(headers.frame.select("file_no", "source_file"), "source_file")
    elif per_file and (cols.rows is None or len(cols.rows) < headers.files.n):
        cells = cells.join(cols.frame.select("source_file"), "source_file", "left_semi")
    file = "file_no" if merged else "source_file"
    if parsed is not None:
        cells = with_bad_cells(cells, cols, headers.width, file)
        cells = observed(cells, parsed, F.col("_c0").isNotNull() & parse_ts(F.col("_c0"), fmt).isNull(), F.col("bad_cells"))
    rows = cells.select(
        file,
        round_ms(parse_ts(F.col("_c0"), fmt), F.col("_c0")).alias("ts"),
        value_array(cols, headers.width).alias("vals"),
        headers.order.of(False).alias("ord"),
    )
    # the last row of a time replaces earlier rows of its file as a whole
    rows = last_wins(rows.where("ts is not null"), [file, "ts"], ["vals"], F.col("ord"))
    long = explode_values(rows, cols, [file, "ts"])
    order = F.col("series").cast("bigint")
    if merged:
        order = order * headers.files.n + F.col("file_no")
    out = long.select(*keys, "instrument", "ts", "value", "series", order.alias("ord"))
    instruments = cols.frame.select(*keys, F.explode("cols.instrument").alias("instrument")).distinct()
    return Readings(out, keys, instruments, not merged and no_name_twice(cols),
                    source=Source(headers.files, fmt, header_cells(headers.frame), parsed))
