"""Strain-gauge layout: a preamble with start time, tag names and units above a wide table.

The cell ``ID`` is the anchor: data lies below its row and from two columns right of it,
preamble labels lie in its column. Rows above and columns left of that are junk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tsnorm.functions.names import sanitize_name, unit_label
from tsnorm.functions.times import DEFAULT_FORMATS, elapsed_to_ts, elapsed_unit_us, infer_ts, round_ms
from tsnorm.session import Scratch, Small
from tsnorm.sources.files import list_files
from tsnorm.sources.normalized import explode_values, value_array, with_bad_cells
from tsnorm.sources.scan import (
    CsvOptions,
    DuplicateColumns,
    NoData,
    Readings,
    Source,
    observed,
    RowOrder,
    field_count,
    parse_lines,
    scan_records,
    series_count,
    value_columns,
)

# The labels of the preamble.
ANCHOR = "ID"
START_LABEL = "Start Time:"
NAMES_LABEL = "Assignment:"
UNITS_LABEL = "Reduction Method:"
ELAPSED_LABEL = "Elapsed"

PROBLEMS = {
    "id_col": f"no cell equal to {ANCHOR!r}",
    "start_us": f"no valid {START_LABEL!r} cell",
    "tags": f"no {NAMES_LABEL!r} row",
    "units": f"no {UNITS_LABEL!r} row",
    "unit_us": f"no {ELAPSED_LABEL!r} column with a known time unit",
}


def _starts(cell: Column, label: str) -> Column:
    return F.startswith(F.lower(cell), F.lit(label.lower()))


def labelled() -> Column:
    """Lines that contain the anchor or a label."""
    marked = F.col("line").contains(ANCHOR)
    for label in (START_LABEL, NAMES_LABEL, UNITS_LABEL, ELAPSED_LABEL):
        marked = marked | F.lower("line").contains(label.lower())
    return marked


def read_preambles(lines: DataFrame, opts: CsvOptions, width: int) -> DataFrame:
    """One row per file: anchor position, start time, elapsed unit, tag names and units.

    Only lines that contain one of the labels are parsed, a handful per file.
    """
    cells = F.array(*[F.col(f"_c{i}") for i in range(width)])
    at = F.struct("block", "row")
    rows = parse_lines(lines.where(labelled()), opts, width)
    # a generator again, so that the array is built once per row
    rows = rows.select("source_file", at.alias("at"), F.explode(F.array(cells)).alias("cells"))

    found = rows.withColumn("col", F.array_position("cells", F.lit(ANCHOR)) - 1).where("col >= 0")
    anchors = found.groupBy("source_file").agg(F.min(F.struct("col", "at")).alias("anchor")).select(
        "source_file", F.col("anchor.col").cast("int").alias("id_col"), F.col("anchor.at").alias("id_at"))

    files = lines.select("source_file").distinct()
    left = F.get("cells", F.col("id_col"))
    right = F.get("cells", F.col("id_col") + 1)

    def first_row(hit: Column, what: Column) -> Column:
        return F.min_by(F.when(hit, what), F.when(hit, F.col("at")))

    labels = rows.join(anchors, "source_file").groupBy("source_file").agg(
        F.first("id_col").alias("id_col"),
        F.first("id_at").alias("id_at"),
        first_row(_starts(left, START_LABEL), left).alias("start"),
        first_row(_starts(left, NAMES_LABEL), F.col("cells")).alias("tags"),
        first_row(_starts(left, UNITS_LABEL), F.col("cells")).alias("units"),
        first_row(F.lower(right).contains(ELAPSED_LABEL.lower()), right).alias("elapsed"),
    )
    start_text = F.trim(F.regexp_extract("start", "^[^:]*:(.*)$", 1))
    return files.join(labels, "source_file", "left").select(
        "source_file", "id_col", F.col("id_at.block").alias("id_block"), F.col("id_at.row").alias("id_row"),
        F.unix_micros(infer_ts(start_text)).alias("start_us"),
        elapsed_unit_us(F.col("elapsed")).alias("unit_us"),
        "tags", "units",
    )


def read_strain(
    spark: SparkSession, paths: Sequence[str], opts: CsvOptions, per_file: bool, scratch: Scratch, parsed: Observation | None = None
) -> Readings:
    files = list_files(spark, paths, scratch, per_file)
    order = RowOrder(spark, files)
    # written once with the rows' positions: those of a further scan could be others
    every = scratch.table(scan_records(spark, files, opts, scratch), "lines")
    # names and labels give the width; the first line is junk that may be narrower than the data
    width = every.where(labelled()).agg(F.max(field_count(F.col("line"), opts.sep))).first()[0]
    if width is None or width < 3:
        raise NoData("no data found: a strain file has at least 3 columns")
    keys = ("source_file",) if per_file else ()
    heads = read_preambles(every, opts, width).join(files.frame.select("file_no", "entry", "source_file"), "source_file")
    heads = Small(heads, scratch, "preambles").frame
    whole = F.lit(True)
    for column in PROBLEMS:
        whole = whole & F.col(column).isNotNull()
    if not per_file:
        unfit = heads.where(~whole)
        told = [
            f"{bad.source_file}: {next(text for column, text in PROBLEMS.items() if bad[column] is None)}"
            for bad in unfit.orderBy("file_no").limit(20).collect()]
        if told:
            raise NoData(f"{unfit.count()} files without a whole preamble: {'; '.join(told)}")
    heads = heads.where(whole)

    cells = heads.select("file_no", "entry", "source_file", "id_col", F.posexplode("tags").alias("pos", "tag"), "units").where(
        "pos >= id_col + 2 and tag is not null"
    ).select("file_no", "entry", "source_file", "pos", unit_label(F.col("tag"), F.get("units", F.col("pos"))).alias("raw"))
    if not per_file:
        repeated = cells.where("entry > 0").groupBy("file_no", "source_file", "raw").count().where("count > 1")
        told = [f"{r.source_file}: tag {r.raw!r} occurs {r['count']} times" for r in repeated.orderBy("file_no", "raw").limit(20).collect()]
        if told:
            raise DuplicateColumns(f"{repeated.count()} repeated tags, the first of them: {'; '.join(told)}")
    names = cells.select("source_file", F.col("raw").alias("name"))
    cells = cells.withColumn("instrument", sanitize_name(F.col("raw")))
    cols = Small(value_columns(cells, per_file, by_name=True), scratch, "columns")
    heads = Small(heads.select("file_no", "source_file", "id_col", "id_block", "id_row", "start_us", "unit_us"), scratch, "heads")

    rows = every.join(heads.frame, "source_file")
    rows = rows.where("block > id_block or (block = id_block and row > id_row)").drop("id_block", "id_row")
    rows = parse_lines(rows, opts, width)
    known = None if heads.rows is None else {h["id_col"] for h in heads.rows}
    if known is not None and len(known) == 1:
        elapsed = F.col(f"_c{known.pop() + 1}")
    else:
        cells = F.array(*[F.col(f"_c{i}") for i in range(width)])
        rows = rows.withColumn("cells", F.explode(F.array(cells)))
        elapsed = F.get("cells", F.col("id_col") + 1)
    ts = elapsed_to_ts(F.timestamp_micros("start_us"), elapsed, F.col("unit_us"))
    if parsed is not None:
        rows = with_bad_cells(rows, cols, width, "file_no")
        rows = observed(rows, parsed, elapsed.isNotNull() & ts.isNull(), F.col("bad_cells"))
    ids = ["file_no", "source_file", "block", "row", "ts"]
    rows = rows.select(*ids[:-1], round_ms(ts).alias("ts"), value_array(cols, width).alias("vals")).where("ts is not null")
    out = explode_values(rows, cols, ids).select(
        *keys, "instrument", "ts", "value", "series",
        order.of(not per_file, F.col("series"), series_count(cols)).alias("ord"))
    # a column without any value is no instrument here, so the data decides
    return Readings(out, keys, out.select(*keys, "instrument").distinct(), False, from_data=True,
                    source=Source(files, opts.time_format or DEFAULT_FORMATS["strain"], names, parsed))
