"""CSV scans as text cells, header tables and the readings record all layouts share.

Column names are never promoted: duplicates are legal in the input, so cells stay in
``_c0.._cN`` and names live in a header table keyed by file.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tsnorm.functions.values import null_tokens
from tsnorm.operators.merge import union_all
from tsnorm.operators.quality import duplicate_names
from tsnorm.session import Scratch, Small
from tsnorm.sources.files import Files, NoData, head_lines, list_files
from tsnorm.sources.records import broken_splits, ends_inside, first_record, whole_records

# A separator no logger file contains: the CSV source then gives whole lines.
_NO_SEPARATOR = "\x01"
# The record a row was read from, where it has not as many cells as were asked for.
_ODD = "_odd"


class DuplicateColumns(ValueError):
    """A file names a column twice in a layout that cannot have that."""


@dataclass(frozen=True)
class CsvOptions:
    """``sep`` longer than one character is a regular expression; quotes have no meaning then. A row of more than
    ``max_columns`` cells is an error; the parser keeps room for so many. A row with cells beyond the columns of its
    header is an error too, or left out if ``long_rows`` is ``skip``; empty cells there do not count. Files larger than one
    split are looked through for quoted line breaks before they are read; ``quoted_breaks=False`` saves that pass where
    there are none.
    """

    sep: str = ","
    encoding: str = "UTF-8"
    time_format: str | None = None
    max_columns: int = 200_000
    long_rows: str = "raise"
    quoted_breaks: bool = True

    def __post_init__(self):
        if self.long_rows not in ("raise", "skip"):
            raise ValueError("long_rows must be raise or skip")

    @property
    def spark_encoding(self) -> str:
        return self.encoding.replace("_", "-")


@dataclass(frozen=True)
class Source:
    """Files of a run: how their times are written, which paths do not exist, and their column names
    (``source_file, name``). ``parsed`` observes the rows as they are read, if a report is wanted."""

    files: Files
    time_format: str
    names: DataFrame
    parsed: Observation | None = None


PARSED = ["n_rows", "bad_times", "bad_values"]


def observed(rows: DataFrame, parsed: Observation | None, bad_time: Column, bad_values: Column) -> DataFrame:
    """Rows, counted in passing: all, those whose time cell is no time, and cells that are no number."""
    if parsed is None:
        return rows
    counts = F.count(F.lit(1)), F.count_if(bad_time), F.coalesce(F.sum(bad_values.cast("bigint")), F.lit(0))
    return rows.observe(parsed, *[c.alias(n) for c, n in zip(counts, PARSED, strict=True)])


@dataclass(frozen=True)
class Readings:
    """Readings of one run, or of many files that are each a run of their own.

    ``frame`` has the key columns, ``instrument``, ``ts``, ``value``, ``series`` (which column,
    pair or tag of the source a row came from) and ``ord`` (later wins). ``unique`` says that
    (keys, instrument, ts) occurs once already. ``instruments`` lists every instrument of the
    source, also those a filter leaves without a value; None: those that have one. If it comes
    ``from_data``, using it is a pass over the source. ``source`` tells more of the files it was read from.
    """

    frame: DataFrame
    keys: tuple[str, ...]
    instruments: DataFrame | None
    unique: bool
    from_data: bool = False
    source: Source | None = None


def _reader(spark: SparkSession, opts: CsvOptions, header: bool):
    reader = spark.read.options(
        header=header, encoding=opts.spark_encoding, ignoreLeadingWhiteSpace=True, escape='"', maxColumns=opts.max_columns
    )
    if opts.spark_encoding.upper().startswith(("UTF-16", "UTF-32")):
        reader = reader.option("lineSep", "\n")
    return reader


def _positions() -> list[Column]:
    """File and position of a row. A row id alone is not file order once a file is split."""
    return [
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ]


def _larger(scan: DataFrame, than: int) -> DataFrame:
    """Of files of more bytes. Splits are as large as the files of a scan let them be, and a filter above a row id leaves no file
    out: this one lies on the scan itself, so that every scan of these files has the same splits."""
    return scan.where(F.col("_metadata.file_size") > than) if than >= 0 else scan


def scan_lines(spark: SparkSession, files: Files, opts: CsvOptions, header: bool, larger: int = -1) -> DataFrame:
    """Whole lines that are not blank; with ``header`` the first one of each file is left out."""
    reader = _reader(spark, opts, header).options(sep=_NO_SEPARATOR, quote="")
    return _larger(reader.schema("line string").csv(files.roots), larger).select("line", *_positions()).where("line is not null")


def scan_physical_lines(spark: SparkSession, files: Files, opts: CsvOptions, larger: int = -1) -> DataFrame:
    """All lines as they are, blank ones included where the files are UTF-8."""
    if opts.spark_encoding.upper() not in ("UTF-8", "UTF8"):
        return scan_lines(spark, files, opts, header=False, larger=larger)
    return _larger(spark.read.text(files.roots), larger).select(F.col("value").alias("line"), *_positions())


def scan_records(spark: SparkSession, files: Files, opts: CsvOptions, scratch: Scratch) -> DataFrame:
    """All records as text, line breaks of quoted cells included, with positions."""
    lines = scan_lines(spark, files, opts, header=False)
    if not opts.quoted_breaks or len(opts.sep) > 1:
        return lines
    physical = scan_physical_lines(spark, files, opts)
    broken = Small(broken_splits(physical, opts.sep), scratch, "broken")
    if broken.rows is not None and not broken.rows:
        return lines
    whole = whole_records(physical, broken.frame, opts.sep, header=False)
    return lines.join(broken.frame, ["source_file", "block"], "left_anti").select(lines.columns).unionByName(whole.select(lines.columns))


def cell_schema(width: int) -> str:
    return ", ".join(f"_c{i} string" for i in range(width))


def parse_lines(lines: DataFrame, opts: CsvOptions, width: int, checked: bool = True) -> DataFrame:
    """Replace ``line`` by its cells ``_c0.._c{width-1}``, missing texts as NULL.

    The generator makes cells real columns: a line is parsed once, however often later
    expressions and pushed-down filters use a cell.
    """
    others = [c for c in lines.columns if c != "line"]
    if len(opts.sep) > 1:
        parts = lines.select(*others, F.explode(F.array(F.split("line", opts.sep))).alias("parts"))
        rest = F.exists(F.slice("parts", F.lit(width + 1), F.lit(opts.max_columns)), lambda c: F.trim(c) != "")
        cells = [F.ltrim(F.get("parts", F.lit(i))).alias(f"_c{i}") for i in range(width)]
        parts = parts.select(*others, *cells, F.when(rest, F.array_join("parts", " ")).alias(_ODD))
    else:
        parsed = F.from_csv(F.col("line"), f"{cell_schema(width)}, {_ODD} string", {
            "sep": opts.sep, "escape": '"', "ignoreLeadingWhiteSpace": "true", "maxColumns": str(opts.max_columns),
            "columnNameOfCorruptRecord": _ODD})
        parts = lines.select(*others, F.inline(F.array(parsed)))
        parts = parts.withColumn(_ODD, _longer(opts, width))
    parts = _without_long(parts, opts, width) if checked else parts
    return parts.select(*others, *[null_tokens(F.col(f"_c{i}")).alias(f"_c{i}") for i in range(width)])


def _longer(opts: CsvOptions, width: int) -> Column:
    """The odd record if cells of it lie beyond the columns; rows may be short, and end in separators."""
    told = F.rtrim(F.col(_ODD), F.lit(opts.sep + " \t\r\n"))
    # adds 0: where rows are only counted, Spark would not read odd records without cells, nor find all of them by a few
    read = F.least(F.length(F.concat_ws("", *[F.col(f"_c{i}") for i in range(width)])), F.lit(0))
    return F.when(F.col(_ODD).isNotNull() & (field_count(told, opts.sep) + read > width), F.col(_ODD))


def _without_long(cells: DataFrame, opts: CsvOptions, width: int) -> DataFrame:
    if opts.long_rows == "skip":
        return cells.where(F.col(_ODD).isNull())
    where = F.col("source_file") if "source_file" in cells.columns else F.lit("a header")
    told = F.concat(F.lit(f"a row of more than {width} cells in "), where, F.lit(": "), F.left(F.col(_ODD), F.lit(200)))
    # a filter is never left out, whichever cells are used later
    return cells.where(F.when(F.col(_ODD).isNull(), True).otherwise(F.raise_error(told).cast("boolean")))


def split_size(spark: SparkSession, files: Files) -> int:
    """Bytes up to which Spark reads a file in one piece."""
    to_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    most, each = (to_bytes(spark.conf.get(f"spark.sql.files.{n}")) for n in ("maxPartitionBytes", "openCostInBytes"))
    return min(most, max(each, (files.total + files.n * each) // spark.sparkContext.defaultParallelism))


def scan_cells(spark: SparkSession, files: Files, opts: CsvOptions, width: int, scratch: Scratch) -> DataFrame:
    """All records below the headers as text columns ``_c0.._c{width-1}``, with positions; one scan for all files.

    Files of one split are read record by record. Larger ones are read in splits, line by line; splits with a
    quoted line break in them, found in a pass before, are put together from lines instead.
    """
    if len(opts.sep) > 1:
        return parse_lines(scan_lines(spark, files, opts, header=True), opts, width)
    reader = _reader(spark, opts, header=True).option("sep", opts.sep).option("columnNameOfCorruptRecord", _ODD)
    reader = reader.schema(f"{cell_schema(width)}, {_ODD} string")
    limit, size = split_size(spark, files), F.col("_metadata.file_size")
    parts, broken = [], None
    if files.smallest <= limit:
        # the size is known of a file before it is opened, so others are not read
        parts.append(reader.option("multiLine", True).csv(files.roots).where(size <= limit).select("*", *_positions()))
    if files.largest > limit:
        large = _larger(reader.option("multiLine", False).csv(files.roots), limit).select("*", *_positions())
        if opts.quoted_breaks:
            lines = scan_physical_lines(spark, files, opts, larger=limit)
            broken = Small(broken_splits(lines, opts.sep), scratch, "broken")
        if broken is not None and (broken.rows is None or broken.rows):
            # not an anti join: the check for long rows would be pushed below it, to lines within quoted cells
            large = large.join(broken.frame, ["source_file", "block"], "left")
            large = large.withColumn(_ODD, F.when(F.col("start").isNull(), F.col(_ODD))).where("start is null").drop("start", "owner")
            whole = whole_records(lines, broken.frame, opts.sep, header=True)
        else:
            broken = None
        parts.append(large)
    if not parts:
        parts.append(reader.csv(files.roots).select("*", *_positions()))
    cells = _without_long(union_all(parts).withColumn(_ODD, _longer(opts, width)), opts, width)
    cells = cells.select(*[null_tokens(F.col(f"_c{i}")).alias(f"_c{i}") for i in range(width)], "source_file", "block", "row")
    if broken is not None:
        cells = cells.unionByName(parse_lines(whole, opts, width))
    return cells


def read_cells(spark: SparkSession, headers: Headers, opts: CsvOptions, scratch: Scratch, least: int = 1) -> DataFrame:
    """:func:`scan_cells` as wide as the widest header, and ``least`` cells; rows are held against the header of their own file."""
    width = max(headers.width, least)
    cells = scan_cells(spark, headers.files, opts, width, scratch)
    if headers.rows is not None and all(r["width"] == headers.width for r in headers.rows):
        return cells
    widths = headers.frame.select("source_file", F.col("width").alias("_width")).distinct()
    every = F.array(*[F.col(f"_c{i}") for i in range(width)])
    beyond = F.exists(F.slice(every, F.col("_width") + 1, F.lit(width)), lambda c: c.isNotNull())
    held = cells.join(widths, "source_file").withColumn(_ODD, F.when(beyond, F.concat_ws(opts.sep, every)))
    return _without_long(held, opts, width).drop(_ODD, "_width")


def first_lines(spark: SparkSession, files: Files, opts: CsvOptions) -> Small:
    """First record and field count of every file that has one: ``file_no, entry, source_file, line, width``."""
    names = ["file_no", "entry", "source_file"]
    line, found = F.col("line"), F.col("lines").isNull().alias("closed")
    heads = head_lines(files, opts.encoding).select(*names, first_record(F.col("lines"), opts.sep).alias("line"), found)
    heads = Small(heads.withColumn("width", field_count(line, opts.sep)), files.scratch, "heads")
    if heads.rows is not None and not any(r["closed"] for r in heads.rows):
        return heads.where(lambda r: r["line"] is not None, line.isNotNull())
    # stores that only Spark opens: a pass over the lines, or a look at the first ones of a single file
    starts = scan_lines(spark, files, opts, header=False).where("block = 0").select("source_file", "line", "row")
    if files.n == 1:
        starts = spark.createDataFrame(starts.head(1), starts.schema)
    starts = starts.groupBy("source_file").agg(F.min_by("line", "row").alias("line"))
    open_ = F.lit(False) if len(opts.sep) > 1 else ends_inside(line, F.lit(False), opts.sep)
    told = F.concat(F.lit("a line break in the header of a file that Python cannot open: "), F.col("source_file"))
    starts = starts.withColumn("line", F.when(open_, F.raise_error(told).cast("string")).otherwise(line))
    closed = heads.frame.where("closed").select(names).join(starts, "source_file")
    opened = heads.frame.where("line is not null").select(*names, "line", "width")
    return Small(opened.unionByName(closed.withColumn("width", field_count(line, opts.sep))), files.scratch, "first_lines")


def field_count(line: Column, sep: str) -> Column:
    """Cells of a line: separators outside quotes, plus one."""
    unquoted = F.regexp_replace(line, '"[^"]*"', "")
    return (F.regexp_count(unquoted, F.lit(sep if len(sep) > 1 else rf"\Q{sep}\E")) + 1).cast("int")


class RowOrder:
    """Order of rows in their files as one whole number.

    A number keeps "last wins" aggregates hash-based; a struct would make them sort. Splits of a
    file start at multiples of at least the smaller of the two split settings, so that unit
    tells them apart; the low 33 bits of a row id count the rows of a task. Where 62 bits are too few the number is
    a decimal, which these aggregates hold as well.
    """

    ROW_BITS = 33

    def __init__(self, spark: SparkSession, files: Files):
        names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
        to_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
        self.unit = max(1, min(to_bytes(spark.conf.get(n)) for n in names))
        self.files = files.n
        self.blocks = 1 + files.largest // self.unit

    def of(self, merged: bool, before: Column | None = None, n_before: int = 1) -> Column:
        """Order by ``before`` (less than ``n_before``), then, if files are ``merged``, ``file_no``, then row."""
        parts = [(before, n_before)] if before is not None else []
        if merged:
            parts.append((F.col("file_no"), self.files))
        parts.append((F.floor(F.col("block") / self.unit), self.blocks))
        bits = sum((n - 1).bit_length() for _, n in parts)
        order = F.lit(0).cast("bigint")
        for part, n in parts:
            order = F.shiftleft(order, (n - 1).bit_length()) + part.cast("bigint")
        row = F.col("row").bitwiseAND(F.lit(2**self.ROW_BITS - 1))
        if bits + self.ROW_BITS <= 62:
            return F.shiftleft(order, self.ROW_BITS) + row
        if bits > 62:
            raise ValueError(f"{self.files} files with {n_before} columns and {self.blocks} splits cannot be put in order")
        return order.cast("decimal(20,0)") * F.lit(2**self.ROW_BITS).cast("decimal(12,0)") + row.cast("decimal(12,0)")


@dataclass(frozen=True)
class Headers:
    """Header cells of every file: ``file_no, entry, source_file, width, names``."""

    files: Files
    frame: DataFrame
    rows: list[dict] | None
    width: int
    order: RowOrder


def read_headers(spark: SparkSession, paths: Sequence[str], opts: CsvOptions, scratch: Scratch, skip_missing: bool = False) -> Headers:
    files = list_files(spark, paths, scratch, skip_missing)
    lines = first_lines(spark, files, opts)
    if lines.rows is not None:
        width = max((r["width"] for r in lines.rows), default=None)
    else:
        width = lines.frame.agg(F.max("width")).first()[0]
    if width is None:
        raise NoData("no data found: the input files are empty")
    cells = F.array(*[F.col(f"_c{i}") for i in range(width)])
    unmarked = lines.frame.withColumn("line", F.regexp_replace("line", "^\ufeff", ""))
    names = parse_lines(unmarked, opts, width, checked=False).select(
        "file_no", "entry", "source_file", "width", F.slice(cells, F.lit(1), F.col("width")).alias("names"))
    small = Small(names, scratch, "headers")
    return Headers(files, small.frame, small.rows, width, RowOrder(spark, files))


def header_cells(headers: DataFrame) -> DataFrame:
    """One row per header cell: ``entry, source_file, name``."""
    return headers.select("entry", "source_file", F.explode("names").alias("name")).where("name is not null")


def reject_duplicates(headers: Headers) -> None:
    if headers.rows is not None and all(_no_repeats(r["names"]) for r in headers.rows):
        return
    found = duplicate_names(header_cells(headers.frame))
    some = found.orderBy("source_file", "name").head(20)
    if some:
        told = "; ".join(f"{r.source_file}: column {r.name!r} occurs {r.n} times" for r in some)
        raise DuplicateColumns(f"{found.count()} repeated columns, the first of them: {told}")


def without_duplicates(headers: Headers) -> DataFrame:
    """Headers of the files that name no column twice."""
    if headers.rows is not None and all(_no_repeats(r["names"]) for r in headers.rows):
        return headers.frame
    bad = duplicate_names(header_cells(headers.frame)).select("source_file").distinct()
    return headers.frame.join(bad, "source_file", "left_anti")


def _no_repeats(names: list[str | None]) -> bool:
    given = [n for n in names if n is not None]
    return len(set(given)) == len(given)


def value_columns(headers: DataFrame, per_file: bool, by_name: bool) -> DataFrame:
    """Which columns hold which instrument, one row per file.

    Takes ``file_no, source_file, pos, raw, instrument`` rows and gives ``file_no, source_file, cols``
    with ``cols`` an array of (pos, instrument, series). ``series`` is the order in which columns
    reach an instrument: the position in the file itself, or, when files are merged, in the
    merged header. There a name seen before keeps its place if ``by_name``, and every column is
    one of its own otherwise.
    """
    if per_file:
        ranked = headers.withColumn("series", F.col("pos"))
    else:
        place = F.struct("file_no", "pos")
        key = F.col("raw") if by_name else place
        firsts = headers.groupBy(key.alias("place_key")).agg(F.min(place).alias("place"))
        # one row per column name of the headers, never per reading
        firsts = firsts.select("place_key", F.row_number().over(Window.orderBy("place")).alias("series"))
        ranked = headers.withColumn("place_key", key).join(firsts, "place_key")
    return ranked.groupBy("file_no", "source_file").agg(
        F.sort_array(F.collect_list(F.struct("pos", "instrument", "series"))).alias("cols")
    )


def series_count(cols: Small) -> int:
    """A number above every ``series``."""
    if cols.rows is not None:
        return 1 + max((c["series"] for r in cols.rows for c in r["cols"]), default=0)
    return 1 + cols.frame.select(F.max(F.array_max("cols.series"))).first()[0]


def one_layout(cols: Small) -> list[dict] | None:
    """Columns of the files if they all share them; None when they differ (or are not known)."""
    if not cols.rows or any(r["cols"] != cols.rows[0]["cols"] for r in cols.rows):
        return None
    return cols.rows[0]["cols"]
