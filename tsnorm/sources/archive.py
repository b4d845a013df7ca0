"""Archive layout: one row per tag and time.

Columns by position: tag id, tag name, time, data source, value, quality.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tsnorm.functions.names import sanitize_name
from tsnorm.functions.times import DEFAULT_FORMATS, parse_ts, round_ms
from tsnorm.functions.values import lenient_double, lenient_long, tag_key
from tsnorm.operators.dedupe import last_wins
from tsnorm.session import Scratch, Small
from tsnorm.sources.scan import (
    CsvOptions,
    NoData,
    Readings,
    Source,
    header_cells,
    observed,
    read_cells,
    read_headers,
    reject_duplicates,
    without_duplicates,
)

ROLES = ["tag_id", "tag_name", "time", "data_source", "value", "quality"]


def tag_dimension(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """First name of every tag id: ``tag_id, instrument`` from rows with both id and name.

    ``rows`` has ``tag_id, tag_name, ord``. The names of an id are told apart first: that
    aggregate holds no text but its keys, so it is hash-based, and it leaves few rows.
    """
    named = rows.where("tag_id is not null and tag_name is not null")
    named = named.groupBy(*keys, "tag_id", "tag_name").agg(F.min("ord").alias("ord"))
    tags = named.groupBy(*keys, "tag_id").agg(F.min_by("tag_name", "ord").alias("tag_name"))
    return tags.select(*keys, "tag_id", sanitize_name(F.col("tag_name")).alias("instrument"))


def tag_join(readings: DataFrame, tags: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Readings of known tags, with ``series`` and ``ord`` by ascending tag id."""
    order = F.struct(lenient_long(F.col("tag_id")).alias("n"), F.col("tag_id").alias("id"))
    return readings.join(tags, [*keys, "tag_id"]).select(
        *keys, "instrument", "ts", "value", F.col("tag_id").alias("series"), order.alias("ord")
    )


def archive_to_readings(
    rows: DataFrame, tags: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Typed archive rows (``tag_id, ts, value, ord``) to readings, last one per tag and time.

    A missing last value still hides the earlier ones; readings without value go afterwards.
    """
    kept = last_wins(rows.where("ts is not null"), [*keys, "tag_id", "ts"], ["value"], F.col("ord"))
    return tag_join(kept, tags, keys)


def read_archive(
    spark: SparkSession, paths: Sequence[str], opts: CsvOptions, per_file: bool, scratch: Scratch, parsed: Observation | None = None
) -> Readings:
    headers = read_headers(spark, paths, opts, scratch, per_file)
    frame = headers.frame
    keys = ("source_file",) if per_file else ()
    if per_file:
        frame = without_duplicates(headers).where("width >= 6")
        frame = frame.select("file_no", "source_file", *[F.lit(i + 1).alias(f"p{i}") for i in range(6)])
    else:
        reject_duplicates(headers)
        if headers.rows is not None:
            base = min(headers.rows, key=lambda r: r["file_no"])
        else:
            base = frame.agg(F.min_by(F.struct("width", "names"), "file_no")).first()[0]
        if base["width"] < 6:
            raise NoData(f"no data found: an archive file has 6 columns, this one {base['width']}")
        # merge files are aligned to the base file by column name
        frame = frame.select("file_no", "source_file", *[
            F.lit(i + 1).alias(f"p{i}") if name is None
            else F.array_position("names", F.lit(name)).cast("int").alias(f"p{i}")
            for i, name in enumerate(base["names"][:6])
        ])
    places = Small(frame, scratch, "places")
    if places.rows is not None and not places.rows:
        raise NoData("no data found: no file with the 6 columns of an archive")
    n_files = headers.files.n
    straight = places.rows is not None and headers.rows is not None and len(places.rows) == len(headers.rows) and all(
        r[f"p{i}"] == i + 1 for r in places.rows for i in range(6)
    )

    fmt = opts.time_format or DEFAULT_FORMATS["archive"]
    cells = read_cells(spark, headers, opts, scratch, least=6)
    if straight and (per_file or n_files == 1):
        picked = {role: F.col(f"_c{i}") for i, role in enumerate(ROLES)}
    else:
        cells = cells.join(places.frame, "source_file")
        row = F.array(*[F.col(f"_c{i}") for i in range(max(headers.width, 6))])
        # position 0 (a name the file lacks) reads as missing
        picked = {role: F.col(f"_c{i}") if straight else F.get(row, F.col(f"p{i}") - 1) for i, role in enumerate(ROLES)}
    typed = cells.select(
        "source_file",
        tag_key(picked["tag_id"]).alias("tag_id"),
        picked["tag_name"].alias("tag_name"),
        round_ms(parse_ts(picked["time"], fmt), picked["time"]).alias("ts"),
        lenient_double(picked["value"]).alias("value"),
        headers.order.of(not per_file and n_files != 1).alias("ord"),
        *([picked["time"].alias("time"), picked["value"].alias("number")] if parsed is not None else []),
    )
    # the names below are another pass, which is not counted
    rows = observed(
        typed, parsed, F.expr("time is not null and ts is null"), F.expr("number is not null and value is null"))

    tags = Small(tag_dimension(typed, keys), scratch, "tags")
    if tags.rows is not None:
        pairs = {tuple(r[k] for k in (*keys, "instrument")) for r in tags.rows}
        one_to_one = len(pairs) == len(tags.rows)
    else:
        one_to_one = False
    frame = archive_to_readings(rows, tags.frame, keys)
    return Readings(frame, keys, tags.frame.select(*keys, "instrument").distinct(), one_to_one,
                    source=Source(headers.files, fmt, header_cells(headers.frame), parsed))
