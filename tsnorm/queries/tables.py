"""One query per operator, on whole tables, through the functions the file runs use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsnorm.functions import names as N
from tsnorm.functions import times as T
from tsnorm.functions import values as V
from tsnorm.operators import dedupe, fill, grid, period, quality, resample, reshape
from tsnorm.operators.asof import asof_backward as asof
from tsnorm.operators.filters import time_range as in_range
from tsnorm.operators.merge import merge_rows, union_all
from tsnorm.plans import normalize
from tsnorm.sources.archive import archive_to_readings as to_readings
from tsnorm.sources.archive import tag_dimension as tag_names
from tsnorm.sources.archive import tag_join as join_tags
from tsnorm.sources.normalized import wide_unpivot as unpivot_columns
from tsnorm.sources.scan import Readings
from tsnorm.sources.trend import trend_unpivot as unpivot_pairs

HOUR = 3_600_000_000
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable) -> Callable:
    """Register ``fn``; results carry zone-free times, so comparing them needs no zone."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

        def table(name: str) -> DataFrame:
            df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
            return df.select(*[
                F.col(c).cast("timestamp").alias(c) if t.startswith("timestamp") else F.col(c) for c, t in df.dtypes
            ])

        out = fn(table)
        return out.select(*[
            F.col(f"`{c}`").cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(f"`{c}`")
            for c, t in out.dtypes
        ])

    QUERIES[fn.__name__] = run
    return fn


def rounded(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Averages differ in the last bits between engines."""
    chosen = [c for c, t in df.dtypes if t == "double"] if columns is None else columns
    return df.select(*[F.round(c, 8).alias(c) if c in chosen else F.col(c) for c in df.columns])


def readings_e(table) -> DataFrame:
    """Events as readings, one instrument per type."""
    return table("events").select(
        F.col("event_type").alias("instrument"), "ts", "value", F.lit(0).alias("series"), F.col("event_id").alias("ord"))


LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def readings_l(table) -> DataFrame:
    """Line items as readings, one instrument per return flag; many share a time."""
    return table("lineitem").select(
        F.col("l_returnflag").alias("instrument"), F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").alias("value"), F.lit(0).alias("series"), F.struct(*LINE_ORDER).alias("ord"))


def run_of(frame: DataFrame, **options):
    return normalize(Readings(frame, (), None, False), **options)


# --- whole runs ---

@query
def normalize_wide(table):
    return rounded(run_of(readings_e(table), period="1H").wide())


@query
def normalize_multi(table):
    return rounded(run_of(readings_e(table), period="12H", stats="vixms").wide())


@query
def normalize_gap_zero(table):
    return rounded(run_of(readings_e(table), period="15T", gap="zero").long())


@query
def normalize_filtered(table):
    run = run_of(
        readings_e(table), period="30T", stats="x", query="5 <= val <= 60",
        start="2024-01-03 07:45:00", end="2024-01-20")
    return run.long()


@query
def normalize_default_period(table):
    return run_of(readings_l(table)).wide()


@query
def upsample_ffill(table):
    daily = resample.resample(readings_e(table), T.PERIOD_UNITS["D"], ["mean"])
    frame = daily.select(
        "instrument", (F.col("bucket") + F.expr("INTERVAL 90 MINUTES")).alias("ts"),
        F.col("mean").alias("value"), F.lit(0).alias("series"), F.lit(0).alias("ord"))
    return rounded(run_of(frame, period="1H").long())


@query
def batch_resample(table):
    frame = table("orders").select(
        F.col("o_orderpriority").alias("source_file"), F.col("o_orderstatus").alias("instrument"),
        F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("value"),
        F.lit(0).alias("series"), F.col("o_orderkey").alias("ord"))
    run = normalize(Readings(frame, ("source_file",), None, False), period="7D")
    return rounded(run.long())


# --- sources and projections ---

def archive_rows(table, *others: str) -> DataFrame:
    return table("events").select(
        *others,
        V.tag_key(F.col("user_id").cast("string")).alias("tag_id"),
        F.concat(F.lit("user-"), F.col("user_id"), F.lit(".pv")).alias("tag_name"),
        T.round_ms(F.col("ts")).alias("ts"), "value", F.col("event_id").alias("ord"))


@query
def archive_to_readings(table):
    rows = archive_rows(table)
    return to_readings(rows, tag_names(rows)).select("instrument", "ts", "value")


@query
def lenient_cast(table):
    return table("part").select(
        "p_partkey",
        V.lenient_double(F.col("p_size").cast("string")).alias("size_number"),
        V.lenient_long(F.substring("p_brand", 7, 9)).alias("brand_number"),
        V.lenient_double(F.col("p_name")).alias("name_number"),
        V.lenient_double(F.concat(F.col("p_size"), F.lit("f"))).alias("suffixed_number"))


@query
def null_tokens(table):
    text = F.when(F.col("p_type") == "PROMO", "N/A").when(F.col("p_type") == "SMALL", "nan").when(
        F.col("p_type") == "LARGE", "").otherwise(F.col("p_name"))
    return table("part").select("p_partkey", V.null_tokens(text).alias("cell"))


@query
def parse_ts(table):
    fmt = "%m/%d/%Y %H:%M:%S.%f"
    texts = table("events").select("event_id", F.when(
        F.col("event_type") == "error", F.lit("no time")
    ).when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).otherwise(
        F.date_format("ts", "MM/dd/yyyy HH:mm:ss.SSSSSS")).alias("text"))
    return texts.select(
        "event_id", T.parse_ts(F.col("text"), fmt).alias("ts"),
        T.parse_ts(F.col("text"), T.DEFAULT_FORMATS["archive"]).alias("ts_iso")
    ).dropna(subset=["ts"])


@query
def format_ts(table):
    return table("events").select(
        "event_id",
        T.format_ts(F.col("ts"), "%m/%d/%Y %I:%M:%S %p").alias("am_pm"),
        T.format_ts(F.col("ts"), "%Y-%m-%d %H:%M:%S.%f").alias("iso"))


@query
def round_ms(table):
    return table("events").select("event_id", T.round_ms(F.col("ts")).alias("ts"))


@query
def floor_period(table):
    return table("events").select(
        "event_id",
        T.floor_period(F.col("ts"), T.parse_period("5T")).alias("five_minutes"),
        T.floor_period(F.col("ts"), T.parse_period("7s")).alias("seven_seconds"))


@query
def sanitize_name(table):
    return table("orders").select("o_orderkey", N.sanitize_name(F.col("o_orderpriority")).alias("name"))


@query
def trend_name(table):
    header = F.when(F.col("p_type") == "SMALL", F.col("p_brand")).otherwise(F.concat("p_name", F.lit(" ValueY")))
    return table("part").select("p_partkey", N.trend_name(header).alias("name"))


@query
def value_name(table):
    name = F.when(F.col("p_type") == "SMALL", F.concat(F.lit("value_"), "p_brand")).otherwise(F.col("p_name"))
    return table("part").select("p_partkey", N.value_name(name).alias("name"))


@query
def unit_label(table):
    unit = F.when(F.col("p_type") == "SMALL", "Strain").when(F.col("p_type") == "LARGE", "").when(
        F.col("p_type") != "PROMO", F.lower("p_type"))
    return table("part").select("p_partkey", N.unit_label(F.col("p_name"), unit).alias("label"))


@query
def elapsed_to_ts(table):
    label = F.when(F.col("event_type") == "click", "Milliseconds Elapsed").when(
        F.col("event_type") == "view", "Seconds Elapsed").when(F.col("event_type") == "error", "Elapsed Min.").when(
        F.col("event_type") == "signup", "Elapsed Hours").otherwise("Elapsed Ticks")
    return table("events").select(
        "event_id", T.elapsed_to_ts(F.col("ts"), F.col("value").cast("string"), T.elapsed_unit_us(label)).alias("ts"))


@query
def wide_unpivot(table):
    return unpivot_columns(table("lineitem"), ["l_orderkey", "l_shipdate"], [
        ("l_quantity", "quantity"), ("l_discount", "Bias"), ("l_extendedprice", "price"), ("l_tax", "tax")])


@query
def trend_unpivot(table):
    return unpivot_pairs(table("orders"), ["o_orderkey"], [
        ("price", "o_orderdate", "o_totalprice"), ("customer", "o_orderdate", "o_custkey")
    ]).select("o_orderkey", "series", "instrument", "ts", "value")


# --- filters ---

@query
def value_query(table):
    return readings_e(table).where(
        V.value_query("val >= 10 & val <= 40 or not val < 80")).select("instrument", "ts", "value")


@query
def time_range(table):
    rows = in_range(readings_e(table), T.start_bound("2024-01-05 06:30:00"), T.end_bound("2024-01-20"))
    return rows.select("instrument", "ts", "value")


@query
def end_of_day(table):
    late = F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR")).otherwise(
        F.col("o_orderdate"))
    return table("orders").select("o_orderkey", T.end_of_day(late).alias("end_ts"))


# --- merge and de-duplication ---

@query
def dedupe_last(table):
    return dedupe.last_wins(readings_l(table), ["instrument", "ts"], ["value"], F.col("ord"))


@query
def dedupe_row_last(table):
    return dedupe.last_wins(
        table("lineitem"), ["l_returnflag", "l_shipdate"], ["l_quantity", "l_extendedprice", "l_discount"],
        F.struct(*LINE_ORDER, "l_discount"))


@query
def tag_dimension(table):
    rows = table("events").select(
        F.col("user_id").cast("string").alias("tag_id"),
        F.when(F.col("event_type") != "error", F.concat("event_type", F.lit("-no."), "user_id")).alias("tag_name"),
        F.col("event_id").alias("ord"))
    return tag_names(rows)


@query
def tag_join(table):
    readings = table("lineitem").select(
        F.col("l_suppkey").cast("string").alias("tag_id"), F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").alias("value"))
    tags = table("supplier").select(
        F.col("s_suppkey").cast("string").alias("tag_id"), N.sanitize_name(F.col("s_name")).alias("instrument"))
    return join_tags(readings, tags).select("instrument", "ts", "value")


@query
def append_series(table):
    rows = table("lineitem").select(
        F.concat(F.lit("line_"), "l_linenumber").alias("instrument"), F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").alias("value"), F.when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("series"),
        *LINE_ORDER)
    rows = rows.select("instrument", "ts", "value", "series", F.struct("series", *LINE_ORDER).alias("ord"))
    return dedupe.append_series(rows, query="val > 10")


@query
def replace_series(table):
    base = table("orders").select(
        F.col("o_orderpriority").alias("instrument"), F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("value"))
    flag = F.col("l_returnflag")
    new = table("lineitem").select(
        F.when(flag == "A", "1-URGENT").when(flag == "N", "2-HIGH").otherwise("returned").alias("instrument"),
        F.col("l_shipdate").alias("ts"), F.col("l_quantity").alias("value"))
    return dedupe.replace_series(base, new)


@query
def archive_merge(table):
    rows = archive_rows(table, "event_type")
    first = rows.where("event_type in ('view', 'click')").drop("event_type")
    second = rows.where("event_type = 'error'").select("value", "ts", "ord", "tag_id")
    third = rows.where("event_type not in ('view', 'click', 'error')").drop("event_type")
    merged = merge_rows([first, second, third])
    return to_readings(merged, tag_names(merged)).select("instrument", "ts", "value")


def normalized_parts(table) -> list[DataFrame]:
    """Two wide tables, the last row of a time kept in each, as readings by column."""
    lines = dedupe.last_wins(
        table("lineitem").withColumnRenamed("l_shipdate", "ts"), ["ts"], ["l_quantity", "l_extendedprice"],
        F.struct(*LINE_ORDER))
    orders = dedupe.last_wins(
        table("orders").withColumnRenamed("o_orderdate", "ts"), ["ts"], ["o_totalprice", "o_custkey"],
        F.col("o_orderkey"))
    return [
        unpivot_columns(lines, ["ts"], [("l_quantity", "quantity"), ("l_extendedprice", "price")]),
        unpivot_columns(orders, ["ts"], [("o_totalprice", "price"), ("o_custkey", "customer")]),
    ]


@query
def normalized_merge(table):
    parts = [p.withColumn("ord", F.lit(0)).withColumn("series", F.lit(0)) for p in normalized_parts(table)]
    return dedupe.append_series(merge_rows(parts))


@query
def trend_merge(table):
    lines = unpivot_pairs(
        table("lineitem").withColumn("ord", F.struct(*LINE_ORDER)), ["ord"],
        [("quantity", "l_shipdate", "l_quantity"), ("price", "l_shipdate", "l_extendedprice")])
    orders = unpivot_pairs(
        table("orders").select("*", F.struct("o_orderkey").alias("ord")), ["ord"],
        [("price", "o_orderdate", "o_totalprice")])
    # each pair is ordered after the pairs left of it and all pairs of earlier files
    ranked = [
        p.select("instrument", "ts", "value", F.col("series") + 10 * i, F.struct(
            (F.col("series") + 10 * i).alias("pair"),
            *[F.col(f"ord.{c}").cast("double").alias(c) if i == 0 else F.lit(None).cast("double").alias(c)
              for c in LINE_ORDER],
            (F.lit(None).cast("bigint") if i == 0 else F.col("ord.o_orderkey")).alias("o_orderkey")).alias("ord"))
        for i, p in enumerate([lines, orders])
    ]
    ranked = [p.toDF("instrument", "ts", "value", "series", "ord") for p in ranked]
    return dedupe.append_series(union_all(ranked))


# --- quality ---

def name_cells(table) -> DataFrame:
    """Parts as header cells: a brand is a file, a part name a column name."""
    return table("part").select(F.col("p_brand").alias("source_file"), F.col("p_name").alias("name"))


@query
def duplicate_names(table):
    return quality.duplicate_names(name_cells(table))


@query
def shared_names(table):
    return quality.shared_names(name_cells(table))


@query
def quality_report(table):
    rows = table("events").select(
        F.col("event_type").alias("source_file"), F.col("user_id").alias("tag_id"),
        F.when(F.col("value") < 5, F.lit("no time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:00:00")).alias("t"),
        F.when(F.col("value") > 90, F.lit("no number")).when(F.col("value") > 10, F.col("value").cast("string")).alias("v"))
    return quality.quality_report(
        rows, ["source_file"], ["tag_id"],
        F.col("t"), T.parse_ts(F.col("t"), T.DEFAULT_FORMATS["archive"]), F.col("v"), V.lenient_double(F.col("v")))


# --- aggregates ---

@query
def global_bounds(table):
    return period.global_bounds(readings_e(table))


@query
def sample_period(table):
    return period.sample_period(readings_e(table))


@query
def common_period(table):
    return period.common_period(readings_e(table))


@query
def instrument_summary(table):
    value = F.when(F.col("instrument") != "error", F.col("value"))
    return period.instrument_summary(readings_e(table).withColumn("value", value))


def hourly(table, *stats: str) -> DataFrame:
    return rounded(resample.resample(readings_e(table), HOUR, list(stats), order=["ord"]))


@query
def resample_mean(table):
    return hourly(table, "mean")


@query
def resample_min(table):
    return hourly(table, "min")


@query
def resample_max(table):
    return hourly(table, "max")


@query
def resample_std(table):
    return hourly(table, "std")


@query
def resample_first(table):
    return hourly(table, "val")


@query
def resample_multi(table):
    return hourly(table, *resample.parse_stats("VIXAS"))


# --- grids, joins and reshape ---

def event_grid(table) -> DataFrame:
    ends = period.global_bounds(readings_e(table))
    return ends.select(*grid.grid_bounds(
        F.unix_micros("start_ts"), F.unix_micros("end_ts"), F.lit(HOUR).cast("bigint")))


@query
def time_grid(table):
    return grid.time_grid(event_grid(table))


def event_spine(table) -> DataFrame:
    return grid.spine(event_grid(table), readings_e(table).select("instrument").distinct())


@query
def spine(table):
    return event_spine(table)


@query
def asof_backward(table):
    events = table("events")
    left = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    right = events.where("event_type <> 'purchase'").select(
        "user_id", F.col("ts").alias("seen_ts"), F.col("event_type").alias("seen"), F.col("value").alias("seen_value"))
    return asof(left, right, ["user_id"], "ts", "seen_ts")


def hourly_cells(table) -> DataFrame:
    """Every hour of every type with its mean, NULL in hours without an event."""
    means = resample.resample(readings_e(table), HOUR, ["mean"]).withColumnRenamed("bucket", "timestamp")
    return event_spine(table).join(means, ["instrument", "timestamp"], "left")


@query
def locf(table):
    return rounded(fill.locf(hourly_cells(table), ["instrument"], "timestamp", "mean", 24 * HOUR))


@query
def fill_zero(table):
    return rounded(fill.fill_zero(hourly_cells(table), ["mean"]))


@query
def wide_pivot(table):
    means = resample.resample(readings_e(table), HOUR, ["mean"])
    return rounded(reshape.wide_pivot(means, reshape.wide_columns(EVENT_TYPES, ["mean"]), ["bucket"]))


@query
def sorted_wide(table):
    daily = resample.resample(readings_e(table), T.PERIOD_UNITS["D"], ["min", "max"])
    wide = reshape.wide_pivot(daily, reshape.wide_columns(EVENT_TYPES, ["min", "max"]), ["bucket"])
    return wide.orderBy("bucket")
