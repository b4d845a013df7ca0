"""Column expressions on a few rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tsnorm.functions import names as N
from tsnorm.functions import times as T
from tsnorm.functions import values as V
from tsnorm.operators.resample import parse_stats
from tsnorm.operators.reshape import order_names


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_periods():
    assert T.parse_period("5s") == 5_000_000
    assert T.parse_period("H") == 3_600_000_000
    assert T.parse_period("10L") == 10_000
    assert T.parse_period("1H30T") == 5_400_000_000
    assert T.parse_period(None) is None
    for bad in ("5Q", "abc", "0S", "1.5H"):
        with pytest.warns(UserWarning):
            assert T.parse_period(bad) == 1_000_000


def test_bounds():
    assert T.start_bound("2017-10-25") == T.start_bound(datetime(2017, 10, 25))
    day = 86_400_000_000
    assert T.end_bound("2017-10-25") == T.start_bound("2017-10-25") + day - 1
    assert T.end_bound("2017-10-25 10:00:00") == T.start_bound("10/25/2017 10:00:00 AM")
    with pytest.warns(UserWarning):
        assert T.start_bound("soon") is None


def test_parse_ts(spark):
    texts = [
        "2017-10-25 22:42:39.214000000", "2018-04-25 10:49:07.0000000", "2018-04-25 10:49:07", "2/11/2020 8:21:20 AM",
        "02/11/2020 20:21:20.5", "rubbish", None,
    ]
    want = [
        datetime(2017, 10, 25, 22, 42, 39, 214000), datetime(2018, 4, 25, 10, 49, 7), datetime(2018, 4, 25, 10, 49, 7),
        datetime(2020, 2, 11, 8, 21, 20), datetime(2020, 2, 11, 20, 21, 20, 500000), None, None,
    ]
    utc = [None if w is None else w for w in want]
    for fmt in T.DEFAULT_FORMATS.values():
        assert apply(spark, texts, lambda c, f=fmt: T.parse_ts(c, f).cast("timestamp_ntz")) == utc
    day_first = apply(spark, ["25.10.2017 07-05"], lambda c: T.parse_ts(c, "%d.%m.%Y %H-%M").cast("timestamp_ntz"))
    assert day_first == [datetime(2017, 10, 25, 7, 5)]


@pytest.mark.parametrize("digits", range(1, 10))
def test_fractions_of_any_length(spark, digits):
    text = "10/25/2017 22:42:39." + "250000000"[:digits]
    fraction = int("250000000"[:digits].ljust(6, "0")[:6])
    got = apply(spark, [text], lambda c: T.parse_ts(c, "%m/%d/%Y %H:%M:%S.%f").cast("timestamp_ntz"))
    assert got == [datetime(2017, 10, 25, 22, 42, 39, fraction)]


def test_round_ms_ties_to_even(spark):
    texts = ["2020-01-01 00:00:00." + f for f in ("0005", "0015", "0014999", "001500", "000500001", "0025", "9996")]
    got = apply(spark, texts, lambda c: F.unix_millis(T.round_ms(T.parse_ts(c, T.DEFAULT_FORMATS["archive"]), c)) % 10000)
    base = 1577836800000 % 10000
    assert [g - base for g in got] == [0, 2, 1, 2, 1, 2, 1000]


def test_floor_and_ceil(spark):
    got = apply(spark, [-1, 0, 6_999_999, 7_000_000, 7_000_001],
                lambda c: F.struct(T.floor_us(c, 7_000_000), T.ceil_us(c, 7_000_000)), "bigint")
    assert [tuple(g) for g in got] == [
        (-7_000_000, 0), (0, 0), (0, 7_000_000), (7_000_000, 7_000_000), (7_000_000, 14_000_000)]


def test_format_ts(spark):
    ts = ["2020-02-11 20:21:20.5"]
    assert apply(spark, ts, lambda c: T.format_ts(c.cast("timestamp"), "%m/%d/%Y %I:%M:%S %p")) == ["02/11/2020 08:21:20 PM"]
    assert apply(spark, ts, lambda c: T.format_ts(c.cast("timestamp"), "%y%b%d %H.%f")) == ["20Feb11 20.500000"]
    with pytest.raises(ValueError):
        T.write_pattern("%Q")


def test_elapsed(spark):
    units = ["Milliseconds Elapsed", "Seconds Elapsed", "elapsed (MIN)", "Elapsed Hours", "Elapsed"]
    assert apply(spark, units, T.elapsed_unit_us) == [1_000, 1_000_000, 60_000_000, 3_600_000_000, None]
    start = F.timestamp_micros(F.lit(0))
    got = apply(spark, ["1.5", "no number", None], lambda c: F.unix_micros(T.elapsed_to_ts(start, c, F.lit(60_000_000))))
    assert got == [90_000_000, None, None]


def test_names(spark):
    assert apply(spark, ["MC-VD115 In.Scaled"], N.sanitize_name) == ["MC_VD115_In_Scaled"]
    assert apply(spark, ["Tank 1 Time", "Tank", "T ValueY"], N.trend_name) == ["Tank 1", "Tank", "T"]
    assert apply(spark, ["value_x", "valueless", "x"], N.value_name) == ["value_x", "valueless", "value_x"]
    units = [("a", "Strain"), ("b", "mm"), ("c", None), ("d", ""), ("e", "STRAIN")]
    df = spark.createDataFrame(units, "t string, u string")
    got = [r[0] for r in df.select(N.unit_label(F.col("t"), F.col("u"))).collect()]
    assert got == ["a (uStrain)", "b (mm)", "c", "d", "e (uStrain)"]
    assert order_names(["b", "A", "a", "C"]) == ["A", "a", "b", "C"]


def test_values(spark):
    assert apply(spark, ["", "NaN", "N/A", "nan", "x", "NAN"], V.null_tokens) == [None, None, None, None, "x", "NAN"]
    cells = ["5", " 5.5", "1e3", "5d", "5F", "no number", "NaN", "inf", "-Infinity"]
    assert apply(spark, cells, V.lenient_double) == [
        5.0, 5.5, 1000.0, None, None, None, None, float("inf"), float("-inf")]
    assert apply(spark, ["007", "7", "x7"], V.tag_key) == ["7", "7", "x7"]


@pytest.mark.parametrize("text,want", [
    ("val >= 0 and val <= 100", [0.0, 100.0, 7.5]),
    ("0 <= val <= 100", [0.0, 100.0, 7.5]),
    ("val == 7.5", [7.5]),
    ("(val < 0) | (val > 100)", [-1.0, 100.5]),
    ("~(val > 1e1)", [-1.0, 0.0, 7.5]),
    ("val in [0, 100]", [0.0, 100.0]),
    ("val * 2 > 100 & val != 100", [100.5]),
])
def test_value_query(spark, text, want):
    df = spark.createDataFrame([(-1.0,), (0.0,), (100.0,), (7.5,), (100.5,), (None,)], "value double")
    assert [r.value for r in df.where(V.value_query(text)).collect()] == want


@pytest.mark.parametrize("text", ["x > 1", "val > 1; drop", "val > (select 1)", "1 > 0", "val > sqrt(2)", "val > '1'"])
def test_value_query_rejects(text):
    with pytest.raises(ValueError):
        V.value_query(text)


def test_stats_letters():
    assert parse_stats("SmXiV") == ["val", "min", "max", "mean", "std"]
    assert parse_stats("ad") == ["mean", "std"]
    with pytest.raises(ValueError):
        parse_stats("q")


def test_only_dates_with_times_are_times(spark):
    cells = ["12345", "10:00:02", "2017-10-25", "2017-10-25 10:00:02.5", "2017-1-5 1:2:3", "2017-10-25T10:00:02Z", "20171025"]
    got = apply(spark, cells, lambda c: T.parse_ts(c, T.DEFAULT_FORMATS["archive"]).cast("string"))
    assert got == [None, None, "2017-10-25 00:00:00", "2017-10-25 10:00:02.5", "2017-01-05 01:02:03", "2017-10-25 10:00:02", None]


def test_digits_beyond_microseconds_break_ties_in_any_layout(spark):
    cells = ["3/1/2020 1:00:00.0005001", "03/01/2020 01:00:00.0005001", "3/1/2020 1:00:00.0005000"]
    got = apply(spark, cells, lambda c: F.unix_micros(T.round_ms(T.parse_ts(c, T.DEFAULT_FORMATS["trend"]), c)) % 1_000_000)
    assert got == [1000, 1000, 0]


def test_odd_elapsed_cells_are_missing(spark):
    cells = ["2", "Infinity", "NAN", "1e30", "5d", "", "1e12"]
    got = apply(spark, cells, lambda c: F.unix_micros(T.elapsed_to_ts(F.timestamp_micros(F.lit(0)), c, F.lit(1_000_000))))
    assert got == [2_000_000, None, None, None, None, None, None]


def test_bounds_with_an_offset_are_converted():
    assert T.start_bound("2020-01-01T05:00:00+05:00") == T.start_bound("2020-01-01T00:00:00")
