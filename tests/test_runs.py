"""Whole runs on small files."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import tsnorm
from tsnorm.operators.grid import GridTooLarge
from tsnorm.sources.scan import Readings

HEAD = "TagId,TagName,TimeStamp,DataSource,Value,Quality\n"


def archive(*rows):
    return HEAD + "".join(f"{i},{n},2020-03-01 {t},DS,{v},128\n" for i, n, t, v in rows)


ROWS = [
    (1, "b.x", "10:00:00.2", 1), (1, "b.x", "10:00:00.7", 2), (1, "b.x", "10:00:01.2", 3),
    (1, "b.x", "10:00:04.2", 9), (2, "A", "10:00:02.0", 5), (2, "A", "10:00:02.5", 7), (2, "A", "10:00:03.0", 6),
]


def test_mean_with_carried_gap(spark, write, columns):
    run = tsnorm.normalize_files(spark, "archive", write("a.csv", archive(*ROWS)), period="1S")
    got = columns(run.wide())
    assert list(got) == ["timestamp", "value_A", "value_b_x"]
    assert got["timestamp"] == [f"2020-03-01 10:00:0{s}" for s in range(5)]
    assert got["value_A"] == [0, 0, 6, 6, 6]
    assert got["value_b_x"] == [1.5, 3, 3, 3, 9]
    run.close()


def test_zero_gap(spark, write, columns):
    got = columns(tsnorm.normalize_files(spark, "archive", write("a.csv", archive(*ROWS)), period="1S", gap="zero").wide())
    assert got["value_A"] == [0, 0, 6, 6, 0]
    assert got["value_b_x"] == [1.5, 3, 0, 0, 9]


def test_several_statistics(spark, write, columns):
    got = columns(tsnorm.normalize_files(spark, "archive", write("a.csv", archive(*ROWS)), period="2S", stats="SX").wide())
    assert list(got) == ["timestamp", "value_A_max", "value_A_std", "value_b_x_max", "value_b_x_std"]
    assert got["value_b_x_max"] == [3, 3, 9]
    assert got["value_b_x_std"] == pytest.approx([1, 1, 0])  # one sample has no deviation
    assert got["value_A_std"] == pytest.approx([0, 1, 1])


def test_default_period_and_mixed_directions(spark, write, columns):
    rows = ROWS + [(3, "slow", "10:00:00.5", 100), (3, "slow", "10:00:02.5", 200), (4, "one", "10:00:03.6", 1)]
    got = columns(tsnorm.normalize_files(spark, "archive", write("a.csv", archive(*rows))).wide())
    assert len(got["timestamp"]) == 9 and got["timestamp"][0] == "2020-03-01 10:00:00.000"
    # buckets of 0.5 s; slow ones are filled forward from their own times
    assert got["value_slow"] == [0, 100, 100, 100, 100, 200, 200, 200, 200]
    assert got["value_one"] == [0] * 7 + [1, 1]  # a single reading counts from its period start
    assert got["value_b_x"] == [1, 2, 3, 3, 3, 3, 3, 3, 9]


def test_upsampled_instrument_has_no_statistics(spark, write, columns):
    rows = ROWS + [(3, "slow", "10:00:00.5", 100), (3, "slow", "10:00:03.5", 200)]
    got = columns(tsnorm.normalize_files(spark, "archive", write("a.csv", archive(*rows)), period="1S", stats="ix").wide())
    assert list(got)[1:] == ["value_A_min", "value_A_max", "value_b_x_min", "value_b_x_max", "value_slow"]
    assert got["value_slow"] == [0, 100, 100, 100, 200]


def test_filters(spark, write, columns):
    run = tsnorm.normalize_files(
        spark, "archive", write("a.csv", archive(*ROWS)), period="1S", query="val != 2",
        start="2020-03-01 10:00:00.5", end="2020-03-01 10:00:02.9")
    got = columns(run.wide())
    # data starts at 1.2 s once 0.2 is too early and 0.7 is filtered; it ends at 2.5
    assert got["timestamp"] == ["2020-03-01 10:00:01", "2020-03-01 10:00:02"]
    assert got["value_b_x"] == [3, 3] and got["value_A"] == [0, 6]


def test_filtered_out_instrument_keeps_its_column(spark, write, columns):
    got = columns(tsnorm.normalize_files(spark, "archive", write("a.csv", archive(*ROWS)), period="1S", query="val >= 9").wide())
    assert got == {"timestamp": ["2020-03-01 10:00:04"], "value_A": [0], "value_b_x": [9]}


def test_no_data(spark, write):
    path = write("a.csv", archive(*ROWS))
    with pytest.raises(tsnorm.NoData):
        tsnorm.normalize_files(spark, "archive", path, query="val > 1000")
    with pytest.raises(tsnorm.NoData):
        tsnorm.normalize_files(spark, "archive", write("b.csv", HEAD + "1,x,never,D,1,1\n"))


def test_grid_limit(spark, write):
    rows = [(1, "x", "10:00:00.000", 1), (1, "x", "10:00:00.001", 2), (1, "x", "20:00:00.0", 3)]
    path = write("a.csv", archive(*rows))
    with pytest.raises(GridTooLarge):
        tsnorm.normalize_files(spark, "archive", path, max_cells=1_000_000)


def test_long_gap_over_many_chunks(spark, write):
    rows = [(1, "x", "00:00:00.0", 1), (1, "x", "00:00:01.0", 2), (1, "x", "20:00:00.0", 3)]
    run = tsnorm.normalize_files(spark, "archive", write("a.csv", archive(*rows)), period="1S")
    wide, long = run.wide(), run.long()
    assert wide.count() == 72_001 == long.count()
    assert wide.agg(F.sum("value_x")).first()[0] == 1 + 2 * 71_999 + 3 == long.agg(F.sum("mean")).first()[0]


def test_names_differing_in_case(spark, write, columns):
    path = write("a.csv", archive((1, "x", "10:00:00.0", 1), (2, "X", "10:00:00.0", 2)))
    assert list(columns(tsnorm.normalize_files(spark, "archive", path).wide())) == ["timestamp", "value_X", "value_x"]


def test_session_zone_is_checked(spark, write):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            tsnorm.normalize_files(spark, "archive", write("a.csv", archive(*ROWS)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_written_file_is_valid_input(spark, write, columns, tmp_path):
    run = tsnorm.normalize_files(spark, "archive", write("a.csv", archive(*ROWS)), period="1S")
    out = str(tmp_path / "out")
    tsnorm.write_wide(run.wide(), out, notice=["Internal use", "only"])
    first = columns(run.wide())
    again = tsnorm.normalize_files(spark, "normalized", out, period="1S")
    assert columns(again.wide()) == first
    assert [r.value for r in spark.read.text(out + ".notice").collect()] == ["Internal use", "only"]
    # overwritten, other separator, time format and one file
    tsnorm.write_wide(run.wide(), out, sep=";", time_format="%m/%d/%Y %I:%M:%S %p", single_file=True)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert lines[:2] == ["timestamp;value_A;value_b_x", "03/01/2020 10:00:00 AM;0.0;1.5"] and len(lines) == 6


def test_output_with_one_instrument_is_valid_input(spark, write, columns, tmp_path):
    run = tsnorm.normalize_files(spark, "archive", write("a.csv", archive(*ROWS[:4])), period="1S")
    tsnorm.write_wide(run.wide(), str(tmp_path / "out"))
    again = tsnorm.normalize_files(spark, "normalized", str(tmp_path / "out"), period="1S")
    assert columns(again.wide()) == columns(run.wide())


def test_parts_are_in_time_order(spark, tmp_path):
    wide = spark.range(0, 5000, 1, 7).select(
        F.timestamp_seconds((F.col("id") * 7919) % 5000).alias("timestamp"), F.lit(1.0).alias("value_x"))
    tsnorm.write_wide(wide, str(tmp_path / "out"))
    seen = []
    for part in sorted((tmp_path / "out").glob("part-*.csv")):
        seen += [line.split(",")[0] for line in part.read_text().splitlines()[1:]]
    assert len(seen) == 5000 and seen == sorted(seen)


@pytest.mark.parametrize("period", ["1S", None])
def test_batch_is_the_single_runs(spark, write, tmp_path, columns, period):
    other = [(5, "A", "11:00:00.0", 1), (5, "A", "11:00:00.25", 2), (6, "c", "11:00:03.0", 4)]
    files = {"many/one": ROWS, "many/two": other}
    paths = {name: write(f"{name}.csv", archive(*rows)) for name, rows in files.items()}
    write("many/broken.csv", "a,b\n1,2\n")
    run = tsnorm.normalize_files(spark, "archive", str(tmp_path / "many"), per_file=True, period=period)
    long = run.long()
    for name, path in paths.items():
        single = columns(tsnorm.normalize_files(spark, "archive", path, period=period).wide())
        mine = long.where(F.col("source_file").endswith(name + ".csv")).toPandas()
        for instrument, rows in mine.groupby("instrument"):
            rows = rows.sort_values("timestamp")
            assert rows["mean"].tolist() == single[f"value_{instrument}"]
            assert len(rows) == len(single["timestamp"])
        assert mine.instrument.nunique() == len(single) - 1
    tsnorm.write_files(long, str(tmp_path / "out"), files=run.instruments)
    assert sorted(p.name for p in (tmp_path / "out").glob("source_file=*")) == [
        "source_file=one_ForExport", "source_file=two_ForExport"]
    back = spark.read.csv(str(tmp_path / "out"), header=True)
    assert back.count() == long.count()


def test_batches_do_not_mix_files_of_one_name(spark, tmp_path):
    long = spark.createDataFrame(
        [(f, "x", datetime(2020, 1, 1), 1.0) for f in ("in/x/a.csv", "in/y/a.csv", "in/y/b.csv")],
        "source_file string, instrument string, timestamp timestamp, mean double")
    for files in (None, long.select("source_file")):
        with pytest.raises(ValueError, match="1 folder names .* a_ForExport: 2 files, such as in/x/a.csv and in/y/a.csv"):
            tsnorm.write_files(long, str(tmp_path / "out"), files=files)
    assert not (tmp_path / "out").exists()
    tsnorm.write_files(long.where("source_file <> 'in/y/a.csv'"), str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("source_file=*"))) == 2


def test_gap_filling_is_cut_by_the_rows_it_makes(spark, write):
    rows = [(1, "x", "00:00:00.000", 1), (1, "x", "00:00:00.010", 2), (1, "x", "08:00:00.0", 3)]
    run = tsnorm.normalize_files(spark, "archive", write("a.csv", archive(*rows)), period="10L")
    assert run.tasks == 2 == run.long().rdd.getNumPartitions() == run.wide().rdd.getNumPartitions()
    assert run.long().count() == 8 * 3600 * 100 + 1


def test_wide_partitions_are_in_time_order(spark, write, tmp_path):
    rows = [(1, "x", "00:00:00.000", 1), (1, "x", "00:00:00.010", 2), (1, "x", "09:00:00.0", 3)]
    run = tsnorm.normalize_files(spark, "archive", write("a.csv", archive(*rows)), period="10L")
    tsnorm.write_wide(run.wide(), str(tmp_path / "out"), time_ordered=True)
    parts = sorted((tmp_path / "out").glob("part-*.csv"))
    seen = []
    for part in parts:
        seen += [line.split(",")[0] for line in part.read_text().splitlines()[1:]]
    assert len(parts) == run.tasks == 3 and len(seen) == 9 * 3600 * 100 + 1 and seen == sorted(seen)


def test_intermediate_tables_are_removed(spark, write):
    from pathlib import Path

    root = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(root.glob("tsnorm-*"))
    run = tsnorm.normalize_files(spark, "archive", write("a.csv", archive(*ROWS)), period="1S")
    made = set(root.glob("tsnorm-*")) - before
    assert len(made) == 1
    run.close()
    assert not any(p.exists() for p in made)


def test_wide_plan_shuffles_once_after_the_gaps_are_known(spark):
    """Filling and pivoting add no exchange to the one that brings chunks of time together."""
    df = spark.range(1000).select(
        F.concat(F.lit("i"), F.col("id") % 3).alias("instrument"), F.timestamp_millis(F.col("id") * 500).alias("ts"),
        F.col("id").cast("double").alias("value"), F.lit(0).alias("series"), F.col("id").alias("ord"))
    run = tsnorm.normalize(Readings(df, (), None, True), period="1S")
    plan = run.wide()._jdf.queryExecution().executedPlan().toString()
    top = plan[:plan.index("Union")]
    assert top.count("Exchange") == 1 and "REPARTITION_BY_NUM" in top
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
