"""Wide batches, files joined from parts, and what a run reports."""

import json
import sys

import pytest
from pyspark.sql import functions as F

import tsnorm
from test_runs import ROWS, archive

OTHER = [(5, "A", "11:00:00.0", 1), (5, "A", "11:00:00.25", 2), (6, "c", "11:00:03.0", 4)]


def text_of(folder):
    """Lines of a folder of parts, with one header."""
    parts = [p.read_text().splitlines() for p in sorted(folder.glob("part-*.csv"))]
    assert len({p[0] for p in parts}) == 1
    return [parts[0][0], *[line for p in parts for line in p[1:]]]


def test_wide_batch_of_several_sets_of_columns(spark, write, tmp_path):
    """Three sets of columns in five files, one file missing, one that is no archive."""
    rows = {
        "one": ROWS, "two": OTHER, "three": [(i, n, t.replace("10:", "12:"), v + 7) for i, n, t, v in ROWS],
        "four": [(1, "b.x", "10:00:00.2", 1), (1, "b.x", "10:00:05.0", 2)], "five": [(i, n, t.replace("10:", "13:"), v) for i, n, t, v in ROWS]}
    paths = {n: write(f"in/{n}.csv", archive(*r)) for n, r in rows.items()}
    broken = write("in/broken.csv", "a,b\n1,2\n")
    gone = str(tmp_path / "in" / "gone.csv")
    run = tsnorm.normalize_files(spark, "archive", [*paths.values(), broken, gone], per_file=True, period="1S", report=True)
    assert len(list(run.wide_files())) == 3
    out = tmp_path / "out"
    for _ in range(2):  # the second time over the first
        tsnorm.write_run(run, str(out))
    assert sorted(p.name for p in out.glob("source_file=*")) == sorted(f"source_file={n}_ForExport" for n in rows)
    for name, path in paths.items():
        single = tsnorm.normalize_files(spark, "archive", path, period="1S")
        tsnorm.write_run(single, str(tmp_path / name))
        lines = text_of(out / f"source_file={name}_ForExport")
        assert lines == text_of(tmp_path / name) and len(lines) > 1
    report = run.report()
    assert report.missing == [gone]
    assert [r.source_file.rsplit("/", 1)[1] for r in report.left_out.collect()] == ["broken.csv"]
    assert report.rows["n_rows"] == report.rows["kept"] == sum(map(len, rows.values()))  # of the files that were used
    with pytest.raises(ValueError):
        tsnorm.write_run(run, str(out), single_file=True)


def test_wide_batch_in_chunks_and_parts(spark, write, tmp_path, monkeypatch):
    plan = sys.modules["tsnorm.plans.normalize"]
    monkeypatch.setattr(plan, "TASK_CELLS", 500)
    monkeypatch.setattr(plan, "WIDE_CHUNK_CELLS", 100)
    day = [(1, "x", f"{h:02d}:00:{s:02d}.0", h + s) for h in (1, 2) for s in range(3)]
    paths = [write(f"{n}.csv", archive(*day[k:])) for k, n in enumerate("abc")]
    run = tsnorm.normalize_files(spark, "archive", paths, per_file=True, period="1S")
    frame = next(run.wide_files())
    assert frame.rdd.getNumPartitions() > 3
    plan_text = frame._jdf.queryExecution().executedPlan().toString()
    top = plan_text[:plan_text.index("REPARTITION_BY_NUM")]
    assert top.count("Exchange") == 1  # the one that brings a chunk of time together
    tsnorm.write_run(run, str(tmp_path / "out"))
    for n, path in zip("abc", paths, strict=True):
        tsnorm.write_run(tsnorm.normalize_files(spark, "archive", path, period="1S"), str(tmp_path / n))
        assert text_of(tmp_path / "out" / f"source_file={n}_ForExport") == text_of(tmp_path / n)


@pytest.mark.parametrize("encoding", ["utf_8", "utf_16", "iso_8859_1"])
def test_one_file_has_the_bytes_of_one_writer(spark, tmp_path, encoding):
    wide = spark.range(0, 3000, 1, 5).select(
        F.timestamp_seconds((F.col("id") * 7919) % 3000).alias("timestamp"), (F.col("id") % 7).cast("double").alias('value_"é",x'))
    out = str(tmp_path / "one.csv")
    tsnorm.write_wide(wide, out, encoding=encoding, sep=";", notice=["For; internal", "use"], single_file=True)
    parts = wide.coalesce(1).sortWithinPartitions("timestamp")
    (tmp_path / "x").mkdir()
    shown = parts.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    shown.write.options(header=True, sep=";", escape='"', emptyValue="").csv(str(tmp_path / "x" / "ref"))
    want = "For; internal\nuse\n" + next((tmp_path / "x" / "ref").glob("part-*.csv")).read_text(encoding="utf-8")
    got = (tmp_path / "one.csv").read_bytes()
    assert got == (want.encode(encoding) if encoding != "utf_16" else b"\xfe\xff" + want.encode("utf-16-be"))
    assert not [p for p in tmp_path.iterdir() if "parts" in p.name]


def test_one_file_is_written_in_parts_and_joined_by_its_manifest(spark, tmp_path):
    from tsnorm.sinks.one_file import write_one_file

    rows = spark.range(0, 1000, 1, 8).select(F.col("id").cast("string").alias("a"))
    manifest = write_one_file(rows, str(tmp_path / "one.csv"), {"header": True, "sep": ",", "encoding": "utf-8", "escape": '"', "emptyValue": ""})
    assert len(manifest["parts"]) == 8 and json.dumps(manifest)
    text = (tmp_path / "one.csv").read_text()
    assert text == "a\n" + "".join(f"{i}\n" for i in range(1000))
    assert manifest["head"] + sum(p["length"] for p in manifest["parts"]) == len(text)


def test_a_notice_of_an_earlier_run_goes(spark, tmp_path):
    wide = spark.range(3).select(F.timestamp_seconds("id").alias("timestamp"), F.lit(1.0).alias("value_x"))
    out = str(tmp_path / "out")
    tsnorm.write_wide(wide, out, notice=["a"])
    assert (tmp_path / "out.notice").exists()
    tsnorm.write_wide(wide, out)
    assert not (tmp_path / "out.notice").exists()
    tsnorm.write_wide(wide, out, notice=["a"], single_file=True)
    assert (tmp_path / "out").read_text().splitlines()[:2] == ["a", "timestamp,value_x"]


def test_times_are_written_as_in_the_source(spark, write, tmp_path):
    trend = write("t.csv", "x Time,x V\n03/01/2020 10:00:00.5,1\n03/01/2020 10:00:01.5,2\n")
    tsnorm.write_run(tsnorm.normalize_files(spark, "trend", trend, period="500L"), str(tmp_path / "t"), single_file=True)
    assert (tmp_path / "t").read_text().splitlines()[1] == "03/01/2020 10:00:00.500000,1.0"
    iso = write("n.csv", "t,Bias,x\n2020-03-01T10:00:00,0,1\n2020-03-01T10:00:01,0,2\n")
    run = tsnorm.normalize_files(spark, "normalized", iso, time_format="%Y-%m-%dT%H:%M:%S")
    tsnorm.write_run(run, str(tmp_path / "n"), single_file=True)
    assert (tmp_path / "n").read_text().splitlines()[1:] == ["2020-03-01T10:00:00,1.0", "2020-03-01T10:00:01,2.0"]
    tsnorm.write_run(run, str(tmp_path / "n"), single_file=True, time_format="%d.%m.%Y %H:%M:%S")
    assert (tmp_path / "n").read_text().splitlines()[1] == "01.03.2020 10:00:00,1.0"


REPORTS = {
    "archive": (
        ["TagId,TagName,TimeStamp,DataSource,Value,Quality\n1,x,2020-03-01 10:00:00,D,1,1\n1,x,2020-03-01 10:00:00,D,2,1\n"
         "1,x,never,D,3,1\n1,x,2020-03-01 10:00:01,D,no,1\n1,x,2020-03-01 10:00:02,D,,1\n"], (5, 1, 1, 1)),
    "trend": (
        ["x Time,x V,y Time,y V\n03/01/2020 10:00:00.0,1,never,1\n03/01/2020 10:00:00.0,2,03/01/2020 10:00:01.0,bad\n,,03/01/2020 10:00:02.0,5\n"],
        (5, 1, 1, 2)),
    "normalized": (
        ["t,Bias,x,y\n2020-03-01 10:00:00,0,1,no\nnever,0,2,3\n2020-03-01 10:00:01,0,,4\n",
         "t,Bias,z\n2020-03-01 10:00:00,0,no\n2020-03-01 10:00:00,0,8\n"], (5, 1, 2, 3)),
}


@pytest.mark.parametrize("layout", sorted(REPORTS))
def test_rows_are_counted_while_they_are_read(spark, write, layout):
    texts, want = REPORTS[layout]
    paths = [write(f"f{i}.csv", t) for i, t in enumerate(texts)]
    run = tsnorm.normalize_files(spark, layout, paths, period="1S", report=True)
    got = run.report().rows
    assert (got["n_rows"], got["bad_times"], got["bad_values"], got["kept"]) == want
    with pytest.raises(ValueError):
        tsnorm.normalize_files(spark, layout, paths, period="1S").report()


def test_reports_tell_repeated_and_shared_names(spark, write):
    a = write("a.csv", "x Time,x V,x Time,x V\n03/01/2020 10:00:00.0,1,03/01/2020 10:00:01.0,2\n")
    b = write("b.csv", "y Time,y V,x Time,x V\n03/01/2020 10:00:00.0,1,03/01/2020 10:00:01.0,2\n")
    report = tsnorm.normalize_files(spark, "trend", [a, b], report=True).report()
    assert [(r.source_file.rsplit("/", 1)[1], r.name, r.n) for r in report.repeated_names.orderBy("name").collect()] == [
        ("a.csv", "x Time", 2), ("a.csv", "x V", 2)]
    assert sorted((r.name, r.n_files) for r in report.shared_names.collect()) == [("x Time", 2), ("x V", 2)]


def test_strain_report(spark, write):
    from test_layouts import strain

    path = write("s.csv", strain("3/1/2020 9:59:58 AM"))
    got = tsnorm.normalize_files(spark, "strain", path, report=True).report()
    assert got.rows == {"n_rows": 3, "bad_times": 1, "bad_values": 0, "kept": 4}
    assert got.shared_names.count() == 0 and got.left_out.count() == 0
