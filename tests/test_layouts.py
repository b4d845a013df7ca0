"""Readers on small files of our own in the four layouts."""

import pytest
from pyspark.sql import functions as F

import tsnorm

HEAD = "TagId,TagName,TimeStamp,DataSource,Value,Quality\n"


def archive(*rows):
    return HEAD + "".join(f"{i},{n},2020-03-01 {t},DS,{v},128\n" for i, n, t, v in rows)


def long(readings, query=None):
    from tsnorm.operators.dedupe import append_series

    rows = append_series(readings.frame, readings.keys, query, readings.unique)
    return sorted(
        (r.instrument, r.t, r.value)
        for r in rows.select("instrument", F.date_format("ts", "HH:mm:ss.SSS").alias("t"), "value").collect())


def names(readings):
    return sorted(r.instrument for r in readings.instruments.select("instrument").collect())


def test_archive(spark, write):
    path = write("a.csv", archive(
        (7, "Pump-1.Out", "10:00:00.000000000", 1), (8, "Pump 2", "10:00:00.500000000", 2),
        (7, "Pump-1.Out", "10:00:01.000000000", 3), (7, "Other name", "10:00:01.000400000", 4),
        (8, "Pump 2", "no time", 9), (8, "Pump 2", "10:00:02.000000000", "broken"), (9, "", "10:00:00.000000000", 5)))
    got = tsnorm.read(spark, "archive", path)
    # the first name of a tag counts, the last value of a rounded time, tags without a name do not exist
    assert long(got) == [("Pump_1_Out", "10:00:00.000", 1.0), ("Pump_1_Out", "10:00:01.000", 4.0), ("Pump_2", "10:00:00.500", 2.0)]
    assert names(got) == ["Pump_1_Out", "Pump_2"]


def test_archive_missing_last_value_hides_earlier(spark, write):
    path = write("a.csv", archive((1, "x", "10:00:00.0", 1), (1, "x", "10:00:00.0", ""), (1, "x", "10:00:01.0", 2)))
    assert long(tsnorm.read(spark, "archive", path)) == [("x", "10:00:01.000", 2.0)]


def test_archive_merge_by_column_name(spark, write):
    base = write("a.csv", archive((1, "x", "10:00:00.0", 1), (1, "x", "10:00:01.0", 2)))
    other = write("b.csv", "Value,TimeStamp,TagId,TagName\n5,2020-03-01 10:00:01.0,01,x\n6,2020-03-01 10:00:02.0,2,y\n")
    assert long(tsnorm.read(spark, "archive", [base, other])) == [
        ("x", "10:00:00.000", 1.0), ("x", "10:00:01.000", 5.0), ("y", "10:00:02.000", 6.0)]
    # the other way round the merge file is the one in short form and has too few columns to be a base
    with pytest.raises(tsnorm.NoData):
        tsnorm.read(spark, "archive", [other, base])


def test_archive_same_instrument_from_two_tags(spark, write):
    path = write("a.csv", archive(
        (10, "A-B", "10:00:00.0", 50), (9, "A.B", "10:00:00.0", 1), (9, "A.B", "10:00:01.0", 2)))
    got = tsnorm.read(spark, "archive", path)
    assert long(got) == [("A_B", "10:00:00.000", 50.0), ("A_B", "10:00:01.000", 2.0)]
    # the filter applies to each tag before they meet
    assert long(got, "val < 10") == [("A_B", "10:00:00.000", 1.0), ("A_B", "10:00:01.000", 2.0)]


def test_filter_does_not_bring_back_earlier_value(spark, write):
    path = write("a.csv", archive((1, "x", "10:00:00.0", 1), (1, "x", "10:00:00.0", 99)))
    assert long(tsnorm.read(spark, "archive", path), "val < 10") == []


@pytest.mark.parametrize("layout,text", [
    ("archive", HEAD.strip() + ",Quality\n1,x,2020-03-01 10:00:00,D,1,1,1\n"),
    ("normalized", "t,Bias,a,b,a\n2020-03-01 10:00:00,0,1,2,3\n"),
])
def test_duplicate_columns_are_rejected(spark, write, layout, text):
    with pytest.raises(tsnorm.DuplicateColumns):
        tsnorm.read(spark, layout, write("a.csv", text))


def test_too_few_columns(spark, write):
    with pytest.raises(tsnorm.NoData):
        tsnorm.read(spark, "archive", write("a.csv", "a,b,c\n1,2,3\n"))


def test_normalized(spark, write):
    path = write("n.csv", (
        "Time_Stamp,Bias,Tank-A,Tank B\n"
        "2020-03-01 10:00:02.0000000,420,1,2\n2020-03-01 10:00:01.0000000,420,3,\n"
        "2020-03-01 10:00:02.0000000,420,,5\nnot a time,420,7,7\n"))
    got = tsnorm.read(spark, "normalized", path)
    # the later row of 10:00:02 replaces the earlier one whole, its missing cell included
    assert long(got) == [("Tank_A", "10:00:01.000", 3.0), ("Tank_B", "10:00:02.000", 5.0)]
    assert names(got) == ["Tank_A", "Tank_B"]
    assert got.unique


def test_normalized_merge(spark, write):
    a = write("a.csv", "t,Bias,x,y\n2020-03-01 10:00:00,0,1,2\n2020-03-01 10:00:01,0,3,4\n")
    b = write("b.csv", "t,Bias,z,x\n2020-03-01 10:00:01,0,5,6\n2020-03-01 10:00:02,0,7,\n")
    assert long(tsnorm.read(spark, "normalized", [a, b])) == [
        ("x", "10:00:00.000", 1.0), ("x", "10:00:01.000", 6.0), ("y", "10:00:00.000", 2.0),
        ("y", "10:00:01.000", 4.0), ("z", "10:00:01.000", 5.0), ("z", "10:00:02.000", 7.0)]


def test_normalized_same_instrument_from_two_columns(spark, write):
    # a-b is left of a.b in the merged header, although the second file has it last
    a = write("a.csv", "t,Bias,a-b,q\n2020-03-01 10:00:00,0,1,0\n")
    b = write("b.csv", "t,Bias,a.b,a-b\n2020-03-01 10:00:00,0,2,3\n")
    assert long(tsnorm.read(spark, "normalized", [a, b])) == [("a_b", "10:00:00.000", 2.0), ("q", "10:00:00.000", 0.0)]


def test_trend(spark, write):
    path = write("t.csv", (
        "Tank 1 Time,Tank 1 ValueY,P.2 Time,P.2 ValueY,Tank 1 Time,Tank 1 ValueY\n"
        "03/01/2020 10:00:00.5,1,03/01/2020 10:00:07,5,03/01/2020 10:00:01.5,8\n"
        "03/01/2020 10:00:01.5,2,,,,\n"))
    assert long(tsnorm.read(spark, "trend", path)) == [
        ("P_2", "10:00:07.000", 5.0), ("Tank_1", "10:00:00.500", 1.0), ("Tank_1", "10:00:01.500", 8.0)]


def test_trend_merge(spark, write):
    a = write("a.csv", "x Time,x V\n03/01/2020 10:00:00.0,1\n03/01/2020 10:00:01.0,2\n")
    b = write("b.csv", "y Time,y V,x Time,x V\n03/01/2020 10:00:05.0,9,03/01/2020 10:00:01.0,7\n")
    assert long(tsnorm.read(spark, "trend", [a, b])) == [
        ("x", "10:00:00.000", 1.0), ("x", "10:00:01.000", 7.0), ("y", "10:00:05.000", 9.0)]
    assert long(tsnorm.read(spark, "trend", [b, a]))[1] == ("x", "10:00:01.000", 2.0)


def strain(start, junk="", unit="Seconds Elapsed", rows=((1, 1, 10, 5), (2, 2.5, 20, 6), (3, "broken", 30, 7))):
    lines = [
        f"{junk}some, text, wider, than, all, other, rows", f'{junk}"Session:  ""one"""', f"{junk}Start Time:  {start}",
        junk, f"{junk}Assignment:,,SG-1 a,EX.2,empty", f"{junk}Reduction Method: ,,Strain,mm,mm",
        f"{junk}ID,{unit},[1] Strain,[2] mm,[3] mm", *[junk + ",".join(map(str, r)) + "," for r in rows]]
    return "\n".join(lines) + "\n"


@pytest.mark.parametrize("junk", ["", "7,8,"])
def test_strain(spark, write, junk):
    got = tsnorm.read(spark, "strain", write("s.csv", strain("3/1/2020 9:59:58 AM", junk)))
    assert long(got) == [
        ("EX_2_(mm)", "09:59:59.000", 5.0), ("EX_2_(mm)", "10:00:00.500", 6.0),
        ("SG_1_a_(uStrain)", "09:59:59.000", 10.0), ("SG_1_a_(uStrain)", "10:00:00.500", 20.0)]
    assert names(got) == ["EX_2_(mm)", "SG_1_a_(uStrain)"]


def test_strain_keeps_columns_right_of_a_narrow_first_line(spark, write):
    text = strain("3/1/2020 9:59:58 AM").replace("some, text, wider, than, all, other, rows", "a,b")
    assert len(long(tsnorm.read(spark, "strain", write("s.csv", text)))) == 4


def test_strain_keeps_all_rows_when_splits_change(spark, write, tmp_path):
    for i in range(12):
        write(f"many/s{i:02}.csv", strain("3/1/2020 10:00:00 AM", rows=[(n, n + 100 * i, n, n + 0.5) for n in range(30)]))
    got = tsnorm.read(spark, "strain", str(tmp_path / "many"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        assert got.frame.where("value is not null").count() == 12 * 30 * 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_strain_survives_odd_elapsed_cells(spark, write):
    rows = [(1, 1, 10, 5), (2, "Infinity", 1, 1), (3, "NAN", 1, 1), (4, "1e30", 1, 1), (5, "5d", 1, 1)]
    assert len(long(tsnorm.read(spark, "strain", write("s.csv", strain("3/1/2020 10:00:00 AM", rows=rows))))) == 2


def test_strain_merge_of_different_headers(spark, write):
    a = write("a.csv", strain("3/1/2020 10:00:00 AM"))
    b = write("b.csv", strain("3/1/2020 10:00:00 AM", "j,", "Elapsed Minutes", ((1, 1, 77, 78),)).replace("EX.2", "EX 9"))
    got = long(tsnorm.read(spark, "strain", [a, b]))
    assert ("SG_1_a_(uStrain)", "10:01:00.000", 77.0) in got and ("EX_9_(mm)", "10:01:00.000", 78.0) in got
    assert len(got) == 6


@pytest.mark.parametrize("label,problem", [
    ("ID,", "'ID'"), ("Start Time:", "Start Time"), ("Assignment:", "Assignment"), ("Reduction Method:", "Reduction"),
    ("Elapsed", "Elapsed")])
def test_strain_preamble_problems(spark, write, label, problem):
    path = write("s.csv", strain("3/1/2020 10:00:00 AM").replace(label, "gone,"))
    with pytest.raises(tsnorm.NoData, match=problem):
        tsnorm.read(spark, "strain", path)


def test_delimiters_and_encoding(spark, write, tmp_path):
    want = [("x", "10:00:00.000", 1.0), ("é", "10:00:00.000", 2.0)]
    text = "t,Bias,x,é\n2020-03-01 10:00:00,0,1,2\n"
    assert long(tsnorm.read(spark, "normalized", write("a.csv", text.replace(",", ";")), tsnorm.CsvOptions(sep=";"))) == want
    regex = tsnorm.CsvOptions(sep=r"\s*[|;]\s*")
    assert long(tsnorm.read(spark, "normalized", write("b.csv", text.replace(",", " | ")), regex)) == want
    latin = tmp_path / "c.csv"
    latin.write_bytes(text.encode("latin-1"))
    assert long(tsnorm.read(spark, "normalized", str(latin), tsnorm.CsvOptions(encoding="iso_8859_1"))) == want


@pytest.mark.parametrize("per_file", [False, True])
def test_folder_with_different_headers(spark, write, per_file):
    write("many/a.csv", "t,Bias,x,y\n2020-03-01 10:00:00,0,1,2\n")
    folder = write("many/b.csv", "t,z,Bias,w,x\n2020-03-01 10:00:00,5,0,6,7\n").rsplit("/", 1)[0]
    got = tsnorm.read(spark, "normalized", folder, per_file=per_file)
    values = [(i, v) for i, _, v in long(got)]
    assert values == ([("w", 6.0), ("x", 1.0), ("x", 7.0), ("y", 2.0), ("z", 5.0)] if per_file
                      else [("w", 6.0), ("x", 7.0), ("y", 2.0), ("z", 5.0)])


def test_row_order_over_split_files(spark, write):
    """Later rows win although the file is read in many pieces."""
    rows = [(1, "x", f"10:00:{i % 50:02d}.0", i) for i in range(20_000)]
    path = write("big.csv", archive(*rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = long(tsnorm.read(spark, "archive", path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [("x", f"10:00:{s:02d}.000", 19_950.0 + s) for s in range(50)]
