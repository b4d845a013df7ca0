"""Listing, heads and records of CSV files against Python's own reader."""

import csv
import io
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import tsnorm
from tsnorm.session import Scratch
from tsnorm.sources import files as tsfiles
from tsnorm.sources import scan
from tsnorm.sources.records import ends_inside


@contextmanager
def settings(spark, **values):
    names = {k: f"spark.sql.files.{k}" for k in values}
    before = {n: spark.conf.get(n) for n in names.values()}
    for k, v in values.items():
        spark.conf.set(names[k], v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def cells_of(spark, paths, opts=None, width=None):
    """Rows of all files in order, cells as text."""
    opts, scratch = opts or tsnorm.CsvOptions(), Scratch(spark)
    headers = scan.read_headers(spark, paths, opts, scratch)
    n = width or headers.width
    cells = scan.read_cells(spark, headers, opts, scratch, least=n).join(headers.frame.select("file_no", "source_file"), "source_file")
    cells = cells.withColumn("ord", headers.order.of(True)).orderBy("ord")
    out = [tuple(r) for r in cells.select(*[f"_c{i}" for i in range(n)]).collect()]
    scratch.close()
    return out


def plain(text, n):
    """What a plain CSV reader gives: short rows filled, blank ones left out, leading blanks of cells too."""
    rows = list(csv.reader(io.StringIO(text, newline=""), skipinitialspace=True))
    rows = [r for r in rows if any(r)][1:]
    return [tuple(c or None for c in [*r, *[""] * (n - len(r))][:n]) for r in rows]


def quoted_text(seed, n):
    rng = random.Random(seed)
    cells = ["1", "2.5", "", "abc", '"x"', '"two\nlines"', '"a ""b"" c"', '"\n\n"', '""', '5" pipe', '"semi;,colon"', ' "lead\n\n, it"', '"""\n"""']
    rows = [",".join(rng.choice(cells if rng.random() < 0.3 else cells[:4]) for _ in range(3)) for _ in range(n)]
    return "t,\"na\nme\",c\n" + "\n".join(f"{i}," + r for i, r in enumerate(rows)) + "\n"


@pytest.mark.parametrize("seed,size", [(1, "200b"), (2, "350b"), (3, "1000b"), (4, "128m")])
def test_quoted_records_in_many_splits(spark, write, seed, size):
    text = quoted_text(seed, 400).replace("t,\"na\nme\",c", "t,\"na\nme\",c,d")
    path = write("q.csv", text)
    with settings(spark, maxPartitionBytes=size):
        assert cells_of(spark, [path]) == plain(text, 4)


def test_a_cell_longer_than_many_splits(spark, write):
    text = "t,a\n1,x\n2,\"" + "long\n" * 400 + "\"\n3,y\n4,\"" + "b\n" * 9 + "\"\n"
    path = write("q.csv", text)
    with settings(spark, maxPartitionBytes="100b"):
        got = cells_of(spark, [path])
    assert got == plain(text, 2) and len(got) == 4


@pytest.mark.parametrize("size", ["350b", "2000b"])
def test_separators_in_the_lines_of_a_cell(spark, write, size):
    """A line within a quoted cell is no row, however many separators it has; rows that are too long are found as before."""
    text = "t,a\n" + "".join(f'{i},"first\nx, y, z, {i}\n,,"\n{i},plain\n' for i in range(60)) + "".join(f"{i},end\n" for i in range(300))
    with settings(spark, maxPartitionBytes=size):
        assert cells_of(spark, [write("q.csv", text)]) == plain(text, 2)
        for at in (text.index("30,plain"), text.index("250,end")):  # in splits with such cells, and in those without
            path = write("l.csv", text[:at] + "7,too,long\n" + text[at:])
            with pytest.raises(Exception, match="a row of more than 2 cells in .*l.csv: 7,too,long"):
                cells_of(spark, [path])
            assert cells_of(spark, [path], tsnorm.CsvOptions(long_rows="skip")) == plain(text, 2)


def test_small_files_beside_one_that_is_split(spark, write):
    """Splits get larger with the bytes of the files that are scanned: those looked through for quoted breaks are those that are read."""
    texts = ["t,a\n" + "".join(f'{i},"{"x" * (i % 7)}\n\"\"{i}, {j},\n"\n' for i in range(n)) for j, n in enumerate((300, 20, 25, 1))]
    paths = [write(f"q{j}.csv", text) for j, text in enumerate(texts)]
    want = [r for text in texts for r in plain(text, 2)]
    for size in ("128m", "512b"):
        with settings(spark, maxPartitionBytes=size, openCostInBytes="1b"):
            assert cells_of(spark, paths) == want


@pytest.mark.parametrize("size", ["128m", "500b"])
def test_rows_are_counted_without_their_cells(spark, write, size):
    text = "t,a\n" + "".join(f'{i},"two\nlines {i}"\n' for i in range(40)) + "".join(f"{i},one\n" for i in range(300)) + "short\n"
    path, long = write("q.csv", text), write("l.csv", text + "7,too,long\n")

    def counted(at, **kw):
        scratch, opts = Scratch(spark), tsnorm.CsvOptions(**kw)
        return scan.read_cells(spark, scan.read_headers(spark, [at], opts, scratch), opts, scratch).count()

    with settings(spark, maxPartitionBytes=size):
        assert counted(path) == counted(path, quoted_breaks=size == "500b") == counted(long, long_rows="skip") == 341
        with pytest.raises(Exception, match="a row of more than 2 cells in .*l.csv: 7,too,long"):
            counted(long)


def test_lines_of_broken_splits_are_shuffled_once(spark, write):
    """Texts are not written to a table between and shuffled again; only what crosses splits meets a second time."""
    path = write("q.csv", "t,a\n" + "".join(f'{i},"two\nlines {i}"\n' for i in range(200)))
    with settings(spark, maxPartitionBytes="500b"):
        scratch = Scratch(spark)
        cells = scan.read_cells(spark, scan.read_headers(spark, [path], tsnorm.CsvOptions(), scratch), tsnorm.CsvOptions(), scratch)
        assert sorted(r["_c1"] for r in cells.collect()) == sorted(f"two\nlines {i}" for i in range(200))
        plan = cells._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Scan text") == 1 and "Scan parquet" not in plan and "ReusedExchange" in plan


@pytest.mark.parametrize("sep", [",", ";", "\t"])
def test_whether_a_line_ends_inside_a_cell(spark, sep):
    lines = ["a", '"a"', '"a', 'a"', '1;"a', '1; "a', '1;x"a', '""', '"""', '"a"";"b', '"a";"b', '"a" "b', 'b";"c', 'b"";"c', '";"', ";", '"a""']
    lines = [line.replace(";", sep) for line in lines]
    frame = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    got = frame.select("i", ends_inside(F.col("line"), F.lit(False), sep).alias("a"), ends_inside(F.col("line"), F.lit(True), sep).alias("b")).collect()

    def inside(line, state):
        at_start, i = True, 0
        while i < len(line):
            c = line[i]
            if state:
                if line[i:i + 2] == '""':
                    i += 1
                elif c == '"':
                    state = False
            elif c == '"' and at_start:
                state = True
            elif c == sep:
                at_start = True
                i += 1
                continue
            at_start = at_start and c == " " and not state
            i += 1
        return state

    for r in got:
        assert r.a == inside(lines[r.i], False), lines[r.i]
        assert r.b == inside(lines[r.i], True), lines[r.i]


def test_no_cell_of_the_readers_is_lost(spark, write):
    """Line breaks in a header and in a cell, and a row longer than the header."""
    from test_layouts import long

    head = "t,Bias,\"a\nx\",b\n"
    path = write("h.csv", head + "2020-03-01 10:00:00,0,1,2\n2020-03-01 10:00:01,0,\"3\n\",4\n")
    assert long(tsnorm.read(spark, "normalized", path)) == [
        ("a\nx", "10:00:00.000", 1.0), ("a\nx", "10:00:01.000", 3.0), ("b", "10:00:00.000", 2.0), ("b", "10:00:01.000", 4.0)]
    path = write("l.csv", "t,Bias,a\n2020-03-01 10:00:00,0,1,,\n2020-03-01 10:00:01,0,3,4,5\n")
    with pytest.raises(Exception, match="a row of more than 3 cells in .*l.csv: 2020-03-01 10:00:01,0,3,4,5"):
        long(tsnorm.read(spark, "normalized", path))
    assert long(tsnorm.read(spark, "normalized", path, tsnorm.CsvOptions(long_rows="skip"))) == [("a", "10:00:00.000", 1.0)]
    # the widest header is not that of each file
    wide = write("w.csv", "t,Bias,a,b,c\n2020-03-01 10:00:00,0,7,8,9\n")
    with pytest.raises(Exception, match="a row of more than 5 cells in .*l.csv"):
        long(tsnorm.read(spark, "normalized", [wide, path]))
    regex = write("r.csv", "t|Bias|a\n2020-03-01 10:00:00|0|1|\n2020-03-01 10:00:01|0|3|4\n")
    with pytest.raises(Exception, match="a row of more than 3 cells in .*r.csv"):
        long(tsnorm.read(spark, "normalized", regex, tsnorm.CsvOptions(sep=r"\|\s*")))


def test_strain_with_line_breaks_in_cells(spark, write):
    from test_layouts import long, strain

    text = strain("3/1/2020 10:00:00 AM").replace("SG-1 a", '"SG-1\na"').replace('"Session:  ""one"""', '"Session\n\n""one"""')
    got = {i for i, _, _ in long(tsnorm.read(spark, "strain", write("s.csv", text)))}
    assert got == {"EX_2_(mm)", "SG_1\na_(uStrain)"}


def bytes_read(spark):
    return sum(s.getBytesRead() for s in spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_heads_do_not_cost_more_for_longer_files(spark, write, monkeypatch):
    opened = []
    monkeypatch.setattr(tsfiles, "HEAD_BYTES", 1000)
    for n in (10, 200_000):
        path = write(f"f{n}.csv", "t,\"a\nb\"\n" + "2020-01-01 00:00:00,1\n" * n)
        scratch = Scratch(spark)
        before = bytes_read(spark)
        files = tsfiles.list_files(spark, [path], scratch)
        lines = scan.first_lines(spark, files, tsnorm.CsvOptions()).rows
        assert [(r["line"], r["width"]) for r in lines] == [('t,"a\nb"', 2)]
        opened.append(bytes_read(spark) - before)
    assert opened[0] == opened[1] < 10_000
    assert tsfiles.read_head(f"file:{path}", "utf-8") == ['t,"a', 'b"']
    assert tsfiles.read_head("nowhere://x/y.csv", "utf-8") is None


def test_headers_of_files_python_cannot_open(spark, write, monkeypatch):
    for n in (1, 2):
        paths = [write(f"f{i}.csv", f"\n\nt,Bias,a{i}\n2020-01-01 00:00:0{i},0,{i}\n") for i in range(n)]
        scratch = Scratch(spark)
        files = tsfiles.list_files(spark, paths, scratch)
        closed = files.frame.select("file_no", "entry", "source_file", F.expr("cast(null as array<string>)").alias("lines"))
        monkeypatch.setattr(scan, "head_lines", lambda files, encoding, closed=closed: closed)
        got = sorted(scan.first_lines(spark, files, tsnorm.CsvOptions()).rows, key=lambda r: r["file_no"])
        assert [r["line"] for r in got] == [f"t,Bias,a{i}" for i in range(n)]


def test_files_entries_and_missing_paths(spark, write, tmp_path):
    a, b, c = (write(f"in/{n}.csv", "t,Bias,x\n2020-03-01 10:00:00,0,1\n") for n in ("a 1", "b", "c"))
    scratch = Scratch(spark)
    files = tsfiles.list_files(spark, [c, str(tmp_path / "in"), a, str(tmp_path / "in" / "[bc].csv")], scratch)
    got = [(r["file_no"], r["entry"], r["source_file"].rsplit("/", 1)[1]) for r in sorted(files.rows, key=lambda r: r["file_no"])]
    assert [g[1:] for g in got] == [
        (0, "c.csv"), (1, "a%201.csv"), (1, "b.csv"), (1, "c.csv"), (2, "a%201.csv"), (3, "b.csv"), (3, "c.csv")]
    assert [g[0] for g in got] == list(range(7))
    with pytest.raises(FileNotFoundError, match="1 of 2 paths do not exist: .*gone.csv"):
        tsfiles.list_files(spark, [a, str(tmp_path / "gone.csv")], scratch)
    some = tsfiles.list_files(spark, [a, str(tmp_path / "gone.csv")], scratch, skip_missing=True)
    assert some.n == 1 and some.missing == [str(tmp_path / "gone.csv")]
    with pytest.raises(tsnorm.NoData):
        tsfiles.list_files(spark, [str(tmp_path / "gone.csv")], scratch, skip_missing=True)


@pytest.mark.parametrize("layout", ["archive", "normalized", "trend"])
def test_one_plan_and_as_many_jobs_for_any_number_of_paths(spark, write, layout):
    head, row = {
        "archive": ("TagId,TagName,TimeStamp,DataSource,Value,Quality", "1,x,2020-03-01 10:00:{:02d},D,{},1"),
        "normalized": ("t,Bias,x", "2020-03-01 10:00:{:02d},0,{}"), "trend": ("x Time,x V", "03/01/2020 10:00:{:02d},{}"),
    }[layout]
    paths = [write(f"f{i:03d}.csv", f"{head}\n{row.format(i % 60, i)}\n") for i in range(120)]
    tracker, seen = spark.sparkContext.statusTracker(), []
    threshold = "spark.sql.sources.parallelPartitionDiscovery.threshold"
    spark.conf.set(threshold, "1000")  # else Spark lists many paths in a job of its own
    try:
        for n in (2, 120):
            spark.sparkContext.setJobGroup(f"paths-{layout}-{n}", "")
            got = tsnorm.read(spark, layout, paths[:n])
            plan = got.frame._jdf.queryExecution().optimizedPlan().toString()
            rows = tsnorm.normalize_files(spark, layout, paths[:n], period="1S")
            seen.append((len(plan.splitlines()), len(tracker.getJobIdsForGroup(f"paths-{layout}-{n}"))))
            top = rows.long().orderBy(F.desc("timestamp")).first()
            assert top["mean"] == (1 if n == 2 else 119)  # the last path wins
    finally:
        spark.conf.unset(threshold)
        spark.sparkContext.setJobGroup("rest", "")
    assert seen[0] == seen[1]
