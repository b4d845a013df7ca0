"""Operators against brute force on random small inputs."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tsnorm.operators import dedupe, fill, grid, period, resample
from tsnorm.operators.asof import asof_backward
from tsnorm.operators.merge import merge_rows


def random_rows(seed, n=300, names="abc", span=5_000):
    """(instrument, milliseconds, value, ord) with repeated times; one instrument has half of all rows."""
    rng = random.Random(seed)
    return [
        (names[0] if rng.random() < 0.5 else rng.choice(names), rng.randrange(span), rng.choice([None, float(rng.randrange(100))]), i)
        for i in range(n)
    ]


def readings(spark, rows):
    df = spark.createDataFrame(rows, "instrument string, ms bigint, value double, ord bigint")
    return df.select("instrument", F.timestamp_millis("ms").alias("ts"), "value", F.lit(0).alias("series"), "ord", "ms")


def collected(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("seed", range(3))
def test_last_wins(spark, seed):
    rows = random_rows(seed)
    df = readings(spark, rows)
    want = {}
    for name, ms, value, _ in rows:
        want[name, ms] = value
    key = lambda t: (t[0], t[1], t[2] is not None, t[2] or 0)
    once = dedupe.last_wins(df, ["instrument", "ms"], ["value"], F.col("ord"))
    got = sorted((tuple(r) for r in once.collect()), key=key)
    assert got == sorted(((n, m, v) for (n, m), v in want.items()), key=key)
    # the order of the rows does not matter, and a second time changes nothing
    again = dedupe.last_wins(df.orderBy(F.rand(seed)), ["instrument", "ms"], ["value"], F.col("ord"))
    assert sorted((tuple(r) for r in again.collect()), key=key) == got


def test_append_is_the_same_for_split_input(spark):
    df = readings(spark, random_rows(5))
    whole = dedupe.append_series(df)
    parts = merge_rows([df.where("ord < 100"), df.where("ord >= 100 and ord < 180"), df.where("ord >= 180")])
    assert collected(dedupe.append_series(parts), "instrument", "ts", "value") == collected(
        whole, "instrument", "ts", "value")


def test_replace_series(spark):
    base = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "instrument string, value int")
    new = spark.createDataFrame([("a", 9), ("c", 8)], "instrument string, value int")
    assert collected(dedupe.replace_series(base, new), "instrument", "value") == [("a", 9), ("b", 3), ("c", 8)]


@pytest.mark.parametrize("chunk_us", [1_000, 50_000, 10**12])
def test_min_gap(spark, chunk_us):
    rows = random_rows(7, 60) + [("single", 5, 1.0, 1), ("single", 5, 2.0, 2)]
    want = {}
    for name in {r[0] for r in rows}:
        times = sorted({r[1] for r in rows if r[0] == name})
        if len(times) > 1:
            want[name] = int(min(np.diff(times))) * 1000
    df = readings(spark, rows).select("instrument", F.unix_micros("ts").alias("us"))
    assert dict(collected(period.min_gap(df, ["instrument"], chunk_us), "instrument", "gap_us")) == want


@pytest.mark.parametrize("seed", range(2))
def test_resample(spark, seed):
    rows = [r for r in random_rows(seed) if r[2] is not None]
    df = readings(spark, rows)
    got = resample.resample(df, 700_000, resample.ORDER, order=["ord"]).toPandas()
    got = got.sort_values(["instrument", "bucket"]).reset_index(drop=True)
    pdf = pd.DataFrame(rows, columns=["instrument", "ms", "value", "ord"]).sort_values(["ms", "ord"])
    pdf["bucket"] = pdf.ms // 700 * 700
    want = pdf.groupby(["instrument", "bucket"]).value.agg(["first", "min", "max", "mean", "std"]).reset_index()
    assert len(got) == len(want)
    for mine, theirs in zip(resample.ORDER, ["first", "min", "max", "mean", "std"]):
        np.testing.assert_allclose(got[mine].astype(float), want[theirs], equal_nan=True)


@pytest.mark.parametrize("chunk", [1, 3, 7, 1000])
def test_align_is_the_same_for_every_chunk_size(spark, chunk):
    rng = random.Random(chunk)
    points, names = 40, ["a", "b", "first", "last", "none"]
    at = {"a": rng.sample(range(points), 9), "b": [0, 1, 2, 39], "first": [0], "last": [39], "none": []}
    rows = [(n, p, float(rng.randrange(50)) if rng.random() < 0.9 else None) for n in names for p in at[n]]
    labelled = spark.createDataFrame(rows, "instrument string, point bigint, v double")
    instruments = spark.createDataFrame([(n,) for n in names], "instrument string")
    want = []
    for n in names:
        known, current = {p: v for m, p, v in rows if m == n}, None
        for p in range(points):
            # a row carries on as it is: a missing value is not skipped
            current = known[p] if p in known else current
            want.append((n, 5_000 + p * 10, -1.0 if current is None else current))
    one = grid.Grid(5_000, 10, points)
    got = fill.align(labelled, instruments, ["v"], grid=one, chunk_points=chunk)
    shape = ("instrument", F.unix_micros("timestamp").alias("us"), F.coalesce("v", F.lit(-1.0)))
    assert collected(got, *shape) == sorted(want)
    # the same with the grid as columns
    extra = [F.lit(x).cast("bigint").alias(c) for c, x in zip(grid.GRID_COLUMNS, (5_000, 10, points))]
    got = fill.align(labelled.select("*", *extra), instruments.select("*", *extra), ["v"], chunk_points=chunk)
    assert collected(got, *shape) == sorted(want)


@pytest.mark.parametrize("chunk_us", [3_000, 100_000, 10**12])
def test_locf(spark, chunk_us):
    rng = random.Random(3)
    rows = [(n, ms, rng.choice([None, None, float(ms)])) for n in "ab" for ms in rng.sample(range(1000), 80)]
    df = spark.createDataFrame(rows, "k string, ms bigint, v double").withColumn("ts", F.timestamp_millis("ms"))
    want = []
    for n in "ab":
        current = None
        for _, ms, v in sorted(r for r in [(a, b, c) for a, b, c in rows] if r[0] == n):
            current = current if v is None else v
            want.append((n, ms, -1.0 if current is None else current))
    got = fill.locf(df, ["k"], "ts", "v", chunk_us)
    assert collected(got, "k", "ms", F.coalesce("v", F.lit(-1.0))) == sorted(want)


@pytest.mark.parametrize("chunk_us", [2_000, 100_000, 10**12])
def test_asof(spark, chunk_us):
    rng = random.Random(chunk_us)
    left = [(rng.choice("aab"), rng.randrange(400), i) for i in range(150)] + [("c", 5, 1000), (None, 5, 1001)]
    right = [(rng.choice("aab"), rng.randrange(400), rng.choice([None, 1.0, 2.0]), i) for i in range(60)]
    ldf = spark.createDataFrame(left, "k string, ms bigint, id int").withColumn("ts", F.timestamp_millis("ms"))
    rdf = spark.createDataFrame(right, "k string, ms bigint, v double, n int").select(
        "k", F.timestamp_millis("ms").alias("at"), "v", "n")
    got = asof_backward(ldf, rdf, ["k"], "ts", "at", order=["n"], chunk_us=chunk_us)
    want = []
    for k, ms, i in left:
        found = [(r[1], r[3], r[2]) for r in right if r[0] == k and r[1] <= ms]
        best = max(found, key=lambda f: f[:2], default=(None, None, None))
        want.append((i, best[0], best[1], best[2]))
    rows = got.select("id", F.unix_millis("at"), "n", "v").collect()
    assert sorted(map(tuple, rows), key=lambda r: r[0]) == sorted(want)


def test_asof_with_many_rows_of_one_time(spark):
    left = spark.range(20_000).select(F.lit("k").alias("k"), F.timestamp_millis(F.lit(7)).alias("ts"), "id")
    right = spark.range(20_000).select(
        F.lit("k").alias("k"), F.timestamp_millis(F.lit(3)).alias("at"), F.col("id").alias("n"))
    got = asof_backward(left, right, ["k"], "ts", "at", order=["n"])
    assert got.groupBy("n").count().collect()[0] == (19_999, 20_000)


def test_asof_is_planned_without_a_job_and_bounded_in_a_burst(spark, monkeypatch):
    """Half of all rows in one second; times carried over spans of chunks; nothing is run while the plan is built."""
    import sys

    monkeypatch.setattr(sys.modules["tsnorm.operators.asof"], "SPAN_CHUNKS", 3)
    rng = random.Random(5)
    left = [("a", rng.randrange(1_000_000) if i % 2 else rng.randrange(10**9), i) for i in range(400)]
    right = [("a", rng.randrange(1_000_000) if i % 2 else rng.randrange(10**9), i) for i in range(60)]
    ldf = spark.createDataFrame(left, "k string, us bigint, id int").withColumn("ts", F.timestamp_micros("us"))
    rdf = spark.createDataFrame(right, "k string, us bigint, n int").select("k", F.timestamp_micros("us").alias("at"), "n")
    spark.sparkContext.setJobGroup("asof-plan", "")
    got = asof_backward(ldf, rdf, ["k"], "ts", "at", order=["n"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("asof-plan")
    spark.sparkContext.setJobGroup("rest", "")
    want = {i: max(((u, n) for _, u, n in right if u <= us), default=(None, None))[1] for _, us, i in left}
    assert {r.id: r.n for r in got.collect()} == want


def test_grid(spark):
    ends = spark.createDataFrame([(12, 31, 5), (10, 30, 5), (7, 7, 5)], "a bigint, b bigint, p bigint")
    cols = [F.col(c) for c in "abp"]
    assert [tuple(r) for r in ends.select(*grid.grid_bounds(*cols)).collect()] == [(10, 5, 5), (10, 5, 5), (5, 5, 1)]
    # bounds inside the data count, bounds outside do not; an empty range has no points
    assert [tuple(r) for r in ends.select(*grid.grid_bounds(*cols, 11, 21)).collect()] == [(10, 5, 3), (10, 5, 3), (10, 5, 0)]
    rows = spark.createDataFrame([(1, 25), (5, 4)], "lo bigint, hi bigint")
    for chunk in (1, 4, 100):
        got = grid.expand_points(rows, F.col("lo"), F.col("hi"), "x", chunk)
        assert sorted(r.x for r in got.collect()) == list(range(1, 26))


def test_summary(spark):
    rows = [("a", 0, 1.0, 0), ("a", 250, 2.0, 1), ("a", 1000, 3.0, 2), ("b", 9, None, 3), ("c", 4, 1.0, 4)]
    got = period.instrument_summary(readings(spark, rows)).orderBy("instrument").collect()
    assert [(r.instrument, r.n, r.period_us, r.is_empty) for r in got] == [
        ("a", 3, 250_000, False), ("b", 0, None, True), ("c", 1, None, False)]
    assert period.common_period(readings(spark, rows)).first()[0] == 250_000
    assert period.common_period(readings(spark, rows[3:])).first()[0] == 1_000_000
