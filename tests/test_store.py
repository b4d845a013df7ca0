"""Stored series against plain dictionaries."""

import random
from datetime import datetime, timedelta

import pytest

import tsnorm
from tsnorm.sinks.store import SeriesStore, Stale

DAY = datetime(2020, 1, 1)
SCHEMA = "instrument string, ts timestamp, value double, series int, ord long"


def rows(rng, names, days, n):
    return [(rng.choice(names), DAY + timedelta(days=rng.choice(days), seconds=rng.randrange(200)), float(rng.randrange(100)), 0, i) for i in range(n)]


def held(store):
    got = [(r.instrument, r.ts, r.value) for r in store.read().collect()]
    assert len({g[:2] for g in got}) == len(got)
    return {g[:2]: g[2] for g in got}


def test_appends_and_replacements_rewrite_only_touched_chunks(spark, tmp_path):
    rng, store, want = random.Random(3), SeriesStore(spark, str(tmp_path / "store")), {}
    assert held(store) == {} and store.summary().count() == 0
    steps = [("append", "abc", range(6), 400), ("append", "bd", [2], 50), ("replace", "b", [4, 9], 30), ("append", "a", [20], 5), ("replace", "e", [1], 4)]
    for how, names, days, n in steps:
        new = rows(rng, names, list(days), n)
        touched = {ts.date() for _, ts, *_ in new}
        if how == "replace":
            gone = {k for k in want if k[0] in {r[0] for r in new}}
            touched |= {ts.date() for _, ts in gone}
            want = {k: v for k, v in want.items() if k not in gone}
        want |= {(r[0], r[1]): r[2] for r in new}
        versions = {(r.chunk, r.version) for r in store.states().select("chunk", "version").distinct().collect()}
        written = getattr(store, how)(spark.createDataFrame(new, SCHEMA))
        assert written == len(touched)
        assert held(store) == want
        after = {(r.chunk, r.version) for r in store.states().select("chunk", "version").distinct().collect()}
        days_of = {datetime(1970, 1, 1) + timedelta(microseconds=c) for c, _ in after - versions}
        assert {d.date() for d in days_of} <= touched
        assert len(store.states().select("version").distinct().collect()) >= 1
    for r in store.summary().collect():
        times = sorted(ts for name, ts in want if name == r.instrument)
        gaps = [b - a for a, b in zip(times[:-1], times[1:], strict=True)]
        least = min(gaps) // timedelta(microseconds=1) if gaps else None
        assert (r.start_ts, r.end_ts, r.n, r.period_us) == (times[0], times[-1], len(times), least)
    assert len(store.manifests()) == len(steps)
    gone = store.vacuum()
    assert len(gone) >= 1 and store.manifests() == [len(steps) - 1] and held(store) == want


def test_readers_see_whole_changes_only(spark, tmp_path):
    store = SeriesStore(spark, str(tmp_path / "store"))
    store.append(spark.createDataFrame([("a", DAY, 1.0, 0, 0)], SCHEMA))
    (tmp_path / "store" / "manifests" / "1").mkdir()  # a change that failed before its end
    assert store.manifests() == [0] and held(store) == {("a", DAY): 1.0}
    assert "PartitionFilters" in store.read()._jdf.queryExecution().executedPlan().toString()


def test_two_writers_do_not_lose_a_change(spark, tmp_path, monkeypatch):
    store = SeriesStore(spark, str(tmp_path / "store"))
    frame = spark.createDataFrame([("a", DAY, 1.0, 0, 0)], SCHEMA)
    # another writer ends while this one's rows are written
    monkeypatch.setattr(store, "manifests", lambda: [0] if (tmp_path / "store" / "data").exists() else [])
    with pytest.raises(Stale):
        store.append(frame)


def test_store_keeps_a_run(spark, tmp_path, write):
    head = "TagId,TagName,TimeStamp,DataSource,Value,Quality\n"
    first = write("a.csv", head + "1,x,2020-03-01 10:00:00,D,1,1\n1,x,2020-03-02 10:00:01,D,2,1\n")
    later = write("b.csv", head + "1,x,2020-03-02 10:00:01,D,5,1\n2,y,2020-03-02 10:00:02,D,3,1\n")
    store = SeriesStore(spark, str(tmp_path / "store"))
    assert store.append(tsnorm.read(spark, "archive", first).frame) == 2
    assert store.append(tsnorm.read(spark, "archive", later).frame) == 1
    assert sorted((k[0], k[1].day, v) for k, v in held(store).items()) == [("x", 1, 1.0), ("x", 2, 5.0), ("y", 2, 3.0)]
