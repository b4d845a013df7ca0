"""The registered queries against their SQL on the smallest driver tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry

SF = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not SF.exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def ordered(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "M":
            df[c] = df[c].astype("datetime64[us]")
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    got = ordered(entry.queries()[name](spark, str(SF)).toPandas())
    want = ordered(duck.sql(entry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want) > 0
    for c in got.columns:
        same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        assert same.all(), c


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "timestamp" and df.count() > 0
