"""Spectra by rank-one changes and whitened rows against a dense eigendecomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsnorm.llm import common, whitening
from tsnorm.llm.spectrum import Spectrum, rank_one

SCHEMA = "vec_id long, x array<long>, n int, component string, whitened string"


def vectors(spark, rows, parts=3):
    frame = spark.createDataFrame([(i, None if x is None else [int(v) for v in x], 7, "c", "w") for i, x in rows], SCHEMA)
    return common.stage(frame.repartition(parts), "vectors")


def scatter(x):
    c = (len(x) * x - x.sum(axis=0)) / len(x)
    return c.T @ c


@pytest.mark.parametrize("dims,n,kind", [(1, 5, 0), (3, 2, 0), (5, 40, 1), (16, 10, 2), (16, 400, 3), (64, 500, 0), (64, 300, 4)])
def test_spectra_are_those_of_the_scatter(dims, n, kind):
    rng = np.random.default_rng(dims + kind)
    spread = [np.ones(dims), np.logspace(0, -6, dims), np.ones(dims), np.r_[np.ones(dims // 2), np.zeros(dims - dims // 2)], np.ones(dims)][kind]
    x = np.floor(64 * rng.standard_normal((n, dims)) * spread).astype(np.int64) + 1_000_000
    if kind == 4:
        x[:, 1:] = x[:, :1]  # one direction
    whole = Spectrum.empty(dims)
    for part in np.array_split(x, 3):
        own = Spectrum.empty(dims)
        for block in np.array_split(part, 2):
            own.add(block)
        whole.join(Spectrum.unpacked(own.packed()))
    want = scatter(x)
    scale = max(1.0, np.abs(want).max())
    assert np.abs(whole.basis @ np.diag(whole.values) @ whole.basis.T - want).max() <= 1e-12 * scale
    assert np.abs(whole.basis.T @ whole.basis - np.eye(dims)).max() <= 1e-12
    assert whole.n == n and list(whole.sums) == x.sum(axis=0).tolist()


def test_changes_that_deflate():
    values, basis = np.zeros(4), np.eye(4)
    for v in ([0, 0, 0, 0], [1, 0, 0, 0], [1, 1, 1, 1], [1, 1, 1, 1], [1e-9, 0, 0, 1], [0, 1e8, 0, 0]):
        before = basis @ np.diag(values) @ basis.T
        values, basis = rank_one(values, basis, np.array(v, float))
        want = before + np.outer(v, v)
        assert np.abs(basis @ np.diag(values) @ basis.T - want).max() <= 1e-13 * max(1, np.abs(want).max())
        assert (np.diff(values) >= 0).all()


def brute(rows, k):
    x = np.array([x for _, x in rows], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    e, v = np.linalg.eigh(scatter(fit) / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return n, (n * x - sums) / n @ v / np.sqrt(e), ((n * x - sums) ** 2).sum(axis=1), e / np.trace(scatter(fit) / n)


def test_rows_match_a_dense_eigendecomposition(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)  # several levels
    rng = np.random.default_rng(3)
    x = np.floor(64 * rng.standard_normal((300, 12)) * np.linspace(1, 3, 12)).astype(np.int64) + 1_000_000
    rows = [(i, v) for i, v in enumerate(x)] + [(5, x[5]), (900, x[0]), (None, x[1])] + [(901, x[2])] * 50
    odd = [(1000, None), (1001, []), (1002, [1, 2, 3])]
    got = whitening.whiten(vectors(spark, rows + odd, 7), components=5)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.toPandas().sort_values(["vec_id", "component"])
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    n, white, deviation, explained = brute(rows, 5)
    assert len(got) == 5 * len(rows) and set(got["n"]) == {n} == {300}
    for c in range(5):
        part = got[got["component"] == c + 1].sort_values("vec_id", kind="stable")
        assert part["deviation"].tolist() == deviation.tolist()
        mine = part["whitened"].to_numpy()
        sign = np.sign(mine @ white[:, c])
        assert np.abs(sign * mine - white[:, c]).max() < 1e-9
        assert np.allclose(part["explained"], explained[c], rtol=1e-12)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-10


def test_tables_without_spread(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [4, 4]), (2, [4, 4])])).count() == 0
    two = whitening.whiten(vectors(spark, [(1, [4, 4]), (2, [6, 4]), (3, [6, 4])])).orderBy("vec_id").collect()
    assert [(r.component, r.n, r.deviation, round(r.whitened, 12), r.explained) for r in two] == [
        (1, 2, 4, -1.0, 1.0), (1, 2, 4, 1.0, 1.0), (1, 2, 4, 1.0, 1.0)]


def test_deviations_beyond_64_bits_are_null(spark):
    rows = [(1, [0, 0]), (2, [2**31, 0]), (3, [2**31, 2**31])]
    got = whitening.whiten(vectors(spark, rows)).filter("component = 1").orderBy("vec_id")
    want = [sum((3 * a - s) ** 2 for a, s in zip(x, (2**32, 2**31), strict=True)) for _, x in rows]
    assert [r.deviation for r in got.collect()] == [w if w < 2**63 else None for w in want]
    assert got.select(F.max("identity_error")).first()[0] < 1e-10
