"""Embedding whitening: incremental eigendecomposition by rank-one changes, refined by Rayleigh and Ritz."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsnorm.llm import common
from tsnorm.llm.spectrum import Spectrum

BLOCK = 4096  # vectors whose triangular factor is taken at once
FAN = 16  # results of tasks that one task combines
RANK = 1e-12  # eigenvalues below this share of the trace are rounding
SPECTRA = "part long, n long, sums array<string>, eigenvalues binary, basis binary"
MOMENTS = "part long, total binary, products binary"
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double"


@dataclass(frozen=True)
class Whitening:
    """Mean (sums / n) and the eigenvectors (columns, by falling eigenvalue) of a covariance with divisor n."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n, the difference taken in whole numbers."""
        return self.scaled(x).astype(np.float64) / float(self.n)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly: in 64 bits where they suffice."""
        most = max(int(np.abs(x).max(initial=0)), 1) * self.n + max(abs(int(s)) for s in self.sums)
        return x * self.n - self.sums.astype(np.int64) if most < 2**63 else x.astype(object) * self.n - self.sums

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.vectors) / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - sums) squared, exactly; None where 64 bits do not hold it."""
        apart = self.scaled(x)
        if apart.size and int(np.abs(apart).max()) ** 2 * apart.shape[1] < 2**63:
            return (apart.astype(np.int64) ** 2).sum(axis=1).tolist()
        return [s if (s := sum(int(v) ** 2 for v in row)) < 2**63 else None for row in apart]


def vectors_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Vectors of a task in blocks of ``BLOCK``."""
    held, n = [], 0
    for batch in batches:
        if len(batch):
            held.append(vectors_of(batch.column(0)))
            n += len(batch)
        if n >= BLOCK:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def combined(parts: DataFrame, schema: str, join: Callable[[pd.DataFrame], dict], name: str) -> list[dict]:
    """One row out of one row per task: ``FAN`` neighbours are joined at a time, until no two are left."""
    while True:
        parts = common.stage(parts, name)
        if parts.count() <= 1:
            return [r.asDict() for r in parts.collect()]  # one row of the size of the result

        def merge(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("part")
            return pd.DataFrame([{"part": int(group["part"].iloc[0]) // FAN, **join(group)}])

        parts = parts.groupBy(F.floor(F.col("part") / FAN).alias("group")).applyInPandas(merge, schema)


def incremental(fit: DataFrame, dims: int) -> Spectrum:
    """Spectrum of the scatter of all vectors (one column). Each task brings its own up to date block by block, then
    the tasks' spectra are joined, all by rank-one changes."""

    @common.tidy
    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum.empty(dims)
        for block in blocks_of(batches):
            own.add(block)
        if own.n:
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), **own.packed()}], pa.schema([
                ("part", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.string())), ("eigenvalues", pa.binary()), ("basis", pa.binary())]))

    def join(group: pd.DataFrame) -> dict:
        whole = Spectrum.empty(dims)
        for row in group.to_dict("records"):
            whole.join(Spectrum.unpacked(row))
        return whole.packed()

    found = combined(fit.mapInArrow(update, SPECTRA), SPECTRA, join, "spectra")
    return Spectrum.unpacked(found[0]) if found else Spectrum.empty(dims)


def second_moments(fit: DataFrame, project: Callable[[np.ndarray], np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the projected vectors and of their products, over all tasks."""

    @common.tidy
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(size), np.zeros((size, size))
        for block in blocks_of(batches):
            y = project(block)
            total += y.sum(axis=0)
            products += y.T @ y
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([TaskContext.get().partitionId()], pa.int64()), "total": [total.tobytes()], "products": [products.tobytes()]})

    def join(group: pd.DataFrame) -> dict:
        return {c: np.sum([np.frombuffer(b, np.float64) for b in group[c]], axis=0).tobytes() for c in ("total", "products")}

    found = combined(fit.mapInArrow(measure, MOMENTS), MOMENTS, join, "moments")
    if not found:
        return np.zeros(size), np.zeros((size, size))
    return np.frombuffer(found[0]["total"], np.float64), np.frombuffer(found[0]["products"], np.float64).reshape(size, size)


def fit(vectors: DataFrame, dims: int, components: int = 16) -> tuple[Whitening, float] | None:
    """The whitening of staged vectors (one column of arrays of ``dims`` whole numbers), and the largest entry by which
    the covariance of the whitened vectors differs from the identity. None without any spread.

    The joined spectrum gives a basis of all ``dims`` directions; in it the covariance is taken once more over all
    vectors and diagonalised (Rayleigh and Ritz), which leaves only the rounding of that pass. Components whose
    eigenvalue is below ``RANK`` of the trace have no direction of their own and are left out.
    """
    spectrum = incremental(vectors, dims)
    if spectrum.n == 0:
        return None
    send = vectors.sparkSession.sparkContext.broadcast
    basis = send(Whitening(spectrum.n, spectrum.sums, 0.0, np.ones(dims), spectrum.basis[:, ::-1].copy()))  # dims squared numbers
    _, products = second_moments(vectors, lambda x: basis.value.apply(x), dims)
    values, turn = np.linalg.eigh(products / spectrum.n)
    order = np.argsort(-values, kind="stable")
    trace = float(np.trace(products)) / spectrum.n
    order = order[values[order] > RANK * trace][:components]
    if len(order) == 0:
        return None
    axes = basis.value.vectors @ turn[:, order]
    axes *= np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))])
    found = Whitening(spectrum.n, spectrum.sums, trace, values[order], axes)
    shared = send(found)
    total, products = second_moments(vectors, lambda x: shared.value.apply(x), len(order))
    mean = total / spectrum.n
    error = np.abs(products / spectrum.n - np.outer(mean, mean) - np.eye(len(order))).max()
    return found, float(error)


def whiten(rows: DataFrame, components: int = 16) -> DataFrame:
    """Whitened rows, one for each row and component: vec_id, component (from 1, by falling eigenvalue), n, deviation,
    whitened, explained, identity_error.

    ``rows`` is staged and has vec_id (long) and x (array of long). The covariance is that of each distinct vector once.
    Every row has its result: repeated rows, vec_ids and null vec_ids as often as they occur. Vectors of
    another dimension than most (the smaller one of equals) take no part. Rows without x, a table without rows, and
    components without spread (all, if there is one distinct vector) give no rows. Of the
    two signs of a component that one is taken whose largest entry is positive. A deviation beyond 64 bits is null.

    Three passes over the distinct vectors: spectra of tasks by rank-one changes, joined by further ones; the covariance in
    the joined basis; the check of the result. What meets on the driver or in a task is dims squared numbers, ``FAN``
    times at most. Tied eigenvalues have no directions of their own; any orthogonal choice whitens.
    """
    spark = rows.sparkSession
    rows = rows.filter(F.size("x") > 0)
    common_dims = rows.groupBy(F.size("x").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").first()
    empty = spark.createDataFrame([], f"{RESULT}, identity_error double")
    if common_dims is None:
        return empty
    dims = common_dims["dims"]
    rows = rows.filter(F.size("x") == dims)
    found = fit(common.stage(rows.select("x").distinct(), "distinct"), dims, components)
    if found is None:
        return empty
    shared = spark.sparkContext.broadcast(found[0])

    @common.tidy
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        k = len(w.values)
        for batch in batches:
            if len(batch):
                x = vectors_of(batch.column(1))
                row = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(row), w.n)), pa.array(w.deviation(x), pa.int64()).take(pa.array(row)),
                    pa.array(w.apply(x).ravel()), pa.array(np.tile(w.values / w.trace, len(x)))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return rows.select("vec_id", "x").mapInArrow(project, RESULT).withColumn("identity_error", F.lit(found[1]))
