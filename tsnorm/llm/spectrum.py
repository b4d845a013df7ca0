"""Eigenvalues and vectors of a covariance, kept up to date by rank-one changes: secular equation with deflation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = np.finfo(np.float64).eps
STEPS = 80  # of the root search; it needs about ten, bisection as its last resort takes more


def deflate(
    values: np.ndarray, basis: np.ndarray, z: np.ndarray, norm: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Values, basis and z after plane rotations that empty z at one of two places where that leaves the matrix diagonal
    but for rounding, and the places where z is left. At all others the value and its vector stay as they are."""
    tol = 8 * EPS * max(np.abs(values).max(), norm)
    live = np.flatnonzero(np.abs(z) * np.sqrt(norm) > tol)
    if len(live) > 1:
        r = np.abs(z[live])
        close = np.diff(values[live]) * r[1:] * r[:-1] <= tol * (r[1:] ** 2 + r[:-1] ** 2)
    if len(live) > 1 and close.any():
        values, basis, z, kept, last = values.copy(), basis.copy(), z.copy(), [], -1
        for j in live.tolist():
            if last >= 0:
                r = np.hypot(z[last], z[j])
                c, s = z[j] / r, z[last] / r
                if abs((values[j] - values[last]) * c * s) <= tol:
                    a, b = values[last], values[j]
                    values[last], values[j] = a * c * c + b * s * s, a * s * s + b * c * c
                    basis[:, last], basis[:, j] = c * basis[:, last] - s * basis[:, j], s * basis[:, last] + c * basis[:, j]
                    z[last], z[j] = 0.0, r
                else:
                    kept.append(last)
            last = j
        live = np.array([*kept, last])
    return values, basis, z, live


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum of weights / (poles - root), one behind each of the ascending poles: the nearest pole of each
    and the root's distance from it, so that differences to poles keep their leading digits."""
    n = len(poles)
    right = np.append(poles[1:], poles[-1] + weights.sum())
    half = (right - poles) / 2
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        at_middle = 1 + (weights / (poles[None, :] - (poles + half)[:, None])).sum(axis=1)
        near = np.arange(n) + ((at_middle < 0) & (np.arange(n) < n - 1))
        delta = poles[None, :] - poles[near][:, None]  # poles as each root sees them
        behind = np.tril(np.ones((n, n), bool))
        left_pole, right_pole = poles - poles[near], right - poles[near]
        low = np.where(near > np.arange(n), -half, 0.0)
        low[-1] = 0.0
        high = np.where(near > np.arange(n), 0.0, half)
        high[-1] = right_pole[-1]
        root = (low + high) / 2
        for _ in range(STEPS):
            parts = weights / (delta - root[:, None])
            slopes = parts / (delta - root[:, None])
            f = 1 + parts.sum(axis=1)
            if (done := np.abs(f) <= 2 * EPS * (1 + np.abs(parts).sum(axis=1))).all():
                break
            low, high = np.where(f < 0, root, low), np.where(f < 0, high, root)
            # a function with the two poles around the root, the same value and slopes, has its root in closed form
            a_l, a_r = left_pole - root, right_pole - root
            d_l, d_r = np.where(behind, slopes, 0).sum(axis=1), np.where(behind, 0, slopes).sum(axis=1)
            c = f - a_l * d_l - a_r * d_r
            a = (a_l + a_r) * f - a_l * a_r * (d_l + d_r)
            b = a_l * a_r * f
            gap = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = root + np.where(a <= 0, (a - gap) / (2 * c), 2 * b / (a + gap))
            fits = np.isfinite(step) & (step > low) & (step < high)
            root = np.where(done, root, np.where(fits, step, (low + high) / 2))
    return near, root


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending eigenvalues and vectors of B diag(values) B' + vector vector'."""
    z = basis.T @ vector
    norm = float(z @ z)
    if norm == 0.0:
        return values, basis
    values, basis, z, live = deflate(values, basis, z, norm)
    if len(live) == 0:
        order = np.argsort(values, kind="stable")
        return values[order], basis[:, order]
    poles, weights = values[live], z[live] ** 2
    near, root = secular_roots(poles, weights)
    apart = (poles[None, :] - poles[near][:, None]) - root[:, None]  # pole less root, for each root
    apart[apart == 0] = np.finfo(np.float64).tiny
    # weights for which the roots found are exact: vectors from them are orthogonal
    n = len(live)
    between = poles[:, None] - poles[None, :]
    np.fill_diagonal(between, 1.0)
    ratio = -apart.T / np.where(np.eye(n, dtype=bool), 1.0, -between)
    sure = np.sqrt(np.abs(np.prod(ratio, axis=1))) * np.sign(z[live])
    vectors = sure[:, None] / apart.T
    vectors /= np.linalg.norm(vectors, axis=0)
    values, basis = values.copy(), basis.copy()
    values[live] = poles[near] + root
    basis[:, live] = basis[:, live] @ vectors
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


@dataclass
class Spectrum:
    """What is known of some vectors: their number, exact sums, and the eigenvalues and vectors of their scatter,
    the sum of (x - mean)(x - mean)'."""

    n: int
    sums: np.ndarray  # whole numbers
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, dims: int) -> Spectrum:
        return cls(0, np.zeros(dims, object), np.zeros(dims), np.eye(dims))

    def shift(self, n: int, sums: np.ndarray) -> None:
        """Take in ``n`` further vectors as if all were their mean: one rank-one change by the distance of the means."""
        if self.n:
            apart = (self.n * sums - n * self.sums).astype(np.float64) / (float(self.n) * n)  # of means, exact before it is rounded
            self.values, self.basis = rank_one(self.values, self.basis, apart * np.sqrt(float(self.n) * n / (self.n + n)))
        self.n, self.sums = self.n + n, self.sums + sums

    def add(self, rows: np.ndarray) -> None:
        """Take in whole-number vectors. The rows of the triangular factor of a block, centred on its own mean, have the same scatter
        as the block; each is a rank-one change, and so is the shift of the mean. So a block of any length costs as many
        changes as it has dimensions, at most."""
        if len(rows) == 0:
            return
        sums = rows.sum(axis=0).astype(object)
        self.shift(len(rows), sums)
        if len(rows) > 1:
            centred = (rows * len(rows) - sums.astype(np.int64)).astype(np.float64) / len(rows)
            short = centred if len(rows) <= rows.shape[1] else np.linalg.qr(centred, mode="r")
            for row in short:
                self.values, self.basis = rank_one(self.values, self.basis, row)

    def join(self, other: Spectrum) -> None:
        """Take in all vectors of another spectrum: each of its eigenvectors, scaled, is a rank-one change."""
        if other.n == 0:
            return
        self.shift(other.n, other.sums)
        for value, vector in zip(other.values, other.basis.T, strict=True):
            if value > 0:
                self.values, self.basis = rank_one(self.values, self.basis, vector * np.sqrt(value))

    def packed(self) -> dict:
        return {"n": self.n, "sums": [str(s) for s in self.sums], "eigenvalues": self.values.tobytes(), "basis": np.ascontiguousarray(self.basis).tobytes()}

    @classmethod
    def unpacked(cls, row) -> Spectrum:
        values = np.frombuffer(row["eigenvalues"], np.float64)
        return cls(int(row["n"]), np.array([int(s) for s in row["sums"]], object), values, np.frombuffer(row["basis"], np.float64).reshape(len(values), -1))
