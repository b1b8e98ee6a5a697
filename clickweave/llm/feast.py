"""Largest eigenpairs of a symmetric positive matrix by contour integration.

The matrix is as large as a vector is long, whatever the number of rows it was
computed from.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# quadrature nodes on the upper half of each contour
NODES = 8
# an interval is split while it and its surroundings hold more eigenvalues than this, or until it is as narrow as NARROW
MOST = 12
SECTIONS = 16
# widths are relative to an upper bound of all eigenvalues; what lies under ZERO counts as zero
NARROW, BORDER, ZERO = 1e-9, 1e-13, 1e-12
MAX_ROUNDS = 40


class Interval(NamedTuple):
    low: float
    high: float
    count: int
    # eigenvalues inside or less than a width away; the quadrature all but removes those further off
    near: int


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues of ``a`` (Householder)."""
    a = np.array(a, dtype=float)
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0 or not np.any(x[1:]):
            continue
        x[0] += norm if x[0] >= 0 else -norm
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ x
        p -= x * (x @ p)
        rest -= 2 * (np.outer(x, p) + np.outer(p, x))
        column = a[k + 1 :, k]
        column -= 2 * x * (x @ column)
        a[k, k + 1 :] = column
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Eigenvalues above each shift: positive pivots of the shifted matrix (law of inertia)."""
    shifts = np.asarray(shifts, dtype=float)
    tiny = np.finfo(float).tiny * 1e8
    squares = np.concatenate(([0.0], off**2))
    above = np.zeros(len(shifts), dtype=np.int64)
    pivot = np.ones(len(shifts))
    for d, square in zip(diagonal, squares):
        pivot = d - shifts - square / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        above += pivot > 0
    return above


class _Inertia:
    def __init__(self, a: np.ndarray, scale: float):
        self._matrix, self._clear = tridiagonal(a), BORDER * scale

    def above(self, shifts: np.ndarray) -> np.ndarray:
        return count_above(*self._matrix, shifts)

    def border(self, at: float) -> tuple[float, int]:
        """A shift close to ``at`` with no eigenvalue right beside it, and the count above it."""
        for k in range(2 * len(self._matrix[0]) + 2):
            shift = at + (k + 1) // 2 * (-1) ** k * 3 * self._clear
            high, middle, low = self.above(np.array([shift + self._clear, shift, shift - self._clear]))
            if high == low:
                break
        return shift, int(middle)


def top_intervals(a: np.ndarray, k: int, scale: float) -> list[Interval]:
    """Disjoint intervals, from the top, that hold the ``k`` largest eigenvalues that are not zero, each few."""
    inertia = _Inertia(a, scale)
    low, count = inertia.border(ZERO * scale)
    high, rest = inertia.border(scale * (1 + 1e-6))
    todo, found, held = [(low, count, high, rest)], [], 0
    while todo and held < k:
        low, count, high, rest = todo.pop()
        inside = count - rest
        if not inside:
            continue
        width = high - low
        beyond = inertia.above(np.array([low - width, high + width]))
        near = int(beyond[0] - beyond[1])
        if near <= MOST or width <= NARROW * scale:
            found.append(Interval(low, high, inside, near))
            held += inside
            continue
        cuts = np.linspace(low, high, SECTIONS + 1)[1:-1]
        marks = [(low, count), *[inertia.border(c) for c in cuts], (high, rest)]
        todo += [(*one, *other) for one, other in zip(marks, marks[1:])]
    return found


def eigenpairs(a: np.ndarray, interval: Interval, scale: float, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """All eigenpairs with eigenvalues inside ``interval``.

    A subspace is projected by the quadrature of the resolvent along a circle
    around the interval, then solved by Rayleigh-Ritz, until the residuals are
    of rounding size and as many pairs lie inside as the inertia says.
    """
    n = len(a)
    size = min(n, interval.near + 4)
    centre, radius = (interval.low + interval.high) / 2, (interval.high - interval.low) / 2
    x, weights = np.polynomial.legendre.leggauss(NODES)
    turns = radius * np.exp(1j * np.pi / 2 * (x + 1))
    # one factor per node serves all rounds
    resolvents = [np.linalg.inv((centre + t) * np.eye(n) - a) for t in turns]
    space = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, size)))[0]
    enough, best = 8 * np.finfo(float).eps * np.sqrt(n) * scale, np.inf
    for _ in range(MAX_ROUNDS):
        projected = sum(w / 2 * (t * (r @ space)).real for w, t, r in zip(weights, turns, resolvents))
        basis = np.linalg.qr(projected)[0]
        values, mix = np.linalg.eigh(basis.T @ a @ basis)
        space = basis @ mix
        inside = (values > interval.low) & (values <= interval.high)
        if inside.sum() == interval.count:
            found = space[:, inside]
            residual = np.linalg.norm(a @ found - found * values[inside], axis=0).max()
            # rounding may keep it from falling further
            if residual <= enough or (residual <= 1e3 * enough and residual > best / 2):
                return values[inside], found
            best = min(best, residual)
    raise ArithmeticError(f"{interval} holds {interval.count} eigenvalues, contour integration found {inside.sum()}")


def largest_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of symmetric positive ``a`` by falling size, and unit eigenvectors as columns.

    Eigenvalues under 1e-12 of the largest row sum count as zero and are left
    out, so fewer than ``k`` may come back.
    """
    n = len(a)
    scale = float(np.abs(a).sum(axis=1).max()) if n else 0.0
    if scale == 0.0:
        return np.zeros(0), np.zeros((n, 0))
    found = [eigenpairs(a, interval, scale) for interval in top_intervals(a, k, scale)]
    if not found:
        return np.zeros(0), np.zeros((n, 0))
    # one more Rayleigh-Ritz step makes vectors of neighbouring intervals orthogonal
    basis = np.linalg.qr(np.concatenate([vectors for _, vectors in found], axis=1))[0]
    values, mix = np.linalg.eigh(basis.T @ a @ basis)
    order = np.argsort(-values, kind="stable")[:k]
    return values[order], basis @ mix[:, order]
