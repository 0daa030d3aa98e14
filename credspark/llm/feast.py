"""Eigenpairs of a symmetric matrix by contour integration (FEAST), in numpy.

For an interval, the resolvent (z I - A)^-1 is integrated over a circle around
it by Gauss-Legendre quadrature; applied to a block of vectors it projects them
onto the eigenvectors inside.  Rayleigh-Ritz on the projected block gives
eigenpairs, which start the next sweep until they no longer improve.  The inertia
of A - x I (signs of the pivots of its factorization) counts the eigenvalues
below x; with it intervals are chosen, and the number found is checked.
"""

from __future__ import annotations

import numpy as np

#: Quadrature points on the upper half circle, sweeps at most, eigenvalues that one interval should hold.
POINTS, SWEEPS, PER_INTERVAL = 8, 40, 8


class Inertia:
    """Counts of eigenvalues below a point: negative pivots in the factorization of T - x I, where T is the
    tridiagonal matrix that one Householder reduction of ``a`` gives (orthogonal, so the inertia is a's)."""

    def __init__(self, a: np.ndarray):
        m = np.array(a, float)
        for k in range(len(m) - 2):
            v = m[k + 1:, k].copy()
            v[0] += np.copysign(np.linalg.norm(v), v[0])
            size = v @ v
            if size == 0:
                continue
            low = m[k + 1:, k:]
            low -= np.outer(v, (2 / size) * (v @ low))
            right = m[k:, k + 1:]
            right -= np.outer((2 / size) * (right @ v), v)
        self.diagonal, self.squares = np.diag(m).copy(), np.diag(m, -1) ** 2

    def __call__(self, x: float) -> int:
        negative, pivot = 0, 1.0
        for d, s in zip(self.diagonal - x, np.concatenate(([0.0], self.squares))):
            pivot = d - s / pivot
            if pivot == 0:
                pivot = -1e-300     # a point that is an eigenvalue of a leading part: count it as below
            negative += pivot < 0
        return int(negative)


def _ritz(a: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``a`` on the space that the columns of ``block`` span."""
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    u = u[:, s > 1e-13 * max(s[0], 1e-300)] if len(s) else u
    value, vector = np.linalg.eigh(u.T @ a @ u)
    return value, u @ vector


def interval(a: np.ndarray, below: Inertia, low: float, high: float, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """All eigenpairs of symmetric ``a`` in [low, high), as many as the inertia counts say."""
    n, count = len(a), below(high) - below(low)
    if count == 0:
        return np.empty(0), np.empty((n, 0))
    scale = max(np.abs(a).sum(axis=1).max(), 1e-300)
    x, w = np.polynomial.legendre.leggauss(POINTS)
    angle = np.pi * (1 - x) / 2     # over the upper half circle; the lower half is its conjugate
    middle, radius = (low + high) / 2, (high - low) / 2
    rng, width = np.random.default_rng(seed), min(n, 2 * count + 4)
    block = rng.normal(size=(n, width))
    for _ in range(3):
        shifted = [(np.linalg.inv((middle + radius * np.exp(1j * t)) * np.eye(n) - a), t) for t in angle]
        last = np.inf
        for _ in range(SWEEPS):
            moved = sum(weight / 2 * (radius * np.exp(1j * t) * (solve @ block)).real
                        for weight, (solve, t) in zip(w, shifted))
            value, vector = _ritz(a, moved)
            inside = np.flatnonzero((value >= low) & (value < high))
            error = np.abs(a @ vector[:, inside] - vector[:, inside] * value[inside]).max(initial=0.0) / scale
            block = vector
            if len(inside) == count and (error < 1e-15 or error >= last / 2 and error < 1e-12):
                return value[inside], vector[:, inside]
            last = error if len(inside) == count else np.inf
        width = min(n, 2 * width)   # a wider block with new directions
        block = np.column_stack((block, rng.normal(size=(n, max(0, width - block.shape[1])))))
    raise ArithmeticError(f"{count} eigenvalues lie in [{low}, {high}), {len(inside)} were found")


def _cut(below: Inertia, n: int, low: float, high: float, wanted: int) -> float:
    """A point in [low, high) with ``wanted`` or a few more eigenvalues at or above it; ``low`` has at least
    that many, ``high`` has fewer.  Where many are equal to rounding, the point below them."""
    for _ in range(60):
        mid = (low + high) / 2
        if high - low < 1e-12:
            return low
        above = n - below(mid)
        if wanted <= above <= wanted + 2:
            return mid
        low, high = (mid, high) if above > wanted else (low, mid)
    return low


def largest(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of symmetric positive semidefinite ``a``, falling, and unit eigenvectors
    as columns.  Eigenvalues within rounding of 0 are left out."""
    n = len(a)
    top = float(np.abs(a).sum(axis=1).max(initial=0.0))
    if top == 0:
        return np.empty(0), np.empty((n, 0))
    a = (a + a.T) / 2 / top     # eigenvalues in [0, 1]
    floor = 1e-13 * n
    below = Inertia(a)
    k = min(k, n - below(floor))
    values, vectors, high, found = [], [], 1.0 + 1e-6, 0
    while found < k:
        need = min(k, found + PER_INTERVAL)
        low = floor if n - below(floor) <= need else _cut(below, n, floor, high, need)
        value, vector = interval(a, below, low, high)
        values.append(value)
        vectors.append(vector)
        found += len(value)
        high = low
    # vectors of neighbouring intervals are made orthogonal together
    value, vector = _ritz(a, np.column_stack(vectors))
    if len(value) != found:
        raise ArithmeticError(f"{found} eigenvectors span a space of {len(value)}")
    order = np.argsort(-value, kind="stable")[:k]
    return value[order] * top, vector[:, order]
