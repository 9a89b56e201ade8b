"""Leading eigenpairs of a symmetric matrix: tridiagonalise, bisect, iterate."""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, subdiagonal and Householder vectors of ``a``, which stays as it is.

    ``a`` = H T H' with H the product of the reflections by the vectors in their order.
    """
    a = np.array(a, float)
    d = len(a)
    vectors = []
    for k in range(d - 2):
        v = a[k + 1 :, k].copy()
        norm = np.linalg.norm(v)
        if norm > 0:
            v[0] += np.copysign(norm, v[0])
            v /= np.linalg.norm(v)
            block = a[k + 1 :, k + 1 :]
            p = block @ v
            w = 2 * (p - (v @ p) * v)
            block -= np.outer(v, w) + np.outer(w, v)
            a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        vectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), vectors


def counts_below(diagonal: np.ndarray, below: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each place."""
    least = _EPS * max(np.abs(diagonal).max(initial=0), np.abs(below).max(initial=0), np.finfo(float).tiny)
    q = np.ones_like(at)
    n = np.zeros(len(at), int)
    for i, x in enumerate(diagonal):
        q = x - at - (below[i - 1] ** 2 / q if i else 0)
        q = np.where(np.abs(q) < least, -least, q)
        n += q < 0
    return n


def leading_values(diagonal: np.ndarray, below: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection of the interval of Gershgorin."""
    d = len(diagonal)
    radius = np.abs(np.append(below, 0)) + np.abs(np.insert(below, 0, 0))
    low = np.full(k, (diagonal - radius).min())
    high = np.full(k, (diagonal + radius).max())
    rank = d - np.arange(k)  # the value has rank - 1 smaller ones
    scale = max(np.abs(low).max(), np.abs(high).max())
    low, high = low - 2 * _EPS * scale, high + 2 * _EPS * scale
    for _ in range(200):
        mid = (low + high) / 2
        up = counts_below(diagonal, below, mid) >= rank
        high, low = np.where(up, mid, high), np.where(up, low, mid)
        if (high - low <= _EPS * np.maximum(np.abs(low), np.abs(high))).all():
            break
    return (low + high) / 2


def _solve(diagonal: np.ndarray, below: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) x = b by elimination with row exchanges; pivots are at least ``least``."""
    d = len(diagonal)
    main, up, up2, b = diagonal - shift, np.append(below, 0.0), np.zeros(d), b.copy()
    for i in range(d - 1):
        low = below[i]
        if abs(main[i]) >= abs(low):
            if abs(main[i]) < least:
                main[i] = least
            f = low / main[i]
            main[i + 1] -= f * up[i]
            b[i + 1] -= f * b[i]
        else:
            f = main[i] / low
            main[i], up_i = low, up[i]
            up[i], up2[i] = main[i + 1], up[i + 1] if i + 1 < d - 1 else 0.0
            main[i + 1] = up_i - f * up[i]
            up[i + 1] = -f * up2[i]
            b[i], b[i + 1] = b[i + 1], b[i] - f * b[i + 1]
    if abs(main[-1]) < least:
        main[-1] = least
    for i in range(d - 1, -1, -1):
        if i + 1 < d:
            b[i] -= up[i] * b[i + 1]
        if i + 2 < d:
            b[i] -= up2[i] * b[i + 2]
        b[i] /= main[i]
    return b


def leading(a: np.ndarray, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Inverse iteration on the tridiagonal matrix; vectors whose values lie within a thousandth
    of its norm are a cluster and made orthogonal to each other in every step.
    """
    d = len(a)
    k = min(k, d)
    scale = np.abs(a).max(initial=0.0)
    if not k or not scale:
        return np.zeros(k), np.eye(d)[:, :k]
    diagonal, below, vectors = tridiagonal(a / scale)
    values = leading_values(diagonal, below, k)
    norm = max(np.abs(diagonal).max(), np.abs(below).max(initial=0.0))
    rng = np.random.default_rng(seed)
    found = np.zeros((d, k))
    start = 0
    shift = values.copy()
    for j in range(k):
        if j and values[j - 1] - values[j] > 1e-3 * norm:
            start = j
        if j > start and shift[j - 1] - shift[j] < 10 * _EPS * norm:
            shift[j] = shift[j - 1] - 10 * _EPS * norm
        x = rng.uniform(-1, 1, d)
        for _ in range(6):
            x /= np.abs(x).max()
            x = _solve(diagonal, below, shift[j], x, _EPS * norm)
            x /= np.linalg.norm(x)
            for _again in range(2):
                x -= found[:, start:j] @ (found[:, start:j].T @ x)
            x /= np.linalg.norm(x)
        found[:, j] = x
    for i in range(len(vectors) - 1, -1, -1):
        v, part = vectors[i], found[i + 1 :]
        part -= 2 * np.outer(v, v @ part)
    return values * scale, found
