"""Singular values and right singular vectors of one small square matrix.

Householder reflections make it bidiagonal, the differential qd algorithm with
shifts (dqds) finds the squared singular values without forming a product, and
twisted factorisations give each right vector.  Singular values closer than
``CLUSTER`` share a subspace; there, inverse iteration against the vectors found
before takes over.  The matrix is as wide as a vector, never as long as the data.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
DEFLATE = (10 * EPS) ** 2
CLUSTER = 1e-3
PIVOT = np.finfo(np.float64).tiny / EPS


def bidiagonalise(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with ``U' a V`` upper bidiagonal."""
    a = np.array(a, np.float64)
    n = a.shape[0]
    v = np.eye(n)

    def reflector(x):
        u = x.copy()
        size = np.linalg.norm(u)
        if size == 0:
            return None
        u[0] += size if u[0] >= 0 else -size
        return u / np.linalg.norm(u)

    for k in range(n):
        u = reflector(a[k:, k])
        if u is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k < n - 1:
            u = reflector(a[k, k + 1:])
            if u is not None:
                a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ u, u)
                v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _lower_bound(q: np.ndarray, e: np.ndarray) -> float:
    """A value below the smallest eigenvalue: an unshifted pass gives the diagonal of the inverse."""
    d, total = q[0], 1.0 / q[0]
    for k in range(len(e)):
        d *= q[k + 1] / (d + e[k])
        total += 1.0 / d
    return 1.0 / total


def _shifted_pass(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """One dqds transform; None where the shift was too large."""
    q2, e2 = np.empty_like(q), np.empty_like(e)
    d = q[0] - shift
    for k in range(len(e)):
        if d <= 0:
            return None
        q2[k] = d + e[k]
        t = q[k + 1] / q2[k]
        e2[k] = e[k] * t
        d = d * t - shift
    if d < 0:
        return None
    q2[-1] = d
    return q2, e2


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Eigenvalues of ``B'B``, falling, by dqds with deflation at the end and splitting inside."""
    found, todo = [], [(diagonal ** 2, above ** 2, 0.0)]
    while todo:
        q, e, shifted = todo.pop()
        if len(q) == 1:
            found.append(q[0] + shifted)
            continue
        cut = np.flatnonzero((e <= DEFLATE * (q[1:] + shifted)) | (e <= DEFLATE * q[:-1]))
        if len(cut):
            k = int(cut[-1])
            todo += [(q[:k + 1], e[:k], shifted), (q[k + 1:], e[k + 1:], shifted)]
            continue
        if not np.all(q > 0):
            q = np.maximum(q, EPS ** 2 * (shifted + q.max()))
        shift = _lower_bound(q, e)
        step = _shifted_pass(q, e, shift)
        while step is None:
            shift = shift * 0.5 if shift > PIVOT else 0.0
            step = _shifted_pass(q, e, shift)
        todo.append((*step, shifted + shift))
    return np.sort(np.array(found))[::-1]


def twisted_vector(q: np.ndarray, lower: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of ``L diag(q) L'`` for ``value``, from the twist with the smallest pivot."""
    n = len(q)
    s, up = np.empty(n), np.empty(max(n - 1, 0))
    s[0] = -value
    for k in range(n - 1):
        pivot = q[k] + s[k]
        up[k] = q[k] * lower[k] / (pivot if abs(pivot) > PIVOT else PIVOT)
        s[k + 1] = up[k] * lower[k] * s[k] - value
    p, down = np.empty(n), np.empty(max(n - 1, 0))
    p[-1] = q[-1] - value
    for k in range(n - 2, -1, -1):
        pivot = q[k] * lower[k] ** 2 + p[k + 1]
        pivot = pivot if abs(pivot) > PIVOT else PIVOT
        down[k] = q[k] * lower[k] / pivot
        p[k] = p[k + 1] * (q[k] / pivot) - value
    twist = np.abs(s + p + value)
    r = int(np.nanargmin(twist)) if np.isfinite(twist).any() else 0
    z = np.zeros(n)
    z[r] = 1.0
    for k in range(r - 1, -1, -1):
        z[k] = -up[k] * z[k + 1]
    for k in range(r, n - 1):
        z[k + 1] = -down[k] * z[k]
    return z / np.linalg.norm(z)


def _in_cluster(t: np.ndarray, value: float, earlier: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Inverse iteration, kept orthogonal to the vectors of the cluster found before."""
    shifted = t - (value + EPS * max(abs(value), np.abs(t).max())) * np.eye(len(t))
    z = start
    for _ in range(5):
        z = z - earlier @ (earlier.T @ z)
        z = np.linalg.solve(shifted, z / np.linalg.norm(z))
        z = z / np.linalg.norm(z)
        z = z - earlier @ (earlier.T @ z)
        z = z / np.linalg.norm(z)
    return z


def right_singular(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all singular values, falling; the first ``count`` right vectors as columns; their singular values).

    Directions whose singular value is zero to working precision are left out.
    """
    n = r.shape[0]
    size = np.abs(r).max(initial=0.0)
    if n == 0 or size == 0 or not np.isfinite(size):
        return np.zeros(n), np.zeros((n, 0)), np.zeros(0)
    diagonal, above, turn = bidiagonalise(r / size)
    # an exactly singular matrix is moved by less than its rounding, so that no pivot is zero
    floor = EPS * np.hypot(np.linalg.norm(diagonal), np.linalg.norm(above)) * 1e-3
    diagonal = np.where(np.abs(diagonal) < floor, floor, diagonal)
    values = squared_singular_values(diagonal, above)
    sigma = np.sqrt(np.maximum(values, 0.0))
    count = min(count, int((sigma > 8 * n * EPS * sigma[0]).sum()))
    q, lower = diagonal ** 2, above / diagonal[:-1]
    t = np.diag(q) + np.diag(diagonal[:-1] * above, 1) + np.diag(diagonal[:-1] * above, -1)
    t[np.arange(1, n), np.arange(1, n)] += above ** 2
    z = np.zeros((n, count))
    first = 0
    for k in range(count):
        if k and values[k - 1] - values[k] > CLUSTER * values[k - 1]:
            first = k
        alone = first == k and (k + 1 == n or values[k] - values[k + 1] > CLUSTER * values[k])
        if alone:
            z[:, k] = twisted_vector(q, lower, values[k])
        else:
            start = np.random.default_rng(k).standard_normal(n)
            z[:, k] = _in_cluster(t, values[k], z[:, first:k], start)
    return sigma * size, turn @ z, sigma[:count] * size
