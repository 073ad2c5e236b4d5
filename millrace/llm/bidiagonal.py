"""Right singular vectors of a small square matrix: bidiagonal form, dqds, twisted factorisations.

Everything here works on one matrix of d x d numbers, d the number of dimensions.
"""

import numpy as np

EPS = float(np.finfo(float).eps)
# Eigenvalues nearer than this share of the greater one are made orthogonal to each other.
CLUSTER = 1e-3


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and beta of I - beta v v', which maps x to a multiple of the first unit vector."""
    norm = np.linalg.norm(x)
    if not norm:
        return np.zeros_like(x), 0.0
    v = x.copy()
    v[0] += norm if x[0] >= 0 else -norm
    return v, 2.0 / float(v @ v)


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and P of matrix = Q B P' by Householder reflections from both sides."""
    a, size = matrix.astype(float).copy(), len(matrix)
    p = np.eye(size)
    for k in range(size):
        v, beta = _reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k < size - 2:
            v, beta = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ v, v)
            p[:, k + 1 :] -= beta * np.outer(p[:, k + 1 :] @ v, v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), p


def _safe_shift(q: list, e: list) -> float:
    """A lower bound of the smallest eigenvalue: one over the trace of the inverse."""
    norm, trace = 0.0, 0.0
    for i in range(len(q) - 1, -1, -1):
        if q[i] <= 0:
            return 0.0
        norm = (1.0 + (e[i] * norm if i < len(e) else 0.0)) / q[i]
        trace += norm
    return (1 - 1e-10) / trace if np.isfinite(trace) else 0.0


def _sweep(q: list, e: list, shift: float) -> tuple[list, list] | None:
    """One differential quotient-difference sweep with a shift; None if the shift was too large."""
    d, new_q, new_e = q[0] - shift, [], []
    for i, off in enumerate(e):
        if d < 0:
            return None
        top = d + off
        ratio = q[i + 1] / top if top > 0 else 0.0
        new_q.append(top)
        new_e.append(off * ratio)
        d = (d * ratio if top > 0 else q[i + 1]) - shift
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix by dqds, falling.

    Shifts never exceed the smallest eigenvalue left, so that no value is lost to cancellation.
    """
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if not scale:
        return np.zeros(len(diagonal))
    tolerance, found = (4 * EPS) ** 2, []
    start = ([float(x) ** 2 for x in diagonal / scale], [float(x) ** 2 for x in above / scale], 0.0)
    blocks = [start]
    while blocks:
        q, e, moved = blocks.pop()
        while e:
            if e[-1] <= tolerance * (moved + q[-1]):
                found.append(q.pop() + moved)
                e.pop()
                continue
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= tolerance * (moved + min(q[i], q[i + 1]))), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            shift = _safe_shift(q, e)
            if moved + shift == moved:
                shift = 0.0
            while (swept := _sweep(q, e, shift)) is None:
                shift = shift / 2 if shift > EPS * moved else 0.0
            q, e = swept
            moved += shift
        found += [x + moved for x in q]
    return np.sort(np.array(found))[::-1] * scale**2


def _twisted(squares: np.ndarray, lower: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of L D L' for the values, one column each, and a correction of each value.

    The stationary factorisation from the top and the progressive one from the bottom meet where
    the pivot is smallest; from there the vector is read off to both sides by products only.
    """
    size, count = len(squares), len(values)
    tiny = EPS * EPS * max(squares.max(), 1e-300)
    top, bottom = np.empty((size, count)), np.empty((size, count))
    down, up = np.zeros((size, count)), np.zeros((size, count))

    def pivot(x):
        return np.where(np.abs(x) < tiny, tiny, x)

    s = -values
    for i in range(size - 1):
        top[i] = s
        down[i] = squares[i] * lower[i] / pivot(s + squares[i])
        s = down[i] * lower[i] * s - values
    top[-1] = s
    p = squares[-1] - values
    bottom[-1] = p
    for i in range(size - 2, -1, -1):
        t = squares[i] / pivot(squares[i] * lower[i] ** 2 + p)
        up[i] = lower[i] * t
        p = p * t - values
        bottom[i] = p
    gamma = top + bottom + values
    at = np.argmin(np.abs(gamma), axis=0)
    columns = np.arange(count)
    z = np.zeros((size, count))
    z[at, columns] = 1.0
    for i in range(size - 2, -1, -1):
        z[i] = np.where(i < at, -down[i] * z[i + 1], z[i])
    for i in range(size - 1):
        z[i + 1] = np.where(i >= at, -up[i] * z[i], z[i + 1])
    norms = np.linalg.norm(z, axis=0)
    return z / norms, gamma[at, columns] / norms**2


def _orthogonal(vectors: np.ndarray, values: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Vectors of neighbouring values made orthogonal; one that vanishes is found anew."""
    draw, start = np.random.default_rng(0), 0
    for j in range(len(values)):
        if j and values[j - 1] - values[j] > CLUSTER * values[j - 1]:
            start = j
        group = vectors[:, start:j]
        if not group.shape[1] and np.linalg.norm(vectors[:, j]) > 0.5:
            continue

        def cleaned(x):
            for _ in range(2):
                x = x - group @ (group.T @ x)
            return x

        x = cleaned(vectors[:, j])
        if np.linalg.norm(x) < 0.5:
            x = cleaned(draw.standard_normal(len(x)))
            # Just off the value, so that the system can be solved and its solution grows along the vector.
            shifted = matrix - (values[j] + 32 * EPS * values[0]) * np.eye(len(x))
            for _ in range(4):
                x = cleaned(np.linalg.solve(shifted, x / np.linalg.norm(x)))
                x = cleaned(x / np.linalg.norm(x))
        vectors[:, j] = x / np.linalg.norm(x)
    return vectors


def right_singular(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a square matrix, falling, and the first right singular vectors.

    At most `count` vectors, one per column; values at rounding level of the greatest get none.
    """
    diagonal, above, p = bidiagonalise(matrix)
    values = squared_singular_values(diagonal, above)
    if not len(values) or not values[0]:
        return values, np.zeros((len(matrix), 0))
    rank = int((np.sqrt(values) > 8 * EPS * len(values) * np.sqrt(values[0])).sum())
    kept = values[: min(count, rank)]
    floor = EPS * EPS * np.sqrt(values[0])
    diagonal = np.where(np.abs(diagonal) < floor, floor, diagonal)
    squares, lower = diagonal**2, above / diagonal[:-1]
    with np.errstate(all="ignore"):
        z, change = _twisted(squares, lower, kept)
        z, _ = _twisted(squares, lower, kept + np.where(np.abs(change) < 1e-8 * kept, change, 0.0))
    z[:, ~np.isfinite(z).all(axis=0)] = 0.0
    b = np.diag(diagonal) + np.diag(above, 1)
    return values, p @ _orthogonal(z, kept, b.T @ b)
