"""Singular values and right vectors of a small square matrix: Householder bidiagonals, differential qd, twisted factors."""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, upper diagonal, P) of the bidiagonal matrix U' r P with orthogonal U and P, by reflections from either side."""
    a, n = r.astype(float).copy(), r.shape[1]
    p = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or size == abs(x[0]):
            return None
        v = x.copy()
        v[0] += size if x[0] >= 0 else -size
        return v / np.linalg.norm(v)

    for k in range(n):
        if (v := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < n - 2 and (v := reflector(a[k, k + 1 :])) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            p[:, k + 1 :] -= 2 * np.outer(p[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), p


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, int]:
    """One transform of the qd array; its last pivot, and the place of the first that isn't positive (-1: none)."""
    d, new_q, new_e = q[0] - shift, [], []
    for k in range(len(e)):
        top = d + e[k]
        if d < 0 or top <= 0:
            return q, e, d, k
        t = q[k + 1] / top
        new_q.append(top)
        new_e.append(e[k] * t)
        d = d * t - shift
    return [*new_q, d], new_e, d, (len(e) if d < 0 else -1)


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling, each to high relative accuracy: the differential qd algorithm with shifts."""
    most = max(float((diagonal**2).max(initial=0)), float((upper**2).max(initial=0)))
    if most == 0:
        return np.zeros(len(diagonal))
    tiny = most * EPS**3  # a zero pivot, far below what counts as a value
    todo = [([max(float(x), tiny) for x in diagonal**2], [float(x) for x in upper**2], 0.0)]
    out: list[float] = []
    while todo:
        q, e, moved = todo.pop()
        while True:
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= EPS**2 * (moved + min(q[k], q[k + 1])) or e[k] <= tiny * EPS), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if len(q) == 1:
                out.append(q[0] + moved)
                break
            if q[0] < q[-1]:  # small values belong to the end
                q, e = q[::-1], e[::-1]
            # The smaller root of the last two rows is a bold shift; one that is too large is taken back.
            s = q[-2] + q[-1] + e[-1]
            shift = 2 * q[-2] * q[-1] / (s + np.sqrt(max(s * s - 4 * q[-2] * q[-1], 0.0)))
            for attempt in range(60):
                new_q, new_e, last, failed = _step(q, e, shift)
                if failed < 0:
                    break
                shift = max(shift + last, 0.0) if failed == len(e) and attempt == 0 else (shift / 4 if attempt < 5 else 0.0)
            q, e, moved = [max(x, tiny * EPS) for x in new_q], new_e, moved + shift
    return np.sort(np.array(out))[::-1]


def _twisted(d: np.ndarray, low: np.ndarray, value: float, tiny: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Both factorisations of L D L' - value: (pivots and multipliers from above, the same from below, sizes of the twists)."""
    n = len(d)
    plus, minus, lp, um, s, p = (np.zeros(n) for _ in range(6))
    safe = lambda x: x if abs(x) > tiny else (tiny if x >= 0 else -tiny)
    s[0] = -value
    for k in range(n - 1):
        plus[k] = safe(s[k] + d[k])
        lp[k] = low[k] * d[k] / plus[k]
        s[k + 1] = lp[k] * low[k] * s[k] - value
    plus[n - 1] = safe(s[n - 1] + d[n - 1])
    p[n - 1] = d[n - 1] - value
    for k in range(n - 2, -1, -1):
        minus[k + 1] = safe(low[k] ** 2 * d[k] + p[k + 1])
        t = d[k] / minus[k + 1]
        um[k], p[k] = low[k] * t, p[k + 1] * t - value
    minus[0] = safe(p[0])
    return plus, lp, um, s + p + value, minus


def _vector(lp: np.ndarray, um: np.ndarray, twist: int) -> np.ndarray:
    z = np.zeros(len(lp))
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -lp[k] * z[k + 1]
    for k in range(twist + 1, len(lp)):
        z[k] = -um[k - 1] * z[k - 1]
    return z / np.linalg.norm(z)


def right_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit right singular vectors of a bidiagonal matrix to squared singular values (falling), as columns.

    Each comes from the factorisation twisted where it breaks down most. Of values closer than a ten-thousandth the later
    vectors are made orthogonal to the earlier ones; where that leaves little, solves with the same factors start anew.
    """
    n = len(diagonal)
    q = diagonal**2
    most = max(float(q.max(initial=0)), float((upper**2).max(initial=0)))
    tiny = most * EPS**3
    d = np.maximum(q, tiny)
    if not len(values):
        return np.zeros((n, 0))
    low = upper * np.where(diagonal < 0, -1.0, 1.0)[: n - 1] / np.sqrt(d[: n - 1])
    rng, out = np.random.default_rng(3), np.zeros((n, len(values)))
    for j, value in enumerate(values):
        plus, lp, um, gamma, _ = _twisted(d, low, float(value), tiny)
        near = [i for i in range(j) if values[i] - value <= 1e-4 * value]

        def apart(z: np.ndarray, near=near) -> np.ndarray:
            for _ in range(2):
                z = z - out[:, near] @ (out[:, near].T @ z)
            return z

        z = apart(_vector(lp, um, int(np.argmin(np.abs(gamma)))))
        if np.linalg.norm(z) < 0.7:
            z = apart(rng.standard_normal(n))
            for _ in range(4):
                y = z / np.linalg.norm(z)
                for k in range(1, n):
                    y[k] -= lp[k - 1] * y[k - 1]
                y = y / plus
                for k in range(n - 2, -1, -1):
                    y[k] -= lp[k] * y[k + 1]
                z = apart(y / max(np.abs(y).max(), tiny))
        out[:, j] = z / np.linalg.norm(z)
    return out
