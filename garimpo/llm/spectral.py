"""Symmetric eigenproblems by spectral divide and conquer on polar decompositions (QDWH)."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
#: Halley steps until a condition of 1/EPS is gone are six; more mean that rounding is all that is left.
STEPS = 12


def _least_singular(x: np.ndarray) -> float:
    """A lower bound of the least singular value; a singular matrix counts as one with condition 1/EPS."""
    try:
        return max(EPS, min(1.0, 0.9 / np.linalg.norm(np.linalg.inv(x))))
    except np.linalg.LinAlgError:
        return EPS


def polar_sign(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, which is its matrix sign.

    Dynamically weighted Halley iteration in its inverse-free form: each step is a QR factorisation of the
    weighted iterate above the identity. The weights follow a lower bound of the singular values.
    """
    n = len(a)
    x = a / np.linalg.norm(a)
    low = _least_singular(x)
    for _ in range(STEPS):
        square = low * low
        inner = np.cbrt(4 * (1 - square) / (square * square)) if low < 1 else 0.0
        root = np.sqrt(1 + inner)
        wa = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * inner + 8 * (2 - square) / (square * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack((np.sqrt(wc) * x, np.eye(n))))
        step = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        step = (step + step.T) / 2
        done = np.linalg.norm(step - x) <= np.cbrt(EPS) * np.linalg.norm(step) and low > 1 - 10 * EPS
        x, low = step, min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if done:
            break
    return x


def _split(a: np.ndarray, size: float):
    """Orthonormal bases of two invariant subspaces of ``a``, the one of larger eigenvalues first; None if it is a multiple of I."""
    n = len(a)
    middle = np.trace(a) / n
    spread = np.linalg.norm(a - middle * np.eye(n))
    if spread <= 4 * EPS * max(size, abs(middle)) * np.sqrt(n):
        return None
    # The mean lies inside the spectrum; a shift that hits an eigenvalue leaves a projector that is none, so try its neighbourhood.
    best = None
    for shift in middle + spread / n * np.array([0.0, 0.11, -0.13, 0.29, -0.31, 0.53, -0.47]):
        projector = (polar_sign(a - shift * np.eye(n)) + np.eye(n)) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < n:
            continue
        # Two rounds of subspace iteration from seeded random vectors span the projector's range.
        start = np.random.Generator(np.random.PCG64(n * 7919 + rank)).standard_normal((n, rank))
        basis, _ = np.linalg.qr(projector @ start)
        whole, _ = np.linalg.qr(projector @ basis, mode="complete")
        upper, lower = whole[:, :rank], whole[:, rank:]
        error = np.linalg.norm(lower.T @ a @ upper)
        if best is None or error < best[0]:
            best = (error, upper, lower)
        if error <= 10 * n * EPS * max(size, spread):
            break
    return best and best[1:]


def eigen(a: np.ndarray, top: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues from the largest down and unit eigenvectors as columns; with ``top`` only so many.

    Halves of the spectrum that hold none of the first ``top`` values are not split further. Eigenvectors of
    equal values are one basis of their space. The sign is set so that the entry of largest size is positive.
    """
    a = np.asarray(a, np.float64)
    n = len(a)
    unit = np.ldexp(1.0, np.frexp(np.abs(a).max(initial=0.0))[1] - 1) or 1.0
    a = (a / unit + a.T / unit) / 2
    top = n if top is None else min(top, n)
    size = np.linalg.norm(a) if n else 0.0
    values, vectors = [], []
    todo = [(a, np.eye(n))] if n else []
    while todo and len(values) < top:
        block, basis = todo.pop()
        parts = _split(block, size) if len(block) > 1 else None
        if parts is None:
            for j in range(len(block)):
                v = basis[:, j]
                v = v * np.sign(v[np.argmax(np.abs(v))])
                values.append(float(v @ a @ v))
                vectors.append(v)
            continue
        for part in parts[::-1]:
            inner = part.T @ block @ part
            todo.append(((inner + inner.T) / 2, basis @ part))
    order = np.argsort(-np.array(values), kind="stable")[:top]
    return np.array(values)[order] * unit, np.array(vectors).reshape(-1, n).T[:, order]
