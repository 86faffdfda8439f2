"""Exact integer matrix products by Strassen's seven recursive products."""

from __future__ import annotations

import numpy as np

# Below this side a plain product costs less than the additions saved.
LEAF = 8


def _padded(a: np.ndarray, rows: int, columns: int) -> np.ndarray:
    if a.shape == (rows, columns):
        return a
    out = np.zeros((rows, columns), a.dtype)
    out[: a.shape[0], : a.shape[1]] = a
    return out


def product(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices of any shapes, odd sides padded by zeros.

    Only additions and products of integers: if the entries of the result fit 64 bits they are exact, even
    where a sum in between wraps around, as all of it is arithmetic modulo 2^64.
    """
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    h, i, j = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    a, b = _padded(a, 2 * h, 2 * i), _padded(b, 2 * i, 2 * j)
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    out = np.empty((2 * h, 2 * j), np.int64)
    c11, c12, c21, c22 = out[:h, :j], out[:h, j:], out[h:, :j], out[h:, j:]
    c11[:] = c22[:] = product(a11 + a22, b11 + b22, leaf)
    part = product(a21 + a22, b11, leaf)
    c21[:] = part
    c22 -= part
    part = product(a11, b12 - b22, leaf)
    c12[:] = part
    c22 += part
    part = product(a22, b21 - b11, leaf)
    c11 += part
    c21 += part
    part = product(a11 + a12, b22, leaf)
    c11 -= part
    c12 += part
    c22 += product(a21 - a11, b11 + b12, leaf)
    c11 += product(a12 - a22, b21 + b22, leaf)
    return out[:m, :n]
