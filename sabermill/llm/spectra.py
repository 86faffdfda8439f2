"""Spectra of scatter matrices under rank-one updates, by their secular equation.

With S = Q diag(d) Q', S + r v v' has the eigenvalues that solve 1 + r sum z_i^2 / (d_i - t) = 0 for z = Q'v, one
between every two d_i. Entries of z that are nothing next to the matrix, and one of every two d_i that are
all but equal (turned so that its entry of z vanishes), keep their eigenpair: they are deflated. The
others' vectors come from z computed anew from the roots, which keeps them orthogonal however
close the roots lie.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps


def _roots(d: np.ndarray, z2: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + r sum z2 / (d - t) as (origin, offset): root i is d[origin[i]] + offset[i].

    ``d`` rises strictly and z2 sums to 1. All roots are refined at once: each step fits a rational function
    with the two nearest poles, and halves the bracket instead where that leaves it.
    """
    k = len(d)
    gap = np.append(np.diff(d), r)
    i = np.arange(k)
    middle = d + gap / 2
    left = 1 + r * (z2 / (d[None, :] - middle[:, None])).sum(axis=1) >= 0
    left[-1] = True
    origin = np.where(left, i, np.minimum(i + 1, k - 1))
    delta = d[None, :] - d[origin][:, None]
    low, high = np.where(left, 0.0, -gap / 2), np.where(left, gap / 2, 0.0)
    high[-1] = gap[-1]
    at = (low + high) / 2
    below = np.tril(np.ones((k, k), bool))
    own, following = delta[i, i], delta[i, np.minimum(i + 1, k - 1)]
    done = np.zeros(k, bool)
    for _ in range(200):
        away = delta - at[:, None]
        with np.errstate(all="ignore"):
            part = r * z2 / away
            value = 1 + part.sum(axis=1)
            slope = part / away
            first, second = (slope * below).sum(axis=1), (slope * ~below).sum(axis=1)
            done |= (np.abs(value) <= 2 * _EPS * (1 + np.abs(part).sum(axis=1))) | (high - low <= 2 * _EPS * np.abs(at))
            if done.all():
                break
            low, high = np.where(~done & (value < 0), at, low), np.where(~done & (value >= 0), at, high)
            a_pole, b_pole = own - at, following - at
            both = (a_pole + b_pole) * value - a_pole * b_pole * (first + second)
            product = a_pole * b_pole * value
            rest = value - a_pole * first - b_pole * second
            root = np.sqrt(np.maximum(both * both - 4 * product * rest, 0))
            step = np.where(both <= 0, (both - root) / (2 * rest), 2 * product / (both + root))
            # The last root has one pole: c + s / (d - t) with the value and the slope of here.
            plain = value[-1] - a_pole[-1] * first[-1]
            step[-1] = a_pole[-1] + a_pole[-1] ** 2 * first[-1] / plain
            new = at + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        at = np.where(done, at, np.where(inside, new, (low + high) / 2))
    return origin, at


def update(d: np.ndarray, q: np.ndarray, v: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and vectors of q diag(d) q' + r v v', for r >= 0."""
    z = q.T @ v
    norm = float(np.linalg.norm(z))
    r = r * norm * norm
    if not r > 0:
        return d, q
    z = z / norm
    q = q.copy()
    tolerance = 8 * _EPS * max(abs(d[0]), abs(d[-1]), r)
    live = np.flatnonzero(r * np.abs(z) > tolerance).tolist()
    kept: list[int] = []
    for j in live:
        if kept and d[j] - d[kept[-1]] <= tolerance:
            i = kept[-1]
            size = float(np.hypot(z[i], z[j]))
            c, s = z[j] / size, z[i] / size
            q[:, [i, j]] = np.column_stack([c * q[:, i] - s * q[:, j], s * q[:, i] + c * q[:, j]])
            z[i], z[j] = 0.0, size
            kept[-1] = j
        else:
            kept.append(j)
    if not kept:
        return d, q
    own = np.array(kept)
    poles, z = d[own], z[own]
    weight = z * z / (z @ z)
    r = r * float(z @ z)
    origin, at = _roots(poles, weight, r)
    # away[j, i]: root j less pole i.
    away = at[:, None] - (poles[None, :] - poles[origin][:, None])
    k = len(own)
    apart = poles[:, None] - poles[None, :]
    fitted = np.log(np.abs(away[k - 1]) / r)
    for i in range(k):
        fitted[i] += np.log(np.abs(away[:i, i] / apart[:i, i])).sum() + np.log(np.abs(away[i : k - 1, i] / apart[i + 1 :, i])).sum()
    z = np.copysign(np.exp(fitted / 2), z)
    turn = -(z[None, :] / away).T
    turn /= np.linalg.norm(turn, axis=0)
    values = d.copy()
    values[own] = poles[origin] + at
    q[:, own] = q[:, own] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], q[:, order]


class Spectrum:
    """Count, exact sums, and eigenpairs of the scatter around the mean of whole-number rows."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray):
        self.n, self.sums, self.values, self.vectors = n, sums, values, vectors

    @staticmethod
    def empty(size: int) -> Spectrum:
        return Spectrum(0, [0] * size, np.zeros(size), np.eye(size))

    def _shift(self, n: int, sums: list[int]) -> None:
        """Take in the count and sums of other rows, and the distance of their mean."""
        if self.n and n:
            apart = np.array([(a * n - b * self.n) / (self.n * n) for a, b in zip(self.sums, sums, strict=True)])
            self._add(apart, self.n * n / (self.n + n))
        self.n += n
        self.sums = [a + b for a, b in zip(self.sums, sums, strict=True)]

    def _add(self, v: np.ndarray, r: float) -> None:
        self.values, self.vectors = update(self.values, self.vectors, v, r)

    def add_rows(self, x: np.ndarray) -> None:
        """Rows of int64. More rows than columns are first turned into as many rows as columns, by a QR
        decomposition of the centred block, which leaves their scatter as it is; each row left is an update."""
        sums = column_sums(x)
        rows = centred(x, len(x), sums)
        if len(rows) > rows.shape[1]:
            rows = np.linalg.qr(rows, mode="r")
        self._shift(len(x), sums)
        for row in rows:
            self._add(row, 1.0)

    def merge(self, other: Spectrum) -> None:
        """The other's eigenpairs as rank-one updates, after that of the distance between the means."""
        self._shift(other.n, other.sums)
        for value, vector in zip(other.values.tolist(), other.vectors.T, strict=True):
            if value > 0:
                self._add(vector, value)


def column_sums(x: np.ndarray) -> list[int]:
    """Exact sums of int64 columns."""
    if len(x) * int(max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))) < 1 << 62:
        return [int(s) for s in x.sum(axis=0)]
    return [int(s) for s in x.astype(object).sum(axis=0)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n in doubles, the whole part of the mean taken off in integers."""
    base = [s // n for s in sums]
    rest = np.array([(s - n * b) / n for s, b in zip(sums, base, strict=True)])
    return (x - np.array(base, np.int64)).astype(float) - rest
