import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sabermill.llm.spectra import Spectrum, centred, column_sums, update
from sabermill.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<double>"


def against_dense(rows, got, components=32):
    """Compare the rows of one length with a dense eigendecomposition and exact fractions."""
    x = [[math.floor(64 * c) + 1_000_000 for c in e] for _, e in rows]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    exact = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(row, sums, strict=True)] for row in x])
    values, vectors = np.linalg.eigh(exact.T @ exact / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    want = exact @ vectors[:, :k] / np.sqrt(values[:k])
    assert len(got) == n * k
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, {})[r.component] = r
    seen = np.array([[by_row[v][c].whitened for c in range(1, k + 1)] for v, _ in rows])
    assert np.abs(seen * np.sign((seen * want).sum(axis=0)) - want).max() < 1e-6
    for (v, _), row in zip(rows, x, strict=True):
        assert by_row[v][1].deviation == sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) and by_row[v][1].n == n
    shares = [by_row[rows[0][0]][c].explained for c in range(1, k + 1)]
    assert np.allclose(shares, values[:k] / values.sum(), rtol=1e-9) and sorted(shares, reverse=True) == shares
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-8


def test_equals_a_dense_decomposition_for_any_cut(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(700, 40)) * np.geomspace(0.1, 30, 40) @ np.linalg.qr(rng.normal(size=(40, 40)))[0]
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    df = spark.createDataFrame(rows, SCHEMA)
    against_dense(rows, whiten(df.repartition(11), fan=3).collect())
    against_dense(rows, whiten(df.coalesce(1), block_bytes=2000, components=4).collect(), 4)


def test_lengths_are_fitted_apart_and_unusable_rows_dropped(spark):
    rng = np.random.default_rng(4)
    short = [(i, rng.normal(size=3).tolist()) for i in range(50)]
    long = [(100 + i, rng.normal(size=7).tolist()) for i in range(60)]
    bad = [(1, None), (2, [1.0, None, 2.0]), (3, [math.nan] * 3), (4, [math.inf] * 3), (5, []), (6, [9.0]), (7, [1.0, 2.0]), (8, [1.0, 2.0])]
    df = spark.createDataFrame(short + long + bad, SCHEMA).repartition(4)
    got = whiten(df).collect()
    against_dense(short, [r for r in got if r.vec_id < 100])
    against_dense(long, [r for r in got if r.vec_id >= 100])
    clash = df.select("*", F.lit(1).alias("vector"), F.lit(1).alias("at"), F.lit(1).alias("size"))
    assert whiten(clash).count() == len(got)


def test_few_or_equal_rows_repeats_and_null_ids(spark):
    few = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 2.0, 5.0])]
    got = whiten(spark.createDataFrame(few, SCHEMA)).collect()
    against_dense(few, got)
    assert whiten(spark.createDataFrame(few[:1], SCHEMA)).count() == 0 == whiten(spark.createDataFrame([], SCHEMA)).count()
    repeated = spark.createDataFrame([few[0], few[0], few[1], (None, [0.0, 1.0, 0.0])], SCHEMA)
    counted = whiten(repeated).groupBy("vec_id").count().collect()
    assert {r.vec_id: r["count"] for r in counted} == {1: 4, 2: 2, None: 2}
    copies = spark.createDataFrame([(i, [1.0, float(i % 500 == 0), 0.0]) for i in range(2000)], SCHEMA).repartition(5)
    assert {r.component for r in whiten(copies).collect()} == {1}


def test_deviations_beyond_64_bits_are_exact(spark):
    rows = [(1, [1e12]), (2, [-1e12]), (3, [5.0])]
    got = {r.vec_id: int(r.deviation) for r in whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    x = [math.floor(64 * c) + 1_000_000 for _, (c,) in rows]
    assert got == {v: (3 * a - sum(x)) ** 2 for (v, _), a in zip(rows, x, strict=True)} and max(got.values()) > 1 << 63
    with pytest.raises(Exception, match="does not fit"):
        whiten(spark.createDataFrame([(1, [1e300]), (2, [0.0])], SCHEMA)).collect()


def test_updates_and_merges_keep_spectra():
    rng = np.random.default_rng(7)
    for data in (
        rng.integers(-50, 50, (300, 12)) + 1_000_000,
        np.repeat(rng.integers(-9, 9, (3, 12)), 40, axis=0),
        np.eye(12, dtype=np.int64)[rng.integers(0, 12, 200)] * 7,
        np.full((20, 12), 5),
        rng.integers(0, 2, (90, 12)) * 10**9,
    ):
        parts = []
        for piece in np.array_split(data, 4):
            s = Spectrum.empty(12)
            for rows in np.array_split(piece, 3):
                s.add_rows(rows)
            parts.append(s)
        for other in parts[1:]:
            parts[0].merge(other)
        s = parts[0]
        c = centred(data, len(data), column_sums(data))
        top = max(np.abs(c.T @ c).max(), 1)
        assert s.n == len(data) and s.sums == column_sums(data)
        assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - c.T @ c).max() / top < 1e-13
        assert np.abs(s.vectors.T @ s.vectors - np.eye(12)).max() < 1e-13


def test_single_updates_against_dense_ones():
    rng = np.random.default_rng(9)
    for trial in range(60):
        k = int(rng.integers(1, 9))
        d = np.sort(np.round(rng.exponential(size=k), int(rng.integers(0, 12))))
        q = np.linalg.qr(rng.normal(size=(k, k)))[0]
        v = rng.normal(size=k) * 10.0 ** rng.integers(-12, 4, k)
        r = float(10.0 ** rng.integers(-6, 6))
        dense = q @ np.diag(d) @ q.T + r * np.outer(v, v)
        values, vectors = update(d, q, v, r)
        scale = max(1.0, np.abs(dense).max())
        assert np.abs(vectors @ np.diag(values) @ vectors.T - dense).max() / scale < 1e-13, trial
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
