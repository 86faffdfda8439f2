import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sabermill.llm import hard_negatives as module
from sabermill.llm.hard_negatives import hard_negatives
from sabermill.llm.strassen import product

SCHEMA = "vec_id long, label string, embedding array<float>"


def expected(rows, every, k=5):
    """Brute force over (vec_id, label, embedding) in whole numbers."""
    usable = [
        (v, lab, [math.floor(256 * float(np.float32(c))) for c in e])
        for v, lab, e in rows
        if lab is not None and e is not None and all(c is not None and math.isfinite(c) for c in e)
    ]
    out = []
    for a, (vec, label, x) in enumerate(usable):
        if vec is None or vec % every:
            continue
        others = [(n, sum(p * q for p, q in zip(x, y, strict=True)), lab, v) for n, (v, lab, y) in enumerate(usable) if n != a and len(y) == len(x)]
        others.sort(key=lambda o: (-o[1], o[3] is None, o[3] or 0))
        for _, ps, _, pv in [o for o in others if o[2] == label][:k]:
            window = [o for o in others if o[2] != label and 80 * ps <= 100 * o[1] <= 100 * ps]
            out += [(vec, pv, rank, nv, ps, ns) for rank, (_, ns, _, nv) in enumerate(window[:k], 1)]
    return sorted(out, key=str)


def found(df, every, **options):
    return sorted((tuple(r) for r in hard_negatives(df, F.col("vec_id") % every == 0, **options).collect()), key=str)


def random_rows(rng, n, size, labels="abc"):
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append((i, rng.choice(labels), [x + rng.gauss(0, 0.4) for x in c]))
    return rows


@pytest.mark.parametrize("size", [0, 1, 7, 24])
def test_equals_brute_force(spark, size):
    rows = random_rows(random.Random(size), 260, size)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = expected(rows, 10)
    assert found(df, 10) == want and (size == 0 or want)
    # Many small tasks, several groups of anchors, and tiles that don't come out even.
    assert found(df, 10, anchor_bytes=64 * max(size, 1), task_work=2000) == want


def test_ties_hot_vectors_repeats_nulls_and_other_lengths(spark, monkeypatch):
    monkeypatch.setattr(module, "TILE_ANCHORS", 3)
    monkeypatch.setattr(module, "TILE_ROWS", 16)
    rng = random.Random(11)
    rows = random_rows(rng, 120, 5)
    rows += [(200 + i, rng.choice("ab"), [1.0, 0.5, 0.25, 0.0, 0.0]) for i in range(150)]
    rows += [(10, "a", rows[10][2]), (10, "a", rows[10][2]), (None, "a", rows[10][2]), (None, "b", rows[20][2]), (30, "c", [0.5] * 6), (31, "a", [0.5] * 6), (33, "c", [0.5] * 6)]
    rows += [(40, None, [1.0] * 5), (50, "a", None), (60, "a", [1.0, None, 1.0, 1.0, 1.0]), (70, "b", [math.nan] * 5), (80, "b", [math.inf] * 5), (90, "zz", [-1.0] * 5), (None, None, None), (0, "a", [])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = expected(rows, 10)
    assert found(df, 10) == want == found(df, 10, anchor_bytes=200, task_work=500)


def test_negative_scores_extra_columns_no_anchor_and_no_rows(spark):
    rows = [(0, "a", [1.0]), (1, "a", [-1.0]), (2, "b", [-1.0]), (3, "b", [1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df, 10) == []
    clash = df.select("*", F.lit("x").alias("no"), F.lit(1).alias("score"), F.lit(1).alias("task"), F.lit(2).alias("vector"))
    rows += [(4, "a", [2.0])]
    both = clash.union(spark.createDataFrame([(4, "a", [2.0], "x", 1, 1, 2)], clash.schema))
    assert found(both, 2) == expected(rows, 2) != []
    assert found(df, 1000) == [] == found(df.limit(0), 1) and hard_negatives(df, F.lit(None).cast("boolean")).count() == 0


def test_scores_that_do_not_fit_are_an_error(spark):
    df = spark.createDataFrame([(0, "a", [1e12]), (1, "a", [1e12])], SCHEMA)
    with pytest.raises(Exception, match="does not fit"):
        found(df, 1)


def test_products_are_exact_for_all_shapes():
    rng = np.random.default_rng(1)
    for m, k, n in [(1, 1, 1), (0, 3, 4), (5, 0, 3), (9, 17, 33), (64, 64, 64), (31, 100, 70)]:
        a, b = rng.integers(-(1 << 28), 1 << 28, (m, k)), rng.integers(-(1 << 28), 1 << 28, (k, n))
        assert (product(a, b, 2) == a @ b).all() and (product(a, b).astype(object) == a.astype(object) @ b.astype(object)).all()
