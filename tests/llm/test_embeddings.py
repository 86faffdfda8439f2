import numpy as np
import pytest

from sabermill.llm.cover_tree import CoverTree, close_pairs
from sabermill.llm.embeddings import link_embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, node string"


def usable(v, label):
    return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute(rows, threshold):
    n = len(rows)
    name, links = [r[0] for r in rows], np.zeros((n, n), bool)
    for i, (_, v, a, *_) in enumerate(rows):
        for j, (_, w, b, *_) in enumerate(rows):
            if i != j and usable(v, a) and usable(w, b) and a == b and len(v) == len(w):
                x, y = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                links[i, j] = x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold
    for _ in range(n):
        for i, j in zip(*np.nonzero(links), strict=True):
            name[i] = name[j] = min(name[i], name[j])
    return sorted((r[0], int(links[i].sum()), name[i], r[0] == name[i]) for i, r in enumerate(rows))


def clustered(seed, n, size):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(n // 6, size))
    rows = []
    for i in range(n):
        v = centres[draw.integers(len(centres))] + draw.choice([0, 0.02, 0.1, 0.2]) * draw.normal(size=size)
        rows.append((3 * i + 1, (v * draw.choice([1, 5])).astype(np.float32).tolist(), int(draw.integers(0, 2)), "x"))
    return rows


@pytest.mark.parametrize("options", [{}, {"block_rows": 9, "max_pivots": 6}])
def test_links_match_brute_force(spark, options):
    rows = clustered(1, 150, 8)
    rows += [(1000 + i, rows[0][1], rows[0][2], "copy") for i in range(20)]
    got = link_embeddings(spark.createDataFrame(rows, SCHEMA).repartition(3), **options)
    assert sorted(map(tuple, got.select("vec_id", "n_links", "component_id", "kept").collect())) == brute(rows, 0.98)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1, ""), (2, [2.0, 0.0], 1, ""), (3, [1.0, 0.0], None, ""), (4, None, 1, ""), (5, [0.0, 0.0], 1, ""), (6, [nan, 1.0], 1, ""),
        (7, [inf, 1.0], 1, ""), (8, [None, 1.0], 1, ""), (9, [], 1, ""), (10, [1.0, 0.0, 0.0], 1, ""), (11, [1.0, 0.0], 2, ""), (12, [-1.0, 0.0], 1, ""),
    ]
    got = link_embeddings(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect())) == brute(rows, 0.98)
    assert link_embeddings(spark.createDataFrame([], SCHEMA)).collect() == []


def test_repeated_and_null_ids(spark):
    rows = [(1, [1.0, 0.0], 1, "")] * 3 + [(None, [1.0, 0.01], 1, ""), (None, [0.0, 1.0], 2, "")]
    got = sorted(map(str, (tuple(r) for r in link_embeddings(spark.createDataFrame(rows, SCHEMA)).collect())))
    assert got == sorted(map(str, [(1, 3, 1, True)] * 3 + [(None, 3, 1, False), (None, 0, None, False)]))


@pytest.mark.parametrize("spread", [0.0, 0.03, 1.0])
def test_traversal_visits_each_close_pair_once(spread):
    draw = np.random.default_rng(3)
    x = np.repeat(draw.normal(size=(20, 6)), 30, axis=0) + spread * draw.normal(size=(600, 6))
    x /= np.linalg.norm(x, axis=1)[:, None]
    trees = CoverTree(x), CoverTree(x[100:400])
    for a, b in ((trees[0], trees[1]), (trees[0], trees[0])):
        seen = np.zeros((len(a.points), len(b.points)), int)

        def found(i, j, seen=seen):
            seen[np.ix_(i, j)] += 1

        close_pairs(a, b, 0.3, found)
        close = np.sqrt(np.maximum(2 - 2 * a.points @ b.points.T, 0)) <= 0.3
        assert seen.max() <= 1
        # Of two nodes of one tree one order is visited; a leaf with itself holds both.
        assert ((seen | seen.T) if a is b else seen)[close].all()
    tree = trees[0]
    for node in range(len(tree.begin)):
        below = tree.points[tree.below(node)]
        assert np.sqrt(np.maximum(2 - 2 * below @ tree.points[tree.centre[node]], 0)).max(initial=0) <= tree.reach[node] + 1e-6
        kids = tree.children[node]
        assert not len(kids) or tree.centre[kids[0]] == tree.centre[node]
