import random

import numpy as np
from test_near_duplicates import brute, lcs

from sabermill.llm.near_duplicates import near_duplicates, short_keys


def test_similar_short_texts_share_an_exact_key():
    draw, similar = random.Random(3), 0
    for _ in range(20_000):
        a = [draw.randint(0, 3) for _ in range(draw.randint(1, 12))]
        b = list(a)
        for _ in range(draw.randint(0, 3)):
            if draw.random() < 0.5 and len(b) > 1:
                del b[draw.randrange(len(b))]
            else:
                b.insert(draw.randint(0, len(b)), draw.randint(0, 5))
        for similarity in (0.8, 0.7, 0.9):
            m = lcs(a, b)
            exact = 11 if similarity > 0.75 else 6
            if a != b and min(len(a), len(b)) <= exact and m / (len(a) + len(b) - m) >= similarity - 1e-12:
                similar += 1
                assert np.intersect1d(*(short_keys(np.array(x, np.uint64), similarity) for x in (a, b))).size, (a, b)
    assert similar > 1000
    assert short_keys(np.arange(14, dtype=np.uint64), 0.8).size == 0


def test_no_link_between_short_texts_is_lost(spark):
    docs = []
    for i in range(3000):
        words = [f"w{i}x{k}" for k in range(9)]
        docs += [(2 * i, " ".join(words[:8])), (2 * i + 1, " ".join(words))]
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i, _ in docs}


def test_short_classes_match_brute_force_with_one_band(spark):
    draw, docs = random.Random(5), []
    for _ in range(30):
        base = [f"w{draw.randint(0, 300)}" for _ in range(draw.randint(5, 15))]
        for lo, hi in ((0, 0), (0, 1), (1, 0), (0, 2), (1, 1)):
            docs.append((len(docs), " ".join(base[lo : len(base) - hi])))
        docs.append((len(docs), " ".join([*base[:-1], "other"])))
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), bands=1).collect()}
    assert got == dict(zip(range(len(docs)), brute(docs), strict=True))
