import hashlib
import random

import numpy as np
import pytest

from sabermill.llm.graph import components
from sabermill.llm.near_duplicates import labelled, matched, near_duplicates, shingles_of, similar, sketch


def lcs(a, b):
    best = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
    return int(best[-1, -1])


def cut(text):
    words = (text or "").encode().split()
    n = min(5, len(words))
    return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)] if n else []


def brute(docs):
    """Class of each (id, text) by comparing all pairs."""
    names = [i for i, _ in docs]
    shingles = [cut(t) for _, t in docs]
    changed = True
    while changed:
        changed = False
        for x, a in enumerate(shingles):
            for y, b in enumerate(shingles):
                if a and b and names[x] != names[y]:
                    m = lcs(a, b)
                    if m / (len(a) + len(b) - m) >= 0.8 - 1e-12:
                        names[x] = names[y] = min(names[x], names[y])
                        changed = True
    return names


def varied(draw, words, edits):
    words = list(words)
    for _ in range(edits):
        kind, at = draw.choice("rid"), draw.randrange(len(words))
        if kind == "r":
            words[at] = f"new{draw.randint(0, 999)}"
        elif kind == "i":
            words.insert(at, f"new{draw.randint(0, 999)}")
        elif len(words) > 6:
            del words[at]
    return " ".join(words)


def test_alignment_matches_the_full_table():
    draw = random.Random(1)
    for _ in range(600):
        a = [draw.randint(0, 6) for _ in range(draw.randint(0, 25))]
        b = list(a) if draw.random() < 0.5 else [draw.randint(0, 6) for _ in range(draw.randint(0, 25))]
        for _ in range(draw.randint(0, 4)):
            if b:
                b[draw.randrange(len(b))] = draw.randint(0, 9)
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        true = lcs(a, b)
        assert matched(x, y, 0) == true
        for need in (max(0, true - 1), true, true + 1):
            assert (matched(x, y, need) >= need) == (true >= need)
        if a and b:
            assert similar(x, y, 0.8) == (true / (len(a) + len(b) - true) >= 0.8 - 1e-12)


def test_sketch_is_sensitive_to_order_and_repeats():
    a = shingles_of(["a b c d e f g h i j k l m n o p"], 1)[0]
    assert (sketch(a, 24, 4) == sketch(a.copy(), 24, 4)).all()
    assert (sketch(a, 24, 4) != sketch(a[::-1], 24, 4)).mean() > 0.8
    assert len(set(labelled(np.array([7, 7, 8, 7], np.uint64)).tolist())) == 4
    assert shingles_of(["one two", "", None, "a b c d e f"], 5)[3].shape == (2,)


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_match_brute_force(spark, seed):
    draw = random.Random(seed)
    docs, number = [], 100
    for _ in range(12):
        base = [f"w{draw.randint(0, 400)}" for _ in range(draw.choice([3, 12, 60, 90]))]
        for edits in [0, 0, *[draw.randint(1, 3) for _ in range(draw.randint(0, 4))], 14]:
            docs.append((number, varied(draw, base, edits)))
            number += draw.randint(1, 5)
    draw.shuffle(docs)
    df = spark.createDataFrame([(i, t, "x", i) for i, t in docs], "doc_id long, text string, kept string, class_id long").repartition(3)
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in near_duplicates(df).collect()}
    want = brute(docs)
    assert got == {i: (c, i == c) for (i, _), c in zip(docs, want, strict=True)}


def test_defined_cases(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    docs = [(1, None), (2, ""), (3, " \n"), (None, "lone words here"), (4, "lone words here"), (4, "lone words here"), (9, long), (5, long + " end"), (7, "a"), (8, "a")]
    got = sorted(((r["doc_id"], r["class_id"], r["kept"]) for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()), key=str)
    want = [(1, 1, True), (2, 2, True), (3, 3, True), (None, None, True), (4, 4, True), (4, 4, True), (5, 5, True), (9, 5, False), (7, 7, True), (8, 7, False)]
    assert got == sorted(want, key=str)
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(200, 260)}, 7: 7}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_copies_are_linked_when_the_centre_of_their_bucket_is_too_long(spark):
    draw = random.Random(21)
    words = [f"w{draw.randint(0, 10**6)}" for _ in range(60)]
    short = [(3, " ".join(words)), (4, " ".join([*words[:30], "other", *words[31:]]))]
    longer = " ".join([*words, *[f"v{draw.randint(0, 10**6)}" for _ in range(30)]])
    for many in ([], [(0, longer)], [(1, longer), (7, f"{longer} end {longer}")], [(9, longer)]):
        df = spark.createDataFrame(short + many, "doc_id long, text string")
        got = {r["doc_id"]: r["class_id"] for r in near_duplicates(df, bands=1, sampled=1).collect()}
        assert got[3] == got[4] == 3, many


def test_rows_that_share_an_id_are_told_apart_by_text(spark):
    a, b = "one two three four five six seven", "nothing in common with the other text at all"
    df = spark.createDataFrame([(1, a), (5, a), (5, b), (6, None)], "doc_id long, text string")
    got = {(r["doc_id"], r["text_md5"] == hashlib.md5(a.encode()).hexdigest()): r["kept"] for r in near_duplicates(df).collect()}
    assert got == {(1, True): True, (5, True): False, (5, False): True, (6, False): True}
