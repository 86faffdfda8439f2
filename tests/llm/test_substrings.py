import random

import numpy as np
import pytest

from sabermill.llm.substrings import _pack, _unpack, remove_repeats
from sabermill.llm.tables import written
from sabermill.llm.word_windows import Words


def brute(docs, window):
    """(id, n_words, n_removed, kept words) of documents by id (nulls first), then text."""
    ordered = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None and "b" or "a", d[1] or ""))
    seen, out = set(), []
    for i, text in ordered:
        words = (text or "").encode().split()
        gone = set()
        for at in range(len(words) - window + 1):
            run = tuple(words[at : at + window])
            if run in seen:
                gone.update(range(at, at + window))
            seen.add(run)
        kept = b" ".join(w for n, w in enumerate(words) if n not in gone).decode()
        out.append((i, len(words), len(gone), kept if gone else text))
    return out


def check(spark, docs, **options):
    df = spark.createDataFrame([(i, t, "own", 1) for i, t in docs], "doc_id long, text string, n_words string, block int").repartition(3)
    got = remove_repeats(df, window=4, **options)
    assert got.columns == ["doc_id", "text", "block", "n_words", "n_removed"]
    rows = [(r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got.collect()]
    assert sorted(rows, key=str) == sorted(brute(docs, 4), key=str)
    return got


def texts(seed, n):
    draw = random.Random(seed)
    passages = [" ".join(draw.choice("abcdefgh") + str(draw.randint(0, 9)) for _ in range(12)) for _ in range(6)]

    def text():
        parts = [draw.choice(passages) if draw.random() < 0.3 else " ".join(draw.choice("abcdefghij") * 2 for _ in range(draw.randint(0, 15))) for _ in range(4)]
        return draw.choice([" ", "\n", "\t "]).join(parts)

    return [(draw.randint(0, 10 * n) if i % 9 else i, text()) for i in range(n)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 700])
def test_random_texts_match_brute_force(spark, block_bytes):
    docs = list({i: (i, t) for i, t in texts(5, 60)}.values())
    check(spark, docs, block_bytes=block_bytes, slice_cells=1 << 12)


def test_one_sketch_row_and_a_narrow_sketch_lose_nothing(spark):
    docs = list({i: (i, t) for i, t in texts(6, 40)}.values())
    check(spark, docs, block_bytes=500, depth=1, slice_cells=1 << 10)


def test_defined_cases(spark):
    run = "one two three four five six"
    docs = [
        (None, run), (1, None), (2, ""), (3, " \n "), (4, f"{run} {run}"), (4, f"{run} {run}"), (5, "one two three"),
        (6, "same " * 30), (7, "é x two\vthree four"), (8, "é x two three four"), (9, "w" * 3_000_000 + f" {run}"),
    ]
    check(spark, docs, block_bytes=400)


def test_hot_passage(spark):
    docs = [(i, f"start{i} the very same passage in all of them end{i}") for i in range(400)]
    got = check(spark, docs, block_bytes=2000)
    assert sum(r["n_removed"] for r in got.collect()) == 399 * 8


def test_no_documents(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_numbers_survive_packing():
    for values in ([], [0], [3, 3, 9], [1 << 40, (1 << 40) + 7]):
        assert _unpack(_pack(np.array(values, np.int64))).tolist() == values


@pytest.mark.parametrize("size", [1, 2, 3, 5, 7, 20])
def test_equal_runs_have_equal_hashes(size):
    words = Words(["x y z x y z " * 12, "q x y z x y z " * 9])
    hashes = words.windows(size)
    cut = [words.raw[a:b].tobytes() for a, b in zip(words.starts, words.ends, strict=True)]
    runs = [tuple(cut[i : i + size]) for i in range(len(cut) - size + 1)]
    assert len(hashes) == len(runs) and len(set(zip(runs, hashes.tolist(), strict=True))) == len(set(runs)) == len(set(hashes.tolist()))


def test_documents_are_shuffled_once(spark):
    df = spark.createDataFrame([(i, f"text {i} of some words", "en") for i in range(50)], "doc_id long, text string, lang string")
    got = remove_repeats(written(df, "test-docs"), window=3, block_bytes=300)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("REPARTITION_BY_NUM") == 3 and plan.count("ReusedExchange") == 2
