import random
import re

from sabermill.llm.decontaminate import decontaminate

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, n_words string, words string"


def cut(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return PATTERN.findall(lowered)


def brute(text, items, window):
    words, hit, found = cut(text), set(), set()
    for item, passage in items:
        own = cut(passage)
        n = min(window, len(own))
        for i in range(len(own) - n + 1):
            for at in range(len(words) - n + 1) if n else ():
                if words[at : at + n] == own[i : i + n]:
                    hit.update(range(at, at + n))
                    if item is not None:
                        found.add(item)
    return len(words), len(hit), sorted(found)


def check(spark, docs, items, **options):
    got = decontaminate(
        spark.createDataFrame([(i, t, "mine", "extra") for i, t in docs], DOCS),
        spark.createDataFrame(items, "item_id long, text string"),
        window=4,
        **options,
    )
    assert got.columns == ["doc_id", "text", "words", "n_words", "n_hit", "n_items", "item_ids", "contaminated"]
    rows = sorted(((r["doc_id"], r["text"], r["n_words"], r["n_hit"], r["item_ids"], r["n_items"], r["contaminated"]) for r in got.collect()), key=str)
    want = []
    for i, text in docs:
        n, hit, found = brute(text, items, 4)
        want.append((i, text, n, hit, found, len(found), hit > 0))
    assert rows == sorted(want, key=str)


def test_random_texts_match_brute_force(spark):
    draw = random.Random(3)
    vocabulary = ["The", "of", "a", "é", "x1", "rare", "Zug"]

    def text(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    items = [(i, text(draw.randint(1, 9))) for i in range(12)]
    docs = [(i, text(draw.randint(0, 40))) for i in range(40)] + [(99, "on " + items[0][1] + " off")]
    check(spark, docs, items)
    check(spark, docs, items, block_windows=5, shingle=2)


def test_defined_cases(spark):
    items = [(1, "one two three four five"), (1, "one two three four five"), (None, "six seven"), (2, None), (3, ""), (4, " ...")]
    docs = [
        (1, None), (2, ""), (3, "ONE two, three-four!"), (3, "ONE two, three-four!"), (3, "other words"),
        (None, "x six seven y"), (5, "one two three"), (6, "word " * 30_000 + "two three four five"), (7, "Éone two three four"),
    ]
    check(spark, docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert decontaminate(docs, items).collect() == []
    some = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    (row,) = decontaminate(some, items.limit(0)).collect()
    assert (row["n_words"], row["n_hit"], row["item_ids"], row["contaminated"]) == (2, 0, [], False)


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    plan = decontaminate(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
