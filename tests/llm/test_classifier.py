import zlib

import numpy as np

from sabermill.llm.quality import classify, descend, features, fit
from sabermill.llm.tables import table

SF = "/root/testdata/sf0.01"


def test_descent_reaches_the_optimum():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(60, 5))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = np.where(x @ np.array([1.0, -2, 0.5, 0, 0]) + 0.3 * draw.normal(size=60) > 0, 1.0, -1.0)
    rows = [np.arange(5)] * 60
    found = descend(rows, list(x), y, 5, 0.5, 3000)

    def loss(w):
        return 0.5 * w @ w + 0.5 * np.maximum(0, 1 - y * (x @ w)).sum()

    best = min(loss(found + 0.01 * draw.normal(size=5)) for _ in range(500))
    assert loss(found) <= best + 1e-3 and loss(found) < loss(np.zeros(5))


def test_features_are_indicators_of_whole_texts():
    a, b, none, empty, shouted, long = features(["one two one two", "one two one two one two", None, "", "ONE!! TWO!!", "one two " * 50_000 + "tail"])
    assert set(a.tolist()) <= set(b.tolist()) and len(none) == len(empty) == 0
    assert not set(a.tolist()) & set(shouted.tolist())
    assert set(b.tolist()) < set(long.tolist())
    assert len(set(features(["x tail"])[0].tolist()) & set(long.tolist())) >= 1


def test_held_out_accuracy(spark):
    done = classify(table(spark, SF, "documents"), table(spark, SF, "labels")).select("doc_id", "held_out", "score", "predicted").toPandas()
    assert len(done) == 1000 and done.score.between(0, 1).all()
    assert (done.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in done.doc_id]).all()
    assert (done.predicted == (done.score >= 0.3)).all()
    both = done[done.held_out].merge(table(spark, SF, "labels").toPandas(), on="doc_id")
    assert len(both) > 40 and (both.predicted == both.quality).mean() > 0.93


def test_only_text_counts_and_held_out_labels_are_not_seen(spark):
    docs = spark.createDataFrame([(i, "GOOD words here" if i % 2 else "bad!! text??", "en") for i in range(200)], "doc_id long, text string, score string")
    labels = [(i, i % 2, 0) for i in range(200)]
    turned = [(i, q if zlib.crc32(str(i).encode()) % 5 else 1 - q, 0) for i, q, _ in labels]
    schema = "doc_id long, quality int, toxic int"
    got = [classify(docs, spark.createDataFrame(x, schema)).orderBy("doc_id").select("score").collect() for x in (labels, turned)]
    assert got[0] == got[1]
    assert len({r["score"] for r in got[0]}) == 2


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (3, "w " * 100_000), (3, "w " * 100_000)], "doc_id long, text string")
    schema = "doc_id long, quality int"
    for labels, share in (([], 0.5), ([(3, 1), (3, None), (77, 1)], 1.0), ([(3, 0)], 0.0)):
        rows = classify(docs, spark.createDataFrame(labels, schema)).collect()
        assert len(rows) == 5 and all(abs(r["score"] - share) < 1e-6 for r in rows), labels
    some = classify(docs, spark.createDataFrame([(3, 1), (1, 0), (2, 0), (3, 0)], schema)).collect()
    assert len(some) == 5 and all(0 <= r["score"] <= 1 for r in some)
    assert [r["held_out"] for r in some if r["doc_id"] is None] == [False]
    assert classify(docs.limit(0), spark.createDataFrame([], schema)).collect() == []
    assert fit([], np.array([])).scores(["x", None]).tolist() == [0.5, 0.5]
