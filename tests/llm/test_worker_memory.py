"""What a block or a batch of texts costs a Python worker beside its Arrow data."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from sabermill.llm.pieces import PieceModel
from sabermill.llm.substrings import remove_repeats


def peak_mb(work):
    tracemalloc.start()
    out = work()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, peak / (1 << 20)


@pytest.fixture(scope="module")
def texts():
    """Nearly 8 MB of texts in which few words are alike; of every two documents the second ends as the first."""
    draw = random.Random(8)
    words = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9))) for _ in range(20_000)]
    out = []
    for _ in range(1000):
        passage = " ".join(draw.choices(words, k=30))
        out += [" ".join([*draw.choices(words, k=600), passage]) for _ in range(2)]
    return out


@pytest.fixture(scope="module")
def steps(spark):
    """The functions that ``remove_repeats`` gives to Spark, in their order, with 2 ** 27 cells or so."""
    found = []
    df = spark.createDataFrame([(1, "some words of a text")], "doc_id long, text string")
    patch = pytest.MonkeyPatch()
    grouped, cogrouped = type(df.groupBy("doc_id")), type(df.groupBy("doc_id").cogroup(df.groupBy("doc_id")))
    for kind, name in ((type(df), "mapInArrow"), (grouped, "applyInArrow"), (cogrouped, "applyInArrow")):
        patch.setattr(kind, name, lambda self, func, schema, real=getattr(kind, name): (found.append(func), real(self, func, schema))[1])
    remove_repeats(df, cells_per_byte=1 << 22, slice_cells=1 << 27)
    patch.undo()
    assert len(found) == 5
    return dict(zip(("sketch", "merge", "repeated", "group", "remove"), found, strict=True))


def test_a_block_costs_a_few_times_its_bytes(texts, steps):
    rest = pa.array([{"_": 0}] * len(texts), pa.struct([("_", pa.int32())]))
    block = pa.table([pa.array([0] * len(texts), pa.int64()), pa.array(range(len(texts)), pa.int64()), pa.array(texts), rest], ["block", "id", "text", "rest"])
    assert 7 << 20 < block.nbytes < 8 << 20
    peaks = {}
    sent, peaks["sketch"] = peak_mb(lambda: list(steps["sketch"](iter(block.to_batches()))))
    sent = pa.Table.from_batches(sent)
    hot = []
    for row in (0, 1):
        own = sent.filter(pa.array(sent["row"].to_numpy() == row))
        for number in np.unique(own["slice"].to_numpy()).tolist():
            key = (pa.scalar(row), pa.scalar(number))
            hot.append(steps["merge"](key, own.filter(pa.array(own["slice"].to_numpy() == number))))
    maybe, peaks["repeated"] = peak_mb(lambda: steps["repeated"]((pa.scalar(0),), block, pa.concat_tables(hot)))
    later = pa.concat_tables([steps["group"](maybe.filter(pa.array(maybe["bucket"].to_numpy() == b))) for b in np.unique(maybe["bucket"].to_numpy())])
    done, peaks["remove"] = peak_mb(lambda: steps["remove"]((pa.scalar(0),), block, later))
    assert done["n_removed"].to_pylist() == [0, 30] * 1000 and done["n_words"].to_pylist() == [630] * 2000
    assert done["text"].to_pylist() == [t if i % 2 == 0 else " ".join(t.split()[:600]) for i, t in enumerate(texts)]
    print({k: round(v) for k, v in peaks.items()})
    assert peaks["sketch"] < 80 and peaks["repeated"] < 60 and peaks["remove"] < 40


def test_pieces_of_a_batch_are_cut_in_parts(texts):
    model = PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    model.encode(texts)
    (ids, counts), peak = peak_mb(lambda: model.encode(texts))
    print(round(peak))
    parts = [model.encode(texts[i : i + 7]) for i in range(0, len(texts), 7)]
    assert ids.tolist() == np.concatenate([i for i, _ in parts]).tolist() and counts.tolist() == np.concatenate([n for _, n in parts]).tolist()
    assert peak < 60
    none, zeros = model.encode([None, "", None])
    assert none.tolist() == [] and zeros.tolist() == [0, 0, 0] and [len(x) for x in model.encode([])] == [0, 0]
