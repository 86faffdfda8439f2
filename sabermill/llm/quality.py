"""Quality classifier: a support vector machine over n-gram indicators scaled by naive Bayes.

Features of a text are the presence of n-grams: one and two words, and one to five word shapes. A
shape is a word's runs of capitals, lower-case letters, digits and other characters, with a mark if the word
repeats the one before. N-grams are hashed to ``2 ** BITS`` places.

Fitting scales every feature by its log-count ratio, log((p + 1) / |p|) - log((q + 1) / |q|) with p and q
the documents of class 1 and 0 that have it, scales rows to unit length and fits a linear hinge-loss
model by dual coordinate descent. Every fifth row of the sample is left out of that and calibrates the
margin to a probability with a logistic curve.

The sample: at most ``max_rows`` labelled rows (10,000 unless said otherwise), those smallest by a hash of
their id. It is the only part that doesn't cover all data: a table of that size is broadcast to find
the texts, and their features (about 40 MB for texts of a thousand distinct n-grams) are
fitted in the driver. Scoring covers every whole text in one pass without a shuffle.

Defined cases: a null or empty text has no features and gets the score of the model's constant. A null
label doesn't count; repeated and contradictory labels each count. With labels of one class only, or
none, the score is the share of class 1 (0.5 if none). Extra columns are carried along; one named like a
result column is replaced. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sabermill.llm.tables import col, stretches
from sabermill.llm.word_windows import Words, mixed

BITS = 18
_BATCH_BYTES = 1 << 19
# Byte classes of shapes; other bytes stand for themselves.
_CLASS = np.arange(256, dtype=np.uint64)
_CLASS[ord("A") : ord("Z") + 1] = ord("X")
_CLASS[ord("a") : ord("z") + 1] = ord("x")
_CLASS[0x80:] = ord("x")
_CLASS[ord("0") : ord("9") + 1] = ord("0")


def _shapes(words: Words) -> np.ndarray:
    """Hash of each word's shape."""
    if not len(words.starts):
        return np.empty(0, np.uint64)
    kinds = _CLASS[words.raw]
    kept = np.append(True, kinds[1:] != kinds[:-1])
    kept[words.starts] = True
    lengths = words.ends - words.starts
    inside = np.repeat(words.starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    kinds, kept = kinds[inside], kept[inside]
    begins = np.cumsum(lengths) - lengths
    rank = np.cumsum(kept) - 1
    rank = np.minimum(rank - np.repeat(rank[begins], lengths), 63)
    powers = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
    return mixed(np.add.reduceat(np.where(kept, kinds * powers[rank], np.uint64(0)), begins))


def features(texts: list[str | None]) -> list[np.ndarray]:
    """Places of the n-grams that each text has, sorted."""
    words = Words(texts, seeds=1)
    shapes = _shapes(words)
    first, counts = words.first[:-1], words.counts
    owner = np.repeat(np.arange(len(counts)), counts)
    word = words.hashes[0]
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    shape = mixed(shapes + again.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    owners, places = [], []
    for kind, tokens, longest in ((1, word, 2), (2, shape, 5)):
        gram = np.zeros(len(tokens), np.uint64)
        for n in range(1, longest + 1):
            m = max(0, len(tokens) - n + 1)
            gram = gram[:m] * np.uint64(0xD6E8FEB86659FD93) + tokens[n - 1 : n - 1 + m]
            whole = owner[:m] == owner[n - 1 : n - 1 + m]
            places.append((mixed(gram[whole] + np.uint64(16 * kind + n)) >> np.uint64(64 - BITS)).astype(np.int64))
            owners.append(owner[:m][whole])
    both = np.unique((np.concatenate(owners) << BITS) | np.concatenate(places))
    cuts = np.searchsorted(both >> BITS, np.arange(1, len(counts)))
    return np.split((both & ((1 << BITS) - 1)).astype(np.int32), cuts) if len(counts) else []


def _stretches(texts: list[str | None]) -> list[tuple[int, int]]:
    sizes = np.cumsum([len(t or "") + 1 for t in texts]) // _BATCH_BYTES
    begins = np.flatnonzero(np.diff(sizes, prepend=-1)).tolist()
    return list(zip(begins, [*begins[1:], len(texts)][: len(begins)], strict=True))


@dataclass
class Model:
    weights: np.ndarray  # ratio times fitted weight of each place
    ratios: np.ndarray
    constant: float
    slope: float
    offset: float

    def margins(self, found: list[np.ndarray]) -> np.ndarray:
        """Margins of rows scaled to unit length, as in the fit."""
        out = np.empty(len(found))
        for i, at in enumerate(found):
            length = np.sqrt(1 + (self.ratios[at].astype(np.float64) ** 2).sum())
            out[i] = (self.weights[at].astype(np.float64).sum() + self.constant) / length
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        parts = [self.margins(features(texts[a:b])) for a, b in _stretches(texts)]
        margin = np.concatenate([np.empty(0), *parts])
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500)))


class _Rows:
    """Rows of places with the constant's place at the end, made when asked for; ``values`` beside them."""

    def __init__(self, found: list[np.ndarray], chosen: np.ndarray, scales: np.ndarray, values: bool = False):
        self.found, self.chosen, self.scales, self.as_values = found, chosen, scales, values
        self.values = self if values else _Rows(found, chosen, scales, True)

    def __len__(self) -> int:
        return len(self.chosen)

    def __getitem__(self, i: int) -> np.ndarray:
        at = np.append(self.found[self.chosen[i]], len(self.scales) - 1)
        if not self.as_values:
            return at
        x = self.scales[at].astype(np.float64)
        return x / np.sqrt(x @ x)


def descend(rows: Sequence[np.ndarray], values: Sequence[np.ndarray], y: np.ndarray, size: int, cost: float, epochs: int) -> np.ndarray:
    """Weights of the hinge-loss machine, by coordinate descent in the dual; rows have unit length."""
    weights, alpha = np.zeros(size), np.zeros(len(rows))
    draw = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in draw.permutation(len(rows)):
            at, x = rows[i], values[i]
            gradient = y[i] * (weights[at] @ x) - 1
            new = min(max(alpha[i] - gradient, 0.0), cost)
            step = new - alpha[i]
            if step:
                weights[at] += step * y[i] * x
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton steps on smoothed targets."""
    ones, zeros = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p) - 1e-3 * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(found: list[np.ndarray], y: np.ndarray, *, cost: float = 1.0, epochs: int = 20) -> Model:
    """A model of rows of places and their classes (1 or 0)."""
    size = 1 << BITS
    if len(np.unique(y)) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return Model(np.zeros(size, np.float32), np.zeros(size, np.float32), 0.0, 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    held = np.arange(len(y)) % 5 == 0
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        held[:] = False
    train = np.flatnonzero(~held)
    counts = [np.ones(size), np.ones(size)]
    for i in train:
        counts[int(y[i])][found[i]] += 1
    ratios = (np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())).astype(np.float32)
    signs = np.where(y > 0, 1.0, -1.0)
    rows = _Rows(found, train, np.append(ratios, np.float32(1)))
    weights = descend(rows, rows.values, signs[train], size + 1, cost, epochs)
    model = Model((weights[:size] * ratios).astype(np.float32), ratios, float(weights[size]), 1.0, 0.0)
    check = np.flatnonzero(held) if held.any() else train
    model.slope, model.offset = _calibrate(model.margins([found[i] for i in check]), signs[check])
    return model


def fold_of(id_col: Column) -> Column:
    """0 to 4 by the CRC-32 of the id as text; fold 0 is held out."""
    return F.crc32(id_col.cast("string")) % 5


def train(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", max_rows: int = 10_000, id_col: str = "doc_id", text_col: str = "text", **options) -> Model:
    """A model of the labelled rows outside fold 0."""
    known = labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1) & (fold_of(F.col("id")) != 0))
    sample = known.orderBy(F.xxhash64("id"), "id", "y").limit(max_rows)
    # At most max_rows rows of two numbers.
    rows = docs.select(col(id_col).alias("id"), col(text_col).alias("text")).join(F.broadcast(sample), "id").select("id", "y", "text")

    def run(batches):
        for batch in batches:
            found = [f for (texts,) in stretches(_BATCH_BYTES, batch.column(2)) for f in features(texts)]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *found])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["id", "y", "places"])

    id_type = rows.schema["id"].dataType.simpleString()
    got = rows.mapInArrow(run, f"id {id_type}, y int, places array<int>").toArrow()
    order = pc.sort_indices(got, [("id", "ascending"), ("y", "ascending")]).to_numpy()
    y = got["y"].to_numpy().astype(np.int64)[order]
    places = got["places"].combine_chunks()
    del got
    flat, offsets = places.values.to_numpy(), places.offsets.to_numpy()
    found = [flat[offsets[i] : offsets[i + 1]] for i in order]
    model = fit(found, y, **options)
    del found, flat, places
    pa.default_memory_pool().release_unused()
    return model


def score(docs: DataFrame, model: Model, *, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with held_out, score and predicted (1 if the score is at least ``threshold``)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB, whatever the corpus

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        parts = [sent.value.scores(some) for (some,) in stretches(_BATCH_BYTES, texts)]
        return pa.array(np.concatenate([np.empty(0), *parts]))

    done = docs.withColumns({"held_out": F.coalesce(fold_of(col(id_col)) == 0, F.lit(False)), "score": scores(col(text_col))})
    return done.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, **options) -> DataFrame:
    return score(docs, train(docs, labels, **options), threshold=threshold)
