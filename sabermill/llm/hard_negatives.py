"""Hard negatives: exact integer scores of anchors against all rows, in tiles, by Strassen's products.

Every component becomes floor(scale * component), as a whole number; a score is the inner product of two
rows, higher ones first, ties by the smaller id. An anchor's positives are its first ``k`` other rows of the same
label. Its negatives for a positive are the first ``k`` rows of other labels with
low * positive score <= high * score <= high * positive score (``low`` and ``high`` in whole numbers).

1. Anchors are dealt into groups of ``anchor_bytes`` at most, all rows into parts, so that a (group, part) is
   about ``task_work`` multiplications; every pair of them is one task with a partition of its own. No key,
   label or repeated vector decides where a row goes, so none can be hot.
2. A task holds its anchors and streams the rows of its part past them: tiles of ``TILE_ANCHORS`` x
   ``TILE_ROWS`` are multiplied by Strassen's recursion in int64, and each anchor keeps a heap of its
   first ``k`` rows so far, which gives the bound the next tile's rows must reach.
3. Heaps of an anchor from all parts are merged (``k`` entries from each, limited again before the shuffle).
4. A second pass does the same for windows: ``k`` entries for every anchor and positive.

The work is anchors times rows, as an exact search asks for; what moves is each row once for each group of
anchors, in the narrowest whole number type, and heaps. Scores are never collected or written.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part. Vectors
of different lengths don't meet; of length 0 all scores are 0. Repeated rows, and rows that share an id, are rows of
their own: one may be another's positive, and a repeated anchor gives its rows again. A null id is no
anchor; as a partner it comes last among ties. A negative positive score has an empty window. Scores
are kept below 2^62 / 100: components too large for that raise an error, as an overflow does in ANSI SQL. Extra
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sabermill.llm.strassen import product
from sabermill.llm.tables import col, written

TILE_ANCHORS, TILE_ROWS = 512, 4096
_TYPES = {2: "<i2", 4: "<i4", 8: "<i8"}
_LAST = np.iinfo(np.int64).max
_LEAST = np.iinfo(np.int64).min


def _whole(vectors: pa.ListArray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * component) of all vectors one after another, and their lengths."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    x = np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * scale)
    if len(x) and np.abs(x).max() >= 2.0**62:
        raise OverflowError("a scaled component does not fit 64 bits")
    return x.astype(np.int64), lengths


def _packed(rows: DataFrame, scale: float) -> DataFrame:
    """Rows with their vector as bytes of whole numbers of ``width`` bytes each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, lengths = _whole(batch["vector"], scale)
            most = int(np.abs(x).max(initial=0))
            width = next(w for w in (2, 4, 8) if most < 1 << (8 * w - 1))
            ends = np.concatenate([[0], np.cumsum(lengths)]) * width
            data = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(x.astype(_TYPES[width]))])
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["label"], batch["anchor"], pa.array(lengths.astype(np.int32)), pa.array(np.full(len(lengths), width, np.int32)), data.cast(pa.binary())],
                ["id", "label", "anchor", "size", "width", "vector"],
            )

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(pack, f"id long, label {label}, anchor boolean, size int, width int, vector binary")


def _matrix(batch: pa.RecordBatch, size: int, width: int) -> np.ndarray:
    data = b"".join(batch["vector"].to_pylist())
    return np.frombuffer(data, _TYPES[width]).reshape(batch.num_rows, size).astype(np.int64)


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids = batch["id"]
    return ids.fill_null(_LAST).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)


class _Heap:
    """The first ``k`` (score, id, no) of each of ``n`` owners."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.owner = self.score = self.id = self.no = np.empty(0, np.int64)
        self.nameless = np.empty(0, bool)
        self.bound = np.full(n, _LEAST)  # a new entry's score must reach it

    def push(self, owner: np.ndarray, score: np.ndarray, ident: np.ndarray, nameless: np.ndarray, no: np.ndarray) -> None:
        if not len(owner):
            return
        parts = [(self.owner, owner), (self.score, score), (self.id, ident), (self.nameless, nameless), (self.no, no)]
        owner, score, ident, nameless, no = (np.concatenate(p) for p in parts)
        order = np.lexsort((no, ident, nameless, -score, owner))
        owner = owner[order]
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        place = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
        order, owner, place = (x[place < self.k] for x in (order, owner, place))
        self.owner, self.score, self.id, self.nameless, self.no = owner, score[order], ident[order], nameless[order], no[order]
        full = place == self.k - 1
        self.bound[owner[full]] = self.score[full]


class _Anchors:
    """Anchors of one length in a task, with heaps for their positives or their windows."""

    def __init__(self, batches: list[pa.RecordBatch], size: int, k: int, low: int, high: int, windows: bool):
        self.k, self.windows = k, windows
        self.limit = (1 << 62) // max(low, high)  # for scores, so that bounds of windows fit as well
        self.x = np.concatenate([_matrix(b, size, b["width"][0].as_py()) for b in batches])
        self.most = int(np.abs(self.x).max(initial=0))
        table = pa.Table.from_batches(batches)
        self.no, self.id = table["no"].to_numpy(), table["id"].to_numpy()
        coded = pc.dictionary_encode(table["label"].combine_chunks())
        self.labels, self.label = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        self.spans = [(a, min(a + TILE_ANCHORS, len(self.x))) for a in range(0, len(self.x), TILE_ANCHORS)]
        if windows:
            found = table["found"].to_pylist()
            self.positive = np.full((len(found), k), _LEAST)
            for i, each in enumerate(found):
                self.positive[i, : len(each)] = [p["score"] for p in each]
            # The smallest score of a window; one above the largest where there is no positive.
            self.floor = np.where(self.positive == _LEAST, _LAST, -((-low * np.maximum(self.positive, -self.limit)) // high))
            self.found = found
        self.heaps = [_Heap((b - a) * (k if windows else 1), k) for a, b in self.spans]

    def meet(self, batch: pa.RecordBatch, size: int, width: int) -> None:
        x = _matrix(batch, size, width)
        if size * self.most * int(np.abs(x).max(initial=0)) >= self.limit:
            raise OverflowError("a score does not fit 64 bits")
        ident, nameless = _ids(batch)
        no = batch["no"].to_numpy()
        label = pc.index_in(batch["label"], value_set=self.labels).fill_null(-1).to_numpy(zero_copy_only=False)
        for (a, b), heap in zip(self.spans, self.heaps, strict=True):
            score = product(self.x[a:b], np.ascontiguousarray(x.T))
            same = self.label[a:b, None] == label[None, :]
            if not self.windows:
                same &= (score >= heap.bound[:, None]) & (self.no[a:b, None] != no[None, :])
                i, j = np.nonzero(same)
                heap.push(i, score[i, j], ident[j], nameless[j], no[j])
                continue
            floor, top = self.floor[a:b], self.positive[a:b]
            lowest = np.maximum(floor, heap.bound.reshape(floor.shape))
            i, j = np.nonzero(~same & (score >= lowest.min(axis=1)[:, None]) & (score <= top.max(axis=1)[:, None]))
            s = score[i, j]
            hits = [np.flatnonzero((s >= lowest[i, p]) & (s <= top[i, p])) for p in range(self.k)]
            owner = np.concatenate([i[h] * self.k + p for p, h in enumerate(hits)])
            h = np.concatenate(hits)
            heap.push(owner, s[h], ident[j[h]], nameless[j[h]], no[j[h]])

    def result(self) -> Iterator[pa.RecordBatch]:
        for (a, _), heap in zip(self.spans, self.heaps, strict=True):
            own = a + heap.owner // (self.k if self.windows else 1)
            columns = {
                "anchor_no": pa.array(self.no[own]), "anchor_id": pa.array(self.id[own]), "no": pa.array(heap.no),
                "id": pa.array(heap.id, mask=heap.nameless), "score": pa.array(heap.score),
            }
            if self.windows:
                which = [self.found[i][p] for i, p in zip(own.tolist(), (heap.owner % self.k).tolist(), strict=True)]
                for name in ("no", "id", "score"):
                    columns[f"positive_{name}"] = pa.array([w[name] for w in which], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Rows of one length and width at a time, as many as a tile takes."""
    kind = batch["size"].to_numpy().astype(np.int64) << 4 | batch["width"].to_numpy()
    for each in np.unique(kind).tolist():
        part = batch if (kind == each).all() else batch.filter(pa.array(kind == each))
        for a in range(0, part.num_rows, TILE_ROWS):
            yield each >> 4, each & 15, part.slice(a, TILE_ROWS)


def _searched(tasks: DataFrame, k: int, low: int, high: int, windows: bool) -> DataFrame:
    """Heaps of the anchors of each task, over the rows of the task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, waiting, ready = None, {}, None
        for whole in batches:
            key = whole["task"].to_numpy().astype(np.int64) * 2 + whole["kind"].to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]]).tolist()
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                if begin == end:
                    continue
                own, kind = divmod(int(key[begin]), 2)
                if own != task:
                    for anchors in (ready or {}).values():
                        yield from anchors.result()
                    task, waiting, ready = own, {}, None
                part = whole.slice(begin, end - begin)
                for size, width, some in _by_length(part):
                    if kind == 0:
                        waiting.setdefault(size, []).append(some)
                        continue
                    if ready is None:
                        ready = {n: _Anchors(found, n, k, low, high, windows) for n, found in waiting.items()}
                    if size in ready:
                        ready[size].meet(some, size, width)
        for anchors in (ready or {}).values():
            yield from anchors.result()

    schema = "anchor_no long, anchor_id long, no long, id long, score long"
    return tasks.mapInArrow(search, schema + (", positive_no long, positive_id long, positive_score long" if windows else ""))


def _first(heaps: DataFrame, k: int, *owner: str) -> DataFrame:
    """The first ``k`` entries of each owner, numbered from 1."""
    order = Window.partitionBy(*owner).orderBy(F.desc("score"), F.asc_nulls_last("id"), "no")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, *, scale: float = 256, k: int = 5, low: int = 80, high: int = 100,
    anchor_bytes: int = 1 << 26, task_work: int = 1 << 36,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of every negative found.

    ``is_anchor`` is a condition on the columns of ``vectors``.
    """
    spark = vectors.sparkSession
    given = vectors.select(
        col(id_col).cast("long").alias("id"), col(label_col).alias("label"), col(vector_col).cast("array<double>").alias("vector"),
        (F.coalesce(is_anchor, F.lit(False)) & col(id_col).isNotNull()).alias("anchor"),
    )
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    given = given.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = written(_packed(given, scale).withColumn("no", F.monotonically_increasing_id()), "scaled")
    sizes = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("anchor").alias("anchors"), F.max("size").alias("size")).first()

    size = max(1, sizes["size"] or 1)
    groups = max(1, math.ceil(sizes["anchors"] * size * 8 / anchor_bytes))
    work = math.ceil(sizes["rows"] * math.ceil(sizes["anchors"] / groups) * size / task_work)
    wanted = math.ceil(2 * spark.sparkContext.defaultParallelism / groups)
    parts = max(1, work, min(wanted, math.ceil(sizes["rows"] / TILE_ANCHORS)))

    def dealt(found: DataFrame | None) -> DataFrame:
        """All tasks: the anchors of the group, then the rows of the part."""
        group = F.pmod(F.xxhash64("no"), F.lit(groups)).cast("int")
        part = F.pmod(F.xxhash64(F.lit(1), "no"), F.lit(parts)).cast("int")
        own = "no", "id", "label", "size", "width", "vector"
        entry = "array<struct<score: bigint, id: bigint, no: bigint>>"
        anchors = rows.where("anchor").select(*own)
        anchors = anchors.withColumn("found", F.lit(None).cast(entry)) if found is None else anchors.join(found, "no")
        anchors = anchors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        anchors = anchors.select((group * parts + F.col("part")).alias("task"), F.lit(0).alias("kind"), *own, "found")
        others = rows.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        others = others.select((F.col("group") * parts + part).alias("task"), F.lit(1).alias("kind"), *own, F.lit(None).cast(entry).alias("found"))
        return anchors.union(others).repartitionById(groups * parts, "task").sortWithinPartitions("task", "kind")

    positives = _first(_searched(dealt(None), k, low, high, False), k, "anchor_no")
    positives = positives.groupBy(F.col("anchor_no").alias("no")).agg(F.collect_list(F.struct("score", "id", "no")).alias("found"))
    positives = written(positives, "positives")
    windows = _first(_searched(dealt(positives), k, low, high, True), k, "anchor_no", "positive_no")
    return windows.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
