"""Near-duplicate embeddings: exact threshold links by dual traversal of cover trees.

Two vectors are linked if they have the same label and length and a cosine, in double precision, of
at least ``threshold``. On unit vectors that is a Euclidean distance of at most sqrt(2 - 2 threshold).

1. Equal vectors of a label are one node with a count, so a vector that a third of all rows share is
   compared once.
2. Nodes are dealt into cells around pivots, a sample of one node in half a block and of about ``max_pivots``
   at most. Pivots decide
   which blocks can be passed over, never the result. Cells are cut by hash into blocks of about
   ``block_rows`` nodes.
3. Pairs of blocks of a label whose pivots are further apart than both radii and the threshold are dropped;
   this joins one short row for each block. Every pair left is one task of bounded size: a cover
   tree for each block, and a dual traversal.
4. A task gives each node's number of linked vectors and a spanning forest of the links it found, never
   all pairs; counts are added up and the forests joined to components.

In many dimensions and without clusters few block pairs can be dropped: the exact answer then takes a
number of block pairs that is quadratic in a label's nodes.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite component, or has a
null label, links with nothing and is its own component. Repeated rows are vectors of their own and link
with each other; rows that share an id get the sums of their vectors' links. A null id takes part but
names no component unless it is alone. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sabermill.llm.cover_tree import CoverTree, close_pairs
from sabermill.llm.graph import components
from sabermill.llm.tables import col, written

_MAX = 1 << 62


class Forest:
    """Union-find over numbered nodes that keeps the links that joined something."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.links.append((x, y))


def _links_between(x: np.ndarray, y: np.ndarray | None, weight_x: np.ndarray, weight_y: np.ndarray, threshold: float):
    """Linked copies of each row of x and y (None: x with itself), and a spanning forest of (row, row)."""
    same = y is None
    y = x if same else y
    size_x, size_y = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    tree_x = CoverTree(x / size_x[:, None])
    tree_y = tree_x if same else CoverTree(y / size_y[:, None])
    count_x, count_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    forest = Forest(len(x) if same else len(x) + len(y))
    shift = 0 if same else len(x)

    def found(i: np.ndarray, j: np.ndarray) -> None:
        linked = (x[i] @ y[j].T) / (size_x[i][:, None] * size_y[j][None, :]) >= threshold
        own = same and len(i) == len(j) and i[0] == j[0]  # a leaf with itself
        if own:
            np.fill_diagonal(linked, False)
        count_x[i] += linked @ weight_y[j]
        if not own:
            count_y[j] += linked.T @ weight_x[i]
        a, b = np.nonzero(np.triu(linked) if own else linked)
        for p, q in zip(i[a].tolist(), (j[b] + shift).tolist(), strict=True):
            forest.join(p, q)

    close_pairs(tree_x, tree_y, float(np.sqrt(max(0.0, 2 - 2 * threshold))), found)
    if same:
        return count_x + count_y, None, forest.links
    return count_x, count_y, forest.links


def link_embeddings(vectors: DataFrame, *, threshold: float = 0.98, block_rows: int = 4096, max_pivots: int = 2000, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept (vec_id = component_id) of every row."""
    spark = vectors.sparkSession
    rows = vectors.select(col(id_col).cast("long").alias("id"), col(vector_col).cast("array<double>").alias("vector"), col(label_col).alias("label"))
    usable = F.col("label").isNotNull() & F.coalesce(F.size("vector") > 0, F.lit(False))
    usable &= F.coalesce(F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))), F.lit(False))
    usable &= F.coalesce(F.exists("vector", lambda v: v != 0), F.lit(False))
    rows = rows.withColumn("vector", F.when(usable, F.col("vector")))
    name = F.coalesce(F.min("id"), F.lit(_MAX))
    grouped = rows.where("vector is not null").groupBy("label", "vector").agg(name.alias("node"), F.count(F.lit(1)).alias("copies"))
    # A number for each node; the smallest id isn't one if ids repeat or are null.
    nodes = written(grouped.withColumn("no", F.monotonically_increasing_id()), "nodes")
    total = nodes.count()

    pivots: dict = {}
    if total:
        # About one pivot for half a block, so that cells are no smaller than blocks.
        every = max(1, block_rows // 2, total // max_pivots)
        picked = nodes.where(F.pmod(F.xxhash64("no"), F.lit(every)) == 0).select("label", "vector").limit(2 * max_pivots)
        for r in picked.collect():  # bounded by twice max_pivots
            pivots.setdefault((r["label"], len(r["vector"])), []).append(r["vector"])
    pivots = {k: np.array(v) / np.linalg.norm(np.array(v), axis=1)[:, None] for k, v in pivots.items()}
    label_type = nodes.schema["label"].dataType.simpleString()

    def place(batches):
        for batch in batches:
            labels, lists = batch.column(0).to_pylist(), batch.column(1)
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            sizes = np.diff(offsets)
            cell, away = np.zeros(len(labels), np.int32), np.full(len(labels), np.pi)
            keys = {}
            for i, (label, size) in enumerate(zip(labels, sizes.tolist(), strict=True)):
                keys.setdefault((label, size), []).append(i)
            for key, own in keys.items():
                if key in pivots:
                    own = np.array(own)
                    x = flat[offsets[own][:, None] + np.arange(key[1])]
                    x = x / np.linalg.norm(x, axis=1)[:, None]
                    d = np.sqrt(np.maximum(2 - 2 * (x @ pivots[key].T), 0))
                    cell[own], away[own] = d.argmin(axis=1), d.min(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), batch.column(0), lists, pa.array(sizes.astype(np.int32)), pa.array(cell), pa.array(away)], ["no", "copies", "label", "vector", "size", "cell", "away"])

    placed = nodes.select("label", "vector", "no", "copies").mapInArrow(place, f"no long, copies long, label {label_type}, vector array<double>, size int, cell int, away double")
    placed = written(placed, "placed")
    cell = ["label", "size", "cell"]
    parts = placed.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("no"), F.col("parts")).cast("int")
    dealt = placed.join(parts, cell).withColumn("part", part)

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        vector = table["vector"].combine_chunks().flatten().to_numpy()
        return pa.table({
            "label": table["label"].slice(0, 1), "size": table["size"].slice(0, 1), "cell": table["cell"].slice(0, 1), "part": table["part"].slice(0, 1),
            "radius": pa.array([float(table["away"].to_numpy().max())]),
            "nos": pa.array([table["no"].to_numpy().astype("<i8").tobytes()]), "weights": pa.array([table["copies"].to_numpy().astype("<i8").tobytes()]), "vectors": pa.array([vector.tobytes()]),
        })

    blocks = dealt.groupBy(*cell, "part").applyInArrow(pack, f"label {label_type}, size int, cell int, part int, radius double, nos binary, weights binary, vectors binary")
    blocks = written(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6

    def prune(batches):
        for batch in batches:
            keep = []
            for label, size, a, b, ra, rb in zip(*[c.to_pylist() for c in batch.columns[2:]], strict=True):
                own = pivots.get((label, size))
                keep.append(own is None or a == b or float(np.sqrt(max(0.0, 2 - 2 * own[a] @ own[b]))) <= ra + rb + reach)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    short = blocks.select("label", "size", "cell", "radius", "block")
    pairs = short.toDF("label", "size", "cell_a", "radius_a", "a").join(short.toDF("label", "size", "cell_b", "radius_b", "b"), ["label", "size"]).where("a <= b")
    pairs = pairs.select("a", "b", "label", "size", "cell_a", "cell_b", "radius_a", "radius_b").mapInArrow(prune, "a long, b long")
    data = blocks.select("block", "size", "nos", "weights", "vectors")
    work = pairs.join(data.toDF("a", "size", "nos_a", "weights_a", "vectors_a"), "a").join(data.drop("size").toDF("b", "nos_b", "weights_b", "vectors_b"), "b")
    work = work.select("a", "b", "size", "nos_a", "weights_a", "vectors_a", "nos_b", "weights_b", "vectors_b").repartition("a", "b")

    def compare(batches):
        for batch in batches:
            for r in batch.to_pylist():
                nos = [np.frombuffer(r[f"nos_{s}"], "<i8") for s in "ab"]
                weights = [np.frombuffer(r[f"weights_{s}"], "<i8") for s in "ab"]
                x, y = (np.frombuffer(r[f"vectors_{s}"], "<f8").reshape(-1, r["size"]) for s in "ab")
                same = r["a"] == r["b"]
                count_x, count_y, links = _links_between(x, None if same else y, *weights, threshold)
                all_nos = nos[0] if same else np.concatenate(nos)
                counts = count_x if same else np.concatenate([count_x, count_y])
                some = np.flatnonzero(counts)
                ends = all_nos[np.array(links, np.int64).reshape(-1, 2)]
                no = np.concatenate([all_nos[some], ends[:, 0]])
                other = pa.array(np.concatenate([np.zeros(len(some), np.int64), ends[:, 1]]), mask=np.arange(len(no)) < len(some))
                n = np.concatenate([counts[some], np.zeros(len(ends), np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(no), other, pa.array(n)], ["no", "other", "n"])

    found = written(work.mapInArrow(compare, "no long, other long, n long"), "found")
    counts = found.where("other is null").groupBy("no").agg(F.sum("n").alias("n"))
    labels = components(found.where("other is not null").select(F.col("no").alias("a"), F.col("other").alias("b")))
    named = nodes.select("label", "vector", "node", "copies", "no").join(counts, "no", "left").join(labels.toDF("no", "component"), "no", "left")
    named = named.withColumn("component", F.coalesce("component", "no"))
    smallest = named.groupBy("component").agg(F.min("node").alias("component_id"))
    named = named.join(smallest, "component").select("label", "vector", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.join(named, ["label", "vector"], "left")
    component = F.when(F.col("component_id") < _MAX, F.col("component_id"))
    out = out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce(component, "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
