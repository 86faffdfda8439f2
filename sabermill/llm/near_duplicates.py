"""Near-duplicate documents by order min-hash sketches and banded alignment.

A document is the sequence of its shingles of ``shingle`` words (one of all its words if it has fewer).
Two documents are linked if an alignment that keeps the order of both matches m of their a and b
shingles with m / (a + b - m) >= ``similarity``: the Jaccard measure of shingles, with repeats
counted and order kept. Classes are the connected components of links.

1. **Sketch.** For each of ``bands`` hash functions the ``sampled`` smallest occurrence-labelled shingles
   (the second "x" differs from the first) are put in their order in the text; their joint hash is the
   band's key. Equal keys need equal minima in equal order, so keys agree the more often the closer
   the edit similarity: with 24 bands of 4, a pair of long texts at similarity 0.8 shares no band with
   probability 0.000003; with few shingles it is more, 0.00002 for 12 against 15. So short texts
   have exact keys beside the bands: their shingle sequences with none, one or two left out. Of a
   pair whose shorter text has at most 11 shingles, similarity 0.8 leaves no more than two unmatched
   in both together, so such a pair always shares a key and is never missed.
2. **Exact copies** are grouped by a 128-bit fingerprint of the text; one of each stands for all.
3. **Stars.** Documents of a bucket are compared with one of them, chosen by hash, in two rounds of
   different choice; the second skips what the first connected. That is linear in the bucket, however
   many near copies it holds.
4. **The rest.** What then lies in one bucket but in different components is compared pair by pair
   inside tasks, in blocks of ``block`` documents, by an upper bound of their matches: a document's
   labelled shingles set bits of a signature, and every bit that the other one lacks stands for
   a shingle that can't match. Only pairs that the bound lets pass leave the task, so no candidate
   is left out and a large bucket of unlike documents gives no rows.
5. **Alignment.** Equal ends are matched first; the middle is aligned by a bit-parallel longest common
   subsequence inside the band of diagonals that the threshold allows.

Sketches, candidates, links and labels are tables in the shared folder.

Defined cases: a document without words (null, empty, white space) is a class of its own. A null id
has a null class and stays. Every row gets the class of its text; repeated rows share it and are all
kept or all not; rows that share an id but not a text are compared under that id. Other columns are
not read. An empty table gives no rows. A very long text is sketched and aligned whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sabermill.llm.graph import components
from sabermill.llm.tables import col, stretches, written
from sabermill.llm.word_windows import Words, mixed

_BATCH_BYTES = 1 << 20
_CELLS = 1 << 20
_BITS = 2048
_SHORT = 11
_LEFT_OUT = 2


def shingles_of(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Hashes of each text's shingles in order; none for a text without words."""
    words = Words(texts, seeds=1)
    runs = {n: words.windows(n) for n in range(1, size + 1) if n == size or (words.counts == n).any()}
    out = []
    for first, n in zip(words.first.tolist(), words.counts.tolist(), strict=False):
        own = min(n, size)
        out.append(runs[own][first : first + n - own + 1] if n else np.empty(0, np.uint64))
    return out


def labelled(shingles: np.ndarray) -> np.ndarray:
    """Shingles with the number of equal ones before them mixed in."""
    order = np.argsort(shingles, kind="stable")
    ordered = shingles[order]
    begins = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    nth = np.empty(len(shingles), np.uint64)
    nth[order] = np.arange(len(shingles)) - np.repeat(begins, np.diff(np.append(begins, len(shingles))))
    return mixed(shingles + nth * np.uint64(0x9E3779B97F4A7C15))


def _seeds(bands: int) -> np.ndarray:
    return mixed(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def sketch(shingles: np.ndarray, bands: int, sampled: int) -> np.ndarray:
    """One key for each band."""
    ids, seeds = labelled(shingles), _seeds(bands)
    keys = np.empty(bands, np.uint64)
    at_once = max(1, _CELLS // len(ids))
    for a in range(0, bands, at_once):
        some = seeds[a : a + at_once, None]
        if len(ids) > sampled:
            least = np.argpartition((ids ^ some) * some, sampled - 1, axis=1)[:, :sampled]
            least.sort(axis=1)
            taken = ids[least]
        else:
            taken = np.broadcast_to(ids, (len(some), len(ids)))
        key = np.zeros(len(some), np.uint64)
        for i in range(taken.shape[1]):
            key = mixed(key * np.uint64(0xD6E8FEB86659FD93) + taken[:, i])
        keys[a : a + at_once] = key
    return keys


@lru_cache(maxsize=256)
def _left(n: int, similarity: float) -> list[np.ndarray]:
    """Places that stay, by rows, if a short text of ``n`` shingles leaves some out for a pair's sake."""
    def unmatched(m: int) -> int:
        return int(m * (1 - similarity) / similarity + 1e-9)

    short = max((m for m in range(_SHORT + 1) if unmatched(m) <= _LEFT_OUT), default=0)
    out = []
    for missing in range(min(n, _LEFT_OUT + 1)):
        # What stays is what both match, so it is no longer than the shorter text.
        if n - missing <= short and unmatched(n - missing) >= max(missing, 1):
            out.append(np.array(list(combinations(range(n), n - missing))))
    return out


def short_keys(shingles: np.ndarray, similarity: float) -> np.ndarray:
    """Keys of a short text, of which it shares one with every similar text if either has at most 11 shingles."""
    found = [np.empty(0, np.uint64)]
    if len(shingles) * similarity <= _SHORT + 1e-9:
        for places in _left(len(shingles), similarity):
            key = np.zeros(len(places), np.uint64)
            for i in range(places.shape[1]):
                key = mixed(key * np.uint64(0xD6E8FEB86659FD93) + shingles[places[:, i]])
            found.append(key)
    return np.unique(np.concatenate(found))


def signature(shingles: np.ndarray) -> bytes:
    """The bits that the labelled shingles set."""
    bits = np.zeros(_BITS, bool)
    bits[labelled(shingles) & np.uint64(_BITS - 1)] = True
    return np.packbits(bits).tobytes()


def may_be_similar(n_a: np.ndarray, bits_a: np.ndarray, n_b: np.ndarray, bits_b: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs of rows (of 64-bit words of signatures) could reach the similarity."""
    own_a, own_b = np.bitwise_count(bits_a).sum(axis=1, dtype=np.int64), np.bitwise_count(bits_b).sum(axis=1, dtype=np.int64)
    out = np.empty((len(n_a), len(n_b)), bool)
    for i in range(0, len(n_a), 32):
        both = np.bitwise_count(bits_a[i : i + 32, None] & bits_b[None]).sum(axis=2, dtype=np.int64)
        most = np.minimum((n_a - own_a)[i : i + 32, None], (n_b - own_b)[None]) + both
        out[i : i + 32] = most * (1 + similarity) >= similarity * (n_a[i : i + 32, None] + n_b[None]) - 1e-6
    return out


def matched(a: np.ndarray, b: np.ndarray, need: int) -> int:
    """Matches in the best alignment of two sequences; below ``need`` only a bound below it."""
    short = min(len(a), len(b))
    differs = np.flatnonzero(a[:short] != b[:short])
    head = int(differs[0]) if len(differs) else short
    differs = np.flatnonzero(a[len(a) - short + head :][::-1] != b[len(b) - short + head :][::-1])
    tail = int(differs[0]) if len(differs) else short - head
    fixed = head + tail
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if fixed + min(len(a), len(b)) < need or not len(a) or not len(b):
        return fixed
    places: dict[int, int] = {}
    for j, x in enumerate(b.tolist()):
        places[x] = places.get(x, 0) | 1 << j
    rows = [(i, places[x]) for i, x in enumerate(a.tolist()) if x in places]
    if fixed + len(rows) < need:
        return fixed
    # Bit j of ``free`` is off where b's item j ends a longer common subsequence. A diagonal
    # further out than the unmatched items that ``need`` leaves can't be on a good alignment.
    out = len(a) + len(b) - 2 * (need - fixed)
    band, all_bits = (1 << (2 * out + 1)) - 1, (1 << len(b)) - 1
    free = all_bits
    for i, bits in rows:
        bits &= band << (i - out) if i >= out else band >> (out - i)
        hit = free & bits
        free = ((free + hit) | (free - hit)) & all_bits
    return fixed + len(b) - free.bit_count()


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    need = int(np.ceil(similarity * (len(a) + len(b)) / (1 + similarity) - 1e-9))
    return min(len(a), len(b)) >= need and matched(a, b, need) >= need


def _sketches(docs: DataFrame, shingle: int, similarity: float, bands: int, sampled: int, id_col: str, text_col: str) -> DataFrame:
    text = col(text_col)
    rows = docs.select(col(id_col).cast("long").alias("id"), F.unhex(F.md5(text)).alias("copy"), text.alias("text"))
    schema = "id long, copy binary, n long, keys array<long>, bits binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, bits = [], [], []
            for (texts,) in stretches(_BATCH_BYTES, batch.column(2)):
                for own in shingles_of(texts, shingle):
                    counts.append(len(own))
                    keys.append(np.concatenate([sketch(own, bands, sampled), short_keys(own, similarity)]) if len(own) else None)
                    bits.append(signature(own) if len(own) else None)
            none = pa.array([k is None for k in keys])
            flat = np.concatenate([np.empty(0, np.uint64), *[k for k in keys if k is not None]]).view(np.int64)
            offsets = np.concatenate([[0], np.cumsum([0 if k is None else len(k) for k in keys])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            copy = pc.if_else(none, pa.scalar(None, pa.binary()), batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), copy, pa.array(counts, pa.int64()), lists, pa.array(bits, pa.binary())], ["id", "copy", "n", "keys", "bits"])

    return rows.mapInArrow(run, schema)


def _linked(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts align well enough."""
    both = pairs.select("a", "b").join(texts.toDF("a", "left"), "a").join(texts.toDF("b", "right"), "b").select("a", "b", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in stretches(_BATCH_BYTES, batch.column(2), batch.column(3)):
                distinct = list(dict.fromkeys([*left, *right]))
                cut = dict(zip(distinct, shingles_of(distinct, shingle), strict=True))
                good += [similar(cut[a], cut[b], similarity) for a, b in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _possible(placed: DataFrame, block: int, similarity: float) -> DataFrame:
    """Pairs (a, b) of a bucket's documents of different components that the bound lets pass.

    A bucket of more than ``block`` documents is cut into parts by hash; each pair of parts is one row.
    """
    bucket = ["band", "key"]
    parts = placed.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    own = placed.join(parts, bucket).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    meets = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    meets = meets.groupBy(*bucket, F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"))
    grouped = meets.agg(F.collect_list(F.struct("part", "node", "component", "n", "bits", "keys")).alias("rows")).select("band", "lo", "hi", "rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[np.ndarray] = [np.empty((0, 2), np.int64)]
            for band, lo, hi, rows in zip(*[batch.column(i).to_pylist() for i in range(3)], batch.column(3), strict=True):
                fields = rows.values.flatten()
                part, node, component, n = (f.to_numpy(zero_copy_only=False) for f in fields[:4])
                bits = np.frombuffer(b"".join(fields[4].to_pylist()), np.uint64).reshape(len(node), -1)
                x, y = np.flatnonzero(part == lo), np.flatnonzero(part == hi)
                good = may_be_similar(n[x], bits[x], n[y], bits[y], similarity)
                good &= (component[x][:, None] < component[y][None]) if lo == hi else (component[x][:, None] != component[y][None])
                i, j = np.nonzero(good)
                # A pair that shares several bands is found in the first of them, else by its exact keys.
                keys = fields[5].flatten().to_numpy().reshape(len(node), -1)
                equal = keys[x[i]] == keys[y[j]]
                first = np.where(equal.any(axis=1), equal.argmax(axis=1), keys.shape[1]) == band
                i, j = i[first], j[first]
                found.append(np.sort(np.stack([node[x[i]], node[y[j]]], axis=1), axis=1))
            both = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    return grouped.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    *,
    shingle: int = 5,
    similarity: float = 0.8,
    bands: int = 24,
    sampled: int = 4,
    block: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, class_id (smallest id of the class), kept (it is that one), n_shingles and text_md5, for every row.

    Rows that share an id are told apart by text_md5, which is null for a text without words.
    """
    spark = docs.sparkSession
    rows = written(_sketches(docs, shingle, similarity, bands, sampled, id_col, text_col), "sketches")
    distinct = rows.where("id is not null and copy is not null").groupBy("copy").agg(F.min("id").alias("node"), F.min_by("keys", "id").alias("keys"), F.min_by("bits", "id").alias("bits"), F.min("n").alias("n"))
    # The exact keys of short texts, after those of the bands, are one band: they have no order.
    spread = distinct.select("node", "n", F.posexplode("keys").alias("band", "key")).withColumn("band", F.least("band", F.lit(bands)))
    one = F.struct("node", "n")
    chosen = F.min_by(one, F.xxhash64("node", "band")).alias("first"), F.max_by(one, F.xxhash64("node", "band")).alias("second")
    shared = spread.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"), *chosen).where("size > 1")
    members = written(spread.join(shared.drop("size"), ["band", "key"]), "members")
    close = F.least("n", "n_other") >= similarity * F.greatest("n", "n_other") - 1e-9
    ends = F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")

    asked = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text")).where("text is not null")
    texts = asked.join(members.select(F.col("node").alias("id")).distinct(), "id", "left_semi")
    texts = written(texts.dropDuplicates(), "candidate-texts")

    def star(center: str, among: DataFrame) -> DataFrame:
        pairs = among.withColumn("other", F.col(center).node).withColumn("n_other", F.col(center).n)
        return pairs.where((F.col("node") != F.col("other")) & close).select(*ends).distinct()

    links = tried = labels = None
    for center in ("first", "second", None):
        if labels is None:
            pairs = star(center, members)
        else:
            label = labels.toDF("node", "component")
            placed = members.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
            split = placed.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("band", "key")
            placed = placed.join(split, ["band", "key"])
            if center:
                there = label.toDF("at", "there")
                apart = placed.join(there, F.col(center).node == F.col("at"), "left").where(F.col("component") != F.coalesce("there", F.col(center).node))
                pairs = star(center, apart)
            else:
                pairs = _possible(placed.join(distinct.select("node", "bits", F.slice("keys", 1, bands).alias("keys")), "node"), block, similarity)
            if tried is not None:
                pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if pairs.isEmpty():
            if labels is None:  # members other than the first centres may still be copies
                labels = spark.createDataFrame([], "node long, component long")
            continue
        found = written(_linked(pairs, texts, shingle, similarity), "links")
        tried = pairs if tried is None else tried.union(pairs)
        links = found if links is None else links.union(found)
        labels = components(links)

    named = distinct.select("copy", "node").join(labels, "node", "left").select("copy", F.coalesce("component", "node").alias("class_id"))
    out = rows.join(named, "copy", "left").select(F.col("id").alias("doc_id"), F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id")).alias("class_id"), F.col("n").alias("n_shingles"), F.lower(F.hex("copy")).alias("text_md5"))
    return out.select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"), "n_shingles", "text_md5")
