"""Substring deduplication: remove words covered by a window that also starts earlier.

A window is ``window`` consecutive words of one document. Documents are dealt into blocks by ranges of
the id, so that the order of (block, position) is the order of (id, position).

1. **Sketch.** Every block counts its windows in a count-min sketch of ``depth`` rows, whose width
   grows with the corpus (``cells_per_byte`` cells for each byte of text). A block touches few of the
   cells, so only those are sent, as compressed gaps, cut into slices of the cell range.
2. **Merge.** A slice's reducer adds the blocks' counts up (counts above 2 don't matter) and sends each
   block those of its own cells that reached 2. No sketch is ever whole in one place.
3. **Exact pass.** A block reads its windows again. One whose cell is below 2 in any row occurs
   once, as estimates are never too low. The others go, by 128-bit hash, to the exact grouping, only the
   first of equal ones in a block; the grouping tells a block which of its windows start
   earlier elsewhere.
4. **Removal.** Each block covers the words of such windows and keeps the rest.

The documents are shuffled once, by block; all three reads share that exchange. Rows of a hot passage
are combined inside each block before the shuffle, so a reducer gets at most one row for each block
and window. Two windows are taken as equal if their 128-bit hashes are.

A task holds one block's texts as Arrow data, and as Python texts and words only a stretch of ``_BATCH_BYTES``, so a
block costs a Python worker a few times its bytes.

Defined cases: null and empty texts have no words and stay as they are. Documents with a null id come
first. Rows that share an id count as documents in the order of their texts, so of two identical rows the
second one is emptied (if it has a window at all). Extra columns are carried along; those named like a
result column are replaced. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sabermill.llm.tables import bundle, col, others, stretches, unbundle
from sabermill.llm.word_windows import Words

# Texts of so many bytes are held as Python texts and cut into words at once.
_BATCH_BYTES = 1 << 20
_ZSTD = pa.Codec("zstd", 1)


def _pack(values: np.ndarray) -> bytes:
    """Sorted whole numbers as compressed gaps."""
    gaps = np.diff(values, prepend=0).astype(np.uint32 if not len(values) or values[-1] < 1 << 32 else np.uint64)
    planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(len(gaps), gaps.itemsize).T)
    return bytes([gaps.itemsize]) + len(gaps).to_bytes(8, "little") + _ZSTD.compress(planes.tobytes(), asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(_ZSTD.decompress(data[9:], n * width, asbytes=True), np.uint8).reshape(width, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64))


def _runs(sorted_keys: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal keys, which are 0 or more."""
    begins = np.flatnonzero(np.diff(sorted_keys, prepend=-1)).tolist()
    return list(zip(begins, [*begins[1:], len(sorted_keys)][: len(begins)], strict=True))


def _texts(column: pa.Array | pa.ChunkedArray) -> Iterator[list[str | None]]:
    """Values of a column, in stretches of about ``_BATCH_BYTES``."""
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        for (some,) in stretches(_BATCH_BYTES, chunk):
            yield some


def _window_hashes(column: pa.Array | pa.ChunkedArray, window: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """By stretches: two hashes of each window of the texts, and its first word's place among all their words."""
    words_before = 0
    for some in _texts(column):
        words = Words(some)
        starts = words.window_starts(window)
        yield [words.windows(window, seed)[starts] for seed in (0, 1)], starts + words_before
        words_before += len(words.starts)


def _joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *parts])


def _is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the values are among the sorted ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _in_order(rows: pa.Table) -> pa.Table:
    """Documents of a block by id, nulls first, then by text."""
    rows = rows.sort_by([("id", "ascending"), ("text", "ascending")])
    empty = rows["id"].null_count
    return pa.concat_tables([rows.slice(len(rows) - empty), rows.slice(0, len(rows) - empty)]) if empty else rows


def remove_repeats(
    docs: DataFrame,
    *,
    window: int = 20,
    depth: int = 2,
    cells_per_byte: int = 1,
    slice_cells: int = 1 << 25,
    block_bytes: int = 16 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with n_words, n_removed and the text of the kept words (joined by one space where words
    were removed, else unchanged)."""
    if not 1 <= depth <= 2:
        raise ValueError("depth is 1 or 2: one row of cells for each of the two hashes")
    rows = docs.select(col(id_col).alias("id"), col(text_col).alias("text"), bundle(docs, id_col, text_col, "n_words", "n_removed").alias("rest"))
    total = docs.agg(F.sum(F.octet_length(col(text_col)).cast("long"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    inner = [i / n_blocks for i in range(1, n_blocks)]
    bounds = docs.agg(F.percentile_approx(col(id_col).cast("long"), inner, 100 * n_blocks)).first()[0] if inner else None
    bounds = np.unique(np.array(bounds or [], np.int64))
    cell_bits = max(16, int(cells_per_byte * total).bit_length())
    slice_bits = min(cell_bits, slice_cells.bit_length() - 1)
    n_buckets = max(1, n_blocks // 2)

    @F.arrow_udf(T.LongType())
    def block_of(ids: pa.Array) -> pa.Array:
        known = ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
        return pa.array(np.searchsorted(bounds, known, side="right"))

    dealt = rows.select(block_of(F.col("id").cast("long")).alias("block"), "*").repartition(n_blocks, "block")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            for block in np.unique(blocks):
                own = batch.column(2).filter(pa.array(blocks == block))
                parts: list[list[np.ndarray]] = [[] for _ in range(depth)]
                for hashes, _ in _window_hashes(own, window):
                    for row in range(depth):
                        parts[row].append((hashes[row] >> np.uint64(64 - cell_bits)).astype(np.int64))
                out = []
                for row in range(depth):
                    cells, parts[row] = _joined(parts[row], np.int64), []
                    cells.sort()
                    first = np.diff(cells, prepend=-1) != 0
                    twice = ~np.append(first[1:], True)[first] if len(first) else first
                    cells = cells[first]
                    for a, b in _runs(cells >> slice_bits):
                        number = cells[a] >> slice_bits
                        out.append((row, int(number), int(block), _pack(cells[a:b] - (number << slice_bits)), np.packbits(twice[a:b]).tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["row", "slice", "block", "cells", "twice"])

    def merge(key: tuple, parts: pa.Table) -> pa.Table:
        # One block's cells at a time, so they are unpacked twice.
        counts = np.zeros(1 << slice_bits, np.uint8)
        for packed, twice in zip(parts["cells"], parts["twice"], strict=True):
            own = _unpack(packed.as_py())
            more = np.unpackbits(np.frombuffer(twice.as_py(), np.uint8), count=len(own))
            counts[own] = np.minimum(counts[own] + 1 + more, 2)
        base = key[1].as_py() << slice_bits
        hot = []
        for packed in parts["cells"]:
            own = _unpack(packed.as_py())
            hot.append(_pack(own[counts[own] > 1] + base))
        return pa.table({"block": parts["block"], "row": parts["row"], "cells": pa.array(hot, pa.binary())})

    merged = dealt.mapInArrow(sketch, "row int, slice long, block long, cells binary, twice binary")
    merged = merged.groupBy("row", "slice").applyInArrow(merge, "block long, row int, cells binary")

    def repeated(key: tuple, texts: pa.Table, cells: pa.Table) -> pa.Table:
        block = key[0].as_py()
        rows, packed = cells["row"].to_numpy(), cells["cells"]
        hot = [np.unique(_joined([_unpack(packed[i].as_py()) for i in np.flatnonzero(rows == row).tolist()], np.int64)) for row in range(depth)]
        found: list[list[np.ndarray]] = [[], [], []]
        for hashes, at in _window_hashes(_in_order(texts.select(["id", "text"]))["text"], window):
            maybe = np.ones(len(at), bool)
            for row in range(depth):
                maybe &= _is_in((hashes[row] >> np.uint64(64 - cell_bits)).astype(np.int64), hot[row])
            for kept, own in zip(found, (*hashes, at), strict=True):
                kept.append(own[maybe])
        del hot
        a, b, places = (_joined(kept, kind) for kept, kind in zip(found, (np.uint64, np.uint64, np.int64), strict=True))
        del found
        order = np.lexsort((places, b, a))
        a, b, places = a[order], b[order], places[order]
        first = np.append(True, (np.diff(a) != 0) | (np.diff(b) != 0))[: len(a)]
        bucket = (a % np.uint64(n_buckets)).astype(np.int64)
        out = []
        for number in np.unique(bucket):
            own = np.flatnonzero(bucket == number)
            own = own[np.argsort(places[own])]
            sent, known = own[first[own]], own[~first[own]]
            out.append((int(number), block, a[sent].tobytes(), b[sent].tobytes(), _pack(places[sent]), _pack(places[known])))
        names = ["bucket", "block", "a", "b", "places", "known"]
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
        return pa.table([pa.array([o[i] for o in out], kinds[i]) for i in range(6)], names)

    schema = "bucket long, block long, a binary, b binary, places binary, known binary"
    maybe = dealt.groupBy("block").cogroup(merged.groupBy("block")).applyInArrow(repeated, schema)

    def group(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("block")
        a, b = (np.concatenate([np.frombuffer(x, np.uint64) for x in parts[n].to_pylist()]) for n in ("a", "b"))
        places = [_unpack(x) for x in parts["places"].to_pylist()]
        order = np.lexsort((np.arange(len(a)), b, a))  # rows stand in the order of blocks
        first = np.append(True, (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0))[: len(a)]
        later = np.empty(len(a), bool)
        later[order] = ~first
        cut = np.cumsum([len(p) for p in places])[:-1]
        removed = [_pack(np.sort(np.concatenate([p[x], _unpack(k)]))) for p, x, k in zip(places, np.split(later, cut), parts["known"].to_pylist(), strict=True)]
        return pa.table({"block": parts["block"], "places": pa.array(removed, pa.binary())})

    later = maybe.groupBy("bucket").applyInArrow(group, "block long, places binary")

    def remove(key: tuple, texts: pa.Table, places: pa.Table) -> pa.Table:
        texts = _in_order(texts)
        starts = np.sort(_joined([_unpack(part.as_py()) for part in places["places"]], np.int64))
        values, counts, removed, before = [], [], [], 0
        for some in _texts(texts["text"]):
            for i, text in enumerate(some):
                words = (text or "").encode().split()
                a, b = np.searchsorted(starts, (before, before + len(words))).tolist() if len(starts) else (0, 0)
                gone = 0
                if a < b:
                    cover = np.zeros(len(words) + 1, np.int32)
                    np.add.at(cover, starts[a:b] - before, 1)
                    np.add.at(cover, starts[a:b] - before + window, -1)
                    keep = np.cumsum(cover[:-1]) == 0
                    gone = len(words) - int(keep.sum())
                    some[i] = b" ".join(compress(words, keep.tolist())).decode()
                counts.append(len(words))
                removed.append(gone)
                before += len(words)
            values.append(pa.array(some, pa.string()))
        return pa.table([texts["id"], pa.chunked_array(values, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), texts["rest"]], ["id", "text", "n_words", "n_removed", "rest"])

    fields = [rows.schema["id"], rows.schema["text"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), rows.schema["rest"]]
    done = dealt.groupBy("block").cogroup(later.groupBy("block")).applyInArrow(remove, T.StructType(fields))
    carried = dict(zip(others(docs, id_col, text_col, "n_words", "n_removed"), unbundle(done, docs, id_col, text_col, "n_words", "n_removed"), strict=True))
    carried |= {id_col: F.col("id").alias(id_col), text_col: F.col("text").alias(text_col)}
    return done.select(*[carried[n] for n in docs.columns if n in carried], "n_words", "n_removed")
