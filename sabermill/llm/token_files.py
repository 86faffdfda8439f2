"""Token ids of documents as Huffman-coded files, and reading them back.

Writing takes four steps, each a distributed job:

1. every whole text is encoded once; its ids and the end id go to a written table;
2. ids are counted over the whole table, in each task and then globally; the counts (one for each id
   of the vocabulary) give a canonical code of at most ``longest`` bits, kept as a table beside the
   data;
3. tasks code their documents' ids: blocks of 4,096 ids start on a byte and are independent, with
   the bit offset of every 256th id as a checkpoint;
4. coded documents are dealt into parts by ranges of the id, ordered inside each part, numbered by
   the ids before them and written as ``part=N`` folders of Parquet rows (doc id, start, n_tokens,
   stream, checkpoints), in ascending id order.

A part holds about ``part_tokens`` ids, so its streams fit one task. Reading decodes each row
on its own, all checkpoints of a batch side by side.

Defined cases: a null or empty text has the end id only. Rows with a null id come first; rows
with the same id stay separate and are ordered by their streams. Only the id and the text are
stored; further columns of the documents are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sabermill.llm.byte_bpe import encoder, vocabulary_size
from sabermill.llm.huffman import CHECKPOINT, Codec, code_lengths
from sabermill.llm.tables import col, written


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _flat(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column as one array, and each row's number of values."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.empty(0, np.uint8)
    return data.view(dtype), np.diff(offsets) // np.dtype(dtype).itemsize


def _stretches(sizes: np.ndarray, bound: int) -> list[tuple[int, int]]:
    """Runs of consecutive rows of about ``bound`` values."""
    if len(sizes) == 0:
        return []
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // bound, prepend=-1))
    return list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(sizes)], strict=True))


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", special_tokens: bool = False) -> DataFrame:
    """doc id, n_tokens (end id included) and ids (little-endian unsigned, 2 or 4 bytes each)."""
    pairs = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    schema = T.StructType([pairs.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer, special_tokens)
        for batch in batches:
            for first, ids, counts in bpe.encode(batch.column(1).to_pylist()):
                ended = np.empty(len(ids) + len(counts), bpe.dtype)
                ends = np.cumsum(counts + 1) - 1
                own = np.ones(len(ended), bool)
                own[ends] = False
                ended[own] = ids
                ended[ends] = end_id
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(counts)), pa.array(counts + 1), _binary(ended, (counts + 1) * bpe.dtype.itemsize)],
                    ["doc_id", "n_tokens", "ids"],
                )

    return pairs.mapInArrow(run, schema)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    end_id: int = 0,
    longest: int = 18,
    part_tokens: int = 1 << 22,
    id_col: str = "doc_id",
    text_col: str = "text",
    special_tokens: bool = False,
) -> None:
    """Token files at ``path``; with ``special_tokens`` the ids are those of the library's plain call."""
    spark = docs.sparkSession
    size = vocabulary_size(tokenizer)
    dtype = "<u2" if size <= 1 << 16 else "<u4"
    tokens = written(encode_documents(docs, tokenizer, end_id, id_col, text_col, special_tokens), "tokens", compression="zstd")

    # Ranges of the id with about as many ids of tokens each: quantiles, as many as parts.
    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    n_parts = max(1, -(-total // part_tokens))
    inner = [i / n_parts for i in range(1, n_parts)]
    bounds = tokens.agg(F.percentile_approx("doc_id", inner, 100 * n_parts)).first()[0] if inner else None
    bounds = np.unique(np.array(bounds or [], np.int64))

    def part_of(ids: pa.Array) -> np.ndarray:
        known = ids.cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
        return np.searchsorted(bounds, known, side="right")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, sums = np.zeros(size, np.int64), np.zeros(len(bounds) + 1, np.int64)
        for batch in batches:
            ids, _ = _flat(batch.column(2), dtype)
            seen += np.bincount(ids, minlength=size)
            np.add.at(sums, part_of(batch.column(0)), batch.column(1).to_numpy())
        for kind, found in ((0, seen), (1, sums)):
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(found[at])], ["kind", "at", "n"])

    counted = tokens.mapInArrow(count, "kind int, at int, n long").groupBy("kind", "at").agg(F.sum("n").alias("n")).collect()
    seen, sums = np.zeros(size, np.int64), np.zeros(len(bounds) + 1, np.int64)
    for row in counted:  # at most an entry for each id of the vocabulary and each part
        (seen if row["kind"] == 0 else sums)[row["at"]] = row["n"]
    lengths = code_lengths(seen, longest)
    before = np.cumsum(sums) - sums
    code = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(code, "id int, bits int").coalesce(1).write.parquet(f"{path}/code")

    id_field = tokens.schema["doc_id"]
    coded_schema = T.StructType([T.StructField("part", T.IntegerType()), id_field, T.StructField("n_tokens", T.LongType()), T.StructField("stream", T.BinaryType()), T.StructField("checkpoints", T.BinaryType())])

    def write_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(lengths)
        for batch in batches:
            ids, sizes = _flat(batch.column(2), dtype)
            ends = np.cumsum(sizes)
            for a, b in _stretches(sizes, 1 << 19):
                data, size_of, marks = codec.write(ids[ends[a] - sizes[a] : ends[b - 1]], sizes[a:b])
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part_of(own.column(0)).astype(np.int32)), own.column(0), own.column(1), _binary(data, size_of), _binary(marks, 4 * -(-sizes[a:b] // CHECKPOINT))],
                    coded_schema.names,
                )

    out_schema = T.StructType([coded_schema["part"], T.StructField("nth", T.LongType()), id_field, T.StructField("start", T.LongType()), *coded_schema.fields[2:]])

    def number(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("stream", "ascending")])
        if rows["doc_id"].null_count:  # sorted last by Arrow; here they come first
            empty = rows["doc_id"].null_count
            rows = pa.concat_tables([rows.slice(len(rows) - empty), rows.slice(0, len(rows) - empty)])
        sizes = rows["n_tokens"].to_numpy()
        start = before[key[0].as_py()] + np.cumsum(sizes) - sizes
        rows = rows.append_column("start", pa.array(start)).append_column("nth", pa.array(np.arange(len(rows))))
        return rows.select(out_schema.names)

    coded = tokens.mapInArrow(write_codes, coded_schema)
    numbered = coded.groupBy("part").applyInArrow(number, out_schema)
    numbered.sortWithinPartitions("part", "nth").write.partitionBy("part").option("compression", "none").parquet(f"{path}/data")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids (little-endian unsigned 32-bit)."""
    code = spark.read.parquet(f"{path}/code").collect()  # one row for each id in use
    lengths = np.zeros(max([r["id"] for r in code], default=0) + 1, np.uint8)
    for r in code:
        lengths[r["id"]] = r["bits"]
    id_type = "long"
    if code:
        stored = spark.read.parquet(f"{path}/data").select("doc_id", "start", "n_tokens", "stream", "checkpoints")
        id_type = stored.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, start long, n_tokens long, ids binary"
    if not code:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(lengths)
        for batch in batches:
            counts = batch.column(2).to_numpy()
            data, sizes = _flat(batch.column(3), "u1")
            marks, n_marks = _flat(batch.column(4), "<u4")
            ends, mark_ends = np.cumsum(sizes), np.cumsum(n_marks)
            for a, b in _stretches(counts, 1 << 21):
                ids = codec.read(data[ends[a] - sizes[a] : ends[b - 1]], ends[a:b] - sizes[a:b] - (ends[a] - sizes[a]), counts[a:b], marks[mark_ends[a] - n_marks[a] : mark_ends[b - 1]].astype(np.int64))
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), own.column(2), _binary(ids.astype("<u4"), 4 * counts[a:b])], ["doc_id", "start", "n_tokens", "ids"])

    return stored.mapInArrow(run, schema)
