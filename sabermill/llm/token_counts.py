"""Token counts of the sections of documents, from one encoding of the whole text.

A whole text is encoded once. The tokens' character spans, which tile the text in order, are
joined with the sections' character intervals by binary search in the sorted starts. The rule for
tokens that cross a boundary: a token belongs to the section that holds its first character (for
a token that begins inside a character, the character it begins in). So sections that tile a text
add up to the text's tokens; overlapping sections each count what begins inside them, and tokens
that begin in no section are counted nowhere. ``n_crossing`` says how many of a section's
tokens run past its end.

Sections are given as an array of (begin, end) character intervals beside each text, end
excluded; without one, the sections are the lines with their line feeds. No row is shuffled.

Defined cases: a null text is empty; an empty text has one empty section, its only line, with no
tokens. A null or empty array gives no row. Bounds outside the text count what lies inside; an
inverted or null interval counts nothing. Repeated rows each give their own sections. Columns other
than the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sabermill.llm.byte_bpe import encoder
from sabermill.llm.tables import col


def _lines(raw: np.ndarray, char_at: np.ndarray, text_at: np.ndarray, ends: np.ndarray):
    """Rows of (text, begin, end) in characters for the lines of each text; \\n ends a line."""
    feeds = np.flatnonzero(raw == 0x0A) + 1
    owner = np.searchsorted(ends, feeds, side="left")
    feeds, owner = feeds[feeds < ends[owner]], owner[feeds < ends[owner]]
    starts = np.concatenate([text_at, feeds])
    owner = np.concatenate([np.arange(len(text_at)), owner])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    last = np.append(np.diff(owner) != 0, True)
    stops = np.where(last, ends[owner], np.append(starts[1:], 0))
    base = char_at[text_at[owner]]
    return owner, char_at[starts] - base, char_at[stops] - base


def count_tokens(docs: DataFrame, tokenizer: str, *, spans_col: str | None = None, id_col: str = "doc_id", text_col: str = "text", special_tokens: bool = False) -> DataFrame:
    """A row for each section: doc_id, section (0, 1, ... in given order), begin, end, n_tokens, n_crossing.

    With ``special_tokens`` the tokens are those of the library's plain call.
    """
    picked = [col(id_col).alias("doc_id"), col(text_col).alias("text")]
    if spans_col:
        picked += [F.transform(col(spans_col), lambda s: s.begin.cast("long")).alias("begins"), F.transform(col(spans_col), lambda s: s.end.cast("long")).alias("ends")]
    rows = docs.select(*picked)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("section", T.LongType()), *[T.StructField(n, T.LongType()) for n in ("begin", "end", "n_tokens", "n_crossing")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer, special_tokens)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, ids, counts in bpe.encode(texts):
                raw_texts = [(t or "").encode() for t in texts[first : first + len(counts)]]
                raw = np.frombuffer(b"".join(raw_texts), np.uint8)
                ends = np.cumsum([len(t) for t in raw_texts])
                text_at = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                # Characters that begin before each byte; a token's first character is the one
                # its first byte is part of.
                char_at = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                stop = np.cumsum(bpe.n_bytes[ids])
                inside = np.append((raw & 0xC0) == 0x80, False)
                begin = stop - bpe.n_bytes[ids]
                begin_char, stop_char = char_at[begin] - inside[begin], char_at[stop]
                if spans_col:
                    own = batch.slice(first, len(counts))
                    lists = [own.column(2), own.column(3)]
                    sizes = lists[0].value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                    owner = np.repeat(np.arange(len(counts)), sizes)
                    a, b = (x.flatten().fill_null(0).to_numpy(zero_copy_only=False) for x in lists)
                else:
                    owner, a, b = _lines(raw, char_at, text_at, ends)
                base, limit = char_at[text_at[owner]], char_at[ends[owner]]
                lo = np.searchsorted(begin_char, np.clip(base + a, base, limit))
                hi = np.searchsorted(begin_char, np.clip(base + b, base, limit))
                n = np.maximum(hi - lo, 0)
                crossing = np.zeros(len(owner), np.int64)
                some = n > 0
                crossing[some] = stop_char[hi[some] - 1] > (base + b)[some]
                runs = np.flatnonzero(np.diff(owner, prepend=-1))
                section = np.arange(len(owner)) - np.repeat(runs, np.diff(np.append(runs, len(owner))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(counts)).take(pa.array(owner)), *[pa.array(x.astype(np.int64)) for x in (section, a, b, n, crossing)]],
                    schema.names,
                )

    return rows.mapInArrow(run, schema)
