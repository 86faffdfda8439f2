"""SentencePiece encoding and decoding of whole texts, by a forward pass over a trie of words.

A text is marked (a space in front, every space as U+2581) and cut before each run of marks and around
line feeds; no piece of the model reaches over such a cut, so words can be encoded alone. The distinct
marked words of a batch that a bounded table of earlier words lacks are sorted, which lists a trie
depth-first: a word takes over the forward states of the prefix it shares with the word before and only
continues from there.

The public models at hand are of the byte-pair kind, for which the best sum of scores, the usual
forward score, is not what the library returns. The forward state of a prefix is therefore the last piece of
its encoding, which is unique: a piece may follow another if the two, joined, encode to just
these two. (Merges that cross no boundary of a sequence of pieces are those of its neighbouring pairs, so a sequence
in which all neighbours may follow each other is the encoding of its text.) The ids are those of
the library.

Defined cases: a null text is empty; an empty text has no ids and decodes to an empty text. U+2581 in a text
decodes to a space, as with the library. Characters without a piece become byte pieces, and unknown where the
model has none. Repeated rows each give their own row. Extra columns are carried along; those named like a
result column are replaced. No row is shuffled.
"""

from __future__ import annotations

import gc
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sabermill.llm.tables import col, stretches

_MARK = "▁"
# Pairs of pieces whose verdict a Python worker keeps (some 270 bytes each).
_PAIRS = 1 << 18
# Words whose ids a Python worker keeps from batch to batch, and their greatest length in characters.
_WORDS, _WORD_CHARS = 1 << 18, 64
# The distinct words of so much text are held at once; the text itself is cut in parts.
_BATCH_BYTES = 16 << 20
_PART_BYTES = 1 << 20
# So many ids are decoded at once.
_IDS = 1 << 18
# Of so many words the ids are held as Python lists at once.
_AT_ONCE = 1 << 15

_loaded: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of a file, loaded once for each Python worker."""
    if path not in _loaded:
        _loaded[path] = PieceModel(path)
    return _loaded[path]


def _cut(texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, each with the spaces before it, and how many there are up to the end of each text."""
    raws = [(" " + t.replace(_MARK, " ")).encode() if t else b"" for t in texts]
    sizes = np.array([len(r) for r in raws], np.int64)
    raw = np.frombuffer(b"".join(raws), np.uint8)
    if not len(raw):
        return pa.array([], pa.binary()), np.zeros(len(texts), np.int64)
    ends = np.cumsum(sizes)
    space, feed = raw == 0x20, raw == 0x0A
    begins = feed.copy()
    begins[1:] |= (space[1:] & ~space[:-1]) | feed[:-1]
    begins[(ends - sizes)[sizes > 0]] = True
    starts = np.flatnonzero(begins)
    cut = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int32)), pa.py_buffer(raw)])
    return cut, np.searchsorted(starts, ends)


class PieceModel:
    def __init__(self, path: str):
        import sentencepiece

        file = sentencepiece.SentencePieceProcessor(model_file=path)
        size = file.get_piece_size()
        names = [file.id_to_piece(i) for i in range(size)]
        self.unknown = file.unk_id()
        self.bytes = {int(names[i][3:5], 16): i for i in range(size) if file.is_byte(i)}
        plain = [i for i in range(size) if not (file.is_byte(i) or file.is_control(i) or file.is_unknown(i) or file.is_unused(i))]
        self.ids = {names[i]: i for i in plain}
        self.names = names
        self.scores = [file.get_score(i) for i in range(size)]
        # Lengths of the pieces that end in the same three characters, the longest first; shorter pieces always count.
        sizes: dict[str, set[int]] = {}
        for name in self.ids:
            if len(name) > 2:
                sizes.setdefault(name[-3:], {1, 2}).add(len(name))
        self.sizes = {tail: sorted(found, reverse=True) for tail, found in sizes.items()}
        if any(_MARK in n.lstrip(_MARK) or ("\n" in n and n != "\n") for n in self.ids):
            raise ValueError("a piece reaches over the start of a word")
        # Which pieces may stand after each piece (-1: at a start or after a character without a piece), as far as tried.
        self.after: dict[int, dict[int, bool]] = {-1: {}}
        self.tried = 0
        self.words: dict[str, list[int]] = {}
        # What each id decodes to.
        surface = [b""] * size
        for i in plain:
            surface[i] = names[i].replace(_MARK, " ").encode()
        for value, i in self.bytes.items():
            surface[i] = bytes([value])
        surface[self.unknown] = " ⁇ ".encode()
        self.surface = pa.array(surface, pa.binary())

    def merged(self, text: str) -> list[str]:
        """Byte-pair merging of a short text: the best-scored neighbours first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, at = self.scores[piece], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def may_follow(self, before: int, piece: int) -> bool:
        """Whether ``piece`` stands after ``before``."""
        if self.tried >= _PAIRS:
            self.tried = 0
            for known in self.after.values():
                known.clear()
        name, first = self.names[piece], [self.names[before]] if before >= 0 else []
        found = self.merged("".join(first) + name) == [*first, name]
        self.after.setdefault(before, {})[piece] = found
        self.tried += 1
        return found

    def segment(self, words: list[str]) -> list[list[int]]:
        """Ids of each of the sorted ``words``."""
        find, lengths, after = self.ids.get, self.sizes.get, self.after
        short = [2, 1]
        # Of the prefixes of the word before: the length and the id of the last piece, and what may follow it.
        sizes, last, follow = [0], [-1], [after[-1]]
        before, out = "", []
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del sizes[shared + 1 :], last[shared + 1 :], follow[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for size in lengths(word[end - 3 : end], short) if end > 2 else short[-end:]:
                    if size > end:
                        continue
                    begin = end - size
                    piece = find(word[begin:end])
                    if piece is not None:
                        known = follow[begin].get(piece)
                        if known or (known is None and self.may_follow(last[begin], piece)):
                            sizes.append(size)
                            last.append(piece)
                            follow.append(after[piece] if piece in after else after.setdefault(piece, {}))
                            break
                else:
                    sizes.append(1)
                    last.append(-1)
                    follow.append(after[-1])
            found, end = [], len(word)
            while end:
                piece = last[end]
                if piece >= 0:
                    found.append(piece)
                elif self.bytes:
                    found.extend(self.bytes[b] for b in reversed(word[end - 1].encode()))
                else:
                    found.append(self.unknown)
                end -= sizes[end]
            found.reverse()
            out.append(found)
            before = word
        return out

    def ids_of(self, words: list[str], often: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct ``words``, where each word's begin and how many it has; words not met in earlier
        batches are sorted into a trie.

        Words that are met ``often`` in a batch are kept for the next ones.
        """
        known = self.words
        old = [i for i, w in enumerate(words) if w in known]
        new = sorted([i for i, w in enumerate(words) if w not in known], key=words.__getitem__)
        flat, lengths = [np.empty(0, np.int32)], [np.empty(0, np.int64)]

        def add(found: list[list[int]]) -> None:
            lengths.append(np.fromiter(map(len, found), np.int64, len(found)))
            flat.append(np.fromiter(chain.from_iterable(found), np.int32, int(lengths[-1].sum())))

        for a in range(0, len(old), _AT_ONCE):
            add([known[words[i]] for i in old[a : a + _AT_ONCE]])
        if len(known) >= _WORDS:
            known.clear()
        collects = gc.isenabled()
        gc.disable()  # very many small lists without a cycle
        try:
            for a in range(0, len(new), _AT_ONCE):
                some = new[a : a + _AT_ONCE]
                found = self.segment([words[i] for i in some])
                add(found)
                for i, ids in zip(some[: max(0, _WORDS - a)], found, strict=False):
                    if often[i] and len(words[i]) <= _WORD_CHARS:
                        known[words[i]] = ids
        finally:
            if collects:
                gc.enable()
        order, sizes = np.array([*old, *new], np.int64), np.concatenate(lengths)
        begins, own = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        begins[order], own[order] = np.cumsum(sizes) - sizes, sizes
        return np.concatenate(flat), begins, own

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        cuts, ends = [], []
        for (some,) in stretches(_PART_BYTES, texts):
            cut, last = _cut(some)
            cuts.append(cut)
            ends.append(last)
        if not any(map(len, cuts)):
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        parts = np.cumsum([len(cut) for cut in cuts])[:-1]
        coded = pc.dictionary_encode(pa.concat_arrays(cuts))
        del cuts
        words = pc.replace_substring(coded.dictionary.cast(pa.string()), " ", _MARK).to_pylist()
        codes = coded.indices.to_numpy()
        del coded
        flat, first, lengths = self.ids_of(words, (np.bincount(codes, minlength=len(words)) > 1).tolist())
        del words
        ids, counts = [], []
        for part, last in zip(np.split(codes, parts), ends, strict=True):
            own = lengths[part]
            running = np.concatenate([[0], np.cumsum(own)])
            ids.append(flat[np.repeat(first[part] - running[:-1], own) + np.arange(running[-1])])
            counts.append(np.diff(running[last], prepend=0))
        return np.concatenate(ids), np.concatenate(counts)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        out, at = [], np.concatenate([[0], np.cumsum(counts)])
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            joined = self.surface.take(pa.array(ids[a:b]))
            data = joined.buffers()[2].to_pybytes()[: np.frombuffer(joined.buffers()[1], np.int32)[b - a]] if b > a else b""
            out.append(data.decode(errors="replace").removeprefix(" "))
        return out


def encoded(text: Column, path: str) -> Column:
    """Ids of a text column."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        found = model(path)
        sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // _BATCH_BYTES
        begins = np.flatnonzero(np.diff(sizes, prepend=-1)).tolist()
        parts = [found.encode(texts[a:b]) for a, b in zip(begins, [*begins[1:], len(texts)], strict=False)]
        ids = np.concatenate([np.empty(0, np.int32), *[i for i, _ in parts]])
        ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *[n for _, n in parts]]))
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))

    return run(text)


def decoded(ids: Column, path: str) -> Column:
    """Text of a column of ids; null ids are an empty text, null or unknown elements decode to nothing."""

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat, at = lists.flatten(), np.concatenate([[0], np.cumsum(counts)])
        found = model(path)
        # Ids outside the model stand for a control piece, which has no surface.
        blank = next((i for i in range(len(found.names)) if found.surface[i].as_py() == b""), found.unknown)
        begins = np.flatnonzero(np.diff(at[1:] // _IDS, prepend=-1)).tolist()
        parts = [pa.array([], pa.string())]
        for a, b in zip(begins, [*begins[1:], len(counts)], strict=False):
            own = flat.slice(at[a], at[b] - at[a]).fill_null(-1).to_numpy(zero_copy_only=False)
            inside = (own >= 0) & (own < len(found.names))
            parts.append(pa.array(found.decode(np.where(inside, own, blank), counts[a:b]), pa.string()))
        return pa.concat_arrays(parts)

    return run(ids)


def encode_documents(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with piece_ids and n_pieces."""
    done = docs.withColumn("piece_ids", encoded(col(text_col), path))
    return done.withColumn("n_pieces", F.size("piece_ids").cast("long"))


def decode_documents(docs: DataFrame, path: str, ids_col: str = "piece_ids") -> DataFrame:
    """``docs`` with the text that its ids stand for, decoded."""
    return docs.withColumn("decoded", decoded(col(ids_col), path))
