"""Whole texts to ids of a byte-level BPE file, each distinct piece encoded once for many batches.

Before merging, such a tokenizer cuts a text where a single space stands between two characters
that are not white space, whatever is around it. So a batch is cut at exactly those places, equal
pieces are found by Arrow's dictionary encoding, the distinct pieces go through the tokenizers
library, and every text's ids are put together again from them: the ids of the whole text.

Where the file names the usual pattern for cutting, no token of it holds a letter and then another kind of
character, nor a line feed and then something else, so a batch is cut there too, but not inside an
added token. Far fewer pieces are distinct then ("word", "word," and "word." share one). A worker keeps the pieces it
has seen with their ids, up to ``_KNOWN_BYTES`` of them, and begins anew when they are more.

With ``special_tokens`` the string of a special token in a text becomes its id, as in the library's
plain call; without, it is ordinary text. A special token that holds white space, takes white space
beside it or asks for word bounds could lie across a cut; then texts go through the library whole.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Lead bytes of UTF-8 characters among which white space can be; no cut is made beside them.
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_LOW = np.arange(256) <= 0x20
_JOINED_BYTES = 1 << 16
_KNOWN_BYTES = 3 << 23
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_ASCII = np.arange(256) < 0x80
_SEEN = _ASCII & ~_LOW

_loaded: dict[tuple[str, bool], ByteBpe] = {}


def encoder(path: str, special_tokens: bool = False) -> ByteBpe:
    """The encoder of a file, loaded once for each Python worker."""
    if (path, special_tokens) not in _loaded:
        _loaded[path, special_tokens] = ByteBpe(path, special_tokens)
    return _loaded[path, special_tokens]


def vocabulary_size(path: str) -> int:
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    return 1 + max([*described["model"]["vocab"].values(), *(t["id"] for t in described["added_tokens"])])


class ByteBpe:
    def __init__(self, path: str, special_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_tokens
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if special_tokens or not t.special]
        self.cuts = not any(t.lstrip or t.rstrip or t.single_word or any(c.isspace() for c in t.content) for t in added)
        self.added = [t.content.encode() for t in added if t.content]
        described = json.loads(self.tokenizer.to_str())
        how = described["pre_tokenizer"] or {}
        self.fine = self.cuts and described["normalizer"] is None and how.get("type") == "ByteLevel" and how.get("use_regex", True) and not how.get("add_prefix_space", True)
        size = self.tokenizer.get_vocab_size()
        pieces = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        # One character of a piece stands for one byte, and this one for a space.
        self.opens = np.array([p.startswith("Ġ") for p in pieces])
        self.n_bytes = np.array([len(p) for p in pieces], np.int64)
        self._forget()

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype) for e in found]

    def _forget(self) -> None:
        self.known = pa.array([], pa.binary())
        self.ids = np.empty(0, self.dtype)
        self.first, self.length = np.empty(0, np.int64), np.empty(0, np.int32)

    def _looked_up(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``_distinct``, but only pieces not seen before go through the library."""
        at = pc.index_in(pieces, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            unseen = pieces.take(pa.array(new))
            ids, first, length = self._distinct(unseen)
            at[new] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, unseen])
            self.first = np.concatenate([self.first, first + len(self.ids)])
            self.length = np.concatenate([self.length, length.astype(np.int32)])
            self.ids = np.concatenate([self.ids, ids])
        found = self.ids, self.first[at], self.length[at].astype(np.int64)
        if self.known.nbytes > _KNOWN_BYTES:
            self._forget()
        return found

    def _inner_cuts(self, joined: bytes, raw: np.ndarray) -> np.ndarray:
        """Bytes before which the pattern always cuts: after a letter, and around a line feed that stands alone."""
        begins = np.zeros(len(raw), bool)
        before, here = raw[:-1], raw[1:]
        begins[1:] = _LETTER[before] & _ASCII[here] & ~_LETTER[here]
        feeds = np.flatnonzero(raw == 0x0A)
        feeds = feeds[(feeds > 0) & (feeds < len(raw) - 1)]
        feeds = feeds[_SEEN[raw[feeds - 1]] & _SEEN[raw[feeds + 1]]]
        begins[feeds] = True
        begins[feeds + 1] = True
        for content in self.added:
            at = joined.find(content)
            while at >= 0:
                begins[at + 1 : at + len(content)] = False
                at = joined.find(content, at + 1)
        return begins

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, each piece's first position in them and its length."""
        offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)
        raw = np.frombuffer(pieces.buffers()[2], np.uint8)
        spaces = np.concatenate([[0], np.cumsum(raw == 0x20)])
        sizes = np.diff(offsets)
        head, second, tail = raw[offsets[:-1]], raw[np.minimum(offsets[:-1] + 1, offsets[1:] - 1)], raw[offsets[1:] - 1]
        # " word": one leading space and no other; such pieces may stand in one string, where
        # each one's ids begin with the only piece that opens with a space.
        plain = (head == 0x20) & (sizes > 1) & (spaces[offsets[1:]] - spaces[offsets[:-1]] == 1)
        plain &= ~_LOW[second] & ~_LEADS[second] & ~_LOW[tail]
        plain &= ~_LEADS[raw[np.maximum(offsets[1:] - 2, 0)]] & ~_LEADS[raw[np.maximum(offsets[1:] - 3, 0)]]
        single, joined = np.flatnonzero(~plain), np.flatnonzero(plain)
        filled = np.cumsum(sizes[joined]) // _JOINED_BYTES
        groups = np.split(joined, np.flatnonzero(np.diff(filled)) + 1) if len(joined) else []
        order, found, lengths = [], [], []
        for group, text in zip(groups, self._texts(pieces, groups), strict=True):
            ids = self._library([text])[0]
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) == len(group):
                order.append(group)
                found.append(ids)
                lengths.append(np.diff(np.append(starts, len(ids))))
            else:
                single = np.concatenate([single, group])
        alone = self._library([v.decode() for v in pieces.take(pa.array(single)).to_pylist()])
        order.append(single)
        found.extend(alone)
        lengths.append(np.array([len(x) for x in alone], np.int64))
        size = np.concatenate(lengths)
        first = np.empty(len(pieces), np.int64)
        length = np.empty(len(pieces), np.int64)
        placed = np.concatenate(order)
        first[placed] = np.cumsum(size) - size
        length[placed] = size
        return np.concatenate([np.empty(0, self.dtype), *found]), first, length

    def _texts(self, pieces: pa.Array, groups: list[np.ndarray]):
        """The pieces of each group in one string."""
        for group in groups:
            part = pieces.take(pa.array(group))
            yield part.buffers()[2].to_pybytes()[: np.frombuffer(part.buffers()[1], np.int32)[len(part)]].decode()

    def encode(self, texts: list[str | None]):
        """Yield (first text, ids, counts) for stretches of consecutive texts; null is empty."""
        raw_texts = [(t or "").encode() for t in texts]
        sizes = np.array([len(t) for t in raw_texts], np.int64)
        ends = np.cumsum(sizes)
        joined = b"".join(raw_texts)
        raw = np.frombuffer(joined, np.uint8)
        del raw_texts
        n = len(raw)
        if n == 0:
            yield 0, np.empty(0, self.dtype), np.zeros(len(texts), np.int64)
            return
        at = np.flatnonzero(raw == 0x20)
        at = at[(at > 0) & (at < n - 1)]
        before, after = raw[at - 1], raw[at + 1]
        cut = ~_LOW[before] & ~_LOW[after] & ~_LEADS[after]
        cut &= ~_LEADS[raw[np.maximum(at - 2, 0)]] & ~_LEADS[raw[np.maximum(at - 3, 0)]] & self.cuts
        begins = self._inner_cuts(joined, raw) if self.fine else np.zeros(n, bool)
        begins[at[cut]] = True
        begins[(ends - sizes)[sizes > 0]] = True
        starts = np.flatnonzero(begins)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.append(starts, n).astype(np.int32)), pa.py_buffer(raw)])
        coded = pc.dictionary_encode(pieces)
        codes = coded.indices.to_numpy()
        ids, first, length = self._looked_up(coded.dictionary)
        lengths = length[codes]
        running = np.concatenate([[0], np.cumsum(lengths)])
        ends_at = running[np.searchsorted(starts, ends)]  # ids up to the end of each text
        counts = np.diff(np.concatenate([[0], ends_at]))
        stretch = np.flatnonzero(np.diff(ends_at // (1 << 20), prepend=-1))
        for a, b in zip(stretch, [*stretch[1:], len(texts)], strict=True):
            lo = np.searchsorted(starts, ends[a] - sizes[a])
            hi = np.searchsorted(starts, ends[b - 1])
            own = lengths[lo:hi]
            place = np.repeat(first[codes[lo:hi]] - (running[lo:hi] - running[lo]), own) + np.arange(own.sum())
            yield int(a), ids[place], counts[a:b]
