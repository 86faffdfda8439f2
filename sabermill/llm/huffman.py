"""Canonical Huffman codes of limited length, and numpy routines that write and read them.

A stream is cut into blocks that start on a byte and can be read alone. Inside a block the bit
offset of every ``CHECKPOINT``-th symbol is noted, so a reader starts at any checkpoint; here all
checkpoints of a batch are read side by side.
"""

from __future__ import annotations

import numpy as np

CHECKPOINT = 256
BLOCK = 16 * CHECKPOINT


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Length of each symbol's code (0: doesn't occur), optimal among codes of at most ``limit`` bits.

    Package-merge: at every level pairs of the cheapest items become packages that compete with
    the symbols; walking back from the 2n - 2 cheapest items of the last level counts how often
    each symbol was taken.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols don't fit into codes of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    levels, packages = [], np.empty(0)
    for _ in range(limit):
        items = np.concatenate([weights, packages])
        order = np.argsort(items, kind="stable")
        levels.append(order < n)
        items = items[order]
        packages = items[0 : len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
    taken, found = 2 * n - 2, np.zeros(n, np.uint8)
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:taken].sum())
        found[:symbols] += 1
        taken = 2 * (taken - symbols)
    lengths[used] = found
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol)."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for size in range(1, int(lengths.max(initial=0)) + 1):
        code <<= size - before
        own = np.flatnonzero(lengths == size)
        codes[own] = code + np.arange(len(own), dtype=np.uint64)
        code, before = code + len(own), size
    return codes


class Codec:
    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical(lengths)
        self.longest = max(1, int(lengths.max(initial=0)))
        # Every value of the next ``longest`` bits leads to its symbol and that symbol's length.
        self.table = np.zeros(1 << self.longest, np.uint32)
        used = np.flatnonzero(lengths)
        used = used[np.lexsort((used, lengths[used]))]
        spans = np.left_shift(1, self.longest - self.lengths[used])
        filled = np.repeat((used.astype(np.uint32) << np.uint32(5)) | self.lengths[used].astype(np.uint32), spans)
        self.table[: len(filled)] = filled

    def write(self, symbols: np.ndarray, counts: np.ndarray):
        """Streams of ``counts`` symbols each: (bytes of all, size of each in bytes, checkpoints).

        A checkpoint is a bit offset from the stream's first byte; there is one for every
        ``CHECKPOINT`` symbols begun, and a stream's are as many as its symbols need.
        """
        sizes = self.lengths[symbols]  # the caller keeps batches to about a million symbols
        bits = np.concatenate([[0], np.cumsum(sizes)])
        first = np.concatenate([[0], np.cumsum(counts)])
        blocks_of = -(-counts // BLOCK)
        blocks = np.repeat(first[:-1], blocks_of) + BLOCK * _within(blocks_of)
        block_ends = np.minimum(blocks + BLOCK, np.repeat(first[1:], blocks_of))
        block_bytes = -(-(bits[block_ends] - bits[blocks]) // 8)
        block_at = np.concatenate([[0], np.cumsum(block_bytes)])
        at = np.repeat(8 * block_at[:-1] - bits[blocks], block_ends - blocks) + bits[:-1]
        stream_at = block_at[np.concatenate([[0], np.cumsum(blocks_of)])]
        out = np.zeros(int(block_at[-1]) // 4 + 2, np.uint64)
        if len(symbols):
            word, shift = at >> 5, (64 - (at & 31) - sizes).astype(np.uint64)
            placed = self.codes[symbols] << shift
            runs = np.flatnonzero(np.diff(word, prepend=-1))
            where = word[runs]
            # Codes don't overlap, so their sum is their union.
            out[where] += np.add.reduceat(placed >> np.uint64(32), runs)
            out[where + 1] += np.add.reduceat(placed & np.uint64(0xFFFFFFFF), runs)
        data = out.astype(">u4").view(np.uint8)[: int(block_at[-1])]
        marks_of = -(-counts // CHECKPOINT)
        marks = np.repeat(first[:-1], marks_of) + CHECKPOINT * _within(marks_of)
        return data, np.diff(stream_at), (at[marks] - 8 * np.repeat(stream_at[:-1], marks_of)).astype(np.uint32)

    def read(self, data: np.ndarray, starts: np.ndarray, counts: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """The symbols of streams that begin at ``starts`` (bytes) and have ``counts`` symbols."""
        first = np.concatenate([[0], np.cumsum(counts)])
        marks_of = -(-counts // CHECKPOINT)
        step = _within(marks_of)
        left = np.minimum(CHECKPOINT, np.repeat(counts, marks_of) - CHECKPOINT * step)
        out_at = np.repeat(first[:-1], marks_of) + CHECKPOINT * step
        at = 8 * np.repeat(starts, marks_of) + marks
        order = np.argsort(-left, kind="stable")
        at, out_at, left = at[order], out_at[order], left[order]
        active = np.searchsorted(-left, -np.arange(1, CHECKPOINT + 1), side="right")
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        window = np.ndarray((len(padded) - 3,), ">u4", padded, strides=(1,))
        out = np.empty(int(first[-1]), np.uint32)
        keep = np.uint32(32 - self.longest)
        for i in range(CHECKPOINT):
            n = active[i]
            if n == 0:
                break
            now = at[:n]
            found = self.table[(window[now >> 3].astype(np.uint32) << (now & 7).astype(np.uint32)) >> keep]
            out[out_at[:n] + i] = found >> np.uint32(5)
            now += found & np.uint32(31)
        return out


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of ``counts`` entries, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
