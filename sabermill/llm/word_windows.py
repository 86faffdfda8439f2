"""Words of texts as 64-bit hashes, and hashes of runs of consecutive words, by numpy.

Texts are joined by line feeds and cut at ASCII white space. A word's hash is a polynomial in its
bytes, taken from prefix sums and then mixed; a run's hash is a polynomial in its words' hashes, made
by doubling. ``seed`` gives independent hashes. Long input is worked through in pieces, so memory beside
the results is bounded.
"""

from __future__ import annotations

import numpy as np

# The white space bytes that separate words.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_PIECE = 1 << 18
# Odd multipliers; each seed has a base for bytes and one for words.
_BASES = [
    (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93),
    (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F),
]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.uint64:
    return np.uint64(pow(base, n, 1 << 64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Words:
    """The words of a list of texts: each one's hashes, and each text's first word."""

    def __init__(self, texts: list[str | None], seeds: int = 2):
        raw_texts = [(t or "").encode() for t in texts]
        sizes = np.array([len(t) + 1 for t in raw_texts], np.int64)
        raw = np.frombuffer(b"\n".join(raw_texts) + b"\n", np.uint8)
        starts, ends, hashes = [], [], [[] for _ in range(seeds)]
        at = 0
        while at < len(raw):
            # A piece ends after a separator; a longer word makes a longer piece.
            stop = min(at + _PIECE, len(raw))
            while not _SPACE[raw[stop - 1]]:
                further = np.flatnonzero(_SPACE[raw[stop : stop + _PIECE]])
                stop = stop + int(further[0]) + 1 if len(further) else stop + _PIECE
            piece = raw[at:stop]
            space = _SPACE[piece]
            edges = np.flatnonzero(np.diff(space, prepend=True))
            s, e = edges[0 : len(edges) // 2 * 2 : 2], edges[1::2]
            starts.append(s + at)
            ends.append(e + at)
            for seed in range(seeds):
                base = _BASES[seed][0]
                sums = np.zeros(len(piece) + 1, np.uint64)
                np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * _powers(base, len(piece))[:-1], out=sums[1:])
                inverse = _powers(pow(base, -1, 1 << 64), len(piece))
                hashes[seed].append(mixed((sums[e] - sums[s]) * inverse[s]))
            at = stop
        self.starts = np.concatenate(starts) if starts else np.empty(0, np.int64)
        self.ends = np.concatenate(ends) if ends else np.empty(0, np.int64)
        self.hashes = [np.concatenate(h) if h else np.empty(0, np.uint64) for h in hashes]
        text_ends = np.cumsum(sizes)
        self.first = np.searchsorted(self.starts, np.concatenate([[0], text_ends]) if len(sizes) else np.zeros(1, np.int64))
        self.raw = raw

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, size: int, seed: int = 0) -> np.ndarray:
        """Hashes of all runs of ``size`` words, whatever text they lie in."""
        h = self.hashes[seed]
        base = _BASES[seed][1]
        n = len(h) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        done, out, width, have = None, h, 1, 0
        left = size
        while left:
            if left & 1:
                done = out[: len(h) - width + 1] if done is None else done[:n_with(len(h), have + width)] * _power(base, width) + out[have : have + n_with(len(h), have + width)]
                have += width
            left >>= 1
            if left:
                m = len(h) - 2 * width + 1
                out = out[:m] * _power(base, width) + out[width : width + m]
                width *= 2
        return mixed(done[:n])

    def window_starts(self, size: int) -> np.ndarray:
        """First words of the runs of ``size`` words that lie inside one text."""
        n = len(self.hashes[0])
        if n < size:
            return np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(self.counts)), self.counts)
        return np.flatnonzero(owner[: n - size + 1] == owner[size - 1 :])


def n_with(n: int, size: int) -> int:
    return max(0, n - size + 1)
