"""64-bit hashes of all words of a text at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be divided by
PIECE = 1 << 18  # bytes whose words are hashed at a time; a longer word is hashed whole
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: A number for each byte; blanks add nothing.
LETTERS = np.where(BLANK, 0, np.random.default_rng(29).integers(1, 1 << 63, 256, np.uint64) * 2 + 1).astype(np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


UP, DOWN = powers(BASE, 2 * PIECE), powers(pow(BASE, -1, 1 << 64), 2 * PIECE)


def word_hashes(raw: bytes) -> np.ndarray:
    """The hash of each word between ASCII white space: a polynomial in its bytes modulo 2^64, mixed."""
    x = np.frombuffer(raw, np.uint8)
    blank = np.ones(len(x) + 2, bool)
    np.take(BLANK, x, out=blank[1:-1])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    out = np.empty(len(starts), np.uint64)
    if len(x) <= PIECE:
        cuts = [0, len(starts)] if len(starts) else []
    else:
        cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(x), PIECE)), len(starts))).tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        first, n = starts[a], ends[b - 1] - starts[a]
        up, down = (UP, DOWN) if n <= len(UP) else (powers(BASE, n), powers(pow(BASE, -1, 1 << 64), n))
        at = starts[a:b] - first
        out[a:b] = np.add.reduceat(LETTERS[x[first : first + n]] * up[:n], at) * down[at]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ out >> np.uint64(30)


class Tally:
    """Counts 64-bit hashes in a buffer of fixed size."""

    def __init__(self, most: int = 2_000_000):
        self.held, self.n = np.empty(most, np.uint64), 0

    def add(self, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Takes the hashes; whenever the buffer is full, gives what recurs in it (``recurring``)."""
        while len(hashes):
            if self.n == len(self.held):
                yield self.recurring()
            part = hashes[: len(self.held) - self.n]
            self.held[self.n : self.n + len(part)] = part
            self.n += len(part)
            hashes = hashes[len(part) :]

    def recurring(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes that are in the buffer twice or more, and how often; empties it."""
        x, self.n = self.held[: self.n], 0
        x.sort()
        again = np.zeros(len(x) + 1, bool)
        np.equal(x[1:], x[:-1], out=again[1 : len(x)])
        edges = np.flatnonzero(again[1:] != again[:-1])
        return x[edges[::2]].copy(), edges[1::2] - edges[::2] + 1
