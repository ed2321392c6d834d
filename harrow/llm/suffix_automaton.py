"""A suffix automaton of weighted sequences, for matching statistics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """All substrings of the given (sequence, weight) pairs, each with its weighted number of occurrences."""

    def __init__(self, sequences: Iterable[tuple[Sequence[int], int]], *, recurring: int):
        """``recurring``: how many occurrences make a substring count in ``matches``."""
        self.length, self.link, self.next = [0], [-1], [{}]
        weight = [0]
        for symbols, times in sequences:
            last = 0
            for c in symbols:
                last = self._extend(last, c, weight)
                weight[last] += times
        order = sorted(range(len(self.length)), key=self.length.__getitem__)
        for v in reversed(order[1:]):
            if self.link[v] > 0:
                weight[self.link[v]] += weight[v]
        # The nearest state on the way to the root whose substrings occur often enough.
        self.often = [0] * len(self.length)
        for v in order[1:]:
            self.often[v] = v if weight[v] >= recurring else self.often[self.link[v]]

    def _state(self, length: int, link: int, following: dict, weight: list[int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        weight.append(0)
        return len(self.length) - 1

    def _split(self, p: int, q: int, c: int, weight: list[int]) -> int:
        """The state of p's substrings followed by c, taken out of q."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]), weight)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int, weight: list[int]) -> int:
        if (q := self.next[last].get(c)) is not None:  # an earlier sequence has it
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c, weight)
        new, p = self._state(self.length[last] + 1, 0, {}, weight), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c, weight)
        return new

    def matches(self, symbols: Sequence[int]) -> list[int]:
        """Matching statistics: of each position, the length of the longest recurring substring that ends there."""
        out, v, n = [], 0, 0
        for c in symbols:
            while v and c not in self.next[v]:
                v = self.link[v]
                n = self.length[v]
            v, n = (self.next[v][c], n + 1) if c in self.next[v] else (0, 0)
            often = self.often[v]
            out.append(n if often == v else self.length[often])
        return out


def spans(statistics: Sequence[int], least: int) -> list[tuple[int, int]]:
    """The maximal stretches [begin, end) that recurring substrings of ``least`` symbols or more cover."""
    out: list[list[int]] = []
    for i, n in enumerate(statistics):
        if n >= least:
            begin = i + 1 - n
            if out and begin <= out[-1][1]:
                out[-1][0], out[-1][1] = min(begin, out[-1][0]), i + 1
                while len(out) > 1 and out[-1][0] <= out[-2][1]:
                    begin, end = out.pop()
                    out[-1] = [min(begin, out[-1][0]), max(end, out[-1][1])]
            else:
                out.append([begin, i + 1])
    return [(a, b) for a, b in out]
