"""Two-stage suffix sorting of a set of byte strings, and which of their long substrings repeat.

Stage one directly sorts only suffixes that are smaller than their successors, by words of seven
symbols, most significant first, each word only among suffixes that are still equal. Stage two induces
the others by one scan over the buckets of first symbols: a suffix that is greater than its successor
takes its place among those of its bucket in the order of the successors. Then the common prefixes of
neighbours are compared. Only prefixes of ``length`` bytes matter, so suffixes that are shorter are
sorted only where an induced one starts from them, and equal prefixes are sorted once.

Symbols are 0 for the end of a string and byte + 1; no prefix reaches beyond the end of its string.
"""

from __future__ import annotations

import numpy as np

from stratalake.llm import words as W

_SYMBOLS, _BITS = 7, 9


class Strings:
    """Strings joined into one array of symbols, each followed by an end."""

    def __init__(self, strings: list[bytes], length: int):
        sizes = np.array([len(s) for s in strings], np.int64)
        self.length = length
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        body = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        self.symbols = np.zeros(len(body) + 64 * _SYMBOLS + length, np.uint16)
        self.symbols[: len(body)] = body + np.uint16(1)
        self.symbols[self.starts[1:] - 1] = 0
        self.n = len(body)
        self.owner = np.repeat(np.arange(len(strings)), sizes + 1)
        self.left = self.starts[1:][self.owner] - 1 - np.arange(self.n)  # bytes from here to the end of the string
        up, self.down = W.powers(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(W._VALUES[body] * up[: self.n], out=self.sums[1:])

    def prints(self, at: np.ndarray) -> np.ndarray:
        """Fingerprints of the next ``length`` bytes, or of all that are left."""
        size = np.minimum(self.left[at], self.length)
        return W.mix((self.sums[at + size] - self.sums[at]) * self.down[at] + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def rising(self) -> np.ndarray:
        """Whether each suffix is smaller than its successor; ends count as smaller."""
        step = np.sign(self.symbols[1 : self.n + 1].astype(np.int32) - self.symbols[: self.n])
        step[self.starts[1:] - 1] = 1
        decided = np.flatnonzero(step)
        return step[decided[np.searchsorted(decided, np.arange(self.n))]] > 0


def _directly(text: Strings, at: np.ndarray) -> np.ndarray:
    """The positions in the order of their suffixes; those with equal prefixes are next to each other."""
    prints = text.prints(at)
    _, first, which = np.unique(prints, return_index=True, return_inverse=True)
    reps = at[first]
    m = len(text.symbols) - _SYMBOLS + 1
    words = np.zeros(m, np.uint64)
    for k in range(_SYMBOLS):
        words = (words << np.uint64(_BITS)) | text.symbols[k : k + m].astype(np.uint64)
    order = np.argsort(words[reps], kind="stable")
    keys = words[reps[order]]
    same = keys[1:] == keys[:-1]
    for depth in range(_SYMBOLS, text.length + _SYMBOLS, _SYMBOLS):
        if not same.any():
            break
        tied = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        slots = np.flatnonzero(tied)
        group = np.cumsum(np.concatenate([[True], ~same]))[slots]
        mine = order[slots]
        keys = words[np.minimum(reps[mine] + depth, m - 1)]
        sub = np.lexsort((keys, group))
        order[slots] = mine[sub]
        keys, group = keys[sub], group[sub]
        still = np.zeros(len(same), bool)
        pair = (slots[1:] == slots[:-1] + 1) & (group[1:] == group[:-1]) & (keys[1:] == keys[:-1])
        still[slots[:-1][pair]] = True
        same = still
    rank = np.empty(len(reps), np.int64)
    rank[order] = np.arange(len(reps))
    return at[np.argsort(rank[which], kind="stable")]


def suffix_array(text: Strings) -> np.ndarray:
    """Positions of all suffixes of ``length`` bytes or more, in order of their first ``length`` bytes."""
    rising = text.rising()
    long_enough = text.left >= text.length
    # the first rising suffix behind the last long one of each string, from which induction starts
    falls = np.flatnonzero(rising)
    lasts = text.starts[1:] - 1 - text.length
    anchors = falls[np.searchsorted(falls, lasts[lasts >= text.starts[:-1]] + 1)]
    wanted = long_enough & rising
    wanted[anchors] = True
    direct = _directly(text, np.flatnonzero(wanted))
    symbols = text.symbols
    bounds = np.searchsorted(symbols[direct], np.arange(258))
    waiting: list[list[np.ndarray]] = [[] for _ in range(257)]
    out: list[np.ndarray] = []
    inside = np.ones(text.n, bool)
    inside[text.starts[:-1]] = False  # has a predecessor in its string

    def send(chunk: np.ndarray, bucket: int) -> np.ndarray:
        """Places the falling predecessors of a chunk; returns those of the same bucket."""
        before = chunk[inside[chunk]] - 1
        before = before[~rising[before]]
        heads = symbols[before]
        here = before[heads == bucket]
        there = before[heads != bucket]
        if len(there):
            heads = symbols[there]
            order = np.argsort(heads, kind="stable")
            there, heads = there[order], heads[order]
            cuts = np.flatnonzero(heads[1:] != heads[:-1]) + 1
            for part in np.split(there, cuts):
                waiting[symbols[part[0]]].append(part)
        return here

    for bucket in range(257):
        chunk = np.concatenate(waiting[bucket]) if waiting[bucket] else direct[:0]
        waiting[bucket] = []
        while len(chunk):
            out.append(chunk)
            chunk = send(chunk, bucket)
        chunk = direct[bounds[bucket] : bounds[bucket + 1]]
        if len(chunk):
            out.append(chunk)
            send(chunk, bucket)
    found = np.concatenate(out) if out else direct
    return found[long_enough[found]]


def repeated(strings: list[bytes], weights: list[int], length: int) -> list[list[tuple[int, int]]]:
    """Per string: runs [a, b) of starts of ``length``-byte substrings that start elsewhere too.

    A string of weight over 1 stands for several places, so all its substrings repeat.
    """
    if not strings:
        return []
    text = Strings(strings, length)
    order = suffix_array(text)
    hit = np.zeros(text.n, bool)
    prints = text.prints(order)
    equal = np.flatnonzero(prints[1:] == prints[:-1])
    for k in range(0, len(equal), 4096):  # the common prefix of neighbours, byte by byte
        a, b = order[equal[k : k + 4096]], order[equal[k : k + 4096] + 1]
        window = np.arange(length)
        sure = (text.symbols[a[:, None] + window] == text.symbols[b[:, None] + window]).all(axis=1)
        hit[a[sure]] = True
        hit[b[sure]] = True
    hit |= (np.array(weights)[text.owner] > 1) & (text.left >= length)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    out: list[list[tuple[int, int]]] = [[] for _ in strings]
    for owner, a, b in zip(text.owner[begins].tolist(), (begins - text.starts[text.owner[begins]]).tolist(), (ends - text.starts[text.owner[begins]]).tolist()):
        out[owner].append((a, b))
    return out
