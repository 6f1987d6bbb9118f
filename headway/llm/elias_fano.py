"""Elias-Fano sequences, and an n-gram trie whose levels are such sequences in a memory-mapped file."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

import numpy as np

#: Lookups that are made at once: what they need stays in the cache.
CHUNK = 1 << 14

U = np.uint64

#: The place of the k-th one in a byte, at 8 * byte + k.
IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], np.int64).reshape(-1)
#: Every so many ones (or zeros) have their word noted.
NOTED = 32


def _select(words: np.ndarray, before: np.ndarray, noted: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The places of the k-th ones (from 0): `before` counts the ones ahead of each word, `noted` has the word of each
    NOTED-th one. A word is halved down to a byte, and a table has the rest."""
    at = noted[k // NOTED]
    for _ in range(3):
        at = at + (before[at + 1] <= k)
    far = np.flatnonzero(before[at + 1] <= k)
    if len(far):
        at[far] = np.searchsorted(before, k[far], "right") - 1
    word, k, place = words[at], k - before[at], at << 6
    for width in (32, 16, 8):
        ones = np.bitwise_count(word & U((1 << width) - 1)).astype(np.int64)
        upper = k >= ones
        k = k - ones * upper
        step = upper * width
        word = word >> step.astype(U)
        place += step
    return place + IN_BYTE[((word & U(255)).astype(np.int64) << 3) + k]


def _notes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(before, noted) for _select, of the ones in each word."""
    before = np.r_[0, np.cumsum(counts)]
    wanted = np.arange(0, before[-1] + 1, NOTED)
    return before, np.minimum(np.searchsorted(before, wanted, "right") - 1, len(counts) - 1)


class Sequence:
    """A non-decreasing sequence of n integers below a universe, in about n * (3 + log2(universe / n)) bits.

    The low bits are packed; the high bits are counts in unary: bucket h's members are ones before the h-th zero. Ones and
    zeros are found through their counts by words of 64 bits; nothing is unpacked.
    """

    PARTS = 7

    def __init__(self, parts: list[np.ndarray]):
        self.n, self.low_bits, self.buckets = (int(x) for x in parts[0].view(U))
        self.low, self.high = parts[1].view(U), parts[2].view(U)
        self.ones, self.zeros = [x.view(np.int64) for x in parts[3:5]], [x.view(np.int64) for x in parts[5:7]]

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> list[np.ndarray]:
        """The arrays of which a file is made."""
        values, n = values.astype(U), len(values)
        low_bits = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        high = (values >> U(low_bits)).astype(np.int64)
        buckets = int(high[-1]) + 1 if n else 0
        bits = np.zeros(-(-(buckets + n + 1) // 64) * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        words = np.zeros(n * low_bits // 64 + 2, U)
        if low_bits and n:
            low = values & U((1 << low_bits) - 1)
            at = np.arange(n, dtype=U) * U(low_bits)
            word, shift = (at >> U(6)).astype(np.int64), at & U(63)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])  # members that begin in one word are or-ed at once
            words[word[first]] = np.bitwise_or.reduceat(low << shift, first)
            over = (shift + U(low_bits)) > 64  # at most one member runs over the end of a word
            words[word[over] + 1] |= low[over] >> (U(64) - shift[over])
        packed = np.packbits(bits, bitorder="little").view(U)
        counts = np.bitwise_count(packed).astype(np.int64)
        return [np.array([n, low_bits, buckets], U), words, packed, *_notes(counts), *_notes(64 - counts)]

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), U)
        at = i.astype(U) * U(self.low_bits)
        word, shift = (at >> U(6)).astype(np.int64), at & U(63)
        high = np.where(shift == 0, U(0), self.low[word + 1] << ((U(64) - shift) & U(63)))
        return ((self.low[word] >> shift) | high) & U((1 << self.low_bits) - 1)

    def bucket(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the members with high bits h begin and end: after the zero before, and as many on as ones follow it."""
        inside = np.clip(h, 1, max(1, self.buckets - 1))
        zero = _select(~self.high, *self.zeros, inside - 1) + 1
        rest = ~self.high[np.minimum(zero >> 6, len(self.high) - 1)] >> (zero & 63).astype(U)
        ones = np.bitwise_count((rest & (~rest + U(1))) - U(1)).astype(np.int64)
        over = np.flatnonzero((rest == 0) | (zero >> 6 >= len(self.high)))  # no zero is left in the word
        if len(over):
            ones[over] = _select(~self.high, *self.zeros, inside[over]) - zero[over]
        begin = zero - inside
        end = begin + ones
        first = h < 1
        if first.any():
            begin, end = np.where(first, 0, begin), np.where(first, begin if self.buckets > 1 else self.n, end)
        known = h < self.buckets
        return np.where(known, begin, self.n), np.where(known, end, self.n)

    def _search(self, x: np.ndarray, first, last) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(successor's index, end of the part that was searched, low bits wanted)"""
        a, b = self.bucket((x >> U(self.low_bits)).astype(np.int64))
        a, b = np.minimum(np.maximum(a, first), last), np.minimum(np.maximum(b, first), last)
        end, want = b.copy(), x & U((1 << self.low_bits) - 1)
        open_ = np.flatnonzero(a < b)
        while len(open_):
            low, high = a[open_], b[open_]
            mid = (low + high) >> 1
            less = self.lows(mid) < want[open_]
            low, high = np.where(less, mid + 1, low), np.where(less, high, mid)
            a[open_], b[open_] = low, high
            open_ = open_[low < high]
        return a, end, want

    def successor(self, x: np.ndarray, first=0, last=None) -> np.ndarray:
        """The index in [first, last) of the first value that is at least x; last if there is none."""
        return self._search(x.astype(U), first, self.n if last is None else last)[0] if self.n else np.zeros(len(x), np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at indices below n."""
        return ((_select(self.high, *self.ones, i) - i).astype(U) << U(self.low_bits)) | self.lows(i)

    def find(self, x: np.ndarray, first=0, last=None) -> np.ndarray:
        """The index of each x in [first, last), or -1: the successor, if it is in x's bucket with x's low bits."""
        if not self.n:
            return np.full(len(x), -1)
        i, end, want = self._search(x.astype(U), first, self.n if last is None else last)
        return np.where((i < end) & (self.lows(np.minimum(i, self.n - 1)) == want), i, -1)


class Trie:
    """N-grams of one length, each with a code, such as the place of its count among the distinct ones.

    A level holds, for each node of the level above and in its order, the words that follow it, made non-decreasing by the
    node's number times the number of words; and pointers, non-decreasing, to the first successor of each node. A lookup
    goes down from the first word, and at each level looks for the successor among its node's alone.
    """

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        count = int(raw[:8].view(U)[0])
        sizes = raw[8 : 8 + 8 * count].view(U).astype(np.int64)
        at, parts = 8 + 8 * count, []
        for size in sizes:
            parts.append(raw[at : at + size])
            at += -(-int(size) // 8) * 8
        self.universe, self.codes = U(int(parts[0].view(U)[0])), parts[1].view(np.uint32)
        found = [Sequence(parts[k : k + Sequence.PARTS]) for k in range(2, len(parts), Sequence.PARTS)]
        self.levels, self.pointers = found[0::2], found[1::2]

    @classmethod
    def write(cls, path: str, grams: list[np.ndarray], codes: np.ndarray) -> None:
        """From a column for each word of the n-grams, sorted by them, none twice."""
        size, n = len(grams[0]), len(grams)
        universe = 1 + max((int(g.max()) for g in grams if size), default=0)
        arrays = [np.array([universe], U), codes.astype(np.uint32)]
        node, new = np.zeros(size, np.int64), np.zeros(size, bool)
        new[:1] = True
        for k, words in enumerate(grams):
            new = new | np.r_[np.zeros(min(1, size), bool), words[1:] != words[:-1]]
            at = np.flatnonzero(new)
            parents = int(node[-1]) + 1 if size else 0
            arrays += Sequence.encode(node[at].astype(U) * U(universe) + words[at].astype(U), max(1, parents * universe))
            if k + 1 < n:
                node = np.cumsum(new) - 1
                down = new | np.r_[np.zeros(min(1, size), bool), grams[k + 1][1:] != grams[k + 1][:-1]]
                first = (np.cumsum(down) - 1)[at]
                total = int(down.sum())
                arrays += Sequence.encode(np.append(first, total), total + 1)
        with open(path, "wb") as out:
            out.write(np.array([len(arrays), *(a.nbytes for a in arrays)], U).tobytes())
            for a in arrays:
                out.write(a.tobytes() + bytes(-a.nbytes % 8))

    def descend(self, level: int, nodes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The node of `level` that each word leads to from a node of the level above, or -1; -1 stays."""
        out = np.empty(len(nodes), np.int64)
        for i in range(0, len(nodes), CHUNK):
            out[i : i + CHUNK] = self._step(level, nodes[i : i + CHUNK], words[i : i + CHUNK])
        return out

    def _step(self, level: int, nodes: np.ndarray, words: np.ndarray) -> np.ndarray:
        out = np.full(len(nodes), -1)
        at = np.flatnonzero((nodes >= 0) & (words.astype(U) < self.universe))
        if not len(at):
            return out
        up, x = nodes[at], words[at].astype(U)
        if level:
            new = np.r_[True, up[1:] != up[:-1]]
            which, some = np.cumsum(new) - 1, up[new]
            first, last = (self.pointers[level - 1].get(some + d).astype(np.int64)[which] for d in (0, 1))
            out[at] = self.levels[level].find(up.astype(U) * self.universe + x, first, last)
        else:
            out[at] = self.levels[0].find(x)
        return out


class Mapped:
    """A trie in a temporary file of the worker's own, which goes with the block."""

    def __init__(self, grams: list[np.ndarray], codes: np.ndarray):
        handle, self.path = tempfile.mkstemp(suffix=".trie")
        os.close(handle)
        self.arrays = grams, codes

    def __enter__(self) -> Trie:
        Trie.write(self.path, *self.arrays)
        return Trie(self.path)

    def __exit__(self, *_) -> None:
        Path(self.path).unlink(missing_ok=True)
