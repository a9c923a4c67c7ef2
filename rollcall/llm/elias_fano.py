"""Elias-Fano sequences that are searched in compact form, and a two-level n-gram trie built of them."""

from __future__ import annotations

import tempfile

import numpy as np

ONE, WORD = np.uint64(1), np.uint64(64)
#: Queries answered at once: bounds the memory of the arrays between.
SLICE = 1 << 18


def select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the ``k``-th (from 0) set bit of each word, by halving: six counts of bits."""
    words, k = words.copy(), k.astype(np.int64)
    at = np.zeros(len(words), np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(words & np.uint64((1 << width) - 1)).astype(np.int64)
        up = k >= below
        k -= np.where(up, below, 0)
        at += np.where(up, width, 0)
        words >>= np.where(up, np.uint64(width), np.uint64(0))
    return at


class EliasFano:
    """A non-decreasing sequence of unsigned numbers in about ``3 + log2(universe / n)`` bits each.

    The low bits of each value are packed; the high bits are a bit vector with one set bit for each
    value, at (high part + position). A directory holds the set bits before each 64-bit word of that
    vector. ``words`` may be memory-mapped: queries touch the words that they need and decode nothing.
    """

    HEAD = 4

    def __init__(self, words: np.ndarray):
        self.words = words
        self.n, self.low_bits, self.n_words, self.top = (int(x) for x in words[: self.HEAD])
        a = self.HEAD + self.n_words
        b = a + -(-self.n_words // 2)
        self.high, self.before, self.low = words[self.HEAD : a], words[a:b].view(np.uint32)[: self.n_words], words[b:]

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if n >= 1 << 31:
            raise OverflowError("a level holds fewer than 2^31 values; use more shards")
        last = int(values[-1]) if n else 0
        low_bits = max(0, ((last + 1) // max(n, 1)).bit_length() - 1)
        top = last >> low_bits
        n_words = -(-(n + top + 1) // 64)  # a zero follows each high part, the largest one's too
        bits = np.zeros(n_words * 64, np.uint8)
        bits[((values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)).astype(np.int64)] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        before = np.zeros(-(-n_words // 2) * 2, np.uint32)
        before[1:n_words] = np.cumsum(np.bitwise_count(high[:-1]), dtype=np.uint32)
        low = np.zeros(-(-n * low_bits // 64) * 64 + 64 * (low_bits > 0), np.uint8)  # one spare word: a value may reach into it
        for k in range(low_bits):  # one bit plane at a time keeps the memory to a byte for each low bit
            low[k : n * low_bits : low_bits] = (values >> np.uint64(k)) & ONE
        packed = np.packbits(low, bitorder="little").view(np.uint64)
        return cls(np.concatenate([np.array([n, low_bits, n_words, top], np.uint64), high, before.view(np.uint64), packed]))

    def _low(self, at: np.ndarray) -> np.ndarray:
        """Low bits of the values at these positions."""
        if not self.low_bits:
            return np.zeros(len(at), np.uint64)
        bit = at.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        value = self.low[word] >> shift
        value |= (self.low[word + 1] << (np.uint64(63) - shift)) << ONE
        return value & np.uint64((1 << self.low_bits) - 1)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Position of the ``k``-th (from 0) zero of the high bits."""
        zeros = np.arange(self.n_words, dtype=np.int64) * 64 - self.before
        word = np.searchsorted(zeros, k, side="right") - 1
        return word * 64 + select_in_word(~self.high[word], k - zeros[word])

    def get(self, at: np.ndarray) -> np.ndarray:
        """Values at these positions."""
        at = np.asarray(at, np.int64)
        word = np.searchsorted(self.before, at, side="right") - 1
        bit = word * 64 + select_in_word(self.high[word], at - self.before[word])
        return ((bit - at).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(at)

    def next_geq(self, queries: np.ndarray) -> np.ndarray:
        """Position of the first value at or above each query (``n`` where there is none).

        The values that share the query's high part lie between two zeros of the high bits; among
        them the low bits are searched by halving.
        """
        queries = np.asarray(queries, np.uint64)
        out = np.full(len(queries), self.n, np.int64)
        if not self.n:
            return out
        inside = np.flatnonzero((queries >> np.uint64(self.low_bits)) <= np.uint64(self.top))
        for i in range(0, len(inside), SLICE):
            part = inside[i : i + SLICE]
            q = queries[part]
            high = (q >> np.uint64(self.low_bits)).astype(np.int64)
            lo = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) + 1 - high, 0)
            hi = self._zero(high) - high
            want = q & np.uint64((1 << self.low_bits) - 1)
            while (open_ := np.flatnonzero(lo < hi)).size:
                middle = (lo[open_] + hi[open_]) >> 1
                less = self._low(middle) < want[open_]
                lo[open_] = np.where(less, middle + 1, lo[open_])
                hi[open_] = np.where(less, hi[open_], middle)
            out[part] = lo
        return out


#: Steps a decade, and the code of an entry that isn't there. 16 bits reach 10^-16.
STEPS, ABSENT = 4000, 0


def quantise(log10p: np.ndarray) -> np.ndarray:
    """Codes of log10 probabilities: 1 is 0, each step 1/4000 of a decade less; the error is at most half a step."""
    return np.clip(np.rint(-log10p * STEPS) + 1, 1, 65535).astype(np.uint16)


def dequantise(codes: np.ndarray) -> np.ndarray:
    return -(codes.astype(np.float64) - 1) / STEPS


class Trie:
    """Pairs (context, follower) with a quantised probability each.

    Level 1 holds the contexts, sorted. ``starts`` are the monotone pointers to where each context's
    followers begin in level 2. Level 2 holds the followers; a follower is stored relative to its
    context, on top of the last value of the context before, which keeps the level monotone. A query
    finds its context by successor search in level 1 and its follower by successor search for
    base + follower, which can only hit within the context's own range.
    """

    def __init__(self, contexts: EliasFano, starts: EliasFano, followers: EliasFano, codes: np.ndarray):
        self.contexts, self.starts, self.followers, self.codes = contexts, starts, followers, codes

    @classmethod
    def build(cls, context: np.ndarray, follower: np.ndarray, log10p: np.ndarray) -> Trie:
        """Arguments sorted by (context, follower), without repeats."""
        ids, first = np.unique(context, return_index=True)
        starts = np.append(first, len(context)).astype(np.uint64)
        f = follower.astype(np.uint64)
        last = f[starts[1:].astype(np.int64) - 1] + ONE if len(ids) else f[:0]
        base = np.concatenate([np.zeros(1, np.uint64), np.cumsum(last, dtype=np.uint64)[:-1]]) if len(ids) else last
        relative = f + np.repeat(base, np.diff(starts.astype(np.int64)))
        return cls(EliasFano.encode(ids), EliasFano.encode(starts), EliasFano.encode(relative), quantise(log10p))

    def to_bytes(self) -> bytes:
        parts = [self.contexts.words, self.starts.words, self.followers.words]
        codes = np.zeros(-(-len(self.codes) // 4) * 4, np.uint16)
        codes[: len(self.codes)] = self.codes
        sizes = np.array([len(p) for p in parts] + [len(self.codes)], np.uint64)
        return np.concatenate([sizes, *parts, codes.view(np.uint64)]).tobytes()

    @classmethod
    def from_words(cls, words: np.ndarray) -> Trie:
        sizes = [int(x) for x in words[:4]]
        at, levels = 4, []
        for n in sizes[:3]:
            levels.append(EliasFano(words[at : at + n]))
            at += n
        return cls(*levels, words[at:].view(np.uint16)[: sizes[3]])

    @classmethod
    def mapped(cls, blob: bytes) -> Trie:
        """The trie in a memory-mapped file of the task; the file has no name any more once it is mapped."""
        with tempfile.TemporaryFile() as f:
            f.write(blob)
            f.flush()
            return cls.from_words(np.memmap(f, np.uint64, "r"))

    def lookup(self, context: np.ndarray, follower: np.ndarray) -> np.ndarray:
        """Codes of the pairs; ``ABSENT`` for pairs that aren't there."""
        codes = np.zeros(len(context), np.uint16)
        if not self.contexts.n or not len(context):
            return codes
        asked, where = np.unique(context, return_inverse=True)
        c = self.contexts.next_geq(asked)
        there = np.minimum(c, self.contexts.n - 1)
        known = (c < self.contexts.n) & (self.contexts.get(there) == asked)
        begin, end = self.starts.get(there).astype(np.int64), self.starts.get(there + 1).astype(np.int64)
        # The last value of the context before, plus one, is this one's base.
        base = np.where(begin > 0, self.followers.get(np.maximum(begin - 1, 0)) + ONE, np.uint64(0))
        pairs = np.flatnonzero(known[where])
        of = where[pairs]
        want = follower[pairs].astype(np.uint64) + base[of]
        at = self.followers.next_geq(want)
        inside = np.flatnonzero(at < end[of])
        hit = inside[self.followers.get(at[inside]) == want[inside]]
        codes[pairs[hit]] = self.codes[at[hit]]
        return codes
