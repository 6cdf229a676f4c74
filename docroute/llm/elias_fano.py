"""Elias-Fano sequences and an n-gram trie made of them, over one buffer.

A monotone sequence of n numbers below u takes about 2 + log2(u / n) bits each:
the low bits as they are, the high ones in unary.  The trie has one level per
order.  A node's children are a stretch of the next level, found by pointers,
which are monotone; the children's words, made monotone by adding up the
stretches, are a sequence too.  From the third level on a word stands for its
place among the successors of the word before it ("context-relative"), a much
smaller number than its id.  Next to a word is the quantised log10 probability.

Questions come as arrays: all n-grams of a text are looked up together, each by
a successor search among the few elements with its high bits.  The buffer may be
a memory map, of a file or anonymous; nothing is copied on opening it.
"""

from __future__ import annotations

import mmap

import numpy as np

#: Steps per power of ten in quantised log10 probabilities.
STEPS = 256


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 * STEPS), 0, 65535).astype("<u2")


class Writer:
    """Collects arrays and lays them out in one buffer."""

    def __init__(self):
        self.parts: list[np.ndarray] = []

    def add(self, array: np.ndarray) -> None:
        self.parts.append(np.ascontiguousarray(array))

    def sequence(self, values: np.ndarray, universe: int) -> None:
        """Add a monotone sequence of numbers below ``universe`` (<= 2**64)."""
        n = len(values)
        low = max(0, min(56, (universe // max(n, 1)).bit_length() - 1))
        values = values.astype(np.uint64)
        self.add(np.array([n, low], "<u8"))
        bits = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        packed = np.packbits(bits.reshape(-1), bitorder="little")
        self.add(np.concatenate([packed, np.zeros(8, np.uint8)]))
        high = (values >> np.uint64(low)).astype(np.int64)
        unary = np.zeros(n + (int(high[-1]) if n else 0) + 1, np.uint8)
        unary[high + np.arange(n)] = 1
        self.add(np.array([len(unary)], "<u8"))
        self.add(np.packbits(unary))

    def buffer(self) -> mmap.mmap:
        """The parts in an anonymous memory map, each after its length."""
        size = sum(8 + p.nbytes + -p.nbytes % 8 for p in self.parts)
        out = mmap.mmap(-1, max(size, 1))
        for part in self.parts:
            out.write(np.array([part.nbytes], "<u8").tobytes())
            out.write(part.tobytes() + bytes(-part.nbytes % 8))
        return out

    def save(self, path: str) -> None:
        with open(path, "wb") as file:
            file.write(self.buffer())


class Reader:
    def __init__(self, buffer):
        self.raw, self.at = np.frombuffer(buffer, np.uint8), 0

    def next(self, dtype) -> np.ndarray:
        size = int(self.raw[self.at : self.at + 8].view("<u8")[0])
        part = self.raw[self.at + 8 : self.at + 8 + size].view(dtype)
        self.at += 8 + size + -size % 8
        return part

    def sequence(self) -> Sequence:
        return Sequence(self)


class Sequence:
    def __init__(self, reader: Reader):
        n, low = reader.next("<u8")
        self.n, self.low = int(n), int(low)
        self.lows = reader.next(np.uint8)
        length = int(reader.next("<u8")[0])
        unary = np.unpackbits(reader.next(np.uint8), count=length).view(bool)
        # Places of the ones and zeros: select in one step.
        self.ones = np.flatnonzero(unary)
        self.zeros = np.flatnonzero(~unary)
        self.words = np.ndarray((max(len(self.lows) - 7, 0),), "<u8", buffer=self.lows, strides=(1,))

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places ``i``."""
        high = (self.ones[i] - i).astype(np.uint64)
        return high << np.uint64(self.low) | self._low(i)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low
        return self.words[bit >> 3] >> (bit & 7).astype(np.uint64) & np.uint64((1 << self.low) - 1)

    def find(self, values: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> np.ndarray:
        """The place of each value (in places lo to hi - 1), or -1."""
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.low)).astype(np.int64)
        low = values & np.uint64((1 << self.low) - 1)
        inside = high < len(self.zeros)
        h = np.where(inside, high, 0)
        # Elements with these high bits stand between two zeros of the unary part.
        a = np.where(h > 0, self.zeros[np.maximum(h - 1, 0)] - (h - 1), 0)
        b = self.zeros[h] - h if len(self.zeros) else np.zeros(len(h), np.int64)
        b = np.where(inside, b, a)
        if lo is not None:
            a, b = np.maximum(a, lo), np.minimum(b, hi)
        out = np.full(len(values), -1)
        live = np.flatnonzero(a < b)
        a, b, low = a[live], b[live], low[live]
        while len(live):
            mid = (a + b) >> 1
            got = self._low(mid)
            hit = got == low
            out[live[hit]] = mid[hit]
            less = got < low
            a, b = np.where(less, mid + 1, a), np.where(less, b, mid)
            go = ~hit & (a < b)
            live, a, b, low = live[go], a[go], b[go], low[go]
        return out


def build(words: np.ndarray, tokens: np.ndarray, at: list[np.ndarray], log10: list[np.ndarray]) -> Writer:
    """A trie of the n-grams of some texts.

    ``words``: the distinct words (64-bit values), sorted.  ``tokens``: the texts
    as places of words.  ``at[k]``: where the n-grams of order k + 1 begin, in
    order; all tokens for order one.  ``log10[k]``: the log10 probability of the
    last word of each.
    """
    out = Writer()
    v = len(words)
    out.add(np.array([len(at), v], "<u8"))
    out.sequence(words, 1 << 64)
    first = np.zeros(v, "<u2")
    first[tokens] = quantised(log10[0])
    out.add(first)
    # Per token, the node of the n-gram of the order at hand that begins there.
    nodes, n_nodes, pairs, pair_starts = tokens.astype(np.int64), v, None, None
    for k in range(1, len(at)):
        here = at[k]
        parents = nodes[here]
        if k == 1:
            last = tokens[here + 1].astype(np.int64)
        else:
            # Place of the last word among the successors of the one before it.
            last = pairs[here + k - 1] - pair_starts[tokens[here + k - 1]]
        span = int(last.max()) + 1 if len(last) else 1
        keys, one, back = np.unique(parents * span + last, return_index=True, return_inverse=True)
        parent, relative = keys // span, keys % span
        starts = np.searchsorted(parent, np.arange(n_nodes + 1))
        out.sequence(starts, len(keys) + 1)
        # Each stretch is moved up by the last words of those before it.
        filled = np.flatnonzero(np.diff(starts))
        tops = np.zeros(n_nodes + 1, np.int64)
        tops[filled + 1] = relative[starts[filled + 1] - 1] + 1
        base = np.cumsum(tops)
        out.sequence(relative + base[parent], int(base[-1]) + 1)
        out.sequence(base, int(base[-1]) + 1)
        out.add(quantised(log10[k][one]))
        nodes, n_nodes = np.full(len(tokens), -1), len(keys)
        nodes[here] = back
        if k == 1:
            pairs, pair_starts = nodes, starts
    return out


class Trie:
    def __init__(self, buffer):
        reader = Reader(buffer)
        self.order, self.n_words = (int(x) for x in reader.next("<u8"))
        self.words = reader.sequence()
        self.codes = [reader.next("<u2")]
        self.starts, self.children, self.bases = [], [], []
        for _ in range(1, self.order):
            self.starts.append(reader.sequence())
            self.children.append(reader.sequence())
            self.bases.append(reader.sequence())
            self.codes.append(reader.next("<u2"))

    @classmethod
    def open(cls, path: str) -> Trie:
        with open(path, "rb") as file:
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def word(self, values: np.ndarray) -> np.ndarray:
        """The places of words, -1 if unknown."""
        return self.words.find(values)

    def _child(self, level: int, parents: np.ndarray, last: np.ndarray) -> np.ndarray:
        ok = (parents >= 0) & (last >= 0)
        p, w = np.where(ok, parents, 0), np.where(ok, last, 0)
        starts = self.starts[level]
        lo, hi = starts[p].astype(np.int64), starts[p + 1].astype(np.int64)
        base = self.bases[level][p]
        found = self.children[level].find(w.astype(np.uint64) + base, lo, hi)
        return np.where(ok, found, -1)

    def nodes(self, grams: np.ndarray) -> np.ndarray:
        """The nodes of n-grams given as an array (m, order) of word places; -1
        for those that the trie does not hold."""
        if grams.shape[1] == 1:
            return grams[:, 0]
        if grams.shape[1] == 2:
            return self._child(0, grams[:, 0], grams[:, 1])
        pairs = self._child(0, grams[:, -2], grams[:, -1])
        parents = self.nodes(grams[:, :-1])
        first = self.starts[0][np.maximum(grams[:, -2], 0)].astype(np.int64)
        return self._child(grams.shape[1] - 2, parents, np.where(pairs >= 0, pairs - first, -1))

    def scores(self, places: np.ndarray, at: list[np.ndarray]) -> np.ndarray:
        """The log10 probability of each token of some texts, given as places of
        words, in the longest context the trie has; ``at`` as in ``build``."""
        each = self._read(0, places)
        nodes, pairs = places, None
        for k in range(1, self.order):
            here = at[k]
            if k == 1:
                last = places[here + 1]
            else:
                first = self.starts[0][np.maximum(places[here + k - 1], 0)].astype(np.int64)
                last = np.where(pairs[here + k - 1] >= 0, pairs[here + k - 1] - first, -1)
            found = self._child(k - 1, nodes[here], last)
            each[here + k] = self._read(k, found)
            nodes = np.full(len(places), -1)
            nodes[here] = found
            if k == 1:
                pairs = nodes
        return each

    def _read(self, level: int, nodes: np.ndarray) -> np.ndarray:
        codes = self.codes[level]
        if not len(codes):
            return np.full(len(nodes), np.nan)
        return np.where(nodes >= 0, codes[np.maximum(nodes, 0)] / -float(STEPS), np.nan)

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """The stored log10 probabilities; nan for n-grams it does not hold."""
        return self._read(grams.shape[1] - 1, self.nodes(grams))
