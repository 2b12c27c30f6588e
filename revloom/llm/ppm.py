"""Prediction by partial matching over bytes, frozen statistics, symbol exclusion.

A gram of order k is a symbol and the k symbols before it, packed into an integer (the
symbol in the lowest byte); its context is the gram without the symbol.  Symbol 0 ends a
text and, as context, stands for what lies before its begin; a NUL byte in a text is read
as byte 1.

Escape estimation is method D: in a context seen N times with D distinct symbols, one seen
n times has probability (n - 1/2) / N, a new symbol D / 2N.  What a longer context has seen is excluded from the
shorter ones.  With frozen counts a shorter context has seen all that the longer one has,
so the excluded count at the shorter context is a fixed number X per longer context:
the sum of the shorter context's counts over the longer one's symbols.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from revloom.llm.blocks import Block

SYMBOLS = 256


def low(order: int) -> int:
    """Mask of a gram of this order."""
    return (1 << (8 * (order + 1))) - 1


def grams(block: Block, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The order-``order`` gram of every symbol of every text, ends included, and its text's number."""
    lengths = np.diff(block.bounds)
    pad = order + 1
    shift = np.arange(len(block)) * pad + pad
    padded = np.zeros(len(block.data) + (len(block) + 1) * pad, np.uint8)
    padded[np.arange(len(block.data)) + np.repeat(shift, lengths)] = np.maximum(block.data, 1)
    symbols = len(block.data) + len(block)
    owner = np.repeat(np.arange(len(block)), lengths + 1)
    at = np.arange(symbols) + pad + owner * (pad - 1)
    wide = padded.astype(np.uint64)
    codes = np.zeros(len(padded) - order, np.uint64)
    for back in range(order + 1):
        codes |= wide[order - back : len(wide) - back] << np.uint64(8 * back)
    return codes[at - order], owner


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and how often each occurs."""
    ordered = np.sort(codes)
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    begin = np.flatnonzero(new)
    return ordered[begin], np.diff(np.append(begin, len(ordered)))


def per_text(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes, and for every occurrence (in order of code) the code's number and its text.

    Needs grams of order 5 at most and blocks of fewer than 65,536 texts: both share 64 bits.
    """
    ordered = np.sort(codes << np.uint64(16) | owner.astype(np.uint64))
    owner = (ordered & np.uint64(0xFFFF)).astype(np.int64)
    ordered >>= np.uint64(16)
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return ordered[new].astype(np.int64), np.cumsum(new) - 1, owner


class Counter:
    """Adds up gram counts over the batches of a task."""

    def __init__(self, limit: int = 1 << 20):
        self.limit, self.held, self.parts = limit, 0, []

    def add(self, codes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Yields sums whenever more than ``limit`` distinct codes are held."""
        self.parts.append((codes, counts))
        self.held += len(codes)
        if self.held > self.limit:
            codes, counts = self._merged()
            if len(codes) > self.limit // 2:
                yield codes, counts
                self.parts, self.held = [], 0
            else:
                self.parts, self.held = [(codes, counts)], len(codes)

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        codes = np.concatenate([c for c, _ in self.parts])
        counts = np.concatenate([n for _, n in self.parts])
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        begin = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        return codes[begin], np.add.reduceat(counts, begin)

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.held:
            yield self._merged()


def log_probabilities(codes: np.ndarray, order: int, gram, context) -> np.ndarray:
    """log10 of the probability of each gram's symbol after its context.

    ``codes`` are sorted grams of order ``order``.  ``gram(k, sorted grams)`` gives their
    counts, ``context(k, sorted contexts)`` gives N, D and X of each, 0 where unseen.
    """
    out = np.zeros(len(codes))
    left = np.arange(len(codes))
    excluded, passed = np.zeros(len(codes)), np.zeros(len(codes))
    for k in range(order, -1, -1):
        if not len(left):
            return out
        own = codes[left] & low(k)
        n = _unsorted(own, lambda keys, k=k: [gram(k, keys)])[0]
        total, distinct, mass = _unsorted(own >> 8, lambda keys, k=k: context(k, keys))
        seen = total > 0
        open_ = distinct - passed
        whole = total - excluded
        hit = n > 0
        out[left[hit]] += np.log10((n[hit] - 0.5) / whole[hit])
        # Where the longer contexts have seen all this one has, escape is certain.
        escape = seen & ~hit & (open_ > 0)
        out[left[escape]] += np.log10(open_[escape] / (2 * whole[escape]))
        excluded, passed = np.where(seen, mass, 0)[~hit], np.where(seen, distinct, 0)[~hit]
        left = left[~hit]
    out[left] -= np.log10(SYMBOLS - passed)
    return out


def _unsorted(keys: np.ndarray, find) -> list[np.ndarray]:
    """``find`` over the distinct keys in order, spread out to all keys."""
    if not len(keys) or (keys[1:] > keys[:-1]).all():
        return find(keys)
    distinct, place = np.unique(keys, return_inverse=True)
    return [column[place] for column in find(distinct)]


class Tree:
    """A context tree small enough for one task, from the counts of its longest grams."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, order: int):
        self.order, self.grams, self.contexts = order, [], []
        codes, counts = np.asarray(codes, np.int64), np.asarray(counts, np.float64)
        for k in range(order + 1):
            own, place = np.unique(codes & low(k), return_inverse=True)
            self.grams.append((own, np.bincount(place, counts, len(own)) if len(own) else np.zeros(0)))
            own_counts = self.grams[k][1]
            keys, place = np.unique(own >> 8, return_inverse=True)
            shorter = self._count(k - 1, own & low(k - 1)) if k else np.zeros(len(own))
            sums = [np.bincount(place, w, len(keys)) if len(keys) else np.zeros(0) for w in (own_counts, None, shorter)]
            self.contexts.append((keys, sums))

    def _count(self, k: int, keys: np.ndarray) -> np.ndarray:
        stored, counts = self.grams[k]
        return _look(stored, [counts], keys)[0]

    def score(self, codes: np.ndarray) -> np.ndarray:
        """log10 probabilities of sorted grams of the tree's order."""
        return log_probabilities(codes, self.order, self._count, lambda k, keys: _look(*self.contexts[k], keys))


def _look(stored: np.ndarray, columns: list[np.ndarray], keys: np.ndarray) -> list[np.ndarray]:
    if not len(stored):
        return [np.zeros(len(keys)) for _ in columns]
    at = np.minimum(np.searchsorted(stored, keys), len(stored) - 1)
    hit = stored[at] == keys
    return [np.where(hit, column[at], 0) for column in columns]
