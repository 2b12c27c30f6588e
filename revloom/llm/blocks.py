"""Texts of a record batch as one byte buffer, and hashes of its words and windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Small enough for the arrays of a block to stay in a core's cache.
BLOCK_BYTES = 1 << 18

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2**64."""
    global _powers
    if len(_powers[0]) < length:
        made = []
        for base in (_BASE, _INVERSE):
            steps = np.full(-(-length // BLOCK_BYTES) * BLOCK_BYTES, base)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        _powers = (made[0], made[1])
    return _powers[0][:length], _powers[1][:length]


def forget_powers() -> None:
    """Free the stored powers; they are made again in a few milliseconds."""
    global _powers
    _powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers whose every output bit depends on every input bit."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


class Block:
    """Some whole texts: ``data`` holds their UTF-8 bytes, text i at ``bounds[i]:bounds[i+1]``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int = 0):
        self.data, self.bounds, self.first = data, bounds, first

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def lowered(self) -> Block:
        """With A-Z in lower case."""
        return Block(_LOWER[self.data], self.bounds, self.first)

    def prefix(self) -> np.ndarray:
        """Prefix sums from which any window's hash follows in two steps."""
        up, _ = powers(len(self.data))
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.multiply(_BYTE[self.data], up, out=sums[1:])
        return np.cumsum(sums, out=sums)

    def hashes(self, prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of ``data[begin:end]``, equal for equal bytes wherever they stand."""
        _, down = powers(len(self.data) + 1)
        return mixed((prefix[end] - prefix[begin]) * down[begin])

    def words(self, separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of each word, and for each text the number of its first word (plus the total)."""
        inside = ~separator[self.data]
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        edges = self.bounds[1:-1]
        edges = edges[(edges > 0) & (edges < len(inside))]
        before[edges] = False
        after[edges - 1] = False
        begin = np.flatnonzero(inside & ~before)
        end = np.flatnonzero(inside & ~after) + 1
        return begin, end, np.searchsorted(begin, self.bounds)

    def word_hashes(self, separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word, and for each text the number of its first word (plus the total)."""
        begin, end, firsts = self.words(separator)
        return self.hashes(self.prefix(), begin, end), firsts


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words (runs across texts included)."""
    count = max(0, len(words) - size + 1)
    found = np.zeros(count, np.uint64)
    for step in range(size):
        found = mixed(found + words[step : step + count] + np.uint64(step))
    return found


def blocks(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a batch in blocks of about ``limit`` bytes; a longer text is a block of its own."""
    array = batch.column(column)
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    offsets = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[array.offset : array.offset + len(array) + 1].astype(np.int64)
    raw = array.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
    at = 0
    while at < len(array):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        stop = min(stop, at + 65000, len(array))
        yield Block(data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at], at)
        at = stop
