"""Array helpers that run inside Spark tasks: Arrow text columns are cut into
words and hashed with numpy, a bounded slice of rows at a time.

A word is a maximal run of bytes other than space and ``\\x09-\\x0D``. These
are all ASCII, so cutting UTF-8 bytes gives the same words as cutting code
points. Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text held in arrays at once. One longer text is held alone.
SLICE_BYTES = 1 << 20

_STEP = 0x9E3779B97F4A7C15


def salt(k: int) -> np.uint64:
    """The k-th of a sequence of 64-bit constants."""
    return np.uint64(k * _STEP & 0xFFFFFFFFFFFFFFFF)


_GOLDEN = salt(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser; spreads small input differences over all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_table(seed: int) -> np.ndarray:
    return mix64((np.arange(1, 257, dtype=np.uint64) + np.uint64(seed * 1000)) * _GOLDEN) | np.uint64(1)


_BYTES = _byte_table(1)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWER_BASE = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, dtype=np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        size = max(n, 2 * len(_powers), 256)
        grown = np.full(size, _POWER_BASE, dtype=np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:n]


@dataclass
class Words:
    """Words of a slice of texts. ``start``/``end`` are byte offsets in
    ``data``; word i belongs to text ``doc[i]``; the words of text d are
    ``first[d]:first[d + 1]``; text d is ``data[offsets[d]:offsets[d + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        size = self.end - self.start
        begin = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(begin, size)
        chars = self.data[place + np.repeat(self.start, size)]
        terms = _BYTES[chars] * _powers_to(int(size.max()))[place]
        return mix64(np.add.reduceat(terms, begin) + size.astype(np.uint64) * _GOLDEN)


def inside_words(data: np.ndarray) -> np.ndarray:
    """Whether each byte belongs to a word."""
    return _IS_WORD[data]


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than texts) of an Arrow string column; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offset_buf, data_buf = texts.buffers()
    offsets = np.frombuffer(offset_buf, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def cut_words(texts: pa.Array, lower: bool = False) -> Words:
    """The words of every text; ``lower`` maps A-Z to a-z first."""
    data, offsets = text_buffer(texts)
    if lower:
        data = _LOWER[data]
    inside = _IS_WORD[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, offsets, none, none, none, np.zeros(len(offsets), np.int64))
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[edges] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, start, end, doc, first)


def window_hashes(hashes: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``length`` words, by its first word, and whether the
    run lies inside one text (windows over a text's end are False)."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    rolled = np.zeros(n, np.uint64)
    factor = np.uint64(0xC6A4A7935BD1E995)
    for j in range(length):
        rolled = rolled * factor + hashes[j : j + n]
    return mix64(rolled + salt(length)), doc[:n] == doc[length - 1 :]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows whose texts hold about ``most`` bytes."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    part = np.cumsum(sizes) // most
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        yield batch.slice(lo, hi - lo)


def group_starts(keys: np.ndarray) -> np.ndarray:
    """First index of each run of equal values in a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
