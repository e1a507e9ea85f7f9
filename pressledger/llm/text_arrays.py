"""Whole columns of texts as flat numpy arrays: words, hashes and shingles without a Python loop over words.

A batch of texts is one byte array with start and end offsets; words are runs of bytes outside ``\\x20`` and
``\\x09-\\x0D`` (all of them ASCII, so bytes of UTF-8 do). Hashes have 64 bits and are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text that are laid out in arrays at a time; one longer text is taken alone
SLICE_BYTES = 1 << 19
STEP = np.uint64(0x9E3779B97F4A7C15)
#: odd base of the polynomial over the bytes of a word, and its inverse modulo 2**64
BASE = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x + STEP
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of pieces of a batch; null texts are empty."""
    texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    if len(texts) == 0:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), first + 60_000, len(texts))
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def space_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a word ends where its text ends."""
    inside = ~space_table()[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """64-bit hashes of byte ranges from one running sum; keeps its tables between batches."""

    def __init__(self) -> None:
        self.values = mix(np.arange(1, 257, dtype=np.uint64))
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) < len(data):
            self.up, self.down = powers(BASE, len(data)), powers(INVERSE, len(data))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[:len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * self.down[starts] if len(data) else np.zeros(0, np.uint64))


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words inside a text, and its text's index. A text of fewer words is one shingle of
    all its words; a text without words has none."""
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), counts)
    whole = mix(hashes + np.uint64(width))
    left = (first + counts)[owner] - np.arange(len(hashes))  # words from here to the end of the text
    for k in range(1, width):
        following = np.zeros_like(hashes)
        following[:max(len(hashes) - k, 0)] = hashes[k:]
        # the hash stops at the text's end, so that a short text is hashed with its number of words
        whole = np.where(left > k, mix(whole * np.uint64(3) + following), whole)
    short = counts < width
    keep = np.where(short[owner], np.arange(len(hashes)) == first[owner], left >= width)
    return whole[keep], owner[keep]


def distinct(values: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, one text after the other, and the number of them by text."""
    order = np.argsort(values)
    order = order[np.argsort(owner[order].astype(np.uint16 if texts < 65536 else np.int64), kind="stable")]
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.bincount(owner[new], minlength=texts)


def text_words(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of words by text."""
    starts, ends = word_bounds(data, offsets)
    return hasher(data, starts, ends), np.diff(np.searchsorted(starts, offsets))


def ragged(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column whose row i holds the next ``sizes[i]`` values."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64) if kind == pa.int64() else values, kind))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values[bounds[i]:bounds[i + 1]]`` for each i, 0 for empty ranges."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
