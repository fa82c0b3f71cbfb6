"""Words, word windows and their hashes over Arrow batches of texts, in numpy.

A word is a maximal run of bytes other than space and the control characters 9 to 13. Whole texts are
used; batches are cut into slices of whole documents so that the arrays of a slice stay small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Text bytes that are worked on at a time, unless one document is larger.
SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))  # one for each half of a 128-bit hash
_LEFT = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))  # odd; tells the left part of a window from the right
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)  # the first n bytes of eight
_BLOCK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of a slice of documents: byte ranges, and the first word of each document (one more at the end)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self, half: int = 0) -> np.ndarray:
        """A 64-bit hash per word: eight bytes at a time are mixed with their place in the word, and summed up."""
        out, i, n = np.empty(len(self.starts), np.uint64), 0, len(self.starts)
        while i < n:
            low = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.ends, low + _BLOCK, "right")))
            data = np.concatenate((self.data[low : self.ends[j - 1]], np.zeros(8, np.uint8)))
            eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
            starts, sizes = self.starts[i:j] - low, self.ends[i:j] - self.starts[i:j]
            counts = (sizes + 7) >> 3
            place = ragged(np.zeros(j - i, np.int64), counts)
            first = np.cumsum(counts) - counts
            at = np.repeat(starts, counts) + 8 * place
            left = np.minimum(np.repeat(sizes, counts) - 8 * place, 8)
            terms = mix((eights[at] & _KEEP[left]) + mix(place.astype(np.uint64) * _GOLDEN + _SEEDS[half]))
            out[i:j] = mix(np.add.reduceat(terms, first) + sizes.astype(np.uint64) * _GOLDEN)
            i = j
        return out

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def arrow_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``limit`` bytes of text, or one row."""
    i = 0
    sizes = np.diff(arrow_bytes(batch.column(column))[1])
    while i < batch.num_rows:
        j = max(i + 1, i + int(np.searchsorted(np.cumsum(sizes[i:]), limit, "right")))
        yield batch.slice(i, j - i)
        i = j


def split_words(column: pa.Array, lower: bool = False) -> Words:
    """The words of each text of a column; with ``lower``, A-Z are lower-cased first."""
    data, offsets = arrow_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1] if len(data) else inside
    after = np.concatenate((inside[1:], [False])) & ~edge[1:] if len(data) else inside
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, width: int, half: int = 0) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` word hashes, also across documents; one per start."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    done, out, power = 0, None, hashes
    step, bits = 1, width
    # Doubling: a window of 2k is two windows of k; ``out`` gathers the parts of width's binary digits.
    # Every step mixes: sums of powers of an odd number alone would agree for some patterns of two words.
    while bits:
        if bits & 1:
            if out is None:
                out, done = power, step
            else:
                n = min(len(out), len(power) - done)
                out = mix(out[:n] * _LEFT[half] + power[done : done + n])
                done += step
        bits >>= 1
        if bits:
            power = mix(power[: len(power) - step] * _LEFT[half] + power[step:])
            step *= 2
    return mix(out[: len(hashes) - width + 1] + np.uint64(width))


def window_counts(words: Words, width: int) -> np.ndarray:
    """Windows of ``width`` words in each document."""
    return np.maximum(words.counts() - (width - 1), 0)


def ragged(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``first[i] .. first[i] + counts[i] - 1`` for every i, one after another."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.repeat(first - (ends - counts), counts) + np.arange(total)
