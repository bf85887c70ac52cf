"""Words, hashes and n-grams of whole Arrow batches in numpy.

A word is a run of bytes other than space and 0x09-0x0D. Words never cross documents. Null
texts count as empty. Hashes are 64-bit and the same in every process, so tables may be keyed
by them; two different words share one with a chance of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time; bounds the memory of a task beside its longest document.
SLICE_BYTES = 4 << 20
WINDOW = 1 << 18

MIX_A, MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
BASE = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * MIX_A
    x = x ^ (x >> np.uint64(33))
    x = x * MIX_B
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def borders(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of documents that lie one after the other."""
    word = ~SPACE[data]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] |= word[first]
    ends[first[first > 0] - 1] |= word[first[first > 0] - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


class Hasher:
    """Positional hashes of byte ranges; one per task, as it holds tables of powers."""

    def __init__(self, lower: bool):
        self.values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
        if lower:
            self.values[65:91] = self.values[97:123]
        self.up = powers(BASE, WINDOW)
        self.down = powers(pow(BASE, -1, 1 << 64), WINDOW)

    def grown(self, n: int) -> None:
        if n > len(self.up):
            self.up, self.down = powers(BASE, n), powers(pow(BASE, -1, 1 << 64), n)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """One more entry than bytes; ``ranges`` turns it into hashes of ranges."""
        self.grown(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], dtype=np.uint64, out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((prefix[ends] - prefix[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of the words of documents that lie one after the other."""
        starts, ends = borders(data, offsets)
        hashes = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            low = starts[at]
            to = max(at + 1, int(np.searchsorted(ends, low + WINDOW - 1, side="right")))
            hashes[at:to] = self.ranges(self.prefix(data[low : ends[to - 1]]), starts[at:to] - low, ends[at:to] - low)
            at = to
        return starts, ends, hashes


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 of all texts one after the other, and where each begins; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("") if texts.null_count else texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about SLICE_BYTES of text; a longer document is alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = bytes_of(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def grams(hashes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words within documents of ``counts`` words, and their documents.

    A run is named by the position of its first word; the second array holds, per document,
    how many runs it has.
    """
    runs = np.maximum(counts - n + 1, 0)
    total = int(runs.sum())
    if not total:
        return np.zeros(0, np.uint64), runs
    first = np.cumsum(counts) - counts
    at = np.repeat(first - (np.cumsum(runs) - runs), runs) + np.arange(total)
    out = np.zeros(total, np.uint64)
    for i in range(n):
        out = out * np.uint64(BASE) + hashes[at + i]
    return mixed(out + np.uint64(n)), runs


def counts_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words of each document."""
    return np.diff(np.searchsorted(starts, offsets))


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list per document of values that lie one after the other."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
