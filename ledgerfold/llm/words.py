"""Words of Arrow text columns as numpy arrays: no Python object per word.

A batch of texts is one byte buffer. Separators are ASCII, so word edges can be found on
bytes, and any run of words or bytes is hashed from one running sum (a polynomial over
random byte values, modulo 2**64)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer single text is worked on alone.
CHUNK_BYTES = 2 << 20
#: The same where many arrays of words are held beside each other.
SMALL_CHUNK = 1 << 19

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = int(_RANDOM.integers(0, 2**62)) * 2 + 1
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII but digits and letters.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def _power(kind: str, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), or of its inverse; grown by need and kept in the worker."""
    known = _powers[kind]
    if len(known) < n:
        base = _BASE if kind == "up" else pow(_BASE, -1, 2**64)
        size = max(n, 2 * len(known))
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        _powers[kind] = known = np.multiply.accumulate(steps)
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Sums:
    """Hashes of any ranges of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _power("up", n + 1)[:n], out=self.total[1:])

    def hashed(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        down = _power("down", len(self.total))
        return mix((self.total[end] - self.total[start]) * down[start] + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Words of a list of texts: bytes buf[start[i]:end[i]]; those of text r are first[r]:first[r+1]."""

    buf: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self) -> np.ndarray:
        return Sums(BYTE_VALUE[self.buf]).hashed(self.start, self.end)

    def windows(self, size: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all windows of so many words within one text."""
        n = np.maximum(self.count - size + 1, 0)
        at = np.repeat(self.first[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return at, Sums(hashes).hashed(at, at + size)


def buffers(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string column; null counts as empty."""
    if text.null_count:
        text = text.fill_null("")
    wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
    _, offsets, data = text.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return offsets.astype(np.int64) - offsets[0], raw


def split_words(text: pa.Array, separators: np.ndarray = SPACES, fold: np.ndarray | None = None) -> Words:
    offsets, buf = buffers(text)
    return split_bytes(offsets, buf if fold is None else fold[buf], separators)


def split_bytes(offsets: np.ndarray, buf: np.ndarray, separators: np.ndarray = SPACES) -> Words:
    word = ~separators[buf]
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    full = np.diff(offsets) > 0
    head, tail = offsets[:-1][full], offsets[1:][full] - 1
    starts[head] = word[head]
    ends[tail] = word[tail]
    start = np.flatnonzero(starts)
    return Words(buf, offsets, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of a bounded number of text bytes, one row at least."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        offsets, _ = buffers(batch.column(at))
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
            yield batch.slice(row, min(stop, batch.num_rows) - row)
            row = stop


def joined(words: Words, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All (kept) words, each followed by one space, and where each word begins in that; one offset more at the end."""
    start, end = (words.start, words.end) if keep is None else (words.start[keep], words.end[keep])
    size = end - start + 1
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    from_ = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    if len(from_):
        from_[-1] = 0  # may lie behind the buffer
    out = words.buf[from_]
    out[offsets[1:] - 1] = 0x20
    return out, offsets
