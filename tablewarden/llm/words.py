"""Words of whole batches of texts as numpy arrays: bounds, hashes, hashes of word windows.

Used inside tasks, over slices of about a megabyte of text (one text, if it is longer).
Hashes are 64 bit: a polynomial over the word's bytes, mixed; windows are hashed the
same way over their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20


def space_words() -> np.ndarray:
    """Bytes of words between ASCII white space."""
    inside = np.ones(256, bool)
    inside[[32, 9, 10, 11, 12, 13]] = False
    return inside


def letter_words() -> np.ndarray:
    """Bytes of words of ASCII letters, digits and anything that is not ASCII."""
    inside = np.zeros(256, bool)
    inside[48:58] = inside[65:91] = inside[97:123] = inside[128:] = True
    return inside


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a new array)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mix_one(x: int) -> int:
    """``mix`` of one value."""
    m = (1 << 64) - 1
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & m
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & m
    return x ^ (x >> 31)


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about ``most`` bytes of text; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offs, data = column.buffers()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(offs, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        end = min(end, n)
        at = offsets[row : end + 1]
        yield row, data[at[0] : at[-1]], at - at[0]
        row = end


class Hasher:
    """Powers and byte tables for hashing; made once in a task."""

    def __init__(self, inside: np.ndarray, lower: bool = False, seed: int = 7):
        self.inside = inside
        self.byte = np.random.default_rng(seed).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        if lower:
            self.byte[65:91] = self.byte[97:123]
        self.base = 0x9E3779B97F4A7C4B
        self.up, self.down = self._powers(SLICE_BYTES + 1)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for base in (self.base, pow(self.base, -1, 1 << 64)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        return out[0], out[1]

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            self.up, self.down = self._powers(n)
        return self.up, self.down

    def bounds(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, first): byte bounds of all words, and each text's first word."""
        n = len(data)
        if not n:
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(len(offsets), np.int64)
        inside = self.inside[data]
        cut = offsets[(offsets > 0) & (offsets < n)]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        begin[cut] = inside[cut]
        end = inside.copy()
        end[:-1] &= ~inside[1:]
        end[cut - 1] = inside[cut - 1]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        return starts, ends, np.searchsorted(starts, offsets)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of every word."""
        out = np.empty(len(starts), np.uint64)
        a = 0
        while a < len(starts):
            # a run of words of at most a slice of bytes, or one longer word
            b = max(a + 1, int(np.searchsorted(ends, starts[a] + SLICE_BYTES, "right")))
            lo, hi = int(starts[a]), int(ends[b - 1])
            up, down = self.powers(hi - lo + 1)
            total = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(self.byte[data[lo:hi]] * up[: hi - lo], out=total[1:])
            s, e = starts[a:b] - lo, ends[a:b] - lo
            out[a:b] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            a = b
        return mix(out)

    def spans(self, words: np.ndarray) -> "Spans":
        return Spans(words, *self.powers(len(words) + 1))


class Spans:
    """Hashes of runs of words."""

    def __init__(self, words: np.ndarray, up: np.ndarray, down: np.ndarray):
        self.down = down
        self.total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[: len(words)], out=self.total[1:])

    def hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of words a to b-1, by content and number."""
        raw = (self.total[b] - self.total[a]) * self.down[a]
        return mix(raw + (b - a).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))

    def every(self, k: int) -> np.ndarray:
        """Of the k words from each position on, text bounds not regarded."""
        n = len(self.total) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        raw = (self.total[k:] - self.total[:n]) * self.down[:n]
        return mix(raw + np.uint64(k * 0xA24BAED4963EE407 & (1 << 64) - 1))


def text_of_word(first: np.ndarray) -> np.ndarray:
    """The text that each word belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def least_in_window(values: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Least value, and its leftmost place, among each w consecutive values."""
    v, at, have = values, np.arange(len(values)), 1
    while have < w:
        step = min(have, w - have)
        n = len(v) - step
        if n <= 0:
            return np.zeros(0, values.dtype), np.zeros(0, np.int64)
        right = v[step:] < v[:n]
        v = np.where(right, v[step:], v[:n])
        at = np.where(right, at[step:], at[:n])
        have += step
    return v, at


def cut_rows(first: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut each text's entries first[i]:first[i + 1] into rows of at most ``most``, one row at least.

    Returns each row's text, its number within the text, and the offsets of all rows.
    """
    n = np.diff(first)
    rows = np.maximum(1, -(-n // most))
    text = np.repeat(np.arange(len(n)), rows)
    part = np.arange(len(text)) - np.repeat(np.cumsum(rows) - rows, rows)
    return text, part, np.append(first[text] + part * most, first[-1])


def list_of(offsets: np.ndarray, **fields: np.ndarray) -> pa.Array:
    """An array<struct> column from flat arrays."""
    values = pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], list(fields))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
