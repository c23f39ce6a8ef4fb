"""Vectorised word hashing on Arrow text batches (numpy, inside tasks).

A batch is cut into slices of about one megabyte, so the working set of a task does not
grow with the batch; a single longer text is hashed in pieces cut at separators. Words
are hashed from the raw UTF-8 bytes with a polynomial over randomly mapped bytes modulo
2**64 and a finaliser; prefixes of the same polynomial give word-prefix and
word-sequence hashes without touching Python strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def _lower(separators: bytes) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[0] = 255  # NUL is a character like others; no UTF-8 text has a byte 255
    table[list(separators)] = 0
    return table


#: Byte tables: separators to 0, A-Z to lower case.
SPACES = _lower(bytes([9, 10, 11, 12, 13, 32]))
NON_WORD = _lower(bytes(b for b in range(128) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, PIECE + 4096), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if len(have) <= PIECE + 4096:  # kept by a worker from task to task; longer ones are made when needed
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Prefix:
    """Hashes of any [start, end) of a sequence of 64-bit values from one running sum."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * powers(_BASE, len(values)), out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * powers(_INVERSE, len(self.sums))[start])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls become empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of rows of about PIECE bytes."""
    if not batch.num_rows:
        return
    data, at = utf8(batch.column(column))
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + PIECE, "right")) - 1)
        yield row, end, data[at[row]:at[end]], at[row:end + 1] - at[row]
        row = end


class Words:
    """Words of some rows: ``hash`` per word, ``bounds`` (row i owns words bounds[i]:bounds[i+1]),
    and on request byte ``starts``/``ends`` and ``prefixes`` (hash of the first n bytes, 0 if shorter)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, prefixes: tuple[int, ...] = ()):
        parts: list[tuple[np.ndarray, ...]] = []
        mapped = table[data]
        inside = mapped != 0
        first = np.zeros(len(data) + 1, dtype=bool)
        first[offsets] = True
        before = np.concatenate(([False], inside[:-1])) if len(data) else inside
        after = np.concatenate((inside[1:], [False])) if len(data) else inside
        self.starts = np.flatnonzero(inside & (~before | first[:-1]))
        self.ends = np.flatnonzero(inside & (~after | first[1:])) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        w = 0
        while w < len(self.starts):
            end = max(w + 1, int(np.searchsorted(self.ends, self.starts[w] + PIECE, "right")))
            lo, hi = self.starts[w], self.ends[end - 1]
            p = Prefix(_BYTE[mapped[lo:hi]])
            s, e = self.starts[w:end] - lo, self.ends[w:end] - lo
            parts.append((p(s, e), *[np.where(e - s >= n, p(s, np.minimum(s + n, e)), np.uint64(0)) for n in prefixes]))
            w = end
        joined = [np.concatenate(x) for x in zip(*parts)] or [np.zeros(0, np.uint64)] * (1 + len(prefixes))
        self.hash, self.prefixes = joined[0], joined[1:]

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def sequences(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive values."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    acc = h[:len(h) - n + 1].copy()
    for k in range(1, n):
        acc = acc * np.uint64(0xD1342543DE82EF95) + h[k:len(h) - n + 1 + k]
    return mix(acc)


def shingle_sets(words: Words, n: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct n-word shingle hashes; fewer words: the whole sequence as one."""
    runs = sequences(words.hash, n)
    for lo, hi in zip(words.bounds[:-1], words.bounds[1:]):
        if hi - lo >= n:
            yield np.unique(runs[lo:hi - n + 1])
        else:
            yield sequences(words.hash[lo:hi], int(hi - lo)) if hi > lo else np.zeros(0, np.uint64)


def same_bytes(a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Whether the byte ranges a[a_start:a_end] and b[b_start:b_end] are equal, pair by pair."""
    size = a_end - a_start
    equal = size == b_end - b_start
    at = np.flatnonzero(equal & (size > 0))
    n = size[at]
    first = np.cumsum(n) - n
    step = np.arange(int(n.sum())) - np.repeat(first, n)
    differ = a[step + np.repeat(a_start[at], n)] != b[step + np.repeat(b_start[at], n)]
    if len(at):
        equal[at] = np.add.reduceat(differ, first, dtype=np.int64) == 0
    return equal
