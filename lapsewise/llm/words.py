"""Vectorised word scanning and hashing of Arrow text columns.

Words are the maximal runs of bytes outside ``{0x20, 0x09..0x0D}`` of the
UTF-8 text (the separators are ASCII, so byte and character views agree).
Everything works on one Arrow record batch at a time: a task's memory is
bounded by its batch, however long the table is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32

_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASES = (0xC2B2AE3D27D4EB4F | 1, 0x165667B19E3779F9 | 1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = x + U64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (base is odd)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n).bit_length())
        inverse = pow(base, -1, 2**64)
        out = []
        for b in (base, inverse):
            p = np.full(size, U64(b), dtype=U64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _POWERS[base] = (out[0], out[1])
    return have[0][:n], have[1][:n]


def sequence_hashes(items: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """Hash of ``items[i:i+length]`` for every i (rolling, modulo 2**64)."""
    n = len(items)
    if n < length:
        return np.empty(0, dtype=U64)
    base = _WORD_BASES[salt & 1]
    up, down = _powers(base, n + 1)
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(mix(items, salt) * up[:n], out=sums[1:])
    return mix((sums[length:] - sums[:-length]) * down[: n - length + 1], salt + 7)


class RangeHash:
    """Hashes of arbitrary ranges of a sequence: ``hasher(starts, ends)``."""

    def __init__(self, items: np.ndarray, salt: int = 0):
        self.salt = salt
        up, self.down = _powers(_WORD_BASES[salt & 1], len(items) + 1)
        self.sums = np.zeros(len(items) + 1, dtype=U64)
        np.cumsum(mix(items, salt) * up[: len(items)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray, extra: np.ndarray | None = None) -> np.ndarray:
        out = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        if extra is not None:
            out = out ^ mix(extra, 11)
        return mix(out, self.salt + 7)


class WordBatch:
    """The words of one Arrow string column.

    ``starts``/``ends`` are byte offsets into ``data``; the words of row i
    are ``first[i]:first[i+1]``; ``hashes`` holds one 64-bit hash a word.
    Null rows have no words.  ``inside(bytes)`` may mark other word bytes and
    ``fold(bytes)`` spell them alike before they are hashed.
    """

    def __init__(self, column, lower: bool = False, hashed: bool = True, fold=None, inside=None):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        if not pa.types.is_large_string(column.type):
            column = column.cast(pa.large_string())
        if column.null_count:
            column = column.fill_null("")
        n = len(column)
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
            column.offset: column.offset + n + 1] if n else np.zeros(1, dtype=np.int64)
        lo, hi = int(offsets[0]), int(offsets[-1])
        raw = column.buffers()[2] if n else None
        data = np.frombuffer(raw, dtype=np.uint8)[lo:hi] if raw is not None and hi > lo else np.empty(0, np.uint8)
        if lower:
            data = _LOWER[data]
        offsets = offsets - lo
        self.data, self.offsets = data, offsets
        inside = ~_SPACE[data] if inside is None else inside(data)
        if fold is not None:
            data = fold(data)
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        finish = inside.copy()
        finish[:-1] &= ~inside[1:]
        # a row border always ends a word
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        begins[cuts] = inside[cuts]
        finish[cuts - 1] = inside[cuts - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.starts, offsets)
        if hashed:
            up, down = _powers(_BYTE_BASE, len(data) + 1)
            sums = np.zeros(len(data) + 1, dtype=U64)
            np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=sums[1:])
            word = (sums[self.ends] - sums[self.starts]) * down[self.starts]
            self.hashes = mix(word, 3) ^ mix((self.ends - self.starts).astype(U64), 5)

    def __len__(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i]: self.first[i + 1]]

    def rows_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.counts())


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Positions chosen by the robust winnowing rule: the rightmost minimum of
    each window of ``width`` values; sorted, each position once.  Equal
    windows choose the same relative position."""
    chosen = chosen_by_window(values, width)
    return chosen[np.r_[True, chosen[1:] != chosen[:-1]]] if len(chosen) else chosen


def chosen_by_window(values: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` values the position of its rightmost minimum."""
    n = len(values)
    if n < width:
        return np.empty(0, dtype=np.int64)
    best = np.arange(n, dtype=np.int64)
    span = 1
    # doubling: best[i] is the rightmost argmin of values[i:i+span]
    while span * 2 <= width:
        left, right = best[: len(best) - span], best[span:]
        best = np.where(values[right] <= values[left], right, left)
        span *= 2
    if span < width:
        left, right = best[: n - width + 1], best[width - span:]
        best = np.where(values[right] <= values[left], right, left)
    return best[: n - width + 1]
