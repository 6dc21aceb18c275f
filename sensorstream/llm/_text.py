"""Word scanning over Arrow text columns with array operations.

A batch's texts lie back to back in one UTF-8 buffer.  Word limits, word
hashes and hashes of word runs come from whole-buffer array steps, so no
Python code runs per word.  Buffers are worked through in slices of whole
texts of about ``SLICE_BYTES``, which bounds memory by the slice or by the
longest single text, never by the batch.

Hashes are 64-bit: a word's is a polynomial over random byte values, finished
by a bijective mixer; a run's is a polynomial over its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: A worker needs some 75 times this for one slice and its tables; larger slices are no faster.
SLICE_BYTES = 1 << 18
_U = np.uint64
_BASE, _RUN = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finisher (xor-shift and odd multipliers)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + _U(seed)) * _U(_BASE))


def _spaced(extra: str = "") -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def _alphanumeric() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for lo, hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        table[lo:hi + 1] = True
    return table


#: Bytes of words.  Both classes treat every byte of a non-ASCII character
#: alike, so they work on UTF-8 bytes as they do on characters.
SPACED = _spaced()              # [^\x20\x09-\x0D]+
#: Letters, digits and non-ASCII; upper-case letters are lowered before.
ALPHANUMERIC = _alphanumeric()  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lowering

_BYTES = random_words(256, 7)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least ``n``."""
    got = _powers.get(base)
    if got is None or len(got[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, _U(b), dtype=np.uint64)
            p[0] = 1
            pair.append(np.multiply.accumulate(p))
        got = _powers[base] = (pair[0], pair[1])
    return got


@dataclass
class Words:
    """Words of one slice of texts.

    ``start``/``end`` are byte offsets into ``data``; words of text ``i`` (of
    this slice, whose first text is number ``row0`` of the column) are
    ``first[i]:first[i + 1]``.
    """
    row0: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.first) - 1

    def runs(self, k: int, weak: bool = False) -> np.ndarray:
        """Hash of each run of ``k`` words, by its first word's index.

        Runs are taken over the slice as a whole; use :meth:`last_run` to see
        which lie inside one text.  ``weak`` skips the finishing mix.
        """
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        power, inverse = _power_tables(_RUN, len(self.hash) + 1)
        total = np.zeros(len(self.hash) + 1, dtype=np.uint64)
        np.cumsum(self.hash * power[:len(self.hash)], out=total[1:])
        h = (total[k:] - total[:-k]) * inverse[:n]
        return h if weak else mix(h)

    def text_bytes(self, word: int) -> bytes:
        return self.data[self.start[word]:self.end[word]].tobytes()


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and data of a text column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return off, raw


def slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``SLICE_BYTES`` together."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def scan(column: pa.Array, lower: bool, word_bytes: np.ndarray = SPACED,
         hashes: bool = True) -> Iterator[Words]:
    """Words of each text of a column, slice by slice."""
    offsets, raw = string_buffers(column)
    for i, j in slices(offsets):
        data = raw[offsets[i]:offsets[j]]
        if lower:
            data = _LOWER[data]
        off = (offsets[i:j + 1] - offsets[i]).astype(np.int64)
        n = len(data)
        inside = word_bytes[data]
        before = np.empty(n + 1, dtype=bool)
        before[0] = False
        before[1:] = inside
        before[off] = False            # a text's first byte follows nothing
        start = np.flatnonzero(inside & ~before[:-1])
        after = np.empty(n + 1, dtype=bool)
        after[n] = False
        after[:-1] = inside
        after[off] = False
        end = np.flatnonzero(inside & ~after[1:]) + 1
        first = np.searchsorted(start, off)
        h = np.zeros(0, dtype=np.uint64)
        if hashes and n:
            power, inverse = _power_tables(_BASE, n + 1)
            total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_BYTES[data] * power[:n], out=total[1:])
            h = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
        yield Words(i, data, start, end, first, h)


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit values as Spark's signed long."""
    return x.view(np.int64)
