"""Words and word shingles of whole Arrow text columns, as numpy arrays.

A word is a maximal run of characters other than ASCII punctuation, white space and controls, with
A-Z lower-cased: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. All work is on the UTF-8 bytes of many texts
at once, so that there is no Python step per word. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

SHINGLE = 5
_BASE = 0x9E3779B97F4A7C15
_PIECE = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _byte_table() -> np.ndarray:
    """The lower-cased byte where it belongs to a word, else 0."""
    table = np.zeros(256, np.uint8)
    for byte in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
        table[byte] = byte
    for byte in range(0x41, 0x5B):
        table[byte] = byte + 32
    return table


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, grown to the longest piece so far."""
    if len(_POWERS[0]) < n:
        size = max(n, _PIECE)
        for k, step in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, step, np.uint64)
            factors[0] = 1
            _POWERS[k] = np.cumprod(factors)
    return _POWERS[0][:n], _POWERS[1][:n]


@dataclass(frozen=True)
class Words:
    """Words in text order: ``text`` is the row, ``start`` and ``end`` are byte offsets in ``data``."""

    data: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    count: np.ndarray

    def word(self, i: int) -> bytes:
        return _byte_table()[self.data[self.start[i] : self.end[i]]].tobytes()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; nulls are empty rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    n = len(data)
    code = _byte_table()[data]
    inside = code != 0
    before = np.zeros(n + 1, bool)
    before[1:] = inside
    before[offsets] = False
    after = np.zeros(n + 1, bool)
    after[:n] = inside
    after[offsets] = False
    start = np.flatnonzero(inside & ~before[:n])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(code * up[:n], dtype=np.uint64, out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start])
    first = np.searchsorted(start, offsets[:-1])
    count = np.searchsorted(start, offsets[1:]) - first
    return Words(data, np.repeat(np.arange(len(count)), count), start, end, hashes, first, count)


def pieces(column: pa.Array, limit: int = _PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about ``limit`` bytes; a longer text is a run by itself."""
    data, offsets = text_buffer(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


@cache
def _factors(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` word hashes, by the place of its first word."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    n = len(hashes) - size + 1
    total = np.zeros(n, np.uint64)
    for j, factor in enumerate(_factors(size)):
        total += hashes[j : j + n] * factor
    return mix(total)


def shingles(hashes: np.ndarray, first: np.ndarray, count: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(item, hash) of the shingles of each item ``hashes[first:first + count]``, items in order.

    An item of fewer words than a shingle, but not none, has one shingle of all its words.
    """
    n = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    item = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    runs = window_hashes(hashes, size)
    short = (count < size)[item] if len(item) else np.zeros(0, bool)
    out = np.zeros(len(item), np.uint64)
    out[~short] = runs[place[~short]]
    for k in np.flatnonzero(short):
        i = item[k]
        own = hashes[first[i] : first[i] + count[i]]
        out[k] = mix((own * _factors(size)[: len(own)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own)))[0]
    return item, out


def distinct_sets(item: np.ndarray, values: np.ndarray, items: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets): the sorted distinct values of each item."""
    order = np.lexsort((values, item))
    item, values = item[order], values[order]
    keep = np.ones(len(item), bool)
    keep[1:] = (item[1:] != item[:-1]) | (values[1:] != values[:-1])
    item, values = item[keep], values[keep]
    return values, np.searchsorted(item, np.arange(items + 1))


def minhash(values: np.ndarray, offsets: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """MinHash sketches, one row of ``size`` 32-bit values per set; an empty set has zeros."""
    rows = len(offsets) - 1
    out = np.zeros((rows, size), np.uint32)
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if not len(full):
        return out
    factors = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)
    starts = offsets[full]
    step = max(1, int(np.searchsorted(starts, 1 << 16)))
    for lo in range(0, len(full), step):
        block = starts[lo : lo + step]
        stop = offsets[full[min(lo + step, len(full)) - 1] + 1]
        own = values[block[0] : stop]
        for j, factor in enumerate(factors):
            least = np.minimum.reduceat(own * factor, block - block[0])
            out[full[lo : lo + step], j] = (least >> np.uint64(32)).astype(np.uint32)
    return out


def cut_words(text: pa.Array, begins: pa.Array, ends: pa.Array) -> pa.Array:
    """Texts with the runs of words from ``begins`` to ``ends`` replaced by one space each; null means no runs."""
    data, offsets = text_buffer(text)
    out = []
    for i, (begin, end) in enumerate(zip(begins.to_pylist(), ends.to_pylist(), strict=True)):
        if not begin:
            out.append(text[i].as_py())
            continue
        own = data[offsets[i] : offsets[i + 1]]
        words = words_of(own, np.array([0, len(own)]))
        parts, at = [], 0
        for b, e in zip(begin, end, strict=True):
            parts.append(own[at : words.start[b]].tobytes())
            at = words.end[e - 1]
        out.append(b" ".join([*parts, own[at:].tobytes()]).decode())
    return pa.array(out, pa.string())


cut_words.__annotations__ = {"text": pa.Array, "begins": pa.Array, "ends": pa.Array, "return": pa.Array}
