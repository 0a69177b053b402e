"""Whole Arrow text columns as words and word shingles, in numpy and without Python strings.

A column of texts is one run of UTF-8 bytes with offsets. Words are found by comparing each
byte with its neighbour; the hash of a word comes from prefix sums of a polynomial over the
bytes, so cost does not depend on the number of words. Work is done in blocks of bounded
size; a text longer than a block is cut only between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_CASED = _BYTE.copy()
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_PLACE = _rng.integers(1, 1 << 63, 8, dtype=np.uint64) * _U(2) + _U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


class _Powers:
    def __init__(self):
        self.up = self.down = np.ones(1, _U)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.up.size < n:
            m = max(n, BLOCK_BYTES)
            self.up, self.down = (np.concatenate([np.ones(1, _U), np.full(m - 1, b, _U)]).cumprod() for b in (_U(_BASE), _U(_INVERSE)))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _segments(data: np.ndarray, start: int, end: int, spaces: np.ndarray) -> Iterator[tuple[int, int]]:
    while end - start > BLOCK_BYTES:
        cut = start + BLOCK_BYTES
        while cut < end and not spaces[data[cut]]:
            cut += 1
        yield start, cut
        start = cut
    yield start, end


def doc_blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``most`` bytes; one long text makes its own range."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offsets: np.ndarray, i: int, j: int, spaces: np.ndarray = _SPACE, cased: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each word of texts i..j-1, and where each text's words begin."""
    parts, table = [], _CASED if cased else _BYTE
    for a, b in _segments(data, int(offsets[i]), int(offsets[j]), spaces) if j == i + 1 else [(int(offsets[i]), int(offsets[j]))]:
        raw = data[a:b]
        if not raw.size:
            continue
        ink = ~spaces[raw]
        edge = np.zeros(raw.size + 1, bool)
        at = offsets[i:j + 1] - a
        edge[at[(at >= 0) & (at <= raw.size)]] = True
        before = np.concatenate([[False], ink[:-1]])
        begins = np.flatnonzero(ink & (~before | edge[:-1]))
        after = np.concatenate([ink[1:], [False]])
        ends = np.flatnonzero(ink & (~after | edge[1:])) + 1
        up, down = _powers(raw.size)
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(table[raw] * up)])
        parts.append((mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(_U)), begins + a, ends + a))
    if parts:
        hashes, starts, ends = (np.concatenate(x) for x in zip(*parts))
    else:
        hashes, starts, ends = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return hashes, starts, ends, np.searchsorted(starts, offsets[i:j + 1])


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` words, by its first word."""
    n = hashes.size - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    total = np.zeros(n, _U)
    for k in range(width):
        total += mix(hashes[k:k + n] + _PLACE[k]) * _PLACE[k]
    return mix(total)


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """Each text's sorted set of distinct shingle hashes; a shorter text is one shingle."""
    data, offsets = utf8(column)
    for i, j in doc_blocks(offsets):
        hashes, _, _, first = words(data, offsets, i, j)
        runs = rolling(hashes, width)
        for d in range(j - i):
            a, b = int(first[d]), int(first[d + 1])
            if b - a >= width:
                yield np.unique(runs[a:b - width + 1])
            elif b > a:
                short = hashes[a:b]
                yield mix(np.array([np.sum(mix(short + _PLACE[:short.size]) * _PLACE[:short.size]) + _U(b - a)], _U))
            else:
                yield np.zeros(0, _U)
