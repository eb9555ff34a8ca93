"""Numpy views of Arrow text columns: words, word hashes, and vectorised lookups of 64-bit codes.

A word is a run of bytes other than the six ASCII white-space bytes, so words of whole batches are
found without decoding. All helpers work on a slice of a batch of bounded size; only a single text
longer than that bound makes a larger slice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that close values end far apart."""
    h = (h ^ (h >> _U(31))) * _U(0x7FB5D329728EA185)
    h = (h ^ (h >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return h ^ (h >> _U(33))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD6E8FEB86659FD93))


def _powers(base: int, n: int, kept: dict[int, np.ndarray] = {}) -> np.ndarray:  # noqa: B006
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = kept.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 65)
        have = np.full(size, _U(base))
        have[0] = 1
        kept[base] = have = np.multiply.accumulate(have)
    return have[:n]


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose texts hold about ``limit`` bytes; at least one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, bounds = flat(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row begins and ends (n + 1 bounds). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and for each row the index of its first word (n + 1 bounds)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(bounds), np.int64)
    space = SPACE[data]
    before = np.empty(len(data), bool)
    before[1:] = space[:-1]
    inner = bounds[(bounds < len(data))]
    before[inner] = True
    after = np.empty(len(data), bool)
    after[:-1] = space[1:]
    after[bounds[bounds > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; equal bytes have equal hashes wherever they stand."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=total[1:])
    raw = (total[ends] - total[starts]) * _powers(_INVERSE, len(data) + 1)[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


_STEP = [_U(x) for x in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xA24BAED4963EE407, 0x8CB92BA72F3D8DD7)]


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words, and for each row the index of its first window."""
    n = np.diff(first)
    have = np.maximum(n - size + 1, 0)
    at = np.concatenate([[0], np.cumsum(have)])
    if not at[-1]:
        return np.zeros(0, np.uint64), at
    begin = np.arange(at[-1]) - np.repeat(at[:-1], have) + np.repeat(first[:-1], have)
    out = np.zeros(at[-1], np.uint64)
    for k in range(size):
        out = (out ^ hashes[begin + k]) * _STEP[k]
        out ^= out >> _U(29)
    return mix(out), at


class Lookup:
    """Finds the position of 64-bit codes in a list of distinct codes: two hash tables without
    chains, then a sorted list for the few codes that found both of their places taken."""

    def __init__(self, codes: np.ndarray):
        codes = np.asarray(codes, np.uint64)
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(codes))))) + 2)
        self.tables = []
        left = np.arange(len(codes))
        for k in range(2):
            place = self._place(codes[left], k)
            row = np.full(1 << self.bits, -1, np.int32)
            row[place] = left
            code = np.zeros(1 << self.bits, np.uint64)
            code[row >= 0] = codes[row[row >= 0]]
            self.tables.append((code, row))
            left = left[row[place] != left]
        order = np.argsort(codes[left])
        self.rest, self.rest_row = codes[left][order], left[order]

    def _place(self, codes: np.ndarray, k: int) -> np.ndarray:
        return ((codes * _STEP[k]) >> _U(64 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """The position of each code, -1 if it isn't listed."""
        place = self._place(codes, 0)
        code, row = self.tables[0]
        out = np.where(code[place] == codes, row[place], -1)
        miss = np.flatnonzero(out < 0)
        if len(miss):
            some = codes[miss]
            place = self._place(some, 1)
            code, row = self.tables[1]
            found = np.where(code[place] == some, row[place], -1)
            if len(self.rest):
                at = np.minimum(np.searchsorted(self.rest, some), len(self.rest) - 1)
                found = np.where((found < 0) & (self.rest[at] == some), self.rest_row[at], found)
            out[miss] = found
        return out


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the runs between bounds; 0 for empty runs. Works on columns of a matrix too."""
    n = len(bounds) - 1
    out = np.zeros((n, *values.shape[1:]), np.float64 if values.dtype.kind == "f" else np.int64)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, bounds[full], axis=0, dtype=out.dtype)
    return out
