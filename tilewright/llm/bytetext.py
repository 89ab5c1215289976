"""Whole texts of an Arrow batch as one byte array, and rolling fingerprints over it, in numpy.

Helpers of the tasks that work on bytes and words. They see one slice of a batch at a time (about a megabyte, or one
longer text), so a task's memory does not grow with its partition.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_ODD = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def byte_table(lower: bool) -> np.ndarray:
    """A random word for each byte; with ``lower``, A-Z count as a-z."""
    table = mix(np.arange(1, 257, dtype=U64) * U64(0xD1B54A32D192ED03))
    if lower:
        table[65:91] = table[97:123]
    return table


@functools.lru_cache(maxsize=8)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _ODD, U64), np.full(size, _INVERSE, U64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd constant and of its inverse modulo 2**64, at least n of them."""
    return _powers(max(1 << 20, 1 << int(n).bit_length()))


def prefix_sums(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """sums such that (sums[e] - sums[s]) * inverse_power[s] fingerprints data[s:e], wherever it stands."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(table[data] * powers(len(data))[0][: len(data)], out=out[1:])
    return out


def spans_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The fingerprint of each data[start:end], which takes in its length."""
    inverse = powers(len(sums))[1]
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U64) * U64(0xA24BAED4963EE407))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null counts as empty."""
    kind = pa.large_binary()
    column = column.cast(pa.large_string() if pa.types.is_string(column.type) else column.type) if pa.types.is_string(column.type) else column
    if column.type not in (pa.large_string(), kind):
        column = column.cast(kind)
    if column.null_count:
        column = column.fill_null("" if column.type == pa.large_string() else b"")
    n, (_, where, what) = len(column), column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(what, np.uint8) if what is not None and what.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, bytes, offsets) of runs of texts that hold ``limit`` bytes at most, or one longer text each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of maximal runs of bytes for which the table ``inside`` is true, never across texts."""
    on = inside[data]
    before, after = np.zeros(len(on), bool), np.zeros(len(on), bool)
    before[1:], after[:-1] = on[:-1], on[1:]
    starts, ends = offsets[:-1], offsets[1:]
    before[starts[starts < len(on)]] = False
    after[ends[ends > 0] - 1] = False
    start, end = np.flatnonzero(on & ~before), np.flatnonzero(on & ~after) + 1
    return start, end, np.searchsorted(ends, start, side="right")


def shingles(hashes: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, text index) of each k consecutive words of one text; a text of fewer words gives all of them as one."""
    n = len(hashes)
    if not n:
        return hashes, text
    out, of = [], []
    if n >= k:
        whole = text[: n - k + 1] == text[k - 1 :]
        h = hashes[: n - k + 1]
        for j in range(1, k):
            h = mix(h) * U64(3) + hashes[j : n - k + 1 + j]
        out.append(mix(h)[whole])
        of.append(text[: n - k + 1][whole])
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    count = np.diff(np.r_[first, n])
    for length in range(1, k):
        at = first[count == length]
        if len(at):
            h = hashes[at]
            for j in range(1, length):
                h = mix(h) * U64(3) + hashes[at + j]
            out.append(mix(h + U64(length) * U64(0x8CB92BA72F3D8DD7)))
            of.append(text[at])
    h, of = np.concatenate(out), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return h[order], of[order]
