"""Words of whole texts as 64-bit hashes, computed for many texts at once.

A word is ``[^\\x20\\x09-\\x0D]+``. Those six separators are single bytes in
UTF-8, so words are found on the bytes of an Arrow string column without
decoding. A hash is a polynomial over per-byte random values modulo 2**64,
read off a running sum (any base that is odd has an inverse there), then
mixed. Runs of k words are hashed the same way over the word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
RUN_BASE = 0xD1B54A32D192ED03 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser; wraps modulo 2**64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STATE: dict = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse for i below n, kept for the next call."""
    key = ("pow", base)
    have = _STATE.get(key)
    if have is None or len(have[0]) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = _STATE[key] = tuple(out)
    return have[0][:n], have[1][:n]


def _bytes_table() -> np.ndarray:
    if "bytes" not in _STATE:
        _STATE["bytes"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
        gap = np.zeros(256, bool)
        gap[[9, 10, 11, 12, 13, 32]] = True
        _STATE["gap"] = gap
    return _STATE["bytes"]


class Words(NamedTuple):
    doc: np.ndarray      # index of the text in the slice, ascending
    start: np.ndarray    # byte offsets in ``buf``
    end: np.ndarray
    hash: np.ndarray     # uint64
    bounds: np.ndarray   # words of text i: bounds[i]..bounds[i+1]
    buf: np.ndarray


def spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each ``buf[start:end]``; equal bytes have equal hashes."""
    n = len(buf)
    power, inverse = _powers(BASE, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_bytes_table()[buf] * power, out=sums[1:])
    at = np.minimum(start, max(0, n - 1))
    return mix((sums[end] - sums[start]) * inverse[at] + (end - start).astype(np.uint64))


def scan(buf: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts ``buf[offsets[i]:offsets[i+1]]`` (offsets from 0)."""
    _bytes_table()
    n = len(buf)
    docs = len(offsets) - 1
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, np.uint64), np.zeros(docs + 1, np.int64), buf)
    word = ~_STATE["gap"][buf]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    h = spans(buf, start, end)
    bounds = np.searchsorted(start, offsets, "left")
    doc = np.repeat(np.arange(docs), np.diff(bounds))
    return Words(doc, start, end, h, bounds, buf)


def runs(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every run of k words in one text."""
    n = len(w.hash)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    power, inverse = _powers(RUN_BASE, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(w.hash * power, out=sums[1:])
    at = np.flatnonzero(w.doc[: n - k + 1] == w.doc[k - 1:])
    return at, mix((sums[at + k] - sums[at]) * inverse[at] + np.uint64(k))


def slices(column, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an Arrow string column into runs of rows of about ``limit`` bytes
    (one longer text is a slice of its own): (first row, row after, bytes,
    offsets). Null counts as empty."""
    import pyarrow as pa

    if column.null_count:
        column = column.fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    rows = len(column)
    if rows == 0:
        return
    off = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset: column.offset + rows + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < rows:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, rows)
        yield i, j, data[off[i]: off[j]], off[i: j + 1] - off[i]
        i = j
