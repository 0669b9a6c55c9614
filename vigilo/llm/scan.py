"""Vectorised scanning of text columns inside tasks.

Arrow batches are cut into slices of a few MB, whose texts lie in one byte buffer with a space after
each; words, hashes and n-grams of a whole slice are then numpy operations. Texts are never shortened:
a text longer than the slice size is a slice of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_ROWS = 4096

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {}

#: Bytes that are not white space, and bytes of the words of letters, digits and non-ASCII characters.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Slice:
    """Rows of a batch with their texts' bytes; text i is buf[starts[i]:ends[i]]."""

    rows: pa.RecordBatch
    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)


def give_back() -> None:
    """Hand freed memory back to the system: workers are reused, and the next operator's may grow elsewhere."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[Slice]:
    """Slices of the batches; a null text is empty."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = pc.fill_null(batch.column(batch.schema.get_field_index(text)), "").cast(pa.large_string())
        off = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + n + 1]
        data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
        lo = 0
        while lo < n:
            hi = int(np.searchsorted(off, off[lo] + SLICE_BYTES, "right")) - 1
            hi = min(max(hi, lo + 1), lo + SLICE_ROWS, n)
            cut = off[lo:hi + 1] - off[lo]
            buf = np.insert(data[off[lo]:off[hi]], cut[1:], np.uint8(0x20))
            shift = np.arange(hi - lo)
            yield Slice(batch.slice(lo, hi - lo), buf, cut[:-1] + shift, cut[1:] + shift)
            lo = hi
    give_back()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + SLICE_ROWS + 1), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have)
    return have[:n]


def span_hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span buf[s:e]; equal bytes, equal hash, wherever they stand."""
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(buf * _power(_BASE, len(buf)), out=total[1:])
    return mix((total[e] - total[s]) * _power(_BASE_INVERSE, len(buf) + 1)[s])


@dataclass
class Words:
    """Words of a slice; those of text i are first[i] to first[i + 1]."""

    s: np.ndarray
    e: np.ndarray
    h: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def words(buf: np.ndarray, starts: np.ndarray, kind: np.ndarray) -> Words:
    """Maximal runs of bytes of the kind (a table over byte values that leaves out the space)."""
    inside = kind[buf]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    s, e = edge[0::2], edge[1::2]
    return Words(s, e, span_hashes(buf, s, e), np.append(np.searchsorted(s, starts), len(s)))


def literal_hashes(text: str, kind: np.ndarray) -> np.ndarray:
    """Hashes of the words of a fixed lower-case text, as words() gives them."""
    buf = np.frombuffer(text.encode() + b" ", np.uint8)
    return words(buf, np.zeros(1, np.int64), kind).h


def gram_hashes(w: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and first word of every run of k words; of all words, where a text has fewer.

    Texts without words have none. The runs are in text order, those of short texts at the end.
    """
    factors = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    n, counts, owner = len(w.h), w.counts(), w.owner()
    parts_h, parts_d, parts_p = [], [], []
    if n >= k:
        total = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            total += w.h[j: n - k + 1 + j] * factors[j]
        at = np.flatnonzero(owner[: n - k + 1] == owner[k - 1:])
        parts_h.append(total[at])
        parts_d.append(owner[at])
        parts_p.append(at)
    for m in range(1, k):
        d = np.flatnonzero(counts == m)
        if len(d):
            total = np.full(len(d), m, np.uint64)
            for j in range(m):
                total += w.h[w.first[d] + j] * factors[j]
            parts_h.append(total)
            parts_d.append(d)
            parts_p.append(w.first[d])
    if not parts_h:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return mix(np.concatenate(parts_h)), np.concatenate(parts_d), np.concatenate(parts_p)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, t) for c, t in zip(columns, schema.types)]
    return pa.RecordBatch.from_arrays([a.cast(t) for a, t in zip(arrays, schema.types)], schema=schema)
