"""Texts of an Arrow batch as flat arrays: slices, words, segments, 64-bit hashes.

All helpers work on the UTF-8 bytes of many texts at once, so that no Python code runs
per word. A hash takes eight bytes at a time and scrambles each such lane, with its place,
before they are added: no family of texts shares a hash by construction, and two given
different runs do with a chance of 2**-64. :func:`distinct_runs` compares the bytes as well.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
# Texts longer than this are hashed piece by piece, so that temporary arrays stay small.
WINDOW_BYTES = 1 << 20

# White space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
# The bytes of a lane that count, by how many are left.
LANE = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_BASE = np.uint64(0x2545F4914F6CDD1D)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd base, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 1024), _BASE)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers[:n]


def slices(batches: Iterable[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the ``column`` of a slice has about ``size`` bytes; a longer text is alone.

    After the last one the worker gives back the memory that its allocators keep: it stays for
    later tasks, next to those of other operators.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(lengths(col))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        del batch, col
    give_back()


def give_back() -> None:
    """Return unused memory of Arrow's pool and, where the C library can, of the heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lengths(col: pa.Array) -> np.ndarray:
    """Bytes of each text; 0 for null."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the offsets of its texts; null is empty."""
    if pa.types.is_string(col.type) or pa.types.is_binary(col.type):
        col = col.cast(pa.large_binary())
    elif pa.types.is_large_string(col.type):
        col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def numbers(col: pa.Array) -> list:
    return col.to_pylist()


def segments(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` bytes that no text boundary cuts.

    Returns start and end of each run and, per text, the number of its first run (one entry
    more than texts).
    """
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts: runs of bytes that are no white space."""
    return segments(data, offsets, ~SPACE[data])


def lanes_view(data: np.ndarray) -> np.ndarray:
    """The eight bytes that start at each byte as one number, with zeros behind the last byte."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))


def _lanes(starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of runs in order: the number of lanes, and of each lane its number in the run and its first byte."""
    count = (size + 7) >> 3
    at = np.cumsum(count) - count
    number = np.arange(int(count.sum()), dtype=np.int64) - np.repeat(at, count)
    return count, number, np.repeat(starts, count) + 8 * number


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run; runs are in order and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    view = lanes_view(data)
    first = 0
    while first < len(starts):
        # As many runs as fit a window, one at least.
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + WINDOW_BYTES, side="right")))
        size = ends[first:last] - starts[first:last]
        count, number, where = _lanes(starts[first:last], size)
        left = np.minimum(np.repeat(size, count) - 8 * number, 8)
        values = mix((view[where] & LANE[left]) + mix((number + 1).astype(np.uint64) * _GOLDEN))
        # reduceat gives an empty run the next value; runs of words are never empty.
        full = size > 0
        sums = np.zeros(last - first, np.uint64)
        if full.any():
            sums[full] = np.add.reduceat(values, (np.cumsum(count) - count)[full])
        out[first:last] = mix(sums + mix(size.astype(np.uint64) + _GOLDEN))
        first = last
    return out


def same_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether each run has the bytes of the run whose number is given for it."""
    view, size = lanes_view(data), ends - starts
    same = size == size[others]
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + WINDOW_BYTES, side="right")))
        own = np.flatnonzero(same[first:last] & (size[first:last] > 0)) + first
        count, number, where = _lanes(starts[own], size[own])
        across = np.repeat(starts[others[own]], count) + 8 * number
        mask = LANE[np.minimum(np.repeat(size[own], count) - 8 * number, 8)]
        differ = (view[where] & mask) != (view[across] & mask)
        same[own[np.repeat(np.arange(len(own)), count)[differ]]] = False
        first = last
    return same


def distinct_runs(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The number of one run of each content (and ``kind``), and for every run which of these it equals.

    Contents are told apart by their bytes: runs that only share a hash are separate.
    """
    hashes = hash_runs(data, starts, ends)
    if kind is not None:
        hashes ^= kind.astype(np.uint64)
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    same = same_runs(data, starts, ends, first[inverse])
    if kind is not None:
        same &= kind == kind[first[inverse]]
    odd = np.flatnonzero(~same)
    if len(odd):
        seen: dict[tuple, int] = {}
        for i in odd.tolist():
            key = (data[starts[i] : ends[i]].tobytes(), None if kind is None else int(kind[i]))
            if key not in seen:
                seen[key] = len(first)
                first = np.append(first, i)
            inverse[i] = seen[key]
    return first, inverse


def windows(hashes: np.ndarray, firsts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``width`` neighbouring words inside a text, and the text of each window."""
    total = len(hashes)
    texts = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    if total < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = total - width + 1
    same = texts[:count] == texts[width - 1 :]
    value = np.zeros(count, np.uint64)
    for k in range(width):
        value += mix(hashes[k : k + count] + np.uint64(k + 1)) * powers(width + 1)[k + 1]
    return mix(value)[same], texts[:count][same]


def per_text(counts_of: np.ndarray, texts: int, weights: np.ndarray | None = None) -> np.ndarray:
    """How many (or which sum) each text has."""
    out = np.bincount(counts_of, weights, minlength=texts)
    return out.astype(np.int64)


def ragged(offsets: np.ndarray, lengths_: np.ndarray) -> np.ndarray:
    """Indices that gather runs [offset, offset + length) one after the other."""
    total = int(lengths_.sum())
    at = np.cumsum(lengths_) - lengths_
    return np.arange(total, dtype=np.int64) + np.repeat(offsets - at, lengths_)
