"""Vectorised primitives over the UTF-8 bytes of Arrow string columns.

Every function works on whole texts. A batch is walked in chunks of whole documents so that
the working set stays near ``CHUNK_BYTES`` times a small constant; one document is never split.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18

#: Word separators: space and \t \n \v \f \r.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: A random odd number for each byte.
BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def release() -> None:
    """Give freed memory back to the system. A worker is kept after its task and serves later stages, and
    the C library holds on to what numpy freed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def released(run: Callable) -> Callable:
    """run, which maps batches to batches, with release() when it ends and now and then before."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for k, batch in enumerate(run(batches)):
                yield batch
                if k % 64 == 63:
                    release()
        finally:
            release()

    return mapped


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if len(_powers[0]) < n:
        size = max(n, 2 * CHUNK_BYTES)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    size = 8 if wide else 4
    off = (
        np.frombuffer(offsets, np.int64 if wide else np.int32, len(column) + 1, column.offset * size).astype(np.int64)
        if len(column)
        else np.zeros(1, np.int64)
    )
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, np.uint8, int(off[-1] - off[0]), int(off[0])), off - off[0]


def chunks(off: np.ndarray, limit: int = 0, rows: int = 1 << 62) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents holding about ``limit`` bytes each (one document at least, ``rows`` at most)."""
    limit = limit or CHUNK_BYTES
    first, n = 0, len(off) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(off, off[first] + limit, side="right")) - 1)
        last = min(last, n, first + rows)
        yield first, last
        first = last


def sliced(batch: pa.RecordBatch, column: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices with about ``limit`` bytes of text each, one row at least."""
    for a, b in chunks(buffers(batch.column(column))[1], limit):
        yield batch.slice(a, b - a)


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a range of documents, or the runs between other separators.

    ``start`` and ``end`` are byte positions in ``data``; words of document i are those with
    index ``doc[i]`` up to ``doc[i + 1]``; ``hash`` is a 64-bit hash of each word's bytes.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, hashed: bool = True, separator: np.ndarray = SEPARATOR):
        self.data, self.off = data, off
        n = len(data)
        inside = ~separator[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[off] = True
        before = np.zeros(n, dtype=bool)
        before[1:] = inside[:-1]
        before &= ~edge[:n]
        self.start = np.flatnonzero(inside & ~before)
        after = np.zeros(n, dtype=bool)
        after[:-1] = inside[1:]
        after &= ~edge[1:]
        self.end = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(self.start, off)
        if hashed:
            self.hash = span_hash(prefix_hash(data), self.start, self.end)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.doc)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """What span_hash needs of bytes, or of 64-bit numbers."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((BYTE[data] if data.dtype == np.uint8 else data) * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each data[start:end], whose prefix_hash is given."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def gram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes (runs may cross documents)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * _BASE + words[k : len(words) - n + 1 + k]
    return mix(out)


def sliding(values: np.ndarray, width: int, fold) -> np.ndarray:
    """fold (np.minimum or np.maximum) over each window of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = fold(out[: len(out) - step], out[step:])
        have += step
    return out
