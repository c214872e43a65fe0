"""Exact substring dedup over bytes with a sparse, range-partitioned suffix array.

Every byte covered by a ``width``-byte string that starts at two places or more is removed. Full
suffix arrays hold one suffix for each byte; here only suffixes at winnowed anchors that occur more
than once are held (see ``seeds``), each with the text around it. They are range-partitioned by
their leading bytes with splitters drawn from a sample; each bucket sorts its suffixes, and the
reversed texts before them, by multikey quicksort on eight bytes at a time, and windows are compared
by the ranks and common prefix lengths of neighbours. Equal leading bytes never straddle a boundary;
an anchor with more than ``HOT`` contexts goes another way, in which its windows are counted one
by one (128-bit digests, partial aggregation) and no bucket holds them.

Defined results: a null text is empty; matches never cross documents; texts under ``width`` bytes
lose nothing; repeated rows count as two documents; null ids take part; an empty table gives an
empty result. Extra columns are not carried. One document is never split: a task's memory follows its
buckets (``seeds.BUCKET_BYTES``, or the contexts of one anchor, ``HOT`` at most) and the longest text.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .seeds import HOT, IDENTITY, IDENTITY_TYPE, Anchors, bucketed, covered, identity, keyed, known_spans, marked, repeated, sent, with_spans
from .storage import partitions
from .vectext import buffers, chunks, prefix_hash, released, sliced, span_hash

WIDTH = 200
GRAM = 32


#: Documents, and leads of each, in the sample from which splitters are drawn.
SAMPLE_DOCUMENTS = 2000
SAMPLE_LEADS = 16


def _byte_units(size: int):
    def units(data: np.ndarray, off: np.ndarray):
        prefix = prefix_hash(data)
        at = np.arange(max(0, len(data) - size + 1))
        gram = span_hash(prefix, at, at + size)
        return gram, gram, off, lambda first, last: span_hash(prefix, first, last), None

    return units


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of the rows of a byte matrix: multikey quicksort with eight bytes as one character.

    Each pass sorts by one character only the rows that are equal so far.
    """
    n, width = rows.shape
    pad = -width % 8
    if pad:
        rows = np.concatenate([rows, np.zeros((n, pad), np.uint8)], axis=1)
    chars = np.ascontiguousarray(rows).view(">u8")  # in place: a column is converted when it is compared
    order = np.arange(n)
    group = np.zeros(n, np.int64)  # by place in order
    live = np.arange(n)
    for k in range(chars.shape[1]):
        part = order[live]
        c = chars[part, k].astype(np.uint64)
        by = np.lexsort((c, group[live]))
        order[live] = part[by]
        c, g = c[by], group[live]
        new = np.ones(len(live), bool)
        new[1:] = (c[1:] != c[:-1]) | (g[1:] != g[:-1])
        number = np.cumsum(new)
        group[live] = number
        count = np.bincount(number)
        live = live[count[number] > 1]
        if not len(live):
            break
    return order


def neighbour_lcp(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row in order with the one before it (the first: -1)."""
    out = np.full(len(order), -1, np.int64)
    for a in range(1, len(order), 20_000):
        b = min(len(order), a + 20_000)
        same = rows[order[a:b]] == rows[order[a - 1 : b - 1]]
        out[a:b] = np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1))
    return out


def repeated_windows(
    texts: pa.Array, before: np.ndarray, windows: np.ndarray, width: int, gram: int,
) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the least and largest start (relative to its text) of a window that another
    suffix has as well; -1 where there is none.

    texts[i] (bytes) spans the windows with starts 0..windows[i] - 1; the suffix begins at before[i].
    """
    n = len(texts)
    flat, off = buffers(texts)
    base, size = off[:-1], np.diff(off)

    def matrix(length: np.ndarray, depth: int, step: int, start: np.ndarray) -> np.ndarray:
        out = np.zeros((n, -(-depth // 8) * 8), np.uint8)
        inner = np.arange(depth)
        for a in range(0, n, 1000):
            inside = inner < length[a : a + 1000, None]
            at = start[a : a + 1000, None] + step * inner
            out[a : a + 1000, :depth][inside] = flat[at[inside]]
        return out

    def ranks(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = multikey_order(rows)
        return order, neighbour_lcp(rows, order)

    right_order, right_lcp = ranks(matrix(np.minimum(size - before, width), width, 1, base + before))
    left_order, left_lcp = ranks(matrix(np.minimum(before, width - gram), width - gram, -1, base + before - 1))
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for j in range(width - gram, -1, -1):  # windows that start j bytes before the suffix, by rising start
        start = before - j
        live = np.flatnonzero((start >= 0) & (start < windows))
        if len(live) < 2:
            continue
        left[left_order] = np.cumsum(left_lcp < j)
        right[right_order] = np.cumsum(right_lcp < width - j)
        key = left[live] * (n + 1) + right[live]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        twice = np.zeros(len(live), bool)
        twice[by[1:][same]] = True
        twice[by[:-1][same]] = True
        hit = live[twice]
        high[hit] = start[hit]
        low[hit] = np.where(low[hit] < 0, start[hit], low[hit])
    return low, high


def _splitters(rows: DataFrame, anchors: Anchors, parts: int) -> list[bytes]:
    """parts - 1 leads at most, from a sample of SAMPLE_DOCUMENTS rows with SAMPLE_LEADS anchors each, those
    of least hash. They only balance the buckets; any splitters give the same result."""
    n = rows.count()
    if parts < 2 or not n:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(0))
            for a, b in chunks(off):
                part = data[off[a] : off[b]]
                found = anchors(part, off[a : b + 1] - off[a])
                order = np.lexsort((found.gram, found.doc))
                rank = np.arange(len(order)) - np.searchsorted(found.doc[order], found.doc[order])
                raw = part.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(
                            [raw[i : i + anchors.size] for i in found.place[order[rank < SAMPLE_LEADS]].tolist()],
                            pa.binary(),
                        )
                    ],
                    names=["lead"],
                )

    some = rows.select("text").sample(min(1.0, SAMPLE_DOCUMENTS / n), seed=11)
    leads = sorted(bytes(r[0]) for r in some.mapInArrow(released(run), "lead binary").collect())
    return sorted({leads[len(leads) * k // parts] for k in range(1, parts)}) if leads else []


def _suffixes(rows: DataFrame, anchors: Anchors, splitters: list[bytes]) -> DataFrame:
    """(part, lead, did, x1, x2, at, before, windows, around) from rows with cool; part: how many splitters
    are not above the lead. A row without windows is a stretch that is known to be repeated, of ``before``
    bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(4))
            did = batch.column(1).to_numpy()
            for a, b in chunks(off):
                part = data[off[a] : off[b]]
                f = anchors(part, off[a : b + 1] - off[a])
                f = f.only(marked(f.doc, f.value, batch.column(5).slice(a, b - a)))
                raw = part.tobytes()
                go = sent(f, did[a:b], True)
                doc, first, size = known_spans(f, go.known, anchors.width)
                s = f.only(go.index)
                around = (
                    [raw[i : j + anchors.width] for i, j in zip(s.first.tolist(), s.last.tolist(), strict=True)]
                    + [b""] * len(doc)
                )
                lead = [raw[i : i + anchors.size] for i in s.place.tolist()]
                where = [bisect_right(splitters, x) for x in lead] + [k % (len(splitters) + 1) for k in range(len(doc))]
                lead += [int(k).to_bytes(8) for k in a + doc]
                none = np.zeros(len(doc), np.int64)
                numbers = [
                    np.concatenate(x)
                    for x in (
                        [s.first - s.bounds[s.doc], first],
                        [s.place - s.first, size],
                        [s.last - s.first + 1, none],
                    )
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(where, pa.int32()),
                        pa.array(lead, pa.binary()),
                        *identity(batch, a + np.concatenate([s.doc, doc])),
                        *(pa.array(x.astype(np.int32)) for x in numbers),
                        pa.array(around, pa.binary()),
                    ],
                    names=["part", "lead", *IDENTITY, "at", "before", "windows", "around"],
                )

    schema = f"part int, lead binary, {IDENTITY_TYPE}, at int, before int, windows int, around binary"
    # Both lists, so that both ways share the exchange of the lists.
    return rows.where(F.size("cool") > 0).select(
        "doc_id", *IDENTITY, "text", "cool", "hots",
    ).mapInArrow(released(run), schema)


def _compared(suffixes: DataFrame, width: int, gram: int, parts: int) -> DataFrame:
    """(did, x1, x2, first, last): bytes first..last - 1 of the document are repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in bucketed(batches, 1):
            windows, at, before = (t[x].to_numpy().astype(np.int64) for x in ("windows", "at", "before"))
            low, high = repeated_windows(
                t["around"].combine_chunks(), np.where(windows, before, 0), windows, width, gram,
            )
            known = windows == 0
            low[known], high[known] = 0, before[known] - width
            hit = np.flatnonzero(low >= 0)
            first, last = at[hit] + low[hit], at[hit] + high[hit] + width
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(t[x].to_numpy()[hit]) for x in IDENTITY),
                    pa.array(first.astype(np.int32)),
                    pa.array(last.astype(np.int32)),
                ],
                names=[*IDENTITY, "first", "last"],
            )

    dealt = suffixes.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "lead")
    return dealt.mapInArrow(released(run), f"{IDENTITY_TYPE}, first int, last int")


def _counted(rows: DataFrame, anchors: Anchors) -> DataFrame:
    """The same for the windows of hot anchors, one row for each window, combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(4))
            for a, b in chunks(off):
                part = data[off[a] : off[b]]
                f = anchors(part, off[a : b + 1] - off[a])
                f = f.only(marked(f.doc, f.value, batch.column(6).slice(a, b - a)))
                raw = part.tobytes()
                size = f.last - f.first + 1
                start = np.arange(size.sum()) + np.repeat(f.first - (np.cumsum(size) - size), size)
                of = np.repeat(f.doc, size)
                key = [hashlib.blake2b(raw[s : s + anchors.width], digest_size=16).digest() for s in start.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key, pa.binary()),
                        *identity(batch, a + of),
                        pa.array((start - f.bounds[of]).astype(np.int32)),
                    ],
                    names=["key", *IDENTITY, "first"],
                )

    windows = rows.where(F.size("hots") > 0).select("doc_id", *IDENTITY, "text", "cool", "hots").mapInArrow(
        released(run),
        f"key binary, {IDENTITY_TYPE}, first int",
    )
    many = windows.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    return windows.join(many, "key").select(*IDENTITY, "first", (F.col("first") + anchors.width).alias("last"))


def repeated_spans(docs: DataFrame, *, width: int = WIDTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, did, x1, x2, text, spans) for every row of docs, see with_spans; spans may overlap."""
    rows = keyed(docs)
    parts = partitions(docs.sparkSession)
    anchors = Anchors(_byte_units(gram), width, gram)
    texts = rows.join(repeated(rows, anchors, True, hot), "key")
    suffixes = _suffixes(texts, anchors, _splitters(rows, anchors, parts))
    hots = _counted(texts, anchors)
    return with_spans(rows, _compared(suffixes, width, gram, parts).unionByName(hots))


def dedup(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) for every row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, 4):
                data, off = buffers(part.column(4))
                gone = covered(part, off)
                new = gone.copy()
                new[1:] &= ~gone[:-1]
                head = off[:-1][off[:-1] < len(gone)]
                new[head] = gone[head]
                count = lambda mark, off=off: np.diff(np.concatenate([[0], np.cumsum(mark)])[off])
                removed = count(gone)
                left = np.concatenate([[0], np.cumsum(np.diff(off) - removed)]).astype(np.int32)
                kept = pa.Array.from_buffers(
                    pa.binary(),
                    part.num_rows,
                    [None, pa.py_buffer(left.tobytes()), pa.py_buffer(data[~gone].tobytes())],
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(off)), pa.array(removed), pa.array(count(new)), kept],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return repeated_spans(docs, **options).mapInArrow(
        released(run),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary",
    )
