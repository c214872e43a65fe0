"""Substring dedup over words by seed and extend.

Documents are joined on winnowed anchors (grams of ``GRAM`` words, see ``seeds``); from each anchor
the matches are extended word by word to both sides for all documents of a bucket at once, and
windows of ``width`` equal words are kept: a word is removed if such a window covers it whose words
also start in a document with a smaller doc_id. Runs of overlapping windows make up the maximal
repeats. Words are compared by 64-bit hashes. An anchor with more than ``HOT`` contexts goes
another way: its windows are counted one by one (128-bit digests, partial aggregation).

Defined results: a null text has no words; documents under ``width`` words lose nothing; rows with
the same doc_id never remove each other's words; a null doc_id counts as larger than all others; an
empty table gives an empty result. Extra columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .seeds import HOT, IDENTITY, IDENTITY_TYPE, Anchors, bucketed, covered, identity, keyed, known_spans, marked, repeated, sent, with_spans
from .storage import partitions
from .vectext import Words, buffers, chunks, gram_hash, prefix_hash, released, sliced, span_hash

WIDTH = 13
GRAM = 3


#: Seeds of a bucket are compared by about a dozen arrays of their words, so buckets are smaller here.
BUCKET_BYTES = 1 << 20


def _word_units(size: int):
    def units(data: np.ndarray, off: np.ndarray):
        words = Words(data, off)
        gram = gram_hash(words.hash, size)
        # Long grams are rare, so they come first in the order and make better seeds. Separators don't count.
        total = np.concatenate([[0], np.cumsum(words.end - words.start)]).astype(np.uint64)
        length = total[size:] - total[: len(gram)] if len(gram) else np.zeros(0, np.uint64)
        rank = np.uint64(63) - np.minimum(length >> np.uint64(1), np.uint64(63))

        prefix = prefix_hash(words.hash)
        return gram, (
            rank << np.uint64(58)
        ) | (gram >> np.uint64(6)), words.doc, lambda first, last: span_hash(prefix, first, last), words

    return units


def _seeds(rows: DataFrame, anchors: Anchors, column: str) -> DataFrame:
    """(h, did, x1, x2, at, before, windows, more, around): the words around each anchor that may carry a
    repeat, followed by ``more`` further places (32 bits each) where the document has the same words. A
    row without windows is a stretch that is known to go, of ``more`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(4))
            did, x1 = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            lists = batch.column(batch.schema.get_field_index(column))
            for a, b in chunks(off):
                part = data[off[a] : off[b]]
                f = anchors(part, off[a : b + 1] - off[a])
                f = f.only(marked(f.doc, f.value, lists.slice(a, b - a)))
                words, raw = f.more, part.tobytes()
                go = sent(f, did[a:b], False)
                doc, first, size = known_spans(f, go.known, anchors.width)
                s = f.only(go.index)
                around = [
                    raw[i:j]
                    for i, j in zip(
                        words.start[s.first].tolist(),
                        words.end[s.last + anchors.width - 1].tolist(),
                        strict=True,
                    )
                ]
                further, cut = f.at(go.places).astype(np.int32), np.cumsum(go.more)
                for k in np.flatnonzero(go.more).tolist():
                    around[k] += further[cut[k] - go.more[k] : cut[k]].tobytes()
                around += [b""] * len(doc)
                none = np.zeros(len(doc), np.int64)
                h = np.concatenate([s.gram.view(np.int64), x1[a + doc]])
                at = np.concatenate([s.first - s.bounds[s.doc], first])
                before, windows = np.concatenate([s.place - s.first, none]), np.concatenate(
                    [s.last - s.first + 1, none]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h),
                        *identity(batch, a + np.concatenate([s.doc, doc])),
                        pa.array(at.astype(np.int32)),
                        pa.array(before.astype(np.int16)),
                        pa.array(windows.astype(np.int16)),
                        pa.array(np.concatenate([go.more, size]).astype(np.int32)),
                        pa.array(around, pa.binary()),
                    ],
                    names=["h", *IDENTITY, "at", "before", "windows", "more", "around"],
                )

    schema = f"h long, {IDENTITY_TYPE}, at int, before short, windows short, more int, around binary"
    # Both lists, so that the seeds of either share the exchange of the lists.
    return rows.where(F.size(column) > 0).select(
        "doc_id", *IDENTITY, "text", "cool", "hots",
    ).mapInArrow(released(run), schema)


def unpacked(blobs: pa.Array, more: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(texts, further places of all rows in a row) of the blobs of seeds."""
    data, off = buffers(blobs)
    tail = 4 * more
    size = np.diff(off)
    end = np.repeat(off[1:] - tail, size)
    place = np.arange(len(data)) >= end
    text_off = np.concatenate([[0], np.cumsum(size - tail)]).astype(np.int32)
    texts = pa.Array.from_buffers(
        pa.binary(),
        len(more),
        [None, pa.py_buffer(text_off.tobytes()), pa.py_buffer(data[~place].tobytes())],
    )
    return texts, np.frombuffer(data[place].tobytes(), np.int32).astype(np.int64)


def _classes(
    group: np.ndarray, words: np.ndarray, place: np.ndarray, inside: np.ndarray, step: int, depth: int,
) -> list[np.ndarray]:
    """Classes of rows that agree on the next 0, 1, ... depth words from ``place`` on in direction step."""
    out = [group]
    for d in range(depth):
        at = place + step * d
        ok = inside(at)
        word = np.where(ok, words[np.where(ok, at, 0)], np.uint64(0))
        key = np.stack([out[-1].astype(np.uint64), word])
        order = np.lexsort(key[::-1])
        new = np.ones(len(order), bool)
        new[1:] = (key[:, order][:, 1:] != key[:, order][:, :-1]).any(axis=0)
        cls = np.empty(len(order), np.int64)
        cls[order] = np.cumsum(new)
        out.append(cls)
    return out


def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of all texts, bounds by text), a chunk of texts at a time."""
    data, off = buffers(texts)
    parts = [Words(data[off[a] : off[b]], off[a : b + 1] - off[a]) for a, b in chunks(off)]
    counts = np.concatenate([w.counts for w in parts])
    return np.concatenate([w.hash for w in parts]), np.concatenate([[0], np.cumsum(counts)])


def removed_windows(
    h: np.ndarray, did: np.ndarray, texts: pa.Array, before: np.ndarray, windows: np.ndarray, width: int, gram: int,
) -> tuple[np.ndarray, np.ndarray]:
    """For each seed the least and largest start (relative to its text) of a window that a smaller
    doc_id has as well; -1 where there is none."""
    n = len(texts)
    words, bounds = _word_hashes(texts)
    first, end = bounds[:-1], bounds[1:]
    place = first + before
    _, group = np.unique(h, return_inverse=True)
    group = _classes(group.astype(np.int64), words, place, lambda at: at < end, 1, gram)[-1]
    right = _classes(group, words, place + gram, lambda at: at < end, 1, width - gram)
    left = _classes(group, words, place - 1, lambda at: at >= first, -1, width - gram)
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    for j in range(width - gram, -1, -1):  # windows that start j words before the anchor
        start = before - j
        live = np.flatnonzero((start >= 0) & (start < windows))
        if len(live) < 2:
            continue
        key = left[j][live] * (n + 1) + right[width - gram - j][live]
        by = np.argsort(key, kind="stable")
        edge = np.concatenate([[0], np.flatnonzero(np.diff(key[by])) + 1])
        least = np.repeat(np.minimum.reduceat(did[live][by], edge), np.diff(np.append(edge, len(by))))
        hit = live[by[did[live][by] > least]]
        high[hit] = start[hit]
        low[hit] = np.where(low[hit] < 0, start[hit], low[hit])
    return low, high


def _extended(seeds: DataFrame, width: int, gram: int) -> DataFrame:
    """(did, x1, x2, first, last): words first..last - 1 of the document go."""
    n = partitions(seeds.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in bucketed(batches, 0, BUCKET_BYTES):
            at, before, windows, more = (t[x].to_numpy().astype(np.int64) for x in ("at", "before", "windows", "more"))
            known = windows == 0
            texts, further = unpacked(t["around"].combine_chunks(), np.where(known, 0, more))
            low, high = removed_windows(t["h"].to_numpy(), t["did"].to_numpy(), texts, before, windows, width, gram)
            low[known], high[known] = 0, more[known] - width
            # The further places of a seed share its answer.
            row = np.concatenate([np.arange(len(at)), np.repeat(np.arange(len(at)), np.where(known, 0, more))])
            at = np.concatenate([at, further])
            hit = np.flatnonzero(low[row] >= 0)
            row, at = row[hit], at[hit]
            first, last = at + low[row], at + high[row] + width
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(t[x].to_numpy()[row]) for x in IDENTITY),
                    pa.array(first.astype(np.int32)),
                    pa.array(last.astype(np.int32)),
                ],
                names=[*IDENTITY, "first", "last"],
            )

    return seeds.repartition(n, "h").sortWithinPartitions("h").mapInArrow(
        released(run),
        f"{IDENTITY_TYPE}, first int, last int",
    )


def _counted(seeds: DataFrame, width: int) -> DataFrame:
    """The same for hot anchors, one row for each window, combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, 6):
                at, windows, more = (part.column(k).to_numpy().astype(np.int64) for k in (3, 4, 5))
                known = windows == 0
                texts, further = unpacked(part.column(6), np.where(known, 0, more))
                places = np.split(further, np.cumsum(np.where(known, 0, more))[:-1])
                key, row, first = [], [], []
                for k, (text, n) in enumerate(zip(texts.to_pylist(), windows.tolist(), strict=True)):
                    words = text.split()
                    for s in range(n):
                        digest = hashlib.blake2b(b" ".join(words[s : s + width]), digest_size=16).digest()
                        for p in (int(at[k]), *places[k].tolist()):
                            key.append(digest)
                            row.append(k)
                            first.append(p + s)
                    if not n:  # a window of its own for each word that is known to go
                        for s in range(0, int(more[k]) - width + 1):
                            key.append(None)
                            row.append(k)
                            first.append(int(at[k]) + s)
                rows = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key, pa.binary()),
                        *(part.column(c).take(rows) for c in range(3)),
                        pa.array(first, pa.int32()),
                    ],
                    names=["key", *IDENTITY, "first"],
                )

    windows = seeds.select(*IDENTITY, "at", "windows", "more", "around").mapInArrow(
        released(run),
        f"key binary, {IDENTITY_TYPE}, first int",
    )
    least = windows.groupBy("key").agg(
        F.min("did").alias("least"), F.max("did").alias("most"),
    ).where("least < most").select("key", "least")
    hit = windows.where("key is null").select(*IDENTITY, "first").unionByName(
        windows.join(least, "key").where("did > least").select(*IDENTITY, "first")
    )
    return hit.withColumn("last", F.col("first") + width)


def repeated_spans(docs: DataFrame, *, width: int = WIDTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, did, x1, x2, text, spans in words) for every row of docs, see with_spans."""
    rows = keyed(docs)
    anchors = Anchors(_word_units(gram), width, gram)
    texts = rows.join(repeated(rows, anchors, False, hot), "key")
    cool = _extended(_seeds(texts, anchors, "cool"), width, gram)
    hots = _counted(_seeds(texts, anchors, "hots"), width)
    return with_spans(rows, cool.unionByName(hots))


def joined(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each document, one space between them."""
    doc = np.searchsorted(words.doc, keep, side="right") - 1
    size = words.end[keep] - words.start[keep] + 1
    size[:-1] -= doc[1:] != doc[:-1]  # the last word of a document has no space
    size[-1:] -= 1
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
    inside = at < np.repeat(words.end[keep] - words.start[keep], size)
    out = np.full(len(at), 0x20, np.uint8)
    out[inside] = words.data[(np.repeat(words.start[keep], size) + at)[inside]]
    length = (
        np.bincount(doc, weights=size, minlength=len(words.doc) - 1).astype(np.int64)
        if len(keep)
        else np.zeros(len(words.doc) - 1, np.int64)
    )
    left = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.string(),
        len(length),
        [None, pa.py_buffer(left.tobytes()), pa.py_buffer(out.tobytes())],
    )


def dedup(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): kept words joined by one space, for every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, 4):
                data, off = buffers(part.column(4))
                words = Words(data, off, hashed=False)
                gone = covered(part, words.doc)
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.doc])
                kept = joined(words, np.flatnonzero(~gone))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words.counts), pa.array(removed), kept],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    return repeated_spans(docs, **options).mapInArrow(
        released(run),
        "doc_id long, n_words long, n_removed long, kept string",
    )
