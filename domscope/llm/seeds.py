"""Winnowed anchors of fixed-length windows, shared by the two exact repeat operators.

A window is ``width`` consecutive units (bytes or words) of one document. Its anchor is the gram of
``gram`` units with the least order key, the rightmost of equals; which place of the window that is
depends on the window's content alone, so equal windows have equal anchors.

Only windows whose anchor stands in the table more than once can be repeated. More than that: of the
``width - gram`` other units of a window at least half lie on one side of its anchor, so one of the two
stretches that begin or end with the anchor and reach half a window further must stand there more
than once as well. An anchor is therefore looked up as 32 bits of the gram's hash with 16 bits of each
stretch's; texts travel only for those that pass. Chance agreements cost work, never correctness.

An anchor travels with its context, the text of all its windows. Equal contexts of a chunk of documents
travel once: their windows are known to be repeated there and then (copies), or they have one answer
for all their places (one document that repeats itself).

Rows are told apart by doc_id and a 128-bit hash of the text: rows alike in both are equal rows, which
have equal results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import partitions
from .vectext import buffers, chunks, mix, released, sliding

_PLACE = np.uint64(31)
_MASK = np.uint64((1 << 31) - 1)
_LOW = np.uint64(0xFFFF)

#: An anchor with more contexts than this is not compared in one bucket: its windows are counted one by
#: one with partial aggregation. A bucket of so many takes some 150 MB.
HOT = 100_000

#: A bucket is closed at the first group that ends beyond so many bytes.
BUCKET_BYTES = 2 << 20

#: What tells rows apart, see the module's text.
IDENTITY = ("did", "x1", "x2")
IDENTITY_TYPE = "did long, x1 long, x2 long"


def window_anchors(order: np.ndarray, bounds: np.ndarray, width: int, size: int) -> tuple[np.ndarray, ...]:
    """(doc, place, first, last): the windows starting at first..last of doc have their anchor at place.

    order: a sort key of the gram starting at each unit; bounds: units by document.
    """
    n = int(bounds[-1])
    none = np.zeros(0, np.int64)
    if n < width:
        return none, none, none, none
    key = (order[: n - size + 1] >> _PLACE << _PLACE) | (_MASK - np.arange(n - size + 1, dtype=np.uint64))
    least = sliding(key, width - size + 1, np.minimum)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    start = np.flatnonzero(doc[: n - width + 1] == doc[width - 1 :])
    if not len(start):
        return none, none, none, none
    place = (_MASK - (least[start] & _MASK)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(new)
    return doc[start[at]], place[at], start[at], start[np.append(at[1:], len(start)) - 1]


class Found:
    """The anchors of a chunk of documents: document, place, first and last window, gram hash, look-up
    value and hash of the context; bounds of the documents in units; ``more`` is what the units function
    adds."""

    def __init__(self, doc, place, first, last, gram, value, context, bounds, more):
        self.doc, self.place, self.first, self.last = doc, place, first, last
        self.gram, self.value, self.context, self.bounds, self.more = gram, value, context, bounds, more

    def only(self, keep: np.ndarray) -> Found:
        parts = (self.doc, self.place, self.first, self.last, self.gram, self.value, self.context)
        return Found(*(x[keep] for x in parts), self.bounds, self.more)

    def at(self, index: np.ndarray) -> np.ndarray:
        """Where the first windows of some anchors start in their documents."""
        return self.first[index] - self.bounds[self.doc[index]]


class Sent(NamedTuple):
    """What travels of a chunk's anchors: ``index`` of those whose contexts do, each with ``more`` further
    places in ``places``; ``known`` are the anchors whose windows all are repeated."""

    index: np.ndarray
    more: np.ndarray
    places: np.ndarray
    known: np.ndarray


def sent(f: Found, did: np.ndarray, within: bool) -> Sent:
    """did: ids by document. Within one document too, every place of an equal context is known. Under
    different ids, those of all but the least id are; of that id each document sends its first place."""
    n = len(f.doc)
    none = np.zeros(0, np.int64)
    if not n:
        return Sent(none, none, none, none)
    before, ids = f.place - f.first, did[f.doc]
    order = np.lexsort((f.doc, ids, before, f.context))
    context, before, ids, doc = f.context[order], before[order], ids[order], f.doc[order]
    new = np.ones(n, bool)
    new[1:] = (context[1:] != context[:-1]) | (before[1:] != before[:-1])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, n))
    if within:
        return Sent(order[head], np.zeros(len(head), np.int64), none, order[np.repeat(size > 1, size)])
    least = ids == np.repeat(ids[head], size)
    start = new.copy()
    start[1:] |= doc[1:] != doc[:-1]
    start = np.flatnonzero(start & least)
    further = np.flatnonzero(least & ~np.isin(np.arange(n), start, assume_unique=True))
    owner = np.searchsorted(start, further, side="right") - 1
    return Sent(order[start], np.bincount(owner, minlength=len(start)), order[further], order[~least])


def known_spans(f: Found, known: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, first, size) of the maximal stretches that the windows of the known anchors cover."""
    if not len(known):
        return known, known, known
    known = known[np.lexsort((f.first[known], f.doc[known]))]
    doc, first, end = f.doc[known], f.first[known], f.last[known] + width
    new = np.ones(len(known), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (first[1:] > end[:-1])  # ends rise with starts
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(known)) - 1
    return doc[head], first[head] - f.bounds[doc[head]], end[last] - first[head]


class Anchors:
    """Finds the anchors of a chunk.

    ``units(data, off)`` gives (gram hashes, order keys, bounds, span, more), where span(first, last)
    hashes the units first..last - 1.
    """

    def __init__(self, units: Callable, width: int, size: int):
        self.units, self.width, self.size = units, width, size
        self.reach = (width - size) // 2

    def __call__(self, data: np.ndarray, off: np.ndarray) -> Found:
        gram, order, bounds, span, more = self.units(data, off)
        doc, place, first, last = window_anchors(order, bounds, self.width, self.size)
        h = gram[place] if len(place) else np.zeros(0, np.uint64)
        left = self._side(span, place - self.reach, place + self.size, bounds, doc)
        right = self._side(span, place, place + self.size + self.reach, bounds, doc)
        value = (h >> np.uint64(32) << np.uint64(32)) | (left << np.uint64(16)) | right
        context = span(first, last + self.width) if len(first) else h
        return Found(doc, place, first, last, h, value, context, bounds, more)

    @staticmethod
    def _side(span: Callable, first: np.ndarray, last: np.ndarray, bounds: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """16 bits of each stretch's hash from 1 on; 0 for one that leaves its document."""
        ok = (first >= bounds[doc]) & (last <= bounds[doc + 1])
        out = np.zeros(len(first), np.uint64)
        out[ok] = span(first[ok], last[ok]) % _LOW + np.uint64(1)
        return out


def _key(did, x1):
    """The key texts are joined by: the id with 16 bits of the text's hash in its upper part. Ids compress
    well, and an id that many rows share (null, above all) is spread by the hash. Rows that share a key by
    chance share a list of candidates, no more."""
    return did.bitwiseXOR(F.shiftleft(x1, 48))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, did, x1, x2, key, text): did is never null (null ids come last)."""
    did = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    rows = docs.select(
        "doc_id",
        did.alias("did"),
        F.xxhash64("text").alias("x1"),
        F.xxhash64(F.lit(20240607), "text").alias("x2"),
        "text",
    )
    return rows.select("doc_id", *IDENTITY, _key(F.col("did"), F.col("x1")).alias("key"), "text")


#: A mark holds the upper 16 bits of an id, which its key mixes with a hash, how many contexts travel
#: (32 bits) and how many occurrences there are, many as one number (8 bits).
_MANY = 255


def marks(did: np.ndarray, contexts: np.ndarray, times: np.ndarray) -> np.ndarray:
    upper = did.view(np.uint64) >> np.uint64(48) << np.uint64(48)
    return upper.view(np.int64) | (contexts << 8) | np.minimum(times, _MANY)


def ids_of(key: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """The ids of rows with these keys and marks (as unsigned numbers)."""
    low = key.view(np.uint64) & np.uint64((1 << 48) - 1)
    return low | (mark.view(np.uint64) >> np.uint64(48) << np.uint64(48))


def anchor_rows(rows: DataFrame, anchors: Anchors, within: bool) -> DataFrame:
    """(value, key, mark): the distinct anchors of each key in a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, did = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, off = buffers(batch.column(2))
            for a, b in chunks(off):
                found = anchors(data[off[a] : off[b]], off[a : b + 1] - off[a])
                mine = key[a + found.doc]
                # Equal rows of a chunk count together; keys stand together, which compresses them.
                order = np.lexsort((found.value, mine, did[a + found.doc]))
                v, k, d = found.value[order], mine[order], did[a + found.doc[order]]
                new = np.ones(len(v), bool)
                new[1:] = (v[1:] != v[:-1]) | (k[1:] != k[:-1]) | (d[1:] != d[:-1])
                head = np.flatnonzero(new)
                travels = np.zeros(len(v), np.int64)
                travels[sent(found, did[a:b], within).index] = 1
                contexts = np.add.reduceat(travels[order], head) if len(head) else head
                mark = marks(d[head], contexts, np.diff(np.append(head, len(v))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v[head].view(np.int64)), pa.array(k[head]), pa.array(mark)],
                    names=["value", "key", "mark"],
                )

    return rows.select("key", "did", "text").mapInArrow(released(run), "value long, key long, mark long")


def _folded(group: np.ndarray, values: np.ndarray, fold: np.ufunc) -> np.ndarray:
    """For each row fold over the values of its group."""
    order = np.argsort(group, kind="stable")
    g = group[order]
    head = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    out = np.empty(len(g), values.dtype)
    out[order] = np.repeat(fold.reduceat(values[order], head), np.diff(np.append(head, len(g))))
    return out


def candidates(
    value: np.ndarray, key: np.ndarray, mark: np.ndarray, within: bool, hot: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(rows to keep, which of all rows are hot) of whole runs of grams, sorted by value. Kept are those with
    a stretch that occurs again (within), or again under another id."""
    v, times, ids = value.view(np.uint64), mark & _MANY, ids_of(key, mark)

    def again(group: np.ndarray) -> np.ndarray:
        if within:
            return _folded(group, times, np.add) > 1
        return _folded(group, ids, np.minimum) != _folded(group, ids, np.maximum)

    left = (v & (_LOW << np.uint64(16)) != 0) & again(v >> np.uint64(16))
    right = (v & _LOW != 0) & again(v & ~(_LOW << np.uint64(16)))
    contexts = mark >> 8 & ((1 << 40) - 1)
    return np.flatnonzero(left | right), _folded(v >> np.uint64(32), contexts, np.add) > hot


def runs(batches: Iterator[pa.RecordBatch], within: bool, hot: int) -> Iterator[pa.RecordBatch]:
    """(key, value, hot) of the anchors that pass, from rows (value, key, mark) sorted by value, in which
    the rows of one gram stand together.

    At most ``hot`` + 1 rows of a gram wait for its end; a longer run is passed on as it comes.
    """
    held = [np.zeros(0, np.int64)] * 3
    passing: int | None = None  # the gram whose rows are passed on
    gram_of = lambda v: v.view(np.uint64) >> np.uint64(32)

    def out(v: np.ndarray, k: np.ndarray, flag: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(v), pa.array(flag)], names=["key", "value", "hot"])

    def settled(v: np.ndarray, k: np.ndarray, mark: np.ndarray) -> pa.RecordBatch:
        keep, flag = candidates(v, k, mark, within, hot)
        return out(v[keep], k[keep], flag[keep])

    for batch in batches:
        new = [c.to_numpy() for c in batch.columns[:3]]
        if passing is not None:
            n = int((gram_of(new[0]) == passing).sum())
            if n:
                yield out(new[0][:n], new[1][:n], np.ones(n, bool))
            new = [x[n:] for x in new]
            if not len(new[0]):
                continue
            passing = None
        held = [np.concatenate([a, b]) for a, b in zip(held, new, strict=True)]
        if not len(held[0]):
            continue
        gram = gram_of(held[0])
        last = int(np.argmax(gram == gram[-1]))
        if last:
            yield settled(*(x[:last] for x in held))
            held = [x[last:] for x in held]
        if len(held[0]) > hot:
            passing = int(gram[-1])
            yield out(held[0], held[1], np.ones(len(held[0]), bool))
            held = [x[:0] for x in held]
    if len(held[0]):
        yield settled(*held)


def repeated(rows: DataFrame, anchors: Anchors, within: bool, hot: int) -> DataFrame:
    """(key, cool, hots): for each key the anchors that may carry a repeat, ``within`` one document too or
    under different ids only.

    Anchors are shuffled once, equal ones of a chunk's equal rows in one row, and a task streams over a
    gram's rows without gathering them.
    """
    n = partitions(rows.sparkSession)
    found = anchor_rows(rows, anchors, within).repartition(n, F.shiftrightunsigned("value", 32))
    # As unsigned numbers, so that the rows of a gram stand together.
    sorted_ = found.sortWithinPartitions(F.shiftrightunsigned("value", 32), "value")
    both = sorted_.mapInArrow(released(lambda batches: runs(batches, within, hot)), "key long, value long, hot boolean")
    one = lambda when: F.collect_set(F.when(when, F.col("value")))
    return both.groupBy("key").agg(one(~F.col("hot")).alias("cool"), one(F.col("hot")).alias("hots"))


def marked(doc: np.ndarray, value: np.ndarray, lists: pa.ListArray) -> np.ndarray:
    """Which (doc, value) stand in the list of the document."""
    size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy().view(np.uint64)
    have = np.sort(mix(values + mix(np.repeat(np.arange(len(size)), size).astype(np.uint64))))
    want = mix(value + mix(doc.astype(np.uint64)))
    at = np.searchsorted(have, want)
    at[at == len(have)] = 0
    return have[at] == want if len(have) else np.zeros(len(want), bool)


def with_spans(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows (of keyed) with ``spans array<struct<x1, x2, first, last>>``; null: none.

    Joined by key, as the lists of anchors are, so that both joins share one exchange of the texts; key and
    x1 give the id. Spans are shuffled as plain rows, which are smaller than partial lists of one or two.
    """
    names = ("x1", "x2", "first", "last")
    dealt = found.select(
        _key(F.col("did"), F.col("x1")).alias("key"),
        *names,
    ).repartition(partitions(rows.sparkSession), "key")
    spans = dealt.groupBy("key").agg(F.collect_set(F.struct(*names)).alias("spans"))
    return rows.join(spans, "key", "left").select("doc_id", *IDENTITY, "text", "spans")


def covered(part: pa.RecordBatch, bounds: np.ndarray) -> np.ndarray:
    """Which units stand in a span of their row. part: columns of with_spans; bounds: units by row."""
    lists = part.column(5)
    row = np.repeat(np.arange(part.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    spans = lists.flatten()
    own = np.ones(len(row), bool)
    for k, name in ((2, "x1"), (3, "x2")):
        own &= spans.field(name).to_numpy() == part.column(k).to_numpy()[row]
    first, last = (bounds[row[own]] + spans.field(x).to_numpy()[own] for x in ("first", "last"))
    n = int(bounds[-1])
    return np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(last, minlength=n + 1))[:n] > 0


def identity(batch: pa.RecordBatch, rows: np.ndarray) -> list[pa.Array]:
    """The identity columns of some rows of a batch that begins with doc_id and them."""
    return [pa.array(batch.column(k).to_numpy()[rows]) for k in (1, 2, 3)]


def bucketed(batches: Iterator[pa.RecordBatch], key: int, limit: int = BUCKET_BYTES) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by the column ``key``: each ends with the first
    group that ends beyond ``limit`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        step = max(1, batch.num_rows * limit // max(1, 4 * batch.nbytes))
        for first in range(0, batch.num_rows, step):
            part = batch.slice(first, step)
            if held and size >= limit:
                last = held[-1].column(key)[held[-1].num_rows - 1].as_py()
                values = part.column(key).to_pylist()
                cut = next((k for k, v in enumerate(values) if v != last), len(values))
                if cut:
                    held.append(part.slice(0, cut))
                part = part.slice(cut)
                if part.num_rows:
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
            if part.num_rows:
                held.append(part)
                size += part.nbytes
    if held:
        yield pa.Table.from_batches(held)
