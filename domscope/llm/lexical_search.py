"""Ranked lexical search: the k best documents for each item, by impact-ordered score-at-a-time.

Terms are maximal runs of ASCII letters, digits and non-ASCII characters, only A-Z lower-cased; they are
compared by 64-bit hashes. A posting's impact depends on the term's count in the document and on the
document's length, an item's term multiplies it by its weight and its number of repeats (``impacts``,
``weights``); all sums are integers.

``rank`` reads whole texts once for each block of items (of about ``ITEM_BYTES`` of text, so that a
block's terms go with the tasks) and writes the postings of the block's terms, some tenth of the text.
Counts over all documents come from these. Then each task builds an impact-ordered index of up to
``POSTINGS`` postings at a time: postings of a term in groups of equal impact, groups descending. For an
item the groups of all its terms are added in the order of their contribution, band by band. Behind each
band the next contributions of all terms sum to a bound on what any document can still gain. When the
bound is under the k-th best sum (of this index, or of those that the task has searched before), no other
document can enter; once few are left that can, their scores are completed term by term. Sums never skip a
group for any other reason, so the result is exact. Lists of tasks are merged in two steps.

Defined results: null texts and texts without a term take no part and count for nothing; an item without a
term, or whose terms are in no document, has no rows; repeated rows of documents are ranked one by one, of
equal scores the smaller doc_id first, null ids last; repeated rows of items give repeated results; empty
tables give an empty result. Extra columns are not carried. One text is never split.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import discard, kept_with, written
from .vectext import LOWER, Words, buffers, chunks, released

#: Text of the items that are searched in one reading of the documents.
ITEM_BYTES = 4 << 20
#: Postings of one impact-ordered index.
POSTINGS = 2_000_000
#: An item's search ends when so many documents at most can be among its best.
FEW = 200
#: A band reaches down to this part of the contribution at which it begins.
BAND = 0.7

#: Bytes that are in no term: ASCII but letters and digits.
OTHER = np.zeros(256, dtype=bool)
OTHER[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 * ln((2 N + 2) / (2 df + 1))) of terms in df of N documents."""
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impact of tf occurrences in a document of n terms, among n_docs documents of n_terms terms; under 10**6."""
    m = 25 + (75 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


@dataclass
class Items:
    """Items of a block: terms[at[i]:at[i + 1]] are item i's, as places in the sorted ``vocabulary``, with repeats."""

    ids: list
    vocabulary: np.ndarray
    at: np.ndarray
    terms: np.ndarray
    repeats: np.ndarray


def counted(data: np.ndarray, off: np.ndarray, vocabulary: np.ndarray | None = None):
    """(terms of each text, text, term, occurrences) of texts data[off[i]:off[i + 1]], sorted by text and term.

    Terms are hashes, or places in the vocabulary, without the words that are not in it."""
    words = Words(LOWER[data], off, separator=OTHER)
    text, term = np.repeat(np.arange(len(off) - 1), words.counts), words.hash
    if vocabulary is not None:
        place = np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)
        known = vocabulary[place] == term
        text, term = text[known], place[known]
    order = np.lexsort((term, text))
    text, term = text[order], term[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(first)
    return words.counts, text[at], term[at], np.diff(np.append(at, len(text)))


def parsed(table: pa.Table) -> Items:
    """Items from (item_id, text)."""
    data, off = buffers(table.column("text"))
    if not len(data):
        none = np.zeros(0, np.int64)
        return Items([], np.zeros(0, np.uint64), np.zeros(1, np.int64), none, none)
    _, text, term, times = counted(data, off)
    vocabulary, place = np.unique(term, return_inverse=True)
    at = np.searchsorted(text, np.arange(table.num_rows + 1))
    return Items(table.column("item_id").to_pylist(), vocabulary, at, place.astype(np.int64), times.astype(np.int64))


def _postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs) of each document with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(1))
            for a, b in chunks(off):
                n, text, term, tf = counted(data[off[a] : off[b]], off[a : b + 1] - off[a], vocabulary)
                some = np.flatnonzero(n)
                at = np.append(np.searchsorted(text, some), len(text)).astype(np.int32)
                lists = (pa.ListArray.from_arrays(pa.array(at), pa.array(x.astype(np.int32))) for x in (term, tf))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(pa.array(some)), pa.array(n[some].astype(np.int64)), *lists],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    return docs.mapInArrow(released(run), "doc_id long, n long, terms array<int>, tfs array<int>")


class Index:
    """Postings of some documents, ordered by term and descending impact, and by document and term."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.keys, self.by_doc = doc * n_terms + term, impact
        order = np.argsort(term << 20 | (1 << 20) - 1 - impact, kind="stable")
        self.doc, self.impact = doc[order], impact[order]
        self.ascending = -self.impact
        self.at = np.searchsorted(term[order], np.arange(n_terms + 1))

    def search(self, terms: np.ndarray, factors: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores): all documents of positive score that can be among the k best, if the k-th
        best of other documents has the score ``floor`` (0: there are none)."""
        use = (self.at[terms] < self.at[terms + 1]) & (factors > 0)
        terms, factors = terms[use], factors[use]
        place, end = self.at[terms].copy(), self.at[terms + 1]
        sums = np.zeros(self.n_docs, np.int64)

        def following() -> np.ndarray:
            """The next contribution of each term."""
            return np.where(place < end, factors * self.impact[np.minimum(place, len(self.impact) - 1)], 0)

        ahead = following()
        while ahead.any():
            least = int(ahead.max() * BAND)
            for i in np.flatnonzero(ahead > least):
                # Those with factor * impact > least.
                stop = place[i] + np.searchsorted(self.ascending[place[i] : end[i]], -(least // factors[i]), side="left")
                sums[self.doc[place[i] : stop]] += factors[i] * self.impact[place[i] : stop]
                place[i] = stop
            ahead = following()
            bound = int(ahead.sum())
            kth = int(np.partition(sums, self.n_docs - k)[self.n_docs - k]) if self.n_docs >= k else 0
            kth = max(kth, floor)
            if bound < kth and np.count_nonzero(sums + bound >= kth) <= max(FEW, k):
                found = np.flatnonzero(sums + bound >= kth)
                return found, self.complete(found, terms, factors)
        kth = int(np.partition(sums, self.n_docs - k)[self.n_docs - k]) if self.n_docs >= k else 0
        found = np.flatnonzero(sums >= max(kth, floor, 1))
        return found, sums[found]

    def complete(self, docs: np.ndarray, terms: np.ndarray, factors: np.ndarray) -> np.ndarray:
        """Whole scores of documents."""
        keys = docs[:, None] * self.n_terms + terms[None, :]
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[place] == keys, self.by_doc[place] * factors[None, :], 0).sum(axis=1)


def _best(found: list[tuple], k: int) -> list[tuple]:
    """The k best of (score, id), ties to smaller ids, null ids last."""
    return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]


def _searched(postings: DataFrame, items: Items, weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(place, item_id, doc_id, score): k rows at most of each item from each task."""
    v = len(items.vocabulary)
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: list[list[tuple]] = [[] for _ in items.ids]

        def search(part: pa.Table) -> None:
            lengths, terms = part.column("n").to_numpy(), part.column("terms").combine_chunks()
            tf = part.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(len(lengths)), terms.value_lengths().to_numpy())
            if not len(doc):
                return
            index = Index(
                doc, terms.flatten().to_numpy().astype(np.int64), impacts(tf, lengths[doc], n_docs, n_terms), len(lengths), v,
            )
            ids = part.column("doc_id")
            for i, had in enumerate(lists):
                own = slice(items.at[i], items.at[i + 1])
                floor = had[-1][0] if len(had) == k else 0
                terms_of = items.terms[own]
                found, scores = index.search(terms_of, items.repeats[own] * weight[terms_of], k, floor)
                new = zip(scores.tolist(), ids.take(pa.array(found)).to_pylist(), strict=True)
                lists[i] = _best(had + [x for x in new if x[0] > 0], k)

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column(2).flatten())
            if size >= POSTINGS:
                search(pa.Table.from_batches(held))
                held, size = [], 0
        if held:
            search(pa.Table.from_batches(held))
        rows = [(i, items.ids[i], doc, score) for i, found in enumerate(lists) for score, doc in found]
        for a in range(0, len(rows), 1 << 16):
            columns = zip(*rows[a : a + (1 << 16)], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["place", "item_id", "doc_id", "score"],
            )

    return postings.mapInArrow(released(run), "place int, item_id long, doc_id long, score long")


def _merged(rows: DataFrame, k: int) -> DataFrame:
    """The k best of each place, first within parts of the ids, so that no place is sorted whole by one task."""
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    for keys in (("place", F.pmod(F.xxhash64("doc_id"), F.lit(64))), ("place",)):
        rows = rows.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return rows


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents of (doc_id, text) for each item of (item_id, text)."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.length("text") > 0)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-int(total) // ITEM_BYTES))
    out = []
    for b in range(n_blocks):
        block = parsed(items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b).toArrow())
        if not len(block.vocabulary):
            continue
        postings = written(_postings(docs, block.vocabulary))
        n_docs, n_terms = postings.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            discard(postings)
            continue
        df = np.zeros(len(block.vocabulary), np.int64)
        held = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
        df[held.column("term").to_numpy()] = held.column("df").to_numpy()
        found = _searched(postings, block, weights(df, n_docs), n_docs, n_terms, k)
        out.append(written(_merged(found, k).select("item_id", "rank", "doc_id", "score"), postings))
    if not out:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return kept_with(reduce(DataFrame.unionByName, out), *out)
