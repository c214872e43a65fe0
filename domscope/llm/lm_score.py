"""Stupid-backoff scores of documents under a bigram model of all other documents.

For each word w after v, with counts c over the whole table less the document's own:
S(w | v) = c(v w) / c(v) if c(v w) > 0, else 0.4 * max(c(w), 1) / N; the first word of a document
takes max(c(w), 1) / N. N is the number of words elsewhere (1 at least). Words are
``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A document's score is the sum of log10 S.

Relationally: documents are dealt to buckets of about ``BUCKET_BYTES``; each bucket sends its
distinct n-grams with their counts to the count table, which is partitioned by n-gram hash; the
table sums them and answers each bucket; the bucket joins the answers to its exploded n-grams and
sums by document. So an n-gram travels once for each bucket, not for each occurrence, and a frequent
n-gram is one entry of a bucket. N-grams are compared by 64-bit hashes.

The n-grams that a bucket sends to one part of the table are one row, packed and sorted: on 0.86 GB of
text buckets hold 116 million distinct n-grams, 77 million of them in several buckets; as rows of their
own they would take some 1.4 GB out and 1.1 GB back, with the texts six times the compressed input.
Packed rows are never more than these n-grams, but where a bucket has fewer n-grams than the table has
parts (beyond a TB or so) nothing is gained by packing any more.

Documents are dealt by their contents, so both readings of a bucket see the same documents wherever its rows
come from. Rows that are equal more than ``REPEATED`` times are one document with a weight in their bucket,
and as many results.

Defined results: null, empty and wordless texts have no words, sum 0 and a null mean; repeated rows
are other documents to each other; an empty table gives an empty result. Extra columns are not
carried.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .mixing import sizes
from .storage import partitions
from .vectext import LOWER, Words, buffers, chunks, gram_hash, mix, release

ALPHA = 0.4
BUCKET_BYTES = 10 << 20
REPEATED = 100
_ONE = np.uint64(0xA5A5A5A55A5A5A5A)


class Grams:
    """N-grams of a bucket: hash of each occurrence, with the document it stands in."""

    def __init__(self, column: pa.Array):
        data, off = buffers(column)
        one, two, counts = [], [], []
        for a, b in chunks(off):
            words = Words(LOWER[data[off[a] : off[b]]], off[a : b + 1] - off[a])
            pair = gram_hash(words.hash, 2)
            inner = np.ones(len(words.hash), bool)
            inner[words.doc[:-1][words.counts > 0]] = False  # first words have no pair
            one.append(mix(words.hash ^ _ONE))
            two.append(pair[np.flatnonzero(inner) - 1])
            counts.append(words.counts)
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.one, self.two, self.counts = join(one, np.uint64), join(two, np.uint64), join(counts, np.int64)
        self.doc_one = np.repeat(np.arange(len(self.counts)), self.counts)
        self.doc_two = np.repeat(np.arange(len(self.counts)), np.maximum(self.counts - 1, 0))
        self.distinct, self.at, self.times = np.unique(
            np.concatenate([self.one, self.two]),
            return_inverse=True,
            return_counts=True,
        )


def trimmed(work, *tables: pa.Table) -> pa.Table:
    """What work makes of a group, with the memory that it freed given back."""
    try:
        return work(*tables)
    finally:
        release()


def _own(doc: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """How often each occurrence's n-gram stands in its own document."""
    _, back, times = np.unique(doc * width + at, return_inverse=True, return_counts=True)
    return times[back]


def _cuts(distinct: np.ndarray, bits: int) -> np.ndarray:
    """Where each part of the count table begins in the sorted distinct hashes."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(distinct, edges), [len(distinct)]])


def scores(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, log_sum, log_mean) for every row of docs (doc_id, text)."""
    spark = docs.sparkSession
    size, total = sizes(docs.select("text")).agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)),
        F.coalesce(F.sum("size"), F.lit(0)),
    ).first()
    buckets = max(1, -(-int(size) // BUCKET_BYTES))
    bits = max(0, math.ceil(math.log2(max(partitions(spark), buckets))))
    weighed, repeated = _weighed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    dealt = weighed.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int").alias("b"), "doc_id", "text", "m",
    )

    def ask(t: pa.Table) -> pa.Table:
        g = Grams(t["text"].combine_chunks())
        weight = t["m"].to_numpy()
        times = g.times
        if (weight > 1).any():
            of = np.concatenate([g.doc_one, g.doc_two])
            times = np.bincount(g.at, weights=weight[of], minlength=len(g.distinct)).astype(np.int64)
        kind = np.int32 if times.max(initial=0) < 2**31 else np.int64
        cut = _cuts(g.distinct, bits)
        full = np.flatnonzero(np.diff(cut))
        b = t["b"][0].as_py()
        return pa.table(
            {
                "q": pa.array(full, pa.int32()),
                "b": pa.array([b] * len(full), pa.int32()),
                "grams": pa.array([g.distinct[cut[k] : cut[k + 1]].tobytes() for k in full], pa.binary()),
                "times": pa.array([times[cut[k] : cut[k + 1]].astype(kind).tobytes() for k in full], pa.binary()),
            }
        )

    asked = dealt.groupBy("b").applyInArrow(lambda t: trimmed(ask, t), "q int, b int, grams binary, times binary")

    def answer(t: pa.Table) -> pa.Table:
        grams = [np.frombuffer(x, np.uint64) for x in t["grams"].to_pylist()]
        _, back = np.unique(np.concatenate(grams), return_inverse=True)
        # Four bytes a count, or eight, as there are for an n-gram.
        times = np.concatenate(
            [
                np.frombuffer(x, np.int32 if len(x) == 4 * len(g) else np.int64)
                for x, g in zip(t["times"].to_pylist(), grams, strict=True)
            ]
        )
        all_ = np.bincount(back, weights=times).astype(np.int64)[back]
        parts = np.split(all_, np.cumsum([len(x) for x in grams])[:-1])
        return pa.table({"b": t["b"], "q": t["q"], "counts": pa.array([x.tobytes() for x in parts], pa.binary())})

    answered = asked.groupBy("q").applyInArrow(lambda t: trimmed(answer, t), "b int, q int, counts binary")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        g = Grams(left["text"].combine_chunks())
        order = np.argsort(right["q"].to_numpy()) if right.num_rows else []
        blobs = right["counts"].to_pylist()
        count = (
            np.concatenate([np.frombuffer(blobs[k], np.int64) for k in order]) if len(order) else np.zeros(0, np.int64)
        )
        n_one = len(g.one)
        c = count[g.at]
        one = c[:n_one] - _own(g.doc_one, g.at[:n_one], len(g.distinct))
        two = c[n_one:] - _own(g.doc_two, g.at[n_one:], len(g.distinct))
        rest = np.maximum(total - g.counts, 1).astype(float)
        first = np.zeros(n_one, bool)
        first[(np.cumsum(g.counts) - g.counts)[g.counts > 0]] = True
        low = np.log10(np.maximum(one, 1) / rest[g.doc_one])
        log = low.copy()
        later = np.flatnonzero(~first)
        context = one[later - 1]
        seen = two > 0
        log[later] = np.where(
            seen,
            np.log10(np.maximum(two, 1) / np.maximum(context, 1)),
            math.log10(ALPHA) + low[later],
        )
        sums = np.bincount(g.doc_one, weights=log, minlength=len(g.counts))
        mean = [s / n if n else None for s, n in zip(sums.tolist(), g.counts.tolist(), strict=True)]
        return pa.table(
            {
                "doc_id": left["doc_id"],
                "n_words": pa.array(g.counts, pa.int64()),
                "log_sum": pa.array(sums, pa.float64()),
                "log_mean": pa.array(mean, pa.float64()),
                "m": left["m"],
            }
        )

    found = dealt.groupBy("b").cogroup(answered.groupBy("b")).applyInArrow(lambda t, counts: trimmed(score, t, counts),
        "doc_id long, n_words long, log_sum double, log_mean double, m long",
    )
    if repeated:
        found = found.withColumn("m", F.explode(F.sequence(F.lit(1).cast("long"), "m")))
    return found.drop("m")


def _weighed(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, text, m) and how many rows stand for more than one: rows equal more than REPEATED times are one of
    weight m. They are told apart by 128 bits of id and text, and combined before the shuffle."""
    names = {f"h{k}": F.xxhash64(F.lit(k), "doc_id", "text") for k in (1, 2)}
    marked = docs.withColumns(names)
    often = marked.groupBy(*names).agg(F.count("*").alias("m")).where(F.col("m") > REPEATED)
    n = often.count()
    if not n:
        return docs.withColumn("m", F.lit(1).cast("long")), 0
    found = marked.join(often, list(names), "left")
    rare = found.where("m IS NULL").select("doc_id", "text", F.lit(1).cast("long").alias("m"))
    once = found.where("m IS NOT NULL").groupBy(*names).agg(
        F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("m").alias("m"),
    )
    return rare.unionByName(once.select("doc_id", "text", "m")), n
