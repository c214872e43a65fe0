"""Quality scores: random-indexing word vectors, pooled per document, and a two-layer network.

Words are runs of letters, of digits and of other characters, lower-cased and told apart by their case
(none, capital, upper). Every word has a random index vector (two of ``DIM`` places, +1 or -1, from its
hash). Its word vector is the sum of the index vectors of the words up to ``WINDOW`` places away, over all
texts, less what its number of neighbours would give it by chance, at length one. Words share ``BUCKETS``
rows by hash, so the table has one size for any corpus (4 MB) and goes with the tasks; tasks add up their
own table and Spark sums these by row.

A document's vector has the mean, the root mean square and the mean product of neighbours of its word
vectors, the logarithm of its number of words and the part of these that are different. The network
(``HIDDEN`` units) learns from at most ``SAMPLE`` labelled documents, those of least hash of doc_id; one in
five of them stays out of training and sets the temperature that divides the network's output.

Labels are learned from rows whose crc32(doc_id as text) mod 3 is not 1 alone; scores read texts only.

Defined results: null and empty texts have a vector of zeros and its score; a null id counts as in the
training part, but has no label; a label row with a null is unused; of several labels of a document the
smallest counts; documents that share an id each teach, as far as the sample goes; without labels each score
is 0.5, with one class only the smoothed part of label 1; repeated rows have one score; an empty table gives
an empty result; extra columns are not carried. Texts are walked in blocks of ``BLOCK`` words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectext import LOWER, buffers, chunks, mix, prefix_hash, released, span_hash

BUCKETS = 1 << 14
DIM = 64
WINDOW = 2
HIDDEN = 32
SAMPLE = 12_000
EPOCHS = 40
BLOCK = 1 << 11
FEATURES = 3 * DIM + 2

#: Kind of each byte: 0 space and control characters, 1 letters, 2 digits, 3 others.
KIND = np.full(256, 3, np.int8)
KIND[:33] = 0
KIND[127] = 0
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
KIND[0x30:0x3A] = 2
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of the words of texts data[off[i]:off[i + 1]], in order."""
    kind = KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    edge[1:-1] |= kind[1:] != kind[:-1]
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    some = kind[start] > 0 if len(start) else np.zeros(0, bool)
    start, end = start[some], end[some]
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    capitals = upper[end] - upper[start]
    case = np.where(capitals == 0, 0, np.where(2 * capitals > end - start + 1, 2, 1)).astype(np.uint64)
    hashed = span_hash(prefix_hash(LOWER[data]), start, end)
    return mix(hashed + case * np.uint64(0x9E3779B97F4A7C15)), np.searchsorted(off, start, side="right") - 1


def bucket_of(word: np.ndarray) -> np.ndarray:
    return (word >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def index_vectors(word: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(place, sign) of the entries of each word's index vector."""
    part = lambda shift, m: ((word >> np.uint64(shift)) & np.uint64(m)).astype(np.int64)
    return [(part(0, DIM - 1), 2 * part(24, 1) - 1), (part(12, DIM - 1), 2 * part(25, 1) - 1)]


def add_contexts(table: np.ndarray, counts: np.ndarray, word: np.ndarray, text: np.ndarray) -> None:
    """Add the index vectors of each word's neighbours to its row of the table."""
    bucket, flat = bucket_of(word), table.reshape(-1)
    counts += np.bincount(bucket, minlength=BUCKETS)
    for place, sign in index_vectors(word):
        for d in range(1, WINDOW + 1):
            near = np.flatnonzero(text[:-d] == text[d:])
            np.add.at(flat, bucket[near] * DIM + place[near + d], sign[near + d])
            np.add.at(flat, bucket[near + d] * DIM + place[near], sign[near])


def context_vectors(docs: DataFrame) -> np.ndarray:
    """The word vectors, a row for each bucket, from all texts."""
    names = [f"v{i}" for i in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, counts = np.zeros((BUCKETS, DIM), np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            data, off = buffers(batch.column(0))
            for a, b in chunks(off):
                add_contexts(table, counts, *words(data[off[a] : off[b]], off[a : b + 1] - off[a]))
        some = np.flatnonzero(counts)
        for a in range(0, len(some), 1024):
            rows = some[a : a + 1024]
            columns = [rows.astype(np.int32), counts[rows], *table[rows].T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["bucket", "n", *names])

    parts = docs.select("text").mapInArrow(
        released(run), "bucket int, n long, " + ", ".join(f"{v} long" for v in names)
    )
    sums = parts.groupBy("bucket").agg(F.sum("n").alias("n"), *(F.sum(v).alias(v) for v in names)).toArrow()
    counts, table = np.zeros(BUCKETS), np.zeros((BUCKETS, DIM))
    at = sums.column("bucket").to_numpy()
    counts[at] = sums.column("n").to_numpy()
    if len(at):
        table[at] = np.stack([sums.column(v).to_numpy() for v in names], axis=1)
    return unit_rows(table - counts[:, None] / max(counts.sum(), 1) * table.sum(axis=0))


def unit_rows(table: np.ndarray) -> np.ndarray:
    length = np.sqrt((table**2).sum(axis=1, keepdims=True))
    return (table / np.where(length > 0, length, 1)).astype(np.float32)


def pooled(vectors: np.ndarray, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The vectors (FEATURES) of documents."""
    word, text = words(data, off)
    n = np.bincount(text, minlength=len(off) - 1)
    sums = np.zeros((len(off) - 1, 3 * DIM))
    for a in range(0, len(word), BLOCK):
        b = min(a + BLOCK, len(word))
        v = vectors[bucket_of(word[a : b + 1])].astype(np.float64)  # one more, for the last one's neighbour
        own, of = v[: b - a], text[a:b]
        next_ = np.zeros_like(own)
        next_[: len(v) - 1] = v[1:]
        next_[: len(v) - 1][text[a + 1 : a + len(v)] != text[a : a + len(v) - 1]] = 0
        first = np.flatnonzero(np.diff(of, prepend=-1))
        for k, x in enumerate((own, own * own, own * next_)):
            sums[of[first], k * DIM : (k + 1) * DIM] += np.add.reduceat(x, first, axis=0)
    out = np.zeros((len(n), FEATURES))
    out[:, : 3 * DIM] = sums / np.maximum(n, 1)[:, None]
    out[:, DIM : 2 * DIM] = np.sqrt(out[:, DIM : 2 * DIM])
    out[:, -2] = np.log1p(n)
    order = np.lexsort((word, text))
    new = np.ones(len(word), bool)
    new[1:] = (np.diff(text[order]) != 0) | (word[order][1:] != word[order][:-1])
    out[:, -1] = np.bincount(text[order][new], minlength=len(n)) / np.maximum(n, 1)
    return out


@dataclass
class Network:
    """A layer of tanh units and one of a single output, over standardised features; ``temperature`` divides the output."""

    center: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def output(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.layers
        return np.tanh((x - self.center) / self.scale @ w + b) @ v + c[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.output(x) / self.temperature)


@dataclass
class Model:
    vectors: np.ndarray
    network: Network | None
    prior: float = 0.5

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.network.probability(x) if self.network else np.full(len(x), self.prior)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def gradients(layers: list[np.ndarray], x: np.ndarray, y: np.ndarray, decay: float) -> tuple[float, list[np.ndarray]]:
    """Mean log loss with decay of the weights, and its gradient."""
    w, b, v, c = layers
    hidden = np.tanh(x @ w + b)
    z = hidden @ v + c[0]
    loss = float(np.mean(np.logaddexp(0, z) - y * z) + decay * ((w**2).sum() + (v**2).sum()) / 2)
    d = (sigmoid(z) - y) / len(y)
    back = d[:, None] * v * (1 - hidden**2)
    return loss, [x.T @ back + decay * w, back.sum(axis=0), hidden.T @ d + decay * v, np.array([d.sum()])]


def fit(x: np.ndarray, y: np.ndarray, *, epochs: int = EPOCHS, batch: int = 64, rate: float = 3e-3, decay: float = 1e-3) -> Network:
    """A network fitted to rows of x with y 0 or 1 by Adam."""
    rng = np.random.default_rng(7)
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - center) / scale
    layers = [
        rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1),
    ]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    t, steps = 0, epochs * -(-len(y) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for a in range(0, len(y), batch):
            t += 1
            rows = order[a : a + batch]
            for p, m, s, g in zip(layers, first, second, gradients(layers, z[rows], y[rows], decay)[1], strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return Network(center, scale, layers)


def calibrated(network: Network, x: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on rows that did not train the network."""
    z = network.output(x)
    tried = np.geomspace(0.2, 20, 200)
    return float(tried[np.argmin([np.mean(np.logaddexp(0, z / t) - y * z / t) for t in tried])]) if len(y) else 1.0


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Model:
    """The model from (doc_id, text) and the labels (doc_id, quality) of documents that are not held out."""
    vectors = context_vectors(docs)
    known = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out()).groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(2))
            for a, b in chunks(off):
                x = pooled(vectors, data[off[a] : off[b]], off[a : b + 1] - off[a]).astype(np.float32)
                rows = pa.array([r.tobytes() for r in x], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), rows], names=["doc_id", "quality", "x"],
                )

    # At most ``sample`` rows of two numbers go to every task.
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select(F.col("doc_id").cast("long"), "quality", "text")
    rows = found.mapInArrow(released(run), "doc_id long, quality int, x binary").orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample).toArrow()
    y = rows.column("quality").to_numpy().astype(np.float64)
    if not len(y) or y.min() == y.max():
        return Model(vectors, None, (y.sum() + 1) / (len(y) + 2))
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float32).reshape(len(y), FEATURES).astype(np.float64)
    apart = np.arange(len(y)) % 5 == 4
    network = fit(x[~apart], y[~apart])
    network.temperature = calibrated(network, x[apart], y[apart])
    return Model(vectors, network)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(2))
            for a, b in chunks(off):
                p = model.probability(pooled(model.vectors, data[off[a] : off[b]], off[a : b + 1] - off[a])).round(6)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(a, b - a) for k in (0, 1)), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        released(run), f"doc_id {kind}, held_out boolean, score double, predicted int",
    )
