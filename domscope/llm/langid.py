"""Language identification by the nearest of several centroids per language.

Texts become normalised TF-IDF vectors over byte trigrams of the lower-cased text; the vectors of
each language are clustered by spherical k-means, and a text takes the language of the centroid with
the largest cosine. A text farther from its centroid than nearly all training texts of that cluster
is marked ``rejected``; its nearest language is still given.

The model is fitted on a bounded sample: at most ``SAMPLE`` different labelled texts, in equal parts of
at most ``PER_LANGUAGE`` by language, those of least hash, and no more of a language than its part of
``SAMPLE_BYTES`` (one text at least; texts over ``LONG`` code points come last). Equal texts count once,
so a language that consists of copies is learned too. With more than ``SAMPLE`` languages the most
frequent ones are learned. The model is a few hundred KB and goes with the tasks. Predictions read the
text alone.

Defined results: a null text and one without a letter are ``und`` with score 0; without any training
document every text is ``und``; a null id counts as in the training part; texts shorter than three
bytes or without a known trigram take the language with the most training rows, with score 0; of equally
near centroids the language that comes first by code point; repeated rows give repeated results; an
empty table gives an empty result. Extra columns are not carried. A batch is walked in ``ROWS`` texts at
most, so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .vectext import LOWER, buffers, chunks, released

SAMPLE = 4000
PER_LANGUAGE = 600
SAMPLE_BYTES = 16 << 20
LONG = 100_000
ROWS = 512
FEATURES = 2048
CENTROIDS = 3
_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII letters and the two-byte letters U+00C0 to U+00DE in lower case."""
    out = LOWER[data]
    if len(out) > 1:
        wide = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][wide] += 0x20
    return out


def trigrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, trigram code) of each byte trigram that lies in one document."""
    low = lowered(data).astype(np.int32)
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    inside = doc[:-2] == doc[2:]
    return doc[:-2][inside], code[inside]


@dataclass
class Model:
    codes: np.ndarray  # sorted trigram codes
    idf: np.ndarray
    centroids: np.ndarray  # unit rows
    language: list[str]  # of each centroid
    radius: np.ndarray  # least cosine that is not rejected
    common: str = ""  # the language of texts without a known trigram

    def vectors(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Normalised TF-IDF rows; tf is ln(1 + count)."""
        index = self.index()
        doc, code = trigrams(data, off)
        f = index[code]
        known = f >= 0
        n = len(off) - 1
        tf = np.bincount(
            doc[known] * len(self.codes) + f[known],
            minlength=n * len(self.codes),
        ).reshape(n, -1).astype(np.float32)
        np.log1p(tf, out=tf)
        tf *= self.idf
        size = np.linalg.norm(tf, axis=1, keepdims=True)
        return tf / np.where(size > 0, size, 1)

    def index(self) -> np.ndarray:
        if not hasattr(self, "_index"):
            self._index = np.full(1 << 24, -1, np.int16)
            self._index[self.codes] = np.arange(len(self.codes))
        return self._index

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_index"}

    def predict(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(centroid, cosine, rejected) of each text."""
        cos = self.vectors(data, off) @ self.centroids.T
        at = cos.argmax(axis=1)
        score = np.clip(cos[np.arange(len(at)), at], 0, 1).astype(np.float64)
        return at, score, score < self.radius[at]


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 25) -> np.ndarray:
    """Unit centroids of unit rows. Starts from the row nearest the mean, then the row farthest from all starts."""
    k = min(k, len(x))
    starts = [int((x @ x.mean(axis=0)).argmax())]
    while len(starts) < k:
        starts.append(int((x @ x[starts].T).max(axis=1).argmin()))
    c = x[starts].copy()
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        new = np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(k)])
        size = np.linalg.norm(new, axis=1, keepdims=True)
        new = new / np.where(size > 0, size, 1)
        if np.allclose(new, c):
            break
        c = new
    return c


def fit(
    texts: list[str],
    languages: list[str],
    *,
    common: str | None = None,
    features: int = FEATURES,
    centroids: int = CENTROIDS,
    quantile: float = 0.01,
) -> Model | None:
    """A model of the texts, null if they have no trigram; common: the language of texts that have no known one."""
    if not texts:
        return None
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    df = np.zeros(1 << 24, np.int32)
    for a, b in chunks(off):
        doc, code = trigrams(data[off[a] : off[b]], off[a : b + 1] - off[a])
        df += np.bincount(np.unique(doc.astype(np.int64) << 24 | code) & 0xFFFFFF, minlength=1 << 24).astype(np.int32)
    seen = np.flatnonzero(df)
    top = np.sort(seen[np.lexsort((seen, -df[seen]))[:features]])
    if not len(top):
        return None
    model = Model(
        top,
        np.log((1 + len(texts)) / (1 + df[top])).astype(np.float32) + np.float32(0.1),
        np.zeros((0, len(top)), np.float32),
        [],
        np.zeros(0),
    )
    x = np.concatenate(
        [model.vectors(data[off[a] : off[b]], off[a : b + 1] - off[a]) for a, b in chunks(off, rows=ROWS)]
    )
    rows, names, radius = [], [], []
    lang = np.array(languages, dtype=object)
    for name in sorted(set(languages)):
        own = x[lang == name]
        c = spherical_kmeans(own, centroids)
        near = own @ c.T
        at = near.argmax(axis=1)
        for j in range(len(c)):
            rows.append(c[j])
            names.append(name)
            radius.append(float(np.quantile(near[at == j, j], quantile)) if (at == j).any() else 1.0)
    model.common = min(languages, key=lambda x: (-languages.count(x), x)) if common is None else common
    model.centroids, model.language, model.radius = np.stack(rows).astype(np.float32), names, np.array(radius)
    return model


def fold(ident: str = "doc_id", folds: int = 3):
    return F.pmod(F.crc32(F.coalesce(F.col(ident).cast("string"), F.lit(""))), F.lit(folds))


def sample(
    docs: DataFrame,
    *,
    total: int = SAMPLE,
    per_language: int = PER_LANGUAGE,
    size: int = SAMPLE_BYTES,
    long: int = LONG,
) -> tuple[DataFrame, list[str]]:
    """((lang, r, text) of the bounded training sample, its languages by falling number of rows).

    A language's texts are thinned by hash before equal ones become one and before they are ranked; the
    shares follow the number of different texts, so copies neither crowd others out nor vanish together.
    """
    x1, x2 = F.xxhash64("text"), F.xxhash64(F.lit(20240607), "text")
    train = docs.where(
        (fold() != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    ).select("lang", "text", x1.alias("x1"), x2.alias("x2"))
    counted = train.groupBy("lang").agg(
        F.count("*").alias("n"),
        F.approx_count_distinct("x1", 0.05).alias("d"),
    ).orderBy(F.desc("n"), "lang").limit(total).collect()
    each = max(1, min(per_language, total // max(1, len(counted))))
    limit = size // max(1, len(counted))
    share = train.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, (2.0 * each + 50.0) / max(1, r["d"]))) for r in counted] or [],
        "lang string, share double",
    )
    thin = train.join(F.broadcast(share), "lang").where(
        F.shiftrightunsigned("x1", 11) / F.lit(float(1 << 53)) < F.col("share")
    )
    one = thin.groupBy("lang", "x1", "x2").agg(F.first("text").alias("text"))
    order = W.partitionBy("lang").orderBy(F.length("text") > long, F.shiftrightunsigned("x1", 1), "x1", "x2")
    ranked = one.withColumn("r", F.row_number().over(order)).where(F.col("r") <= each)
    before = F.coalesce(
        F.sum(F.octet_length("text")).over(W.partitionBy("lang").orderBy("r").rowsBetween(W.unboundedPreceding, 0)),
        F.lit(0),
    )
    kept = ranked.withColumn("before", before).where((F.col("r") == 1) | (F.col("before") <= limit))
    return kept.select("lang", "r", "text"), [r["lang"] for r in counted]


def train(docs: DataFrame, **options) -> Model | None:
    some, languages = sample(docs)
    rows = sorted(some.collect(), key=lambda r: (r["lang"], r["r"]))
    return fit(
        [r["text"] for r in rows],
        [r["lang"] for r in rows],
        common=languages[0] if languages else None,
        **options,
    )


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) for every row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            data, off = buffers(column)
            names, scores, far = [], [], []
            for a, b in chunks(off, rows=ROWS):
                part, o = data[off[a] : off[b]], off[a : b + 1] - off[a]
                letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[part])])
                has = letters[o[1:]] > letters[o[:-1]]
                for k in np.flatnonzero(~has).tolist():
                    has[k] = bool(_LETTER.search(column[a + k].as_py() or ""))
                if model is None:
                    names += ["und"] * (b - a)
                    scores.append(np.zeros(b - a))
                    far.append(np.ones(b - a, bool))
                    continue
                at, score, out = model.predict(part, o)
                best = [
                    model.language[c] if s > 0 else model.common
                    for c, s in zip(at.tolist(), score.tolist(), strict=True)
                ]
                names += [x if h else "und" for x, h in zip(best, has.tolist(), strict=True)]
                scores.append(np.where(has, score, 0.0))
                far.append(out | ~has)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(names, pa.string()),
                    pa.array(np.concatenate(scores) if scores else np.zeros(0)),
                    pa.array(np.concatenate(far) if far else np.zeros(0, bool)),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return docs.select("doc_id", (fold() == 1).alias("held_out"), "text").mapInArrow(
        released(run),
        "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean",
    )
