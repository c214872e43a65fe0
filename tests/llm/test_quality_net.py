"""Word vectors, pooling, network and calibration of the quality scores."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from domscope.llm import quality_net as q
from domscope.llm import queries

WORD = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[!-/:-@\[-`{-~]+")


def bytes_of(texts):
    raw = [(t or "").encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), off


TEXTS = ["Hello world, hello AGAIN!! 12 été", None, "", "a", "x x x x", "Ünder_score\tand--dash\n100% of it", "hello"]


def test_words_are_runs_told_apart_by_case():
    word, text = q.words(*bytes_of(TEXTS))
    runs = [(i, r) for i, t in enumerate(TEXTS) for r in WORD.findall((t or "").encode())]
    assert text.tolist() == [i for i, _ in runs]

    def name(run):
        capitals = sum(0x41 <= c <= 0x5A for c in run)
        return run.lower(), 0 if not capitals else 2 if 2 * capitals > len(run) + 1 else 1

    by_name = {}
    for h, (_, r) in zip(word.tolist(), runs, strict=True):
        assert by_name.setdefault(name(r), h) == h
    assert len(set(by_name.values())) == len(by_name)


def test_context_vectors_are_sums_over_all_neighbours(spark):
    texts = TEXTS * 3
    word, text = q.words(*bytes_of(texts))
    index = np.zeros((len(word), q.DIM))
    for place, sign in q.index_vectors(word):
        np.add.at(index, (np.arange(len(word)), place), sign)
    table, counts = np.zeros((q.BUCKETS, q.DIM)), np.zeros(q.BUCKETS)
    for i, b in enumerate(q.bucket_of(word)):
        counts[b] += 1
        for j in range(max(0, i - q.WINDOW), min(len(word), i + q.WINDOW + 1)):
            if j != i and text[i] == text[j]:
                table[b] += index[j]
    expected = q.unit_rows(table - counts[:, None] / counts.sum() * table.sum(axis=0))
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    assert np.allclose(q.context_vectors(frame), expected, atol=1e-6)


@pytest.mark.parametrize("block", [1, 2, 5, 1 << 16])
def test_pooling_equals_a_plain_one(monkeypatch, block):
    monkeypatch.setattr(q, "BLOCK", block)
    vectors = q.unit_rows(np.random.default_rng(3).normal(size=(q.BUCKETS, q.DIM)))
    data, off = bytes_of(TEXTS)
    word, text = q.words(data, off)
    got = q.pooled(vectors, data, off)
    for i in range(len(TEXTS)):
        own = word[text == i]
        v = vectors[q.bucket_of(own)].astype(float)
        row = np.zeros(q.FEATURES)
        if len(own):
            row[: q.DIM] = v.mean(axis=0)
            row[q.DIM : 2 * q.DIM] = np.sqrt((v * v).mean(axis=0))
            row[2 * q.DIM : 3 * q.DIM] = (v[:-1] * v[1:]).sum(axis=0) / len(own)
            row[-2:] = math.log1p(len(own)), len(Counter(own.tolist())) / len(own)
        assert np.allclose(got[i], row)


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(9, 4)), rng.integers(0, 2, 9).astype(float)
    layers = [rng.normal(size=(4, 3)), rng.normal(size=3), rng.normal(size=3), rng.normal(size=1)]
    _, found = q.gradients(layers, x, y, 0.1)
    for p, g in zip(layers, found, strict=True):
        # Decay is that of the weights alone, as in the loss.
        for at in np.ndindex(p.shape):
            had, sides = p[at], []
            for step in (1e-6, -1e-6):
                p[at] = had + step
                sides.append(q.gradients(layers, x, y, 0.1)[0])
            p[at] = had
            assert abs((sides[0] - sides[1]) / 2e-6 - g[at]) < 1e-6


def test_network_learns_what_no_line_separates():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    p = q.fit(x[:2000], y[:2000]).probability(x[2000:])
    assert np.mean((p >= 0.5) == y[2000:]) > 0.93


def test_temperature_calibrates():
    rng = np.random.default_rng(8)
    z = rng.normal(0, 2, 20_000)
    y = (rng.random(20_000) < q.sigmoid(z)).astype(float)
    sure = q.Network(np.zeros(1), np.ones(1), [])
    sure.output = lambda x: 5 * z
    assert abs(q.calibrated(sure, z[:, None], y) - 5) < 0.3


def test_edges(spark):
    docs = [(i, "good words make a fine text here" if i % 2 else "bad ### bad ### bad") for i in range(60)]
    docs += [(None, "good words"), (61, None), (62, ""), (3, "good words make")]
    frame = spark.createDataFrame([(*d, 0.5, 1) for d in docs], "doc_id long, text string, score double, quality int")
    labels = [(i, i % 2) for i in range(60)] + [(5, 1), (7, None), (None, 1)]
    marks = spark.createDataFrame([(*m, "t") for m in labels], "doc_id long, quality int, text string")
    got = q.score(frame, q.train(frame, marks)).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if r.doc_id is not None and r.doc_id < 60:
            assert r.predicted == r.doc_id % 2
    assert q.score(frame.limit(0), q.train(frame.limit(0), marks)).collect() == []
    assert {r.score for r in q.score(frame, q.train(frame, marks.limit(0))).collect()} == {0.5}
    one = q.train(frame, marks.where("quality = 1"))
    assert one.network is None and one.prior > 0.9


def test_labels_of_held_out_rows_and_ids_are_not_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    a, b = (q.score(docs, q.train(docs, m)).orderBy("doc_id").collect() for m in (labels, turned))
    assert a == b


def test_long_texts(spark):
    docs = [(1, "x" * 3_000_000), (2, "word " * 400_000), (3, "a1!" * 500_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    assert q.score(frame, q.train(frame, labels)).count() == 3


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    got = queries.op13_quality_scores(spark, folder).where("held_out")
    rows = got.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("score", "predicted", "quality").collect()
    y, p = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    right = np.array([r.predicted for r in rows]) == y
    # Labels mark what is clean; both kinds are found, and probabilities are calibrated.
    assert right[y == 1].mean() > 0.97 and right[y == 0].mean() > 0.9
    assert abs(p.mean() - y.mean()) < 0.03
