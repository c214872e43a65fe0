"""Top-k search, language identification and LM scoring."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from domscope.llm import langid, lm_score, topk_search

VECTORS = "vec_id long, embedding array<float>, rank string"


def _top(rows, k):
    used = [
        (i, [math.floor(64 * float(np.float32(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, v) in enumerate(used):
        if i % 20 == 0:
            scored = sorted(
                (-sum(x * y for x, y in zip(v, u, strict=True)), j)
                for b, (j, u) in enumerate(used)
                if b != a and len(u) == len(v)
            )
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("tile", [7, 32_768])
def test_top_k(spark, tile):
    rng = random.Random(1)
    rows = [(k, [rng.choice([-1.5, -0.01, 0.0, 0.3, 2.25]) for _ in range(3)]) for k in range(150)]
    rows += [
        (None, [1.0, 1.0, 1.0]),
        (160, None),
        (161, [1.0, None, 2.0]),
        (162, [1.0, float("nan"), 2.0]),
        (163, [float("inf"), 0.0, 0.0]),
        (40, rows[40][1]),
        (200, [1.0, 2.0]),
        (220, [3.0, 4.0]),
        (240, []),
        (260, []),
    ]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], VECTORS).repartition(3)
    got = topk_search.top_k(frame, 20, tile=tile, block=tile).collect()
    assert sorted(tuple(r) for r in got) == _top(rows, 20)


def test_top_k_tiles_by_bytes(spark, monkeypatch):
    """Many equal rows and long vectors, in tiles that hold a few of them."""
    monkeypatch.setattr(topk_search, "TILE_BYTES", 40_000)
    rng = random.Random(5)
    rows = (
        [(k, [rng.uniform(-1, 1) for _ in range(300)]) for k in range(90)] + [(k, [0.5] * 300) for k in range(100, 160)]
    )
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], VECTORS).repartition(3)
    assert sorted(tuple(r) for r in topk_search.top_k(frame, 7).collect()) == _top(rows, 7)


def test_top_k_broadcasts_no_queries(spark, monkeypatch):
    """Queries repeated for every tile, which Spark takes for as small as their file, don't go through the driver."""
    plans = []
    keep = topk_search.written
    monkeypatch.setattr(topk_search, "TILE_BYTES", 4_000)
    monkeypatch.setattr(
        topk_search, "written",
        lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), keep(df))[1],
    )
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(400)]
    got = topk_search.top_k(spark.createDataFrame([(i, v, "x") for i, v in rows], VECTORS), 5).collect()
    assert sorted(tuple(r) for r in got) == _top(rows, 5)
    assert plans and not any("BroadcastHashJoin" in p for p in plans) and "SortMergeJoin" in plans[-1]


def test_top_k_edges(spark):
    assert topk_search.top_k(spark.createDataFrame([], VECTORS), 5).collect() == []
    big = spark.createDataFrame([(0, [3e30, 1.0], "x"), (1, [2e30, 5.0], "x"), (2, [-3e30, 1.0], "x")], VECTORS)
    assert [
        (r["vec_id"], r["score"]) for r in sorted(topk_search.top_k(big, 5).collect(), key=lambda r: r["rank"])
    ] == [(1, (1 << 63) - 1), (2, -(1 << 63))]
    one = spark.createDataFrame([(20, [1.0, 2.0], "x")], VECTORS)
    assert topk_search.top_k(one, 5).collect() == []


def _language_rows():
    rng = random.Random(2)
    parts = {
        "xx": ["ka", "to", "mi", "ru", "se"],
        "yy": ["sch", "ung", "ver", "ein"],
        "zz": ["éau", "tion", "oui", "ça"],
    }
    rows = []
    for k in range(400):
        lang = rng.choice(sorted(parts))
        rows.append(
            (
                k,
                " ".join(
                    "".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 4)))
                    for _ in range(rng.randrange(5, 60))
                ).capitalize(),
                lang,
            )
        )
    return rows


def test_language(spark):
    rows = (
        _language_rows()
        + [
            (900, None, "xx"), (901, "", "xx"), (902, "123 !!", "yy"), (903, "ñ", None), (None, "kato mirus", "xx"),
            (5, "kato " * 20_000, "xx"),
        ]
    )
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    got = langid.identify(docs.withColumnRenamed("lang", "score"), model).collect()
    assert len(got) == len(rows)
    right = held = 0
    lang = {d: x for d, _, x in rows}
    for r in got:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        if r["doc_id"] in (900, 901, 902):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["held_out"]:
            held += 1
            right += r["lang_pred"] == lang[r["doc_id"]]
    assert right >= 0.97 * held
    assert langid.identify(spark.createDataFrame([], docs.schema), model).collect() == []
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}


def test_held_out_texts_teach_nothing(spark):
    rows = _language_rows()
    a = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    b = langid.train(
        spark.createDataFrame(
            [(d, "other words" if zlib.crc32(str(d).encode()) % 3 == 1 else t, x) for d, t, x in rows],
            "doc_id long, text string, lang string",
        )
    )
    assert (a.codes == b.codes).all() and np.allclose(a.centroids, b.centroids)


def _lm(rows):
    docs = [[w.translate({c: c + 32 for c in range(65, 91)}) for w in (t or "").split()] for _, t in rows]
    one, two = Counter(w for d in docs for w in d), Counter(p for d in docs for p in zip(d, d[1:], strict=False))
    total = sum(map(len, docs))
    out = []
    for (i, _), d in zip(rows, docs, strict=True):
        o, t, n = Counter(d), Counter(zip(d, d[1:], strict=False)), max(1, total - len(d))
        s = 0.0
        for k, w in enumerate(d):
            c = max(one[w] - o[w], 1)
            if k == 0:
                s += math.log10(c / n)
                continue
            v = d[k - 1]
            both = two[v, w] - t[v, w]
            s += math.log10(both / max(one[v] - o[v], 1)) if both > 0 else math.log10(0.4) + math.log10(c / n)
        out.append((i, len(d), round(s, 6), round(s / len(d), 8) if d else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket", [200, 10 << 20])
def test_lm(spark, bucket, monkeypatch):
    monkeypatch.setattr(lm_score, "BUCKET_BYTES", bucket)
    rng = random.Random(3)
    rows = (
        [
            (k, " ".join(rng.choice(["a", "B", "b", "c", "dd", "é"]) for _ in range(rng.randrange(30))))
            for k in range(60)
        ]
        + [(None, "a b"), (100, None), (101, ""), (3, "a a a"), (102, "a b a b")]
    )
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_words string")
    got = [
        (r[0], r[1], round(r[2], 6), None if r[3] is None else round(r[3], 8)) for r in lm_score.scores(docs).collect()
    ]
    assert sorted(got, key=repr) == _lm(rows)


def test_lm_empty(spark):
    assert lm_score.scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def _grams(text):
    """Byte trigrams of the lower-cased text."""
    low = "".join(c.lower() if c.isascii() or "\u00c0" <= c <= "\u00de" and c != "\u00d7" else c for c in text).encode()
    return Counter(low[i : i + 3] for i in range(len(low) - 2))


def _tf_idf(text, idf):
    """Brute force: normalised ln(1 + count) * idf."""
    v = {g: math.log(1 + c) * idf[g] for g, c in _grams(text).items() if g in idf}
    size = math.sqrt(sum(x * x for x in v.values())) or 1.0
    return {g: x / size for g, x in v.items()}


def _language_texts(seed=5, n=240):
    rng = random.Random(seed)
    words = {
        x: ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(40)]
        for x, letters in (("aa", "abcdeÉ"), ("bb", "cdefgß"), ("cc", "efghij "))
    }
    langs = [rng.choice(list(words)) for _ in range(n)]
    return [" ".join(rng.choice(words[x]) for _ in range(rng.randrange(1, 20))).capitalize() for x in langs], langs


def test_language_against_plain_tf_idf():
    """Document frequencies, vectors, centroids and the nearest one agree with dictionaries."""
    texts, langs = _language_texts()
    model = langid.fit(texts, langs, features=300, centroids=3)
    grams = [bytes([c >> 16, c >> 8 & 255, c & 255]) for c in model.codes.tolist()]
    every = Counter(g for t in texts for g in _grams(t))
    assert set(grams) == set(sorted(every, key=lambda g: (-every[g], g))[:300])
    idf = {g: math.log((1 + len(texts)) / (1 + every[g])) + 0.1 for g in grams}
    assert np.allclose(model.idf, [idf[g] for g in grams], atol=1e-5)
    vectors = [_tf_idf(t, idf) for t in texts]
    data = "".join(texts).encode()
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    got = model.vectors(np.frombuffer(data, np.uint8), off)
    for row, v in zip(got, vectors, strict=True):
        assert np.allclose(row, [v.get(g, 0.0) for g in grams], atol=1e-5)
    # Each centroid is the unit mean of the texts of its language that are nearest to it.
    for name in set(langs):
        own = [v for v, x in zip(vectors, langs, strict=True) if x == name]
        cs = [
            dict(zip(grams, c.tolist(), strict=True))
            for c, x in zip(model.centroids, model.language, strict=True)
            if x == name
        ]
        near = [max(range(len(cs)), key=lambda j, v=v: sum(x * cs[j][g] for g, x in v.items())) for v in own]
        for j, c in enumerate(cs):
            mean = {g: sum(v.get(g, 0.0) for v, k in zip(own, near, strict=True) if k == j) for g in grams}
            size = math.sqrt(sum(x * x for x in mean.values()))
            assert size == 0 or all(abs(mean[g] / size - c[g]) < 1e-3 for g in grams)
    new, _ = _language_texts(6, 60)
    raw = "".join(new).encode()
    at, score, rejected = model.predict(
        np.frombuffer(raw, np.uint8),
        np.concatenate([[0], np.cumsum([len(t.encode()) for t in new])]),
    )
    for t, k, s, far in zip(new, at.tolist(), score.tolist(), rejected.tolist(), strict=True):
        v = _tf_idf(t, idf)
        cos = [
            sum(x * c for x, c in ((v.get(g, 0.0), c) for g, c in zip(grams, row.tolist(), strict=True)))
            for row in model.centroids
        ]
        assert abs(max(cos) - s) < 1e-4 and cos[k] > max(cos) - 1e-4 and far == (s < model.radius[k])


def test_language_sample(spark):
    """A language of equal rows is learned, copies don't crowd others out, sizes are bounded."""
    rows = (
        [(k, "aba abba baab aba", "aa") for k in range(4000)]
        + [(5000 + k, f"cde edc ccd {'dec ' * (k % 9)}", "bb") for k in range(300)]
    )
    rows += [
        (6000 + k, "same text for all", "cc") for k in range(3000)
    ] + [(9500 + k, f"other text {k}", "cc") for k in range(12)]
    docs = spark.createDataFrame(
        [(*r, "x") for r in rows],
        "doc_id long, text string, lang string, extra string",
    ).repartition(3)
    some, languages = langid.sample(docs)
    got = some.collect()
    assert languages == ["aa", "cc", "bb"]
    assert Counter(r["lang"] for r in got)["aa"] == 1 and len({r["text"] for r in got if r["lang"] == "cc"}) > 5
    found = {r["doc_id"]: r for r in langid.identify(docs, langid.train(docs)).collect()}
    assert {
        found[d]["lang_pred"] for d, _, x in rows if x == "aa"
    } == {"aa"} and {found[d]["lang_pred"] for d, _, x in rows if x == "bb"} == {"bb"}
    small, _ = langid.sample(docs, size=300)
    by = defaultdict(list)
    for r in small.collect():
        by[r["lang"]].append(r["text"])
    assert set(by) == {"aa", "bb", "cc"} and all(len(x) == 1 or sum(map(len, x)) <= 100 for x in by.values())
    odd = spark.createDataFrame(
        [(1, "щщщ щщ", None, ""), (2, "12", None, ""), (3, None, None, ""), (4, "", None, "")],
        "doc_id long, text string, lang string, extra string",
    )
    assert [
        (r["lang_pred"], r["score"]) for r in langid.identify(odd, langid.train(docs)).orderBy("doc_id").collect()
    ] == [("aa", 0.0), ("und", 0.0), ("und", 0.0), ("und", 0.0)]


def test_lm_repeated_rows(spark, monkeypatch):
    """Equal rows do not meet in one bucket, and count as documents of their own."""
    monkeypatch.setattr(lm_score, "BUCKET_BYTES", 2000)
    rows = [(1, "a b a c")] * 400 + [(k, f"x{k} b a") for k in range(2, 60)]
    got = lm_score.scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert sorted([(r[0], r[1], round(r[2], 6), round(r[3], 8)) for r in got.collect()], key=repr) == _lm(rows)


@pytest.mark.parametrize("repeated", [1, 3, 100])
def test_lm_weighs_rows_that_repeat_often(spark, monkeypatch, repeated):
    """Buckets follow from contents alone, so a row is in the same one however often its partition is made again."""
    monkeypatch.setattr(lm_score, "REPEATED", repeated)
    monkeypatch.setattr(lm_score, "BUCKET_BYTES", 300)
    rows = [(1, "a b a c")] * 5 + [(None, "b b")] * 4 + [(2, None)] * 4 + [(2, "")] * 2 + [(k, f"x{k % 7} b a") for k in range(3, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = lm_score.scores(docs)
    assert "SPARK_PARTITION_ID" not in found._jdf.queryExecution().toString().upper()
    got = [(r[0], r[1], round(r[2], 6), None if r[3] is None else round(r[3], 8)) for r in found.collect()]
    assert sorted(got, key=repr) == _lm(rows)
