"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import pytest

from domscope.llm import lexical_search, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def terms_of(text):
    return [w.translate(LOWER) for w in TERM.findall(text or "")]


def expected(docs, items, k=10):
    lists = [(d, Counter(terms_of(t))) for d, t in docs]
    lists = [(d, c, sum(c.values())) for d, c in lists if c]
    n_docs, total = len(lists), sum(n for _, _, n in lists)
    df = Counter(w for _, c, _ in lists for w in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in lists:
            m = 25 + (75 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
                for w in terms_of(text) if w in c
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "naïve", "日本", "A1", "x", "\U0001f600"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda m: rng.choice([" ", "-", "_ ", "\x7f", "\n"]).join(rng.choices(words, weights, k=m))
    docs = [(i, text(rng.choice([0, 1, 5, 40, 400]))) for i in range(n)]
    items = [(i, text(rng.choice([1, 3, 30]))) for i in range(12)]
    docs += [(n + i, items[i][1] + " " + text(3)) for i in range(6)]
    return docs, items


@pytest.mark.parametrize("postings,few,block", [(2_000_000, 200, 4 << 20), (300, 1, 4 << 20), (50, 12, 300)])
def test_equal_to_brute_force(spark, monkeypatch, postings, few, block):
    monkeypatch.setattr(lexical_search, "POSTINGS", postings)
    monkeypatch.setattr(lexical_search, "FEW", few)
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", block)
    docs, items = corpus(postings, 300)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = lexical_search.rank(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got) == expected(docs, items)


def test_search_stops_before_the_last_group():
    import numpy as np

    rng = np.random.default_rng(1)
    n, v = 5000, 8
    doc, term = np.repeat(np.arange(n), v), np.tile(np.arange(v), n)
    impact = rng.integers(1, 1000, n * v)
    impact[: 20 * v] += 500_000  # twenty documents that stand out
    index = lexical_search.Index(doc, term, impact, n, v)
    read = []
    whole = index.complete
    index.complete = lambda *a: read.append(len(a[0])) or whole(*a)
    found, scores = index.search(np.arange(v), np.full(v, 3), 10, 0)
    assert read and read[0] <= lexical_search.FEW
    total = np.bincount(doc, impact * 3, n).astype(np.int64)
    best = np.sort(total)[::-1][:10]
    assert sorted(scores, reverse=True)[:10] == best.tolist()


def test_nulls_ties_repeats_and_clashing_columns(spark):
    docs = [(3, "apple pear"), (1, "apple pear"), (None, "apple pear"), (1, "apple pear"), (7, None), (8, ""), (9, "..."), (10, "plum")]
    items = [(1, "Apple"), (1, "Apple"), (None, "pear"), (4, None), (5, ""), (6, "nowhere"), (7, "apple apple plum")]
    frame = spark.createDataFrame([(*d, 5, 6, "n") for d in docs], "doc_id long, text string, n int, rank int, term string")
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, score int")
    assert rows(lexical_search.rank(frame, asked)) == expected(docs, items)
    assert rows(lexical_search.rank(frame.limit(0), asked)) == []
    assert rows(lexical_search.rank(frame, asked.limit(0))) == []
    assert rows(lexical_search.rank(frame.where("doc_id in (7, 8, 9)"), asked)) == []


def test_long_texts(spark):
    docs = [(1, "x" * 3_000_000), (2, "word " * 400_000), (3, "word " + "other " * 300_000), (4, "word")]
    items = [(1, "word other " + "x" * 3_000_000)]
    got = lexical_search.rank(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
    )
    assert rows(got) == expected(docs, items)


def test_query_is_equal_to_brute_force_on_the_given_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows(queries.op11_lexical_search(spark, folder)) == expected(docs, items)
