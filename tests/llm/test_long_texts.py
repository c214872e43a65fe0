"""Very long texts, and texts without a space, in every operator."""

import random

import pytest

from domscope.llm import bpe, langid, lm_score, mixing, near_dedup, pii_crf, quality_rules, substring_dedup, suffix_dedup
from domscope.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    passage = " ".join(word() for _ in range(2000))
    own = " ".join(word() for _ in range(300_000))
    return [
        (1, " ".join([passage] * 120)),
        (2, own),
        (3, "x" * 1_000_000),
        (4, passage),
        (5, own[:-1] + "z"),
        (6, "=-" * 200_000),
        (7, "a few words only"),
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(
        [(*t, "en", f"s{t[0] % 2}") for t in texts],
        "doc_id long, text string, lang string, source string",
    )


def test_repeats(docs, texts):
    size = {d: len(t.encode()) for d, t in texts}
    got = {r["doc_id"]: r for r in suffix_dedup.dedup(docs).collect()}
    assert {d: r["n_bytes"] for d, r in got.items()} == size
    assert all(
        got[d]["n_removed"] == size[d] for d in (1, 3, 4, 6)
    ) and got[2]["n_removed"] == got[5]["n_removed"] == size[2] - 1 and got[7]["n_removed"] == 0
    words = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.dedup(docs).collect()}
    assert words == {
        1: (240_000, 0), 2: (300_000, 0), 3: (1, 0), 4: (2000, 2000), 5: (300_000, 299_999), 6: (1, 0), 7: (4, 0),
    }


def test_near_duplicates(docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.dedup(docs).collect()}
    assert {d: c for d, (_, c) in got.items()} == {1: 1, 2: 2, 3: 3, 4: 1, 5: 2, 6: 6, 7: 7}
    assert got[1][0] == 2000 and got[4][0] == 1996 and got[2][0] <= 299_996


def test_one_pass_operators(docs, texts):
    size = {d: len(t.split()) for d, t in texts}
    assert {r["doc_id"]: r["size"] for r in mixing.mix(docs).collect()} == size
    assert {r["doc_id"]: r["n_words"] for r in quality_rules.statistics(docs).collect()} == size
    assert {r["doc_id"]: r["n_words"] for r in lm_score.scores(docs).collect()} == size
    assert {
        r["doc_id"] for r in langid.identify(docs, langid.train(docs)).where("score between 0 and 1").collect()
    } == set(size)
    assert all(not r["spans"] for r in pii_crf.detect(docs).where("doc_id in (1, 2, 4, 5, 7)").collect())
    back = bpe.encode(docs, vocabulary_path(), decoded="back").where("text = back")
    assert back.count() == len(texts)
