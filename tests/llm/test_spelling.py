"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from domscope.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = (a, b) if len(a) > len(b) else (b, a)
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def vocabulary(docs, least=3, length=5):
    out = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            out[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in out.items() if n >= least and len(w) >= length}


def expected(found):
    kin = {w: [v for v in found if near(w, v)] for w in found}
    form = {}
    for w, others in kin.items():
        best = min(others, key=lambda v: (-found[v], v), default=None)
        form[w] = best if best is not None and found[best] >= 2 * found[w] else None
    out = []
    for w in found:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, found[w], len(kin[w]), found[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def words_of(seed, alphabet, count, longest):
    rng = random.Random(seed)
    base = ["".join(rng.choices(alphabet, k=rng.randrange(5, longest))) for _ in range(count)]
    out = set(base)
    for w in base:
        for _ in range(3):
            i = rng.randrange(len(w))
            out.add(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(alphabet) + w[i:], w[:i] + rng.choice(alphabet) + w[i + 1 :]]))
    return {w: rng.choice([3, 4, 6, 8, 16, 40, 100]) for w in out if len(w) >= 5}


@pytest.mark.parametrize("seed,alphabet,longest,shard", [(1, "ab", 12, 100), (2, "abcé", 9, 60), (3, "aÿ", 7, 20), (4, "a", 40, 50), (5, "abc", 8, 1 << 18)])
def test_equal_to_brute_force(spark, monkeypatch, seed, alphabet, longest, shard):
    monkeypatch.setattr(spelling, "TILE", 64)
    monkeypatch.setattr(spelling, "PAIRS", 10)
    monkeypatch.setattr(spelling, "SEGMENT", 4)
    found = words_of(seed, alphabet, 120, longest)
    frame = spark.createDataFrame(list(found.items()), "word string, n long")
    assert rows(spelling.forms(frame, shard=shard)) == expected(found)


def test_shards_stay_small(spark):
    """All words begin and end alike: a grid of shards, each with a bounded part of the words."""
    found = words_of(7, "abcdefgh", 400, 9)
    found = {f"th{w}ng": n for w, n in found.items()}
    frame = spark.createDataFrame(list(found.items()), "word string, n long")
    per = spelling.sharded(frame, 1000).selectExpr("shard", "role", "length(word) AS size").groupBy("shard", "role").sum("size").collect()
    assert max(r[2] for r in per) <= 2000 and len({r[0] for r in per}) > 20
    assert rows(spelling.forms(frame, shard=1000)) == expected(found)


def test_letters_are_packed_without_mixing_kinds():
    got = spelling.plan([(0, "aa", 5), (0, "ab", 4), (0, "ac", 25), (0, "ad", 10), (1, "aa", 1), (1, "ab", 1)], 10)
    assert got == [(0, "aa", 0, 1), (0, "ab", 0, 1), (0, "ac", 1, 3), (0, "ad", 10, 1), (1, "aa", 11, 1), (1, "ab", 11, 1)]


def test_words_of_texts(spark):
    rng = random.Random(3)
    base = ["Straße", "naïveté", "HELLO", "hello", "world", "worlds", "ÀÉÎ", "àéî", "wörld", "abcde"]
    docs = [(i, " ".join(rng.choices(base, k=60)) + rng.choice(["", "123abcde×÷x", "日本abcde"])) for i in range(200)]
    docs += [(None, "hello hello"), (5, None), (6, ""), (7, "..."), (8, "world"), (8, "world")]
    frame = spark.createDataFrame([(*d, 1, "w") for d in docs], "doc_id long, text string, n int, word string")
    assert rows(spelling.variants(frame)) == expected(vocabulary(docs))
    assert rows(spelling.variants(frame.limit(0))) == []
    assert rows(spelling.variants(frame.where("text = '...'"))) == []


def test_long_texts_and_words(spark):
    docs = [(i, "x" * 1_000_000 + " " + "other " * 200_000) for i in range(4)] + [(9, "y" + "x" * 999_999)] * 3
    got = spelling.variants(spark.createDataFrame(docs, "doc_id long, text string")).select("word", "form", "n", "n_near").collect()
    found = vocabulary(docs)
    assert {(r.word, r.n) for r in got} == set(found.items())
    assert sum(r.n_near for r in got) == 2 * (("x" * 1_000_000 in found) and ("y" + "x" * 999_999 in found))


def test_query_is_equal_to_brute_force_on_the_given_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(queries.op12_spelling_variants(spark, folder)) == expected(vocabulary(docs))
