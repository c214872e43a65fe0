"""The pipeline's stages, each against what its operator promises."""

import hashlib
import random
import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as p
from domscope.llm import pii_crf, quality_rules
from domscope.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8)))
    rows, labels = [], []
    for k in range(240):
        words = [word() for _ in range(rng.randrange(30, 120))]
        junk = k % 6 == 0
        if junk:
            words = [w + rng.choice(("###", "$$$", "%%%")) for w in words]
        elif k % 10 == 1:
            words[3] = "mail.me@example.org"
        rows.append((k, " ".join(words), "en", f"src{k % 4}" if k % 9 else None, 0))
        labels.append((k, int(not junk), 0))
    rows += [
        (300 + k, rows[k][1].replace(" ", "\n", 1), "en", "src1", 0) for k in (1, 2, 3)
    ] + [(310, None, None, None, None), (311, "", "en", "src1", 0)]
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long",
    ).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = p.quality(spark, docs, folder)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    rules = quality_rules.learn(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert ids == {r["doc_id"] for r in quality_rules.apply(docs, rules).where("kept").collect()}
    assert all((k % 6 != 0) == (k in ids) for k in range(240)) and not ids & {310, 311}
    one = p.near_duplicates(spark, kept, folder)
    assert one.columns == docs.columns and {r["doc_id"] for r in one.collect()} == ids - {301, 302, 303}
    masked = p.personal_data(spark, one, folder)
    assert masked.columns == docs.columns
    crf = pii_crf.model()
    for r in masked.collect():
        assert r["text"] == pii_crf.mask(
            texts[r["doc_id"]],
            pii_crf.find([texts[r["doc_id"]]], crf)[0],
        ) and r["n_chars"] == len(r["text"]) and "@" not in r["text"]
    mixed = p.mixture(spark, masked, folder)
    assert mixed.columns == docs.columns
    assert max(Counter(r["doc_id"] for r in mixed.collect()).values()) <= 3
    encoded = p.encoding(spark, mixed, folder)
    assert {"doc_id", "ids", "n_tokens"} <= set(encoded.columns) and encoded.count() == mixed.count()


def _encoded(text, library):
    return tuple(library.encode(text or "", add_special_tokens=False).ids)


def test_run_against_brute_force(spark, folder):
    """The whole pipeline on planted documents: junk goes, one of each group of copies stays, addresses are
    masked, sources come near their targets, ids are those of the tokenizers library."""
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    library = Tokenizer.from_file(vocabulary_path())
    expected = {
        k: re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "[EMAIL]", docs[k]["text"])
        for k in range(240)
        if k % 6
    }
    got = p.run(spark, folder).collect()
    taken = Counter(r["doc_id"] for r in got)
    assert set(taken) <= set(expected) and max(taken.values()) <= 3
    for r in got:
        text = expected[r["doc_id"]]
        assert tuple(r["ids"]) == _encoded(
            text, library,
        ) and r["n_tokens"] == len(r["ids"]) and r["source"] == docs[r["doc_id"]]["source"]
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    size = {k: len(t.split()) for k, t in expected.items()}
    total = Counter()
    for k, n in size.items():
        total[docs[k]["source"]] += n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    low, high = 0.0, 1e9
    for _ in range(200):  # the level at which min(level * weight, 3 * size) fills the whole
        level = (low + high) / 2
        share = {s: min(level * (1 + k % 3), 3 * total[s]) for k, s in enumerate(names)}
        low, high = (level, high) if sum(share.values()) < sum(total.values()) else (low, level)
    for s in names:
        have = sum(n * size[k] for k, n in taken.items() if docs[k]["source"] == s)
        assert abs(have - share[s]) <= max(size.values()) / 2 + 1


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(None, None, None, None, None)] * 3,
        [(1, "", "en", None, 0), (1, "", "en", None, 0), (None, " \n", None, "s", 0)],
    ],
)
def test_edges_of_stages(spark, folder, rows):
    """Empty tables, nulls in every column, wordless and repeated rows, and clashing columns."""
    names = [
        "masked", "ids", "decoded", "spans", "size", "draws", "kept", "rule", "row", "r1", "component", "shard",
        "_masked",
    ]
    docs = spark.createDataFrame(
        [(*r, *names) for r in rows],
        f"doc_id long, text string, lang string, source string, n_chars long, {', '.join(f'{n} string' for n in names)}",
    )
    for _, stage in p.STAGES:
        got = stage(spark, docs, folder)
        if stage is not p.encoding:
            assert got.columns == list(p.COLUMNS)
        n = got.count()
        assert n == 0 if stage is p.quality or not rows else n >= 0
    assert p.near_duplicates(spark, docs, folder).count() == len(rows)
    assert p.personal_data(
        spark, docs, folder,
    ).count() == len(rows) and p.encoding(spark, docs, folder).count() == len(rows)


def test_run(spark, folder):
    a = sorted((r["doc_id"], tuple(r["ids"])) for r in p.run(spark, folder).collect())
    assert a and a == sorted((r["doc_id"], tuple(r["ids"])) for r in p.run(spark, folder).collect())
    assert [n for n, _ in p.STAGES] == ["quality_rules", "near_dedup", "personal_data", "mixing", "bpe"]


def test_near_copies_of_the_stage(spark, folder):
    """A copy at similarity 0.815 goes."""
    words = [f"word{k}" for k in range(200)]
    copy = [f"new{k}" if k in (20, 60, 100, 140) else w for k, w in enumerate(words)]
    docs = spark.createDataFrame(
        [(1, " ".join(words), "en", "a", 0), (2, " ".join(copy), "en", "a", 0)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    assert [r["doc_id"] for r in p.near_duplicates(spark, docs, folder).collect()] == [1]


def test_round_trip_of_the_stage(spark, folder):
    """The ids decode to the text of each document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("text is not null")
    texts = {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in docs.collect()}
    assert {r["doc_id"]: r["decoded_sha256"] for r in p.encoding(spark, docs, folder).collect()} == texts
