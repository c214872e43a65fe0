"""Quality statistics against brute force; the decision list on planted junk."""

import random
import re
from collections import Counter

from domscope.llm import quality_rules as q

SCHEMA = "doc_id long, text string, n_words string"


def _expected(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if count[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_statistics(spark):
    rng = random.Random(2)
    texts = (
        ["".join(rng.choice("ab é\n#|\t") for _ in range(rng.randrange(200))) for _ in range(400)]
        + [None, "", "\n", "a b c d e a b c d e", "a\na\n\na", " x\nx", "x\rx\nx\rx", "w " * 30_000]
    )
    docs = spark.createDataFrame(
        [(k, t, "old") for k, t in enumerate(texts)] + [(0, texts[0], None)],
        SCHEMA,
    ).repartition(3)
    for r in q.statistics(docs).collect():
        assert tuple(r[x] for x in q.BASE) == _expected(texts[r["doc_id"]])


def _corpus(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8)))
    rows, labels = [], []
    for k in range(600):
        words = [word() for _ in range(rng.randrange(30, 200))]
        bad = k % 6 == 0
        if bad:
            words = (
                [w + rng.choice(("###", "$$$", "|")) for w in words] if k % 12 else [w.upper() + "!!" for w in words]
            )
        rows.append((k, " ".join(words), "x"))
        if k % 2 == 0:
            labels.append((k, int(not bad)))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(
        [*labels, (None, 1), (4, None), (2, 1)],
        "doc_id long, quality int",
    )


def test_rules_learn(spark):
    docs, labels = _corpus(spark)
    rules = q.learn(docs, labels)
    assert rules and rules == q.learn(docs.repartition(5), labels)
    for r in q.apply(docs, rules).collect():
        bad = r["doc_id"] % 6 == 0
        assert r["kept"] == (not bad and not r["base_failed"]), r


def test_edge_cases(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = spark.createDataFrame(
        [(1, None, None), (2, "a " * 9, "x"), (3, "b c d e f g h i j k l", "x"), (3, "b c d e f g h i j k l", "x")],
        SCHEMA,
    )
    assert q.learn(docs, none) == []
    assert sorted(
        (r["doc_id"], r["base_failed"], r["kept"]) for r in q.apply(docs, []).collect()
    ) == [(1, True, False), (2, True, False), (3, False, True), (3, False, True)]
    empty = spark.createDataFrame([], SCHEMA)
    assert q.apply(empty, q.learn(empty, none)).collect() == []
