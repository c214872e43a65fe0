"""Near-dedup against brute force over all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from domscope.llm import near_dedup

SCHEMA = "doc_id long, text string, extra string"


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return frozenset()
    return (
        frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))
        if len(words) >= 5
        else frozenset([tuple(words)])
    )


def _expected(rows):
    sets = [_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                    parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def _rows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 7)))
    rows = []
    k = 0
    for size, copies, edits in ((60, 40, 1), (120, 30, 2), (200, 12, 8), (30, 3, 0), (9, 5, 1), (4, 4, 0), (1, 3, 0)):
        base = [word() for _ in range(size)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(edits + 1)):
                text[rng.randrange(size)] = word()
            joined = rng.choice([" ", "\n", "\t "]).join(text)
            rows.append((k, joined.upper() if rng.random() < 0.2 else joined))
            k += 1
    rows += [(k + i, " ".join(word() for _ in range(rng.randrange(1, 80)))) for i in range(40)]
    rows += [
        (None, rows[0][1]), (None, "only one here"), (7, rows[7][1]), (8, rows[50][1]), (900, None), (901, ""),
        (902, " \n"), (903, None),
    ]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tile", [8, 2048])
def test_all_pairs(spark, tile, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE", tile)
    rows = _rows()
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    got = near_dedup.dedup(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted([tuple(r) for r in got], key=repr) == _expected(rows)


def test_keep_one(spark):
    docs = spark.createDataFrame(
        [
            (1, "a b c d e f g", "x"),
            (2, "A b c d e f  g", "y"),
            (2, "A b c d e f  g", "z"),
            (3, None, "x"),
            (4, "other words stand here now ok", "x"),
            (4, "other words stand here now ok", "x"),
        ],
        SCHEMA,
    )
    assert sorted(r[0] for r in near_dedup.keep_one(docs).collect()) == [1, 3, 4]


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert near_dedup.dedup(docs).collect() == []
    assert near_dedup.keep_one(docs).collect() == []


def test_pigeonhole():
    """Signatures within the distance share a key."""
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(300):
        a = rng.integers(0, 1 << 16, near_dedup.SYMBOLS).astype(np.uint16)
        b = a.copy()
        b[rng.permutation(near_dedup.SYMBOLS)[: near_dedup.DISTANCE]] ^= 1
        ka, kb = near_dedup.keys(np.stack([a, b]))
        assert (ka == kb).any()


def test_threshold(spark):
    """Pairs at 0.80 to 0.85: 200 words, 4 scattered edits, 176 of 216 shingles shared."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    rows = []
    for k in range(150):
        base = [word() for _ in range(200)]
        for edits in (0, 4 if k % 3 else 6):
            text = list(base)
            for e in range(edits):
                text[20 + 30 * e] = word()
            rows.append((len(rows), " ".join(text), "x"))
    for k in range(0, 300, 2):
        a, b = _set(rows[k][1]), _set(rows[k + 1][1])
        assert 80 * len(
            a | b
        ) <= 100 * len(a & b) < 85 * len(a | b) if k // 2 % 3 else 100 * len(a & b) < 80 * len(a | b)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(
        r[0] for r in near_dedup.keep_one(docs, threshold=80).collect()
    ) == [k for k in range(300) if not (k % 2 and k // 2 % 3)]
    assert near_dedup.keep_one(docs.where("doc_id < 20")).count() == 20


@pytest.mark.parametrize("scheme", near_dedup.SCHEMES.values())
def test_pigeonhole_of_schemes(scheme):
    import numpy as np

    rng = np.random.default_rng(4)
    assert scheme.distance // scheme.chunks == 1
    for _ in range(300):
        a = rng.integers(0, 1 << 16, scheme.symbols).astype(np.uint16)
        b = a.copy()
        b[rng.permutation(scheme.symbols)[: scheme.distance]] ^= 1
        ka, kb = near_dedup.keys(np.stack([a, b]), scheme)
        assert (ka == kb).any()


def test_keep_one_of_each_group(spark):
    """Groups without ids, and different texts under the smallest id, leave one row."""
    words = [f"w{k}" for k in range(60)]
    near = [" ".join([*words[:-1], x]) for x in ("a", "b", "c")]
    other = [" ".join(["o" + w for w in [*words[:-1], x]]) for x in ("a", "b", "c")]
    rows = [
        *((None, t, "x") for t in near),
        (5, other[0], "x"),
        (5, other[1], "x"),
        (6, other[2], "x"),
        (None, other[2], "x"),
        (None, None, "x"),
        (None, "", "x"),
        (7, " ", "x"),
    ]
    got = near_dedup.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    full = [r for r in got if (r["text"] or "").strip()]
    assert len(full) == 2 and sorted(r["doc_id"] or 0 for r in full) == [0, 5]
    assert len(got) == 5


def test_long_sets_and_clashing_columns(spark, monkeypatch):
    """Groups are dealt to tiles by bytes too; columns of any name pass through keep_one."""
    monkeypatch.setattr(near_dedup, "TILE_BYTES", 20_000)
    names = ["row", "r1", "r2", "full", "component", "node", "n", "own", "of", "first"]
    base = [f"w{k}" for k in range(1500)]
    rows = (
        [(k, " ".join([*base[:-1], f"x{k}"]), *[f"{n}{k}" for n in names]) for k in range(12)]
        + [(50, "other " * 40, *names), (51, None, *names), (52, "", *names)]
    )
    docs = spark.createDataFrame(
        rows,
        f"doc_id long, text string, {', '.join(f'`{n}` string' for n in names)}",
    ).repartition(3)
    got = sorted(near_dedup.keep_one(docs).collect(), key=lambda r: r["doc_id"])
    assert [tuple(r) for r in got] == [rows[0], *rows[12:]]
    assert sorted(
        [tuple(r) for r in near_dedup.dedup(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()],
        key=repr,
    ) == _expected([r[:2] for r in rows])


def test_many_equal_rows(spark):
    rows = (
        [(None, "a b c d e f g h", "x")] * 500
        + [(9, "a b c d e f g h", "x")] * 300
        + [(4, "a b c d e f g h", "x"), (1, "not like the others at all", "x")]
    )
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert sorted(r["doc_id"] for r in near_dedup.keep_one(docs).collect()) == [1, 4]
    assert sorted(
        [tuple(r) for r in near_dedup.dedup(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()],
        key=repr,
    ) == _expected([r[:2] for r in rows])


def test_a_place_gets_one_text_of_equal_rows(spark):
    """Rows equal in id and text, in any number, are read once for each place of their class."""
    rng = random.Random(8)
    text = " ".join(rng.choices("abcdefgh", k=60))
    rows = [(1, text)] * 300 + [(2, text + " z"), (3, "other words " * 9), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    place = "r1 long, r2 long, group long, t int, u int, item long, n long, component long, rest double"
    one = near_dedup._rids(docs).where("doc_id = 1").select("r1", "r2").first()
    dealt = spark.createDataFrame([(one.r1, one.r2, g, 0, 0, 7, 56, 0, 0.0) for g in (4, 5)], place).withColumn("g", F.col("group"))
    made = near_dedup._with_sets(docs, dealt.select("r1", "r2", "g", *near_dedup.PLACE[1:])).collect()
    assert sorted(r["group"] for r in made) == [4, 5]
    found = {(r.doc_id, r.component_id) for r in near_dedup.dedup(docs, threshold=80).collect()}
    assert found == {(1, 1), (2, 1), (3, 3), (None, 1)}
