"""Exact repeat removal against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from domscope.llm import substring_dedup, suffix_dedup
from domscope.llm.seeds import ids_of, marks, runs

SCHEMA = "doc_id long, text string, extra string"


def _bytes_expected(rows, width):
    where = defaultdict(int)
    raw = [(t or "").encode() for _, t in rows]
    for t in raw:
        for i in range(len(t) - width + 1):
            where[t[i : i + width]] += 1
    out = []
    for (d, _), t in zip(rows, raw, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - width + 1):
            if where[t[i : i + width]] > 1:
                gone[i : i + width] = True
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[: len(t)]).sum()) if t else 0
        out.append(
            (d, len(t), int(gone.sum()), runs, bytes(c for c, g in zip(t, gone.tolist(), strict=False) if not g))
        )
    return sorted(out, key=repr)


def _words_expected(rows, width):
    least = {}
    split = [(t or "").encode().split() for _, t in rows]
    big = 1 << 62
    for (d, _), w in zip(rows, split, strict=True):
        for i in range(len(w) - width + 1):
            k = tuple(w[i : i + width])
            least[k] = min(least.get(k, big), big if d is None else d)
    out = []
    for (d, _), w in zip(rows, split, strict=True):
        keep = [True] * len(w)
        for i in range(len(w) - width + 1):
            if least[tuple(w[i : i + width])] < (big if d is None else d):
                keep[i : i + width] = [False] * width
        kept = [x for x, k in zip(w, keep, strict=True) if k]
        out.append((d, len(w), len(w) - len(kept), b" ".join(kept).decode()))
    return sorted(out, key=repr)


def _rows(seed, alphabet, count, longest):
    rng = random.Random(seed)
    parts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(12)]
    rows = []
    for k in range(count):
        text = "".join(
            rng.choice(parts) if rng.random() < 0.6 else "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            for _ in range(rng.randrange(6))
        )
        rows.append((k, text))
    rows += [
        (None, parts[0] + parts[1]), (None, parts[0]), (3, rows[3][1]), (3, parts[2]), (count, None), (count + 1, ""),
        (count + 2, "ab" * 400), (count + 3, " \t\n "),
    ]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [3, 50_000])
def test_bytes(spark, hot):
    for seed, alphabet, longest in ((1, "ab é", 60), (2, "abcdefghij klm\n", 300)):
        rows = _rows(seed, alphabet, 60, longest)
        docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
        got = sorted(
            [
                (r[0], r[1], r[2], r[3], bytes(r[4]))
                for r in suffix_dedup.dedup(docs, width=40, gram=8, hot=hot).collect()
            ],
            key=repr,
        )
        assert got == _bytes_expected(rows, 40)


@pytest.mark.parametrize("hot", [3, 50_000])
def test_words(spark, hot):
    for seed, alphabet, longest in ((3, "ab  ", 60), (4, "abc é \n\t", 200)):
        rows = _rows(seed, alphabet, 60, longest)
        docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
        got = sorted([tuple(r) for r in substring_dedup.dedup(docs, hot=hot).collect()], key=repr)
        assert got == _words_expected(rows, 13)


def test_production_width(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(50))
    rows = [
        (k, " ".join(word() for _ in range(30)) + (" " + passage[k : k + 220 + k] + " " if k % 2 else " ") + word())
        for k in range(20)
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = sorted([(r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffix_dedup.dedup(docs).collect()], key=repr)
    assert got == _bytes_expected(rows, 200)
    assert sum(r[2] for r in got) > 0


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.dedup(docs).collect() == []
    assert substring_dedup.dedup(docs).collect() == []


def test_multikey_order():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 2, (500, 21), dtype=np.uint8)
    order = suffix_dedup.multikey_order(rows)
    got = [rows[k].tobytes() for k in order]
    assert got == sorted(got)
    lcp = suffix_dedup.neighbour_lcp(rows, order)
    for k in range(1, 500):
        a, b = got[k - 1], got[k]
        assert lcp[k] == next((i for i in range(21) if a[i] != b[i]), 21)


@pytest.mark.parametrize("within", [True, False])
@pytest.mark.parametrize("hot", [1, 3, 100])
def test_runs(hot, within):
    """The streamed run lengths agree with counts over all rows, whatever the sizes of batches."""
    rng = random.Random(hot)
    ids = [0, 1, 1 << 50, (1 << 50) + 1, -3, (1 << 63) - 1, 77, 78]
    rows = sorted(
        {
            (
                rng.choice([0, 1, 7, 0xFFFFFFFF, *range(100, 130)]) << 32
                | rng.choice([0, 1, 2]) << 16
                | rng.choice([0, 5, 6]),
                rng.choice(ids),
            ): rng.choice([1, 1, 1, 2, 1 << 30])
            for _ in range(150)
        }.items()
    )
    group = defaultdict(list)
    for (v, d), c in rows:
        for g in ((v >> 32,), (v >> 16, 0), (v >> 32, 1, v & 0xFFFF)):
            group[g].append((d, c))
    again = lambda g: sum(c for _, c in group[g]) > 1 if within else len({d for d, _ in group[g]}) > 1
    sure = {
        (v, d)
        for (v, d), _ in rows
        if (v >> 16 & 0xFFFF and again((v >> 16, 0))) or (v & 0xFFFF and again((v >> 32, 1, v & 0xFFFF)))
    }
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    did = np.array([d for (_, d), _ in rows])
    keys = did ^ np.int64(0x1234 << 48)
    mark = marks(did, np.array([c % 4 for _, c in rows]), np.array([c for _, c in rows]))
    assert (ids_of(keys, mark) == did.view(np.uint64)).all()
    table = pa.RecordBatch.from_arrays(
        [pa.array([signed(v) for (v, _), _ in rows], pa.int64()), pa.array(keys), pa.array(mark)],
        names=["value", "key", "mark"],
    )
    back = dict(zip(keys.tolist(), did.tolist(), strict=True))
    for size in (1, 2, 7, 150):
        got = [
            (r["value"] % (1 << 64), back[r["key"]], r["hot"])
            for b in runs((table.slice(i, size) for i in range(0, len(rows), size)), within, hot)
            for r in b.to_pylist()
        ]
        assert len(got) == len(set(got)) and {(v, d) for v, d, _ in got} >= sure
        for v, d, flag in got:
            assert flag == (sum(c % 4 for _, c in group[v >> 32,]) > hot) or len(group[v >> 32,]) > hot
            assert (v, d) in sure or len(group[v >> 32,]) > hot


def test_equal_ids(spark):
    """Rows that share an id, null above all, are told apart by their texts."""
    words = lambda seed, n: " ".join(f"w{(seed * 7919 + k * 104729) % 1000003}" for k in range(n))
    rows = (
        [(None, words(k, 40)) for k in range(3000)]
        + [(7, words(k, 40)) for k in range(3000, 6000)]
        + [(1, words(5, 40)), (2, words(3005, 40))]
    )
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(5)
    got = sorted([(r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffix_dedup.dedup(docs).collect()], key=repr)
    assert got == _bytes_expected(rows, 200)
    assert sum(r[2] > 0 for r in got) == 4
    assert sorted([tuple(r) for r in substring_dedup.dedup(docs).collect()], key=repr) == _words_expected(rows, 13)


def test_repeated_rows_and_one_hot_text(spark):
    """Many equal rows, and one text of equal grams, beside texts of their own."""
    own = [(k, " ".join(f"v{k}x{j}" for j in range(60))) for k in range(5)]
    rows = (
        [(None, own[0][1])] * 300
        + [(4, own[1][1])] * 300
        + own
        + [(90, "=" * 30_000), (91, "w " * 30_000), (92, "=" * 300 + " w w " * 10)]
    )
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    for hot in (100, 50_000):
        got = sorted(
            [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffix_dedup.dedup(docs, hot=hot).collect()],
            key=repr,
        )
        assert got == _bytes_expected(rows, 200)
        assert sorted(
            [tuple(r) for r in substring_dedup.dedup(docs, hot=hot).collect()],
            key=repr,
        ) == _words_expected(rows, 13)


def test_bucketed():
    from domscope.llm.seeds import bucketed

    keys = [1] * 5 + [2] * 50 + [3, 4, 5, 5, 6] + [7] * 9
    batch = pa.RecordBatch.from_arrays([pa.array(keys), pa.array([b"x" * 40] * len(keys))], names=["k", "v"])
    for size in (1, 3, 100):
        parts = list(bucketed(iter([batch.slice(i, size) for i in range(0, len(keys), size)]), 0, 200))
        assert [k for t in parts for k in t["k"].to_pylist()] == keys
        assert all(a["k"][-1] != b["k"][0] for a, b in zip(parts, parts[1:], strict=False)) and len(parts) > 3
