"""Mixing: targets, quotas and draws."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from domscope.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string"


def _rows(n=3000):
    rng = random.Random(8)
    sources = ["a"] * 10 + ["b"] * 4 + ["c", "d", "", None, "é"]
    return [
        (
            k,
            rng.choice(["w " * rng.randrange(1, 60), "", None, "x"]) if k % 40 else "z " * 900,
            rng.choice(sources),
            "old",
        )
        for k in range(n)
    ]


def _brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: 1 + k % 3 for k, s in enumerate(order)}
    total = sum(sizes.values())
    lo, hi = 0.0, 1e12
    for _ in range(300):  # the common level at which min(level * weight, cap) fills the whole
        mid = (lo + hi) / 2
        if sum(min(mid * w[s], 3 * sizes[s]) for s in sizes) < total:
            lo = mid
        else:
            hi = mid
    return {s: min(hi * w[s], 3 * sizes[s]) for s in sizes}


@pytest.mark.parametrize("seed", range(5))
def test_targets(seed):
    rng = random.Random(seed)
    sizes = {f"s{k}" if k else None: rng.choice([0, 5, rng.randrange(10_000)]) for k in range(rng.randrange(1, 12))}
    got = mixing.targets(list(sizes.items()))
    for s, t in _brute_targets(sizes).items():
        assert abs(got[s] - t) < 1e-6 * max(1, t) + 1e-6


def test_split_tree():
    quota = np.array([100, 0, 7, 33])
    deal = mixing.split_tree(quota, 5, np.random.default_rng(1))
    assert (deal.sum(axis=0) == quota).all() and deal.min() >= 0
    assert deal.sum(axis=1).max() - deal.sum(axis=1).min() <= 1
    mean = np.mean([mixing.split_tree(quota, 4, np.random.default_rng(k))[0] for k in range(400)], axis=0)
    assert np.abs(mean - quota / 4).max() < 1.0


def test_mix(spark):
    rows = _rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    mixed = mixing.mix(docs.repartition(5)).collect()
    again = mixing.mix(docs.repartition(2)).collect()
    assert sorted(map(repr, mixed)) == sorted(map(repr, again))
    words = {d: len((t or "").split()) for d, t, _, _ in rows}
    size = defaultdict(int)
    for d, _, s, _ in rows:
        size[s] += words[d]
    want, taken, largest = mixing.targets(list(size.items())), Counter(), Counter()
    assert len(mixed) == len(rows)
    for r in mixed:
        s = r["source"]
        assert r["size"] == words[r["doc_id"]] and r["source_size"] == size[s] and abs(r["target"] - want[s]) < 1e-6
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] == r["size"] * len(r["draws"]))
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s in size:
        assert abs(taken[s] - want[s]) <= largest[s]
    drawn = mixing.rows_of(mixing.mix(docs)).collect()
    assert Counter(r["doc_id"] for r in drawn) == Counter({r["doc_id"]: len(r["draws"]) for r in mixed if r["draws"]})


def test_edge_cases(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    got = mixing.mix(spark.createDataFrame([(1, None, None, "x"), (2, "", "a", "x")], SCHEMA)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2
    one = mixing.mix(
        spark.createDataFrame([(1, "a b", "s", "x"), (1, "a b", "s", "x"), (2, "long " * 50_000, "s", "x")], SCHEMA)
    ).collect()
    assert sorted(r["taken"] for r in one) == [2, 2, 50_000]


def _check(mixed):
    """Every source within half of its largest text of the target."""
    taken, target, largest = Counter(), {}, Counter()
    for r in mixed:
        assert r["taken"] == r["size"] * len(r["draws"]) <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s, t in target.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1, (s, taken[s], t)
    return taken


def test_repeated_rows(spark):
    """Some of equal rows are taken, as many as the target wants."""
    rows = [(None, " ".join("w" * 10), "a")] * 100 + [(k, f"v{k} " * 10, "b") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs.repartition(4)).collect()
    taken = _check(mixed)
    assert 650 <= taken["a"] <= 680 and 1310 <= taken["b"] <= 1345
    assert sorted(map(repr, mixed)) == sorted(map(repr, mixing.mix(docs.coalesce(1)).collect()))


@pytest.mark.parametrize("kind", ["huge", "tiny", "one"])
def test_near_the_target(spark, kind):
    rng = random.Random(kind)
    if kind == "huge":  # one text holds much of a source
        rows = (
            [(k, "w " * rng.randrange(1, 30), "a") for k in range(400)]
            + [(900, "x " * 5000, "a")]
            + [(1000 + k, "y " * 20, "b") for k in range(900)]
        )
    elif kind == "tiny":
        rows = [(k, "w " * rng.randrange(1, 9), rng.choice("abcdefg")) for k in range(25)]
    else:
        rows = [(k, f"{k} " * 7, "s") for k in range(3000)] + [(k, "z", None) for k in range(5000, 9000)]
    _check(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())


def test_clashing_columns(spark):
    """Columns named like the operator's own pass through, result columns are replaced."""
    names = [
        "s", "k", "b", "c", "row", "rid", "edge", "passes", "shards", "number", "shard", "place", "source_", "block",
        "all", "one", "some",
    ]
    docs = spark.createDataFrame(
        [(k, f"w{k} w", "s1", "old", *[f"{n}{k}" for n in names]) for k in range(30)],
        f"doc_id long, text string, source string, taken string, {', '.join(f'`{n}` string' for n in names)}",
    )
    for got in (mixing.mix(docs).collect(), mixing.rows_of(mixing.mix(docs)).collect()):
        assert got and all(
            r[n] == f"{n}{r['doc_id']}" for r in got for n in names
        ) and all(r["taken"] % 2 == 0 for r in got)


def test_shards(spark):
    """A shard is a partition; the draws of the shards are those of the documents."""
    docs = spark.createDataFrame(
        [(k, "w " * (k % 7 + 1), f"s{k % 3}") for k in range(2000)],
        "doc_id long, text string, source string",
    )
    mixed = mixing.mix(docs, shards=5)
    parts = mixing.rows_of(mixed, 5).rdd.glom().map(lambda p: Counter(r["doc_id"] for r in p)).collect()
    rows = mixed.collect()
    for k, part in enumerate(parts):
        assert part == Counter(r["doc_id"] for r in rows for d in r["draws"] if d["shard"] == k)
    words = [sum(n * (d % 7 + 1) for d, n in p.items()) for p in parts]
    assert len(parts) == 5 and max(words) < 1.3 * min(words)


def test_fill():
    words, copies = np.array([5, 3, 7, 2]), np.array([2, 1, 9, 0])
    taken, rest = mixing.fill(words, copies, 17)
    assert taken.tolist() == [2, 1, 0, 0] and rest == 4
    assert mixing.nearest(words, copies, taken, rest).tolist() == [2, 1, 1, 0]
    assert mixing.nearest(words, copies, taken, 3).tolist() == [2, 1, 0, 0]
