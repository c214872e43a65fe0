"""Relational operators."""

import random

import pytest
from pyspark.sql import functions as F

from domscope.operators import graph, keyed, pairs, places


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _brute_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return sorted((x, find(x)) for x in parent)


@pytest.mark.parametrize("local", [7, 200_000])
def test_components(spark, local):
    rng = random.Random(local)
    edges = (
        [(rng.randrange(120), rng.randrange(120)) for _ in range(70)]
        + [(200 + k, 201 + k) for k in range(25)]
        + [(9, 9), (3, 3)]
    )
    frame = spark.createDataFrame([*edges, (None, 1), (2, None)], "a long, b long").repartition(4)
    got = _rows(graph.components(frame, "a", "b", local_edges=local))
    assert got == _brute_components([e for e in edges if e[0] != e[1]])


def test_components_of_nothing(spark):
    assert _rows(graph.components(spark.createDataFrame([], "a string, b string"), "a", "b")) == []


def test_keep_first_and_last(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), ("b", 3, None), (None, 1, "n")],
        "k string, o int, v string",
    )
    assert sorted(
        map(repr, keyed.keep_first(df, ["k"], ["o"]).collect())
    ) == sorted(map(repr, df.where("v IS NULL OR v <> 'x'").collect()))
    assert {
        (r["k"], r["v"]) for r in keyed.keep_last(df, ["k"], ["o"]).collect()
    } == {("a", "x"), ("b", None), (None, "n")}


def test_merge_first(spark):
    a = spark.createDataFrame([("a", "1", 5)], "k string, v string, ordinal int")
    b = spark.createDataFrame([("a", "2", 0), ("b", "3", 1), ("b", "4", 0)], "k string, v string, ordinal int")
    assert sorted((r["k"], r["v"]) for r in keyed.merge_first([a, b], ["k"]).collect()) == [("a", "1"), ("b", "4")]


def test_edges(spark):
    nodes = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    edges = spark.createDataFrame([("a", "b"), ("x", "y"), ("a", "y"), (None, "a")], "from_id string, to_id string")
    assert _rows(keyed.valid_edges(edges, nodes)) == [("a", "b")]
    assert {
        r["error"] for r in keyed.edge_errors(edges, nodes).collect()
    } == {"unknown from_id: x", "unknown to_id: y", "unknown from_id: "}


def test_lookup_first(spark):
    left = spark.createDataFrame([("h",), ("g",), (None,)], "host string")
    index = spark.createDataFrame(
        [("h", "second", 2), ("h", "first", 1), (None, "no", 0)],
        "domain string, who string, o int",
    )
    assert sorted(
        ((r["host"] or ""), r["hit_who"]) for r in keyed.lookup_first(left, index, "host", "domain", ["o"]).collect()
    ) == [("", None), ("g", None), ("h", "first")]


def test_shared_keys(spark):
    rows = spark.createDataFrame(
        [("k", "b", 1), ("k", "a", 2), ("k", "a", 3), ("j", "a", 1), (None, "a", 1), ("k", None, 1)],
        "key string, m string, o int",
    )
    assert _rows(pairs.shared_keys(rows, "key", "m")) == [("a", "b", "k")]
    assert _rows(pairs.shared_keys(rows, "key", "m", order="o")) == [("b", "a", "k")]
    assert _rows(pairs.shared_keys(rows, "key", "m", max_members=1)) == []


def test_overlaps(spark):
    rows = spark.createDataFrame(
        [(m, k) for m, ks in {"x": "abc", "y": "bcd", "z": "d"}.items() for k in ks],
        "m string, k string",
    )
    got = pairs.overlaps(rows, "k", "m", least=2).collect()
    assert [
        (r["left"], r["right"], r["n"], r["least_key"], r["sample"]) for r in got
    ] == [("x", "y", 2, "b", ["b", "c"])]


def test_reciprocal(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "a"), ("d", "d"), ("a", "b")], "x string, y string")
    assert _rows(pairs.reciprocal(edges, "x", "y")) == [("a", "b", True), ("a", "c", False)]


def test_star_and_complete(spark):
    rows = spark.createDataFrame(
        [("g", "n", 2), ("g", "m", 1), ("g", "o", 3), ("h", "z", 1), (None, "q", 1)],
        "k string, m string, o int",
    )
    assert _rows(pairs.star(rows, "k", "m", "o")) == [("m", "n", "g"), ("m", "o", "g")]
    assert _rows(pairs.complete(rows, "k", "m")) == [("m", "n", "g"), ("m", "o", "g"), ("n", "o", "g")]


def test_pair_scores(spark):
    rows = spark.createDataFrame(
        [("a", "b", 1, "t1", "v", 60), ("a", "b", 0, "t0", "w", 60), ("a", "c", 0, "t0", "w", 0)],
        "left string, right string, rank int, type string, value string, weight int",
    )
    (r,) = pairs.pair_scores(rows).collect()
    assert (r["score"], [e["type"] for e in r["evidence"]]) == (100, ["t0", "t1"])


def test_sightings(spark):
    rows = spark.createDataFrame(
        [("h", "u2", "t2", 2), ("h", "u1", "t1", 1), ("h", "u2", "t3", 3)],
        "k string, u string, t string, o int",
    )
    assert [
        tuple(r) for r in keyed.sightings(rows, "k", "u", "t", ["o"]).collect()
    ] == [("h", "t1", "t3", ["u1", "u2"])]


def test_count_by(spark):
    assert [
        tuple(r) for r in keyed.count_by(spark.range(5).select((F.col("id") % 2).alias("k")), "k").collect()
    ] == [(0, 3), (1, 2)]


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_overlaps_against_all_pairs(spark, least):
    """The filter by first keys loses no pair, whatever the frequencies."""
    rng = random.Random(least)
    sets = {
        f"m{k}": {f"k{min(int(rng.expovariate(0.15)), 30)}" for _ in range(rng.randrange(12))}
        | ({"all"} if k % 5 else set())
        for k in range(60)
    }
    rows = (
        [(m, x) for m, s in sets.items() for x in s] + [("m1", None), (None, "all"), *(("m2", x) for x in sets["m2"])]
    )
    got = {
        (r["left"], r["right"]): (r["n"], r["least_key"], r["sample"])
        for r in pairs.overlaps(
            spark.createDataFrame(rows, "member string, key string"),
            "key",
            "member",
            least=least,
            sample=2,
        ).collect()
    }
    want = {
        (a, b): (len(s := sorted(sets[a] & sets[b])), s[0], s[:2])
        for a in sets
        for b in sets
        if a < b and len(sets[a] & sets[b]) >= least
    }
    assert got == want


@pytest.mark.parametrize("parts", [1, 7])
def test_numbered_without_one_task(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.randrange(40) if rng.random() < 0.9 else None, k, f"r{k}") for k in range(500)]
    rng.shuffle(rows)
    had = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    frame = spark.createDataFrame(rows, "g int, k int, n string")
    got = places.numbered(frame, ["g", "k"], "n")
    spark.conf.set("spark.sql.shuffle.partitions", had)
    assert got.columns == ["g", "k", "n"] and "SinglePartition" not in got._jdf.queryExecution().toString()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted((r.n, r.g, r.k) for r in got.collect()) == [(i, g, k) for i, (g, k, _) in enumerate(order, 1)]
    assert places.numbered(frame.limit(0), ["g"], "n").collect() == []


def test_pair_counts_against_pairs(spark):
    """Counts by places are the counts of the pairs, with repeated rows, nulls and keys of one member."""
    rng = random.Random(5)
    rows = [(rng.choice("aabbbcd") if rng.random() < 0.95 else None, rng.choice([None, *range(60)])) for _ in range(200)]
    frame = spark.createDataFrame([*rows, ("one", 1), ("one", 1)], "key string, m int")
    met = pairs.shared_keys(frame, "key", "m").groupBy("left", "key")
    want = met.agg(F.count("*").alias("n"), F.min("right").alias("least"), F.max("right").alias("most"))
    got = pairs.pair_counts(frame, "key", "m")
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_pair_counts_of_a_large_key(spark):
    """200,000 members of one key: 20 billion pairs, which are counted and not made."""
    got = pairs.pair_counts(spark.range(200_000).selectExpr("'all' AS key", "id AS m"), "key", "m")
    total = got.agg(F.count("*"), F.sum("n"), F.min("least"), F.min("most"), F.max("most")).first()
    assert tuple(total) == (199_999, 200_000 * 199_999 // 2, 1, 199_999, 199_999)


def _members(seed):
    rng = random.Random(seed)
    sets = {
        k: {f"k{min(int(rng.expovariate(0.12)), 40)}" for _ in range(rng.randrange(9))} | ({"all"} if k % 3 else set())
        for k in range(70)
    }
    sets[7] |= {f"k{k}" for k in range(30)}
    return sets


@pytest.mark.parametrize("listed", [0, 3, 100])
def test_shared_lists_against_all_pairs(spark, monkeypatch, listed):
    """Each pair once with all that it shares, in cells of any size, whether or not lists travel."""
    monkeypatch.setattr(pairs, "LISTED", listed)
    monkeypatch.setattr(pairs, "CELL", 9)
    sets = _members(listed)
    place = {k: (k * 37) % 70 for k in sets}
    rows = [(f"m{k}", x, place[k], f"about {k}") for k, s in sets.items() for x in s]
    frame = spark.createDataFrame([*rows, *rows[:9], ("m1", None, 0, "-"), (None, "all", 0, "-")], "m string, k string, o int, a string")
    got = pairs.shared_lists(frame, "k", "m", order="o", about="a")
    want = sorted(
        (f"m{a}", f"m{b}", sorted(sets[a] & sets[b]), f"about {a}")
        for a in sets for b in sets if place[a] < place[b] and sets[a] & sets[b]
    )
    assert _rows(got) == want
    few = pairs.shared_lists(frame, "k", "m", order="o", max_members=12).select("left", "right", "shared")
    rare = {x for x in set().union(*sets.values()) if sum(x in s for s in sets.values()) <= 12}
    assert _rows(few) == [(a, b, s) for a, b, w, _ in want if (s := [x for x in w if x in rare])]


@pytest.mark.parametrize(("listed", "common"), [(0, 1), (3, 1), (100, 1), (100, 40)])
def test_first_shared_against_all_pairs(spark, monkeypatch, listed, common):
    """Each pair once with its least shared key of each mark, also where all members meet in cells of the whole."""
    monkeypatch.setattr(pairs, "LISTED", listed)
    monkeypatch.setattr(pairs, "CELL", 9)
    sets = {k: {f"{'ab'[int(x[1:]) % 2]}{x}" if x != "all" else "call" for x in s} for k, s in _members(listed).items()}
    for s in sets.values():
        s |= {f"c{k:02}" for k in range(common)} if common > 1 else set()
    place = {k: (k * 37) % 70 for k in sets}
    frame = spark.createDataFrame(
        [(f"m{k}", x, place[k], f"about {k}") for k, s in sets.items() for x in s], "m string, k string, o int, a string",
    )
    got = pairs.first_shared(frame, "k", "m", ["a", "b", "c", "d"], order="o", about="a")
    least = lambda both, mark: min((x for x in both if x[0] == mark), default=None)
    want = {
        (f"m{a}", f"m{b}", f"about {a}", *(least(both, mark) for mark in "abcd"))
        for a in sets for b in sets if place[a] < place[b] and (both := sets[a] & sets[b])
    }
    rows = got.collect()
    assert len(rows) == len(want) and {(r.left, r.right, r.about, r.a, r.b, r.c, r.d) for r in rows} == want
    assert all(r.bits == sum(1 << x for x in range(4) if r["abcd"[x]]) for r in rows)
    ends = [(r.left, r.right) for r in sorted(rows, key=lambda r: r.pair)]
    assert ends == sorted(ends)


@pytest.mark.parametrize("listed", [0, 3])
def test_overlaps_of_long_lists(spark, monkeypatch, listed):
    monkeypatch.setattr(pairs, "LISTED", listed)
    sets = _members(listed + 1)
    rows = spark.createDataFrame([(m, x) for m, s in sets.items() for x in s], "m int, k string")
    got = pairs.overlaps(rows, "k", "m", least=2, sample=50).select("left", "right", "n", "sample")
    assert _rows(got) == sorted(
        (a, b, len(s), sorted(s)) for a in sets for b in sets if a < b and len(s := sets[a] & sets[b]) >= 2
    )


def test_cells_stay_in_their_tasks(spark):
    """Pairs are many more than the rows that meet, so tasks of few rows aren't put together."""
    rows = spark.range(400).selectExpr("id % 9 AS k", "id AS m")
    assert pairs.complete(rows, "k", "m").rdd.getNumPartitions() == 4


def test_places_as_given(spark):
    """Rows in order are numbered as they come, by no second sort."""
    frame = spark.range(900).selectExpr("(id * 7919) % 900 AS k", "'x' AS n").repartition(3).orderBy(F.desc("k"))
    got = places.given(frame, "n")
    assert sorted((r.n, r.k) for r in got.collect()) == [(i, 900 - i) for i in range(1, 901)]
    assert places.given(frame.limit(0), "n").collect() == []
