"""Terms and suffixes as tables, and hot keys, against plain ones."""

import random

import pytest
from pyspark.sql import functions as F

from domscope.functions import hosts, html, text
from domscope.functions import terms as t
from domscope.operators import matching, pairs


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_shipped_terms_equal_contains(spark, block):
    lists = {k: v for k, v in vars(t).items() if k.endswith(("_TERMS", "_MARKERS"))}
    rng = random.Random(2)
    every = [x for v in lists.values() for x in v]
    texts = [None, "", *(" ".join(rng.choices([*every, "no", "cas"], k=rng.randrange(12))) for _ in range(60))]
    frame = spark.createDataFrame([(x,) for x in texts], "t string")
    for terms in lists.values():
        find = matching.finder(spark.createDataFrame([(x, x) for x in terms], "key string, value string"), block_bytes=block)
        got = frame.select(F.size(find(F.col("t"))).alias("n"), text.term_hits(F.col("t"), terms).alias("m")).collect()
        assert all(r.n == r.m for r in got)


def test_ten_thousand_names(spark):
    rng = random.Random(3)
    names = sorted({"".join(rng.choices("abcdeé ", k=rng.randrange(3, 9))).strip() for _ in range(10_000)} - {""})
    texts = ["".join(rng.choices("abcdeé ", k=400)) for _ in range(40)]
    table = spark.createDataFrame([(n, n.upper()) for n in names] + [("", "x"), (None, "y"), ("abc", None)], "key string, value string")
    find = matching.finder(table, block_bytes=50_000)
    got = spark.createDataFrame([(x,) for x in texts], "t string").select("t", find(F.col("t")).alias("f")).collect()
    for r in got:
        assert sorted(r.f) == sorted(n.upper() for n in names if n in r.t)
    none = matching.finder(table.limit(0))
    assert spark.range(1).select(none(F.lit("abc")).alias("f")).first().f == []


def test_provider_mentions_by_table_equal_those_by_list(spark):
    pages = [("https://a.example/", "<title>x</title> Studio X and studio x, ÜBER gmbh"), ("https://b.example/", "nothing")]
    frame = html.parsed(spark.createDataFrame(pages, "url string, html string"))
    names = ["Studio X", "STUDIO X", "Über GmbH", "ab"]
    terms = spark.createDataFrame([(n,) for n in names], "value string").where("length(value) >= 3")
    find = matching.finder(terms.select(F.lower("value").alias("key"), "value"))
    frame, found = html.with_names(frame, "html", find, "names")
    made = frame.select(
        html.signals(F.col("page"), F.col("html"), found)["content"]["provider_mentions"].alias("a"),
        html.signals(F.col("page"), F.col("html"), sorted(names, key=lambda n: (n.lower(), n)))["content"]["provider_mentions"].alias("b"),
    ).collect()
    assert all(r.a == r.b for r in made) and any(r.a for r in made)


def test_many_suffixes(spark):
    rng = random.Random(4)
    label = lambda: "".join(rng.choices("abc", k=rng.randrange(1, 4)))
    suffixes = [".".join(label() for _ in range(rng.randrange(2, 4))) for _ in range(100_000)]
    names = [".".join(label() for _ in range(rng.randrange(1, 6))) for _ in range(500)] + [None, "", "a", ".", "x.", "zz.zz"]
    known = set(suffixes)
    frame = spark.createDataFrame([(k, h, 1) for k, h in enumerate(names)], "k int, h string, hit int")
    table = spark.createDataFrame([(s,) for s in [*suffixes, "", None]], "suffix string")
    got = matching.under_suffixes(frame, F.col("h"), table, "hit").orderBy("k").collect()
    plain = lambda h: h is not None and any(".".join(h.split(".")[i:]) in known for i in range(len(h.split("."))))
    assert [(r.k, r.hit) for r in got] == [(k, plain(h)) for k, h in enumerate(names)]
    few = suffixes[:20]
    small = matching.under_suffixes(frame, F.col("h"), spark.createDataFrame([(s,) for s in few], "suffix string"), "hit")
    both = small.withColumn("old", F.coalesce(hosts.suffix_matches(F.col("h"), few), F.lit(False))).collect()
    assert all(r.hit == r.old for r in both)


@pytest.mark.parametrize("cell", [3, 7, 2000])
def test_a_key_of_all_members(spark, monkeypatch, cell):
    monkeypatch.setattr(pairs, "CELL", cell)
    rng = random.Random(cell)
    rows = [("all", f"m{i:03}", rng.randrange(50)) for i in range(60)] + [(f"k{i % 9}", f"m{i:03}", i) for i in range(60)]
    frame = spark.createDataFrame([*rows, ("all", None, 1), (None, "m001", 1)], "key string, m string, o int")
    got = sorted(tuple(r) for r in pairs.shared_keys(frame, "key", "m", order="o").collect())
    want = sorted(
        (*(a, b), k) for k, a, x in rows for k2, b, y in rows if k == k2 and a != b and (x, a) < (y, b)
    )
    assert got == want
    left, right = pairs.cells(frame.where("key IS NOT NULL AND m IS NOT NULL"))
    for side in (left, right):
        most = side.groupBy("key", "i", "j").count().agg(F.max("count")).first()[0]
        assert most <= max(4 * cell, 12) if cell < 60 else most == 60
