"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is dealt by hash into at most ``BLOCKS`` blocks. A source with target t and size s is
taken whole t // s times; the rest comes from its blocks in a keyed random order, block by block while
they fit. What is left then comes from one block that did not fit (the one with the most rows): from
its own blocks in the same way, and in the last of these text by text, as many copies of a text as fit,
with one more if that brings the sum nearer. So a source misses its target by at most half of a text
(half of its smallest one left out, where all its blocks are single texts).

Block draws, one for each pass over a block, are dealt to the output shards by a splitting tree: at
each node the exact per-source draw quotas split between the two halves by the multivariate
hypergeometric law, so shards hold disjoint draws of permuted blocks and each shard sees sources as a
uniform random deal would give them. ``taken`` is what the draws that the tree dealt hold. Within a shard
rows come in keyed random order.

Everything random is keyed by hashes of contents and the seed, so reruns agree whatever the
partitioning; of equal rows any may be the ones taken. Documents are written once with their size and
all later steps read narrow columns of that table. No step holds a source in one task: sizes are summed
by (source, block), a plan has at most ``BLOCKS`` rows, texts are ordered one by one only in a
BLOCKS-squared part of a source, equal rows are one row there, and if a text is taken in part its copies
are numbered in ``BLOCKS`` parts.

Defined results: a null text has size 0; null sources come last; a document of size 0 is taken
0 words; repeated rows count each, and some of them may be taken more often than others; an empty table
gives an empty result; if every size is 0, all targets are 0. Extra columns pass through whatever their
names; clashing result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .storage import written
from .vectext import Words, buffers, chunks, released

BLOCKS = 1024
CAP = 3
SHARDS = 16
#: Sources are planned on the driver, one small row each; more are refused.
MAX_SOURCES = 1_000_000
#: Tables of at most so many narrow rows are broadcast; larger ones are joined by a shuffle.
MAX_BROADCAST = 100_000
RESULTS = ("size", "source_size", "target", "taken", "draws")


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with ``size``: the number of words of the text."""
    kept = docs.drop("size")
    schema = T.StructType([*kept.schema.fields, T.StructField("size", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(batch.schema.get_field_index(text)))
            got = [Words(data[off[a] : off[b]], off[a : b + 1] - off[a], hashed=False).counts for a, b in chunks(off)]
            made = pa.array(np.concatenate(got).astype(np.int64) if got else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, "size"])

    return kept.mapInArrow(released(run), schema)


def targets(
    source_sizes: list[tuple[str | None, int]],
    weights: tuple[float, ...] = (1, 2, 3),
    cap: float = CAP,
) -> dict[str | None, float]:
    """The target of each source: weights repeat over the sources by code point, null last; no target
    is above cap times its source, and what is cut off is shared again by weight."""
    order = sorted(source_sizes, key=lambda x: (x[0] is None, x[0] or ""))
    w = {s: float(weights[k % len(weights)]) for k, (s, _) in enumerate(order)}
    n = dict(order)
    total = float(sum(n.values()))
    full: set[str | None] = set()
    while True:
        open_ = [s for s in w if s not in full]
        rest = total - sum(cap * n[s] for s in full)
        share = sum(w[s] for s in open_)
        over = [s for s in open_ if rest * w[s] / share > cap * n[s]]
        if not over:
            return {s: float(cap * n[s]) if s in full else rest * w[s] / share for s in w}
        full.update(over)


def split_tree(quota: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Rows: shards; columns: sources. Each half of the shards draws its share of all draws without
    replacement (multivariate hypergeometric), down to single shards."""
    out = np.zeros((shards, len(quota)), np.int64)

    def go(first: int, last: int, left: np.ndarray) -> None:
        if last - first == 1:
            out[first] = left
            return
        mid = (first + last) // 2
        take = int(round(int(left.sum()) * (mid - first) / (last - first)))
        half = rng.multivariate_hypergeometric(left, take, method="marginals")
        go(first, mid, half)
        go(mid, last, left - half)

    go(0, shards, quota.astype(np.int64))
    return out


def fill(words: np.ndarray, copies: np.ndarray, rest: int) -> tuple[np.ndarray, int]:
    """(copies taken of each item, words still wanted): items in order, as many copies of each as fit."""
    taken = np.zeros(len(words), np.int64)
    for k, (w, m) in enumerate(zip(words.tolist(), copies.tolist(), strict=True)):
        if 0 < w <= rest:
            taken[k] = min(m, rest // w)
            rest -= int(taken[k]) * w
    return taken, rest


def nearest(words: np.ndarray, copies: np.ndarray, taken: np.ndarray, rest: int) -> np.ndarray:
    """taken with one more copy of the smallest item left, if the sum comes nearer to what is wanted."""
    left = np.flatnonzero((taken < copies) & (words > 0))
    if rest > 0 and len(left):
        k = left[np.argmin(words[left])]
        if words[k] < 2 * rest:
            taken = taken.copy()
            taken[k] += 1
    return taken


def fill_blocks(
    words: np.ndarray, rows: np.ndarray, rest: int, rng: np.random.Generator,
) -> tuple[np.ndarray, int, int]:
    """(1 for each block taken, the block to go on in or -1, what is wanted of it)."""
    order = rng.permutation(len(words))
    taken = np.zeros(len(words), np.int64)
    one = np.ones(len(words), np.int64)
    taken[order], rest = fill(words[order], one, rest)
    left = np.flatnonzero((taken == 0) & (rows > 1) & (words > 0))
    if rest > 0 and len(left):
        return taken, int(left[np.argmax(rows[left])]), rest
    return nearest(words, one, taken, rest), -1, 0


def mix(docs: DataFrame, *, text: str = "text", shards: int = SHARDS, **options) -> DataFrame:
    """docs with size, source_size, target, taken, and ``draws array<struct<shard int, place long>>``:
    one element for each time the document is drawn, with its shard and random place there."""
    return mix_sized(sizes(docs, text), "doc_id", text, shards=shards, **options)


def mix_sized(
    docs: DataFrame,
    *key: str,
    without: tuple[str, ...] = (),
    weights: tuple[float, ...] = (1, 2, 3),
    cap: int = CAP,
    shards: int = SHARDS,
    seed: int = 17,
) -> DataFrame:
    """mix for documents with ``size``; the random order is keyed by the columns key; those named in
    without are not carried on."""
    spark = docs.sparkSession
    carried = [c for c in docs.columns if c not in RESULTS and c not in without]
    base = written(
        docs.select(
            F.struct(*(F.col(f"`{c}`") for c in carried)).alias("row"),
            F.col("source").alias("s"),
            "size",
            F.xxhash64(F.lit(seed), *key).alias("k"),
            F.monotonically_increasing_id().alias("rid"),
        )
    )
    bits = lambda k, shift: F.pmod(F.shiftrightunsigned(k, shift), F.lit(BLOCKS)).cast("int")
    block, sub = bits(F.col("k"), 54), bits(F.col("k"), 44)
    blocks = written(base.groupBy("s", block.alias("b")).agg(F.sum("size").alias("words"), F.count("*").alias("rows")))
    found = blocks.groupBy("s").agg(F.sum("words").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    want = targets([(r["s"], r["n"]) for r in found], weights, cap)
    order = {s: k for k, s in enumerate(sorted(want, key=lambda x: (x is None, x or "")))}
    few = lambda df, rows: F.broadcast(df) if rows <= MAX_BROADCAST else df
    goal = spark.createDataFrame(
        [(s, int(n), want[s], order[s]) for s, n in found] or [],
        "source_ string, source_size long, target double, number int",
    )
    numbered = blocks.join(few(goal, len(found)), F.col("s").eqNullSafe(F.col("source_"))).drop("s", "source_")

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of one source: passes over each block, and what is wanted of the block to go on in."""
        pdf = pdf.sort_values("b", ignore_index=True)
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        whole = min(cap, int(target // size)) if size else 0
        rest = max(0, round(target - whole * size)) if size and whole < cap else 0
        rng = np.random.default_rng([seed, int(pdf["number"].iloc[0])])
        more, at, wanted = fill_blocks(pdf["words"].to_numpy(), pdf["rows"].to_numpy(), rest, rng)
        edge = np.where(np.arange(len(pdf)) == at, wanted, 0)
        return pdf[["number", "b", "source_size", "target"]].assign(passes=(whole + more).astype("int32"), edge=edge)

    planned = written(
        numbered.groupBy("number").applyInPandas(
            plan,
            "number int, b int, source_size long, target double, passes int, edge long",
        )
    )
    quota = planned.groupBy("number").agg(F.sum(F.col("passes") + (F.col("edge") > 0).cast("int")).alias("n")).collect()
    counts = np.zeros(len(order), np.int64)
    for r in quota:
        counts[r["number"]] = r["n"]
    deal = split_tree(counts, shards, np.random.default_rng(seed)) if len(order) else np.zeros((shards, 0), np.int64)
    dealt = spark.createDataFrame(
        [(int(k), deal[:, k].tolist()) for k in range(len(order))],
        "number int, quota array<long>",
    )

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        """The shards of each block's draws (at most (cap + 1) * BLOCKS draws of one source)."""
        pdf = pdf.sort_values("b", ignore_index=True)
        n = (pdf["passes"] + (pdf["edge"] > 0)).to_numpy()
        rng = np.random.default_rng([seed, 1, int(pdf["number"].iloc[0])])
        shard = rng.permutation(np.repeat(np.arange(shards), pdf["quota"].iloc[0]))
        parts = np.split(shard, np.cumsum(n)[:-1])
        return pdf.drop(columns="quota").assign(shards=[x.tolist() for x in parts])

    drawn = written(
        planned.join(few(dealt, len(order)), "number")
        .groupBy("number")
        .applyInPandas(
            assign,
            "number int, b int, source_size long, target double, passes int, edge long, shards array<int>",
        )
        .join(few(goal.select("source_", "number"), len(found)), "number")
    )
    plans = few(drawn.withColumnRenamed("b", "block"), len(order) * BLOCKS)
    rows = base.withColumn("c", sub).join(plans, F.col("s").eqNullSafe(F.col("source_")) & (block == F.col("block")))
    texts = written(_texts(rows.where("edge > 0").select("number", "c", "k", "size", "edge", "rid"), seed))
    n_texts = texts.count()
    chosen = texts.where("some is null").select("number", "k", "size", F.lit(1).alias("all"))
    some = texts.where("some is not null").select(F.col("some").alias("rid"), F.lit(1).alias("one"))
    rows = rows.join(few(chosen, n_texts), ["number", "k", "size"], "left").join(few(some, n_texts), "rid", "left")
    times = F.col("passes") + F.when(F.col("edge") > 0, F.coalesce("all", "one", F.lit(0))).otherwise(0)
    place = lambda k: F.xxhash64(F.lit(seed + 2), "k", k)
    draws = F.transform(
        F.slice("shards", F.lit(1), times),
        lambda s, i: F.struct(s.alias("shard"), place(i).alias("place")),
    )
    out = rows.select("row", "size", "source_size", "target", draws.alias("draws"))
    taken = (F.col("size") * F.size("draws")).cast("long")
    return out.select("row.*", "size", "source_size", "target", taken.alias("taken"), "draws")


def _texts(rows: DataFrame, seed: int) -> DataFrame:
    """(number, k, size, some): the texts of the edge blocks that are drawn once more; ``some`` is null if
    all copies are, else the rid of one that is. rows: number, c, k, size, edge, rid."""

    def parts(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of one edge block: its own blocks that are taken, and what is wanted of the one to go on in."""
        pdf = pdf.sort_values("c", ignore_index=True)
        rng = np.random.default_rng([seed, 3, int(pdf["number"].iloc[0])])
        more, at, wanted = fill_blocks(pdf["words"].to_numpy(), pdf["rows"].to_numpy(), int(pdf["edge"].iloc[0]), rng)
        return pdf[["number", "c"]].assign(
            whole=more.astype("int32"),
            wanted=np.where(np.arange(len(pdf)) == at, wanted, 0),
        )

    def last(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of the last block: copies of each text, in the order of their keys."""
        pdf = pdf.sort_values(["k", "size"], ignore_index=True)
        words, copies = pdf["size"].to_numpy(), pdf["m"].to_numpy()
        took, rest = fill(words, copies, int(pdf["wanted"].iloc[0]))
        return pdf[["number", "k", "size", "m"]].assign(e=nearest(words, copies, took, rest))

    by_part = rows.groupBy("number", "c").agg(
        F.sum("size").alias("words"), F.count("*").alias("rows"), F.first("edge").alias("edge"),
    )
    planned = written(by_part.groupBy("number").applyInPandas(parts, "number int, c int, whole int, wanted long"))
    whole = rows.join(planned.where("whole > 0"), ["number", "c"], "left_semi").select("number", "k", "size").distinct()
    inside = rows.join(planned.where("wanted > 0").select("number", "c", "wanted"), ["number", "c"])
    units = inside.groupBy("number", "k", "size").agg(F.count("*").alias("m"), F.first("wanted").alias("wanted"))
    units = written(
        units.groupBy("number").applyInPandas(last, "number int, k long, size long, m long, e long").where("e > 0")
    )
    full = units.where("e = m").select("number", "k", "size")
    # Of a text taken in part the first e copies by rid, numbered in BLOCKS parts.
    copies = inside.join(
        units.where("e < m"), ["number", "k", "size"],
    ).select("number", "k", "size", "e", "rid").withColumn("p", F.pmod(F.xxhash64("rid"), F.lit(BLOCKS)))
    unit = ["number", "k", "size"]
    counts = copies.groupBy(*unit, "p").agg(F.count("*").alias("n"))
    before = counts.select(
        *unit,
        "p",
        F.coalesce(
            F.sum("n").over(W.partitionBy(*unit).orderBy("p").rowsBetween(W.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("before"),
    )
    ranked = copies.join(before, [*unit, "p"]).withColumn(
        "r",
        F.col("before") + F.row_number().over(W.partitionBy(*unit, "p").orderBy("rid")),
    )
    none: Column = F.lit(None).cast("long")
    every = whole.unionByName(full).withColumn("some", none)
    return every.unionByName(ranked.where("r <= e").select(*unit, F.col("rid").alias("some")))


def rows_of(mixed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row for each draw: a partition is a shard, with its rows in random order."""
    one = mixed.select(
        F.struct(*(F.col(f"`{c}`") for c in mixed.columns if c != "draws")).alias("row"),
        F.inline("draws"),
    )
    return one.repartitionById(shards, F.col("shard")).sortWithinPartitions("place").select("row.*")
