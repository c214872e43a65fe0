"""MinHash near-dedup by a multi-index Hamming join, confirmed on full shingle sets.

1. Each document gets its set of 5-word shingles (64-bit hashes), a 128-bit digest of the set, and a
   signature of minhashes of 16 bits. Documents of equal sets form one class.
2. The signature is split into chunks. Two signatures that differ in at most ``distance`` symbols
   have, by the pigeonhole principle, a chunk with at most distance // chunks = 1 error, so they
   share a key among "chunk without one symbol" for all places of the symbol left out. ``SCHEMES``
   has the numbers by threshold: at Jaccard 0.85 a symbol differs with probability 0.15, and more
   than 17 of 40 differ about once in 100,000 pairs; at 0.8 more than 23 of 48 differ still less often.
3. In each bucket, members within the signature distance are linked by a spanning forest (never all
   pairs); the components of all forests are families. Any two linked documents are in one family.
4. Inside each family full sets are compared, and links with 100 * intersection >= threshold * union
   are kept, again as a spanning forest; their components are the result.

Buckets and families above ``TILE`` members, or ``TILE_BYTES`` of sets, are dealt to tiles, twice by
different hashes; what is then not in the group's largest component is compared with all its tiles, so
no link is missed and no task holds more than two tiles (a single set is never split). Groups are
planned on narrow (group, item) rows; signatures and sets join them by item, dealt to tiles already.

Defined results: a null or wordless text has an empty set and no links; repeated rows are linked as
equal sets; null ids take part, and a component's id is its smallest non-null doc_id (null if it has
none); an empty table gives an empty result. Other columns pass through ``keep_one``, whatever their
names, which leaves one row of each component. Rows are told apart by doc_id and 128 bits of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from .seeds import bucketed
from .storage import discard, partitions, written
from .vectext import LOWER, Words, buffers, chunks, gram_hash, mix, released, sliced

WORDS = 5
SYMBOLS = 40
CHUNKS = 9
DISTANCE = 17
TILE = 2048
TILE_BYTES = 8 << 20
#: Plans of at most so many groups are broadcast; more are joined by a shuffle.
MAX_BROADCAST = 100_000


class Scheme(NamedTuple):
    """Pairs of at least threshold per cent are linked; signatures of so many symbols, in chunks, at a distance."""

    threshold: int
    symbols: int
    chunks: int
    distance: int


SCHEMES = {x.threshold: x for x in (Scheme(85, SYMBOLS, CHUNKS, DISTANCE), Scheme(80, 48, 12, 23))}
MOST = max(x.symbols for x in SCHEMES.values())

_RNG = np.random.default_rng(90210)
_A = _RNG.integers(1, 1 << 62, SYMBOLS, dtype=np.uint64)
_B = _RNG.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64)
_A = np.concatenate([_A, _RNG.integers(1, 1 << 62, MOST - SYMBOLS, dtype=np.uint64)]) * np.uint64(2) + np.uint64(1)
_B = np.concatenate([_B, _RNG.integers(1, 1 << 63, MOST - SYMBOLS, dtype=np.uint64)])


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all documents in a row, offsets by document)."""
    n = len(off) - 1
    words = Words(LOWER[data], off)
    counts = words.counts
    wdoc = np.repeat(np.arange(n), counts)
    gram = gram_hash(words.hash, WORDS)
    at = np.flatnonzero(wdoc[: len(gram)] == wdoc[WORDS - 1 :]) if len(gram) else np.zeros(0, np.int64)
    doc, key = wdoc[at], gram[at]
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    if len(short):  # the whole sequence as one shingle
        own = [
            int(mix(np.array([hash_words(words.hash[words.doc[d] : words.doc[d + 1]])], np.uint64))[0]) for d in short
        ]
        doc, key = np.concatenate([doc, short]), np.concatenate([key, np.array(own, np.uint64)])
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    doc, key = doc[new], key[new]
    return key, np.searchsorted(doc, np.arange(n + 1))


def hash_words(hashes: np.ndarray) -> int:
    out = len(hashes)
    for h in hashes.tolist():
        out = (out * 0x9E3779B97F4A7C15 + h) & 0xFFFFFFFFFFFFFFFF
    return out


def signatures(key: np.ndarray, bounds: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """A row of uint16 symbols for each non-empty set (zeros for empty ones)."""
    n = len(bounds) - 1
    out = np.zeros((n, symbols), np.uint16)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        starts = bounds[:-1][full]
        for k in range(symbols):
            out[full, k] = (mix(np.minimum.reduceat(key * _A[k] + _B[k], starts)) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def places(scheme: Scheme = SCHEMES[85]) -> list[tuple[int, list[int]]]:
    """(chunk, symbols of a key): every chunk with each of its symbols left out."""
    out = []
    for c, chunk in enumerate(np.array_split(np.arange(scheme.symbols), scheme.chunks)):
        out += [(c, [int(x) for x in chunk if x != gone]) for gone in chunk]
    return out


def keys(sig: np.ndarray, scheme: Scheme = SCHEMES[85]) -> np.ndarray:
    """len(places(scheme)) 64-bit keys for each signature."""
    out = np.zeros((len(sig), scheme.symbols), np.uint64)
    for j, (_, at) in enumerate(places(scheme)):
        h = np.full(len(sig), j + 1, np.uint64)
        for s in at:
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, s].astype(np.uint64))
        out[:, j] = h
    return out


def _rids(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with r1 and r2, 128 bits of doc_id and text."""
    return docs.select(
        "doc_id",
        F.xxhash64("doc_id", "text").alias("r1"),
        F.xxhash64(F.lit(20240607), "doc_id", "text").alias("r2"),
        "text",
    )


def sketches(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """(doc_id, r1, r2, n, node, sig): node is the digest of the set, null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(3))
            for a, b in chunks(off):
                key, bounds = shingle_sets(data[off[a] : off[b]], off[a : b + 1] - off[a])
                cut = bounds.tolist()
                nodes = [
                    hashlib.blake2b(key[i:j].tobytes(), digest_size=16).hexdigest() if j > i else None
                    for i, j in zip(cut, cut[1:], strict=False)
                ]
                sigs = [x.tobytes() for x in signatures(key, bounds, scheme.symbols)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(a, b - a) for k in range(3)),
                        pa.array(np.diff(bounds)),
                        pa.array(nodes, pa.string()),
                        pa.array(sigs, pa.binary()),
                    ],
                    names=["doc_id", "r1", "r2", "n", "node", "sig"],
                )

    return _rids(docs).mapInArrow(released(run), "doc_id long, r1 long, r2 long, n long, node string, sig binary")


def _exploded(classes: DataFrame, scheme: Scheme) -> DataFrame:
    """(key, nid): a row for each symbol of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, scheme.symbols)
            for a in range(0, len(sig), 2000):
                k = keys(sig[a : a + 2000], scheme)
                nid = np.repeat(batch.column(0).to_numpy()[a : a + 2000], scheme.symbols)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k.reshape(-1).view(np.int64)), pa.array(nid)],
                    names=["key", "nid"],
                )

    return classes.select("nid", "sig").mapInArrow(released(run), "key long, nid long")


def _near_signature(sig: np.ndarray, n: np.ndarray, scheme: Scheme):
    def near(p: int, q: np.ndarray) -> np.ndarray:
        ok = 100 * np.minimum(n[q], n[p]) >= scheme.threshold * np.maximum(n[q], n[p])
        ok[ok] = (sig[q[ok]] != sig[p]).sum(axis=1) <= scheme.distance
        return ok

    return near


def _near_sets(items: list[bytes], threshold: int):
    """Exact test on full sets: entries of all sets in one array, by document."""
    size = np.fromiter(map(len, items), np.int64, len(items)) // 8
    flat = np.frombuffer(b"".join(items), np.uint64)
    distinct, local = np.unique(flat, return_inverse=True)
    first = np.cumsum(size) - size
    mine = np.zeros(len(distinct), bool)

    def near(p: int, q: np.ndarray) -> np.ndarray:
        own = local[first[p] : first[p] + size[p]]
        mine[own] = True
        ok = 100 * np.minimum(size[q], size[p]) >= threshold * np.maximum(size[q], size[p])
        at = q[ok]
        length = size[at]
        total = np.cumsum(length)
        hit = mine[local[np.arange(total[-1] if len(at) else 0) + np.repeat(first[at] - (total - length), length)]]
        both = np.add.reduceat(hit, total - length, dtype=np.int64) if len(at) else np.zeros(0, np.int64)
        ok[ok] = 100 * both >= threshold * (size[p] + length - both)
        mine[own] = False
        return ok

    return near


def forest(m: int, near) -> list[tuple[int, int]]:
    """A spanning forest of m items under near(item, others): breadth first over the items not reached yet."""
    out: list[tuple[int, int]] = []
    left = np.arange(m)
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            p = todo.pop()
            ok = near(p, left)
            got = left[ok].tolist()
            out += [(p, q) for q in got]
            todo += got
            left = left[~ok]
    return out


def across(component: np.ndarray, rest: np.ndarray, near) -> list[tuple[int, int]]:
    """Links of the items in rest with items of other components, one for each pair of item and component."""
    out = []
    every = np.arange(len(component))
    for p in np.flatnonzero(rest).tolist():
        q = every[component != component[p]]
        q = q[near(p, q)] if len(q) else q
        _, first = np.unique(component[q], return_index=True)
        out += [(p, int(x)) for x in q[first]]
    return out


#: Columns of a member that is dealt to a place of comparison.
PLACE = ("g", "group", "t", "u", "item", "n", "component", "rest")


def _linked(members: DataFrame, attached: Callable[[DataFrame], DataFrame], kind: str, scheme: Scheme) -> DataFrame:
    """(a, b): links between the items of each group that connect what is connected.

    members: group, item, n (the size of its set) and what attached needs. It gives rows that are dealt
    (PLACE, and what members have beside) their payload: sig for kind "signature", items for "sets".
    """
    n_parts = partitions(members.sparkSession)
    item = dict(members.dtypes)["item"]
    value = "sig" if kind == "signature" else "items"
    more = [c for c in members.columns if c not in PLACE]

    def compare(t: pa.Table) -> pa.RecordBatch:
        names = ["group", "t", "u"]
        mark = t.select(names).to_pandas()
        cut = np.flatnonzero((mark.values[1:] != mark.values[:-1]).any(axis=1)) + 1
        bounds = [0, *cut.tolist(), t.num_rows]
        items = t["item"].combine_chunks()
        comp, rest = t["component"].to_numpy(), t["rest"].to_numpy()
        blobs = t[value].to_pylist()
        n = t["n"].to_numpy()
        a, b = [], []
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            if hi - lo < 2:
                continue
            if kind == "signature":
                near = _near_signature(
                    np.frombuffer(b"".join(blobs[lo:hi]), np.uint16).reshape(-1, scheme.symbols),
                    n[lo:hi],
                    scheme,
                )
            else:
                near = _near_sets(blobs[lo:hi], scheme.threshold)
            got = (
                forest(hi - lo, near)
                if rest[lo] is None or np.isnan(rest[lo])
                else across(comp[lo:hi], rest[lo:hi] > 0, near)
            )
            a += [lo + x for x, _ in got]
            b += [lo + x for _, x in got]
        return pa.RecordBatch.from_arrays(
            [items.take(pa.array(a, pa.int64())), items.take(pa.array(b, pa.int64()))],
            names=["a", "b"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in bucketed(batches, 0):
            yield compare(t)

    def compared(dealt: DataFrame) -> DataFrame:
        dealt = attached(
            dealt.withColumn("g", F.xxhash64("group", "t", "u")).select(*PLACE, *more)
        ).select(*PLACE, value)
        return dealt.repartition(n_parts, "g").sortWithinPartitions("g", "group", "t", "u").mapInArrow(
            released(run), f"a {item}, b {item}",
        )

    each = F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n") * 8 / TILE_BYTES) if kind == "sets" else F.lit(1))
    size = members.groupBy("group").agg(each.cast("int").alias("tiles")).where("tiles > 1")
    large = size.count()
    # One narrow row for each large group: sent to all tasks, so that no task gathers a group.
    of_group = lambda df: F.broadcast(df) if large <= MAX_BROADCAST else df
    rows = (
        members.join(of_group(size), "group", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
        if large
        else members.withColumn("tiles", F.lit(1))
    )
    tile = lambda salt: F.pmod(F.xxhash64("item", F.lit(salt)), F.col("tiles")).cast("int")
    plain = rows.withColumns(
        {"component": F.lit(0).cast("long"), "rest": F.lit(None).cast("double"), "t": tile(1), "u": F.lit(-1)}
    )
    if not large:
        return written(compared(plain))
    second = plain.where("tiles > 1").withColumns({"t": tile(2), "u": F.lit(-2)})
    links = written(compared(plain.unionByName(second)))
    joined = components(links, "a", "b")
    found = joined.select(F.col("node").alias("item"), F.xxhash64("component").alias("component"))
    big = rows.where("tiles > 1").join(found, "item", "left").withColumn(
        "component",
        F.coalesce("component", F.xxhash64("item")),
    )
    main = big.groupBy("group", "component").agg(F.count("*").alias("c")).groupBy("group").agg(
        F.max_by("component", F.struct("c", "component")).alias("main")
    )
    split = written(
        big.join(of_group(main), "group")
        .withColumn("rest", (F.col("component") != F.col("main")).cast("double"))
        .withColumn("t", tile(1)),
        joined,
    )
    parts = F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n") * 8 / TILE_BYTES) if kind == "sets" else F.lit(1))
    few = split.where("rest > 0").groupBy("group").agg(parts.cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("item", F.lit(3)), F.col("parts")).cast("int")
    sides = split.join(of_group(few), "group")
    left = sides.where("rest > 0").withColumn("u", own).withColumn(
        "t",
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)),
    )
    # A rest item meets its own tile as a rest item already; it goes there once.
    right = sides.withColumn(
        "u",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)),
    ).where(~((F.col("rest") > 0) & (F.col("u") == own)))
    right = right.withColumn("rest", F.lit(0.0))
    names = [*PLACE[1:], *more]
    return written(links.unionByName(compared(left.select(*names).unionByName(right.select(*names)))), links, split)


def _with_sets(docs: DataFrame, dealt: DataFrame) -> DataFrame:
    """dealt (PLACE, r1 and r2 of a class's representative row) with ``items``, the full sets.

    Of equal rows one is read, so each place gets one text however many copies its representative has; texts are
    dealt by the key of the join.
    """
    kind = dict(dealt.dtypes)["group"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, 1):
                key, bounds = shingle_sets(*buffers(part.column(1)))
                cut = bounds.tolist()
                items = [key[i:j].tobytes() for i, j in zip(cut, cut[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *part.columns[2:], pa.array(items, pa.binary())],
                    names=[*PLACE, "items"],
                )

    texts = _rids(docs).groupBy("r1", "r2").agg(F.first("text").alias("text"))
    joined = texts.join(dealt.hint("merge"), ["r1", "r2"]).select("g", "text", *PLACE[1:])
    return joined.mapInArrow(
        released(run),
        f"g long, group {kind}, t int, u int, item {dict(dealt.dtypes)['item']}, n long, component long, rest double, items binary",
    )


def dedup(docs: DataFrame, threshold: int = 85) -> DataFrame:
    """(doc_id, r1, r2, n_shingles, component_id, kept), one row for each row of docs (doc_id, text).

    threshold: per cent of similarity from which two documents are linked, one of SCHEMES.
    """
    return _grouped(docs, threshold).drop("component")


def _grouped(docs: DataFrame, threshold: int) -> DataFrame:
    """(doc_id, r1, r2, n_shingles, component_id, kept, component) for each row of docs; component is the
    name of the row's group, null for an empty set."""
    scheme = SCHEMES[threshold]
    rows = written(sketches(docs, scheme))
    rep = F.min(F.struct("r1", "r2"))
    classes = written(
        rows.where("n > 0")
        .groupBy("node")
        .agg(F.min("n").alias("n"), F.first("sig").alias("sig"), rep.alias("rep"), F.min("doc_id").alias("least"))
        .withColumn("nid", F.conv(F.substring("node", 1, 15), 16, 10).cast("long"))
    )
    table = _exploded(classes, scheme)
    many = table.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    # Classes that share a nid by chance are members of each other's buckets, which costs a comparison.
    buckets = written(
        table.join(many, "key")
        .join(classes.select("nid", "node", "n"), "nid")
        .select(F.col("key").alias("group"), F.col("node").alias("item"), "n")
    )
    links = _linked(
        buckets,
        lambda dealt: dealt.join(classes.select(F.col("node").alias("item"), "sig"), "item"),
        "signature",
        scheme,
    )
    near = components(links, "a", "b")
    family = written(
        near.join(classes, "node").select(F.col("component").alias("group"), F.col("node").alias("item"), "n", "rep.*"),
        near,
        links,
        buckets,
    )
    links = _linked(family, lambda dealt: _with_sets(docs, dealt), "sets", scheme)
    discard(family)
    found = components(links, "a", "b")
    # The smallest doc_id of each component, by way of its classes.
    joined = written(
        classes.select("node", "least")
        .join(found, "node", "left")
        .withColumn("component", F.coalesce("component", "node")),
        found,
        links,
        classes,
    )
    ids = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = joined.select("node", "component").join(ids, "component").select(
        F.col("node").alias("of"), "component", "component_id",
    )
    # An empty set joins nothing: a key of its own keeps such rows apart.
    own = F.coalesce("node", F.concat(F.lit("-"), F.col("r1").cast("string")))
    out = rows.withColumn("own", own).join(of_node, F.col("own") == F.col("of"), "left")
    id_ = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        "r1",
        "r2",
        F.col("n").alias("n_shingles"),
        id_.alias("component_id"),
        F.col("doc_id").eqNullSafe(id_).alias("kept"),
        "component",
    )


def keep_one(docs: DataFrame, threshold: int = 85) -> DataFrame:
    """One row of each group of near-duplicates stays, one with the smallest doc_id (null last); all rows
    without words stay. Of rows with equal ids and texts any may be the one."""
    rows = _grouped(docs.select("doc_id", "text"), threshold)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "r1", "r2"))
    one = rows.where("n_shingles > 0").groupBy("component").agg(first.alias("first")).select(
        "first.r1", "first.r2", F.lit(True).alias("full"),
    )
    bare = rows.where("n_shingles = 0").select("r1", "r2", F.lit(False).alias("full")).distinct()
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", "text")
    keys = (F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64(F.lit(20240607), "doc_id", "text").alias("r2"))
    out = packed.select("row", *keys).join(one.unionByName(bare), ["r1", "r2"])
    full = out.where("full").groupBy("r1", "r2").agg(F.first("row").alias("row"))
    return full.select("row.*").unionByName(out.where("not full").select("row.*"))
