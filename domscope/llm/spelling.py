"""Spelling variants: words at edit distance one, grouped under their most frequent form.

``words`` counts the words of all texts with Spark's own functions. Two words are near if they differ by
one inserted, deleted or replaced code point. Then one of the two halves of the longer word (of either, if
they are equally long) lies whole in the other, the first half at its beginning or the second half at its
end. ``near`` holds every word's halves in automata (Aho-Corasick), runs all words through them, takes the
matches whose place and length fit, and verifies the rest of the two words.

A shard is an automaton with its words: one for first halves that begin with some pairs of letters, one for
second halves that end with some, since a word can only meet halves with its own first or last two. There
are at most 8,100 such pairs, so counts of them are planned on the driver; pairs are packed up to
``SHARD`` code points. A pair with more words is dealt to a grid of p by p shards, each with one part of
the halves and one part of the words scanned, so that a shard stays that small. Near words are counted and
compared in the shard; only each word's count and best leave it.

``forms`` follows forms by doubling steps; n doubles with each form, so chains are short.

Defined results: null, empty and wordless texts have no words; a null id is an empty one in the checksum;
repeated rows count again; an empty table gives an empty result; extra columns are not carried. A text is
never split, nor is a word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import discard, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words after lower-casing.
WORD = "[a-zÀ-ÿ]+"
#: Code points of the words of a shard.
SHARD = 250_000
#: Outer code points of a half that the automaton holds; those further in are compared. A long half of few
#: letters would make the automaton's steps back as long as itself.
SEGMENT = 64
#: Comparisons of one code point that are made at a time.
TILE = 1 << 22
#: Near pairs that a shard holds before it counts them.
PAIRS = 1 << 20


def _checked(run: Column, doc_id: Column) -> Column:
    """The run without one code point, if 97 divides its checksum in this document."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % 97 == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def words(docs: DataFrame, *, least: int = 3, length: int = 5) -> DataFrame:
    """(word, n) of words of ``length`` code points or more that occur ``least`` times or more."""
    runs = docs.select(
        "doc_id", F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORD), F.lit(0))).alias("run"),
    )
    found = runs.select(_checked(F.col("run"), F.col("doc_id")).alias("word")).where(F.length("word") >= length)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def plan(counts: list[tuple[int, str, int]], shard: int) -> list[tuple[int, str, int, int]]:
    """(kind, letters, first shard, parts) from (kind, letters, code points): letters share a shard while
    they fit; those that don't fit in one have parts * parts shards of their own."""
    out, next_, room, last = [], 0, 0, None
    for kind, letters, size in sorted(counts):
        parts = -(-size // shard)
        if parts == 1 and kind == last and size <= room:
            out.append((kind, letters, next_ - 1, 1))
            room -= size
        else:
            out.append((kind, letters, next_, parts))
            next_ += parts * parts
            room, last = (shard - size, kind) if parts == 1 else (0, None)
    return out


def sharded(vocabulary: DataFrame, shard: int) -> DataFrame:
    """(shard, kind, role, word, n); role 0: halves and word, 1: halves, 2: word."""
    keyed = vocabulary.select(
        "word",
        "n",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("kind"), F.substring("word", 1, 2).alias("letters")),
                F.struct(F.lit(1).alias("kind"), F.substring("word", -2, 2).alias("letters")),
            )
        ).alias("k"),
    ).select("word", "n", "k.kind", "k.letters")
    counts = keyed.groupBy("kind", "letters").agg(F.sum(F.length("word")).alias("size")).collect()  # 2 * 90 * 90 at most
    planned = plan([tuple(r) for r in counts], shard)
    table = vocabulary.sparkSession.createDataFrame(planned, "kind int, letters string, first int, parts int")
    dealt = keyed.join(F.broadcast(table), ["kind", "letters"]).withColumn(
        "part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    )
    places = F.expr(
        """flatten(array(
             transform(sequence(0, parts - 1), j -> struct(first + part * parts + j AS shard, if(j = part, 0, 1) AS role)),
             transform(filter(sequence(0, parts - 1), i -> i <> part), i -> struct(first + i * parts + part AS shard, 2 AS role))))"""
    )
    rows = dealt.select("kind", "word", "n", F.explode(places).alias("p"))
    return rows.select("p.shard", "kind", "p.role", "word", "n")


def _one_less(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row of a and each of b, one shorter: whether deleting one code point of a gives b."""
    width = b.shape[1]
    before = np.logical_and.accumulate(a[:, None, :width] == b[None], axis=2).sum(axis=2)
    after = np.logical_and.accumulate((a[:, None, 1:] == b[None])[:, :, ::-1], axis=2).sum(axis=2)
    return before + after >= width


def scan(kind: int, halves: list[bytes], scanned: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(difference of lengths, places in halves, places in scanned) of near pairs: the word of halves is as
    long (0) or longer by one (1). A pair comes once from its two halves; of equally long words each comes
    as word of halves once, if it is in both lists."""
    if not halves:
        return
    owners: dict[bytes, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
    for i, word in enumerate(halves):
        h = len(word) // 2
        owners[word[:h] if kind == 0 else word[h:]][len(word)].append(i)
    outer = (lambda w: w[:SEGMENT]) if kind == 0 else (lambda w: w[-SEGMENT:])
    segments: dict[bytes, list[bytes]] = defaultdict(list)
    for half in owners:
        segments[outer(half)].append(half)
    automaton = ahocorasick.Automaton()
    for segment in segments:
        automaton.add_word(segment.decode("latin-1"), segment)
    automaton.make_automaton()
    met: dict[tuple[bytes, int, int], list[int]] = defaultdict(list)
    for i, word in enumerate(scanned):
        piece = outer(word).decode("latin-1")
        for end, segment in automaton.iter(piece):
            if (end + 1 == len(segment)) if kind == 0 else (end + 1 == len(piece)):
                for half in segments[segment]:
                    if len(half) > SEGMENT and not (word.startswith(half) if kind == 0 else word.endswith(half)):
                        continue
                    for more in (0, 1):
                        if len(word) + more in owners[half]:
                            met[half, len(word) + more, more].append(i)
    matrix = lambda of: np.frombuffer(b"".join(of), np.uint8).reshape(len(of), -1)
    for (half, length, more), others in met.items():
        own = owners[half][length]
        a, b = matrix([halves[i] for i in own]), matrix([scanned[i] for i in others])
        h = length // 2
        rest = (slice(h, None), slice(h, None)) if kind == 0 else (slice(0, h), slice(0, h - more))
        step = max(1, int((TILE // length) ** 0.5))
        for x in range(0, len(a), step):
            for y in range(0, len(b), step):
                p, q = a[x : x + step], b[y : y + step]
                if more:
                    hit = _one_less(p[:, rest[0]], q[:, rest[1]])
                    if kind == 1 and hit.any():  # those with the first half were met by it
                        hit &= ~(p[:, None, :h] == q[None, :, :h]).all(axis=2)
                else:
                    hit = (p[:, None, rest[0]] != q[None, :, rest[1]]).sum(axis=2) == 1
                i, j = np.nonzero(hit)
                if len(i):
                    yield more, np.array(own)[x + i], np.array(others)[y + j]


class _Best:
    """Number of near words of each word, and the best of them."""

    def __init__(self, text: list[bytes], n: np.ndarray):
        self.n = n
        self.order = np.empty(len(text), np.int64)
        self.order[np.array(sorted(range(len(text)), key=text.__getitem__), np.int64)] = np.arange(len(text))
        self.count = np.zeros(len(text), np.int64)
        self.best = np.full(len(text), -1)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, word: np.ndarray, near: np.ndarray) -> None:
        self.held.append((word, near))
        self.size += len(word)
        if self.size >= PAIRS:
            self.fold()

    def fold(self) -> None:
        if not self.held:
            return
        word, near = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.count += np.bincount(word, minlength=len(self.count))
        had = np.flatnonzero(self.best >= 0)
        word, near = np.concatenate([word, had]), np.concatenate([near, self.best[had]])
        order = np.lexsort((self.order[near], -self.n[near], word))
        first = order[np.flatnonzero(np.diff(word[order], prepend=-1))]
        self.best[word[first]] = near[first]
        self.held, self.size = [], 0


def _near_of_shard(rows: pa.Table) -> pa.Table:
    kind, role = rows.column("kind")[0].as_py(), rows.column("role").to_numpy()
    text = [w.encode("latin-1") for w in rows.column("word").to_pylist()]
    n = rows.column("n").to_numpy()
    best = _Best(text, n)
    halves, scanned = np.flatnonzero(role != 2), np.flatnonzero(role != 1)
    for more, a, b in scan(kind, [text[i] for i in halves], [text[i] for i in scanned]):
        best.add(scanned[b], halves[a])
        if more:
            best.add(halves[a], scanned[b])
    best.fold()
    some = np.flatnonzero(best.count)
    form = best.best[some]
    word = rows.column("word").combine_chunks()
    return pa.table(
        {"word": word.take(pa.array(some)), "n_near": best.count[some], "n": n[form], "form": word.take(pa.array(form))}
    )


def near(vocabulary: DataFrame, *, shard: int = SHARD) -> DataFrame:
    """(word, n_near, best: struct<n, word>) of each word of (word, n) with a near word; best is the near
    word of largest n, the smallest of several."""
    found = sharded(vocabulary, shard).groupBy("shard").applyInArrow(_near_of_shard, "word string, n_near long, n long, form string")
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("form").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.struct((-F.col("best.n")).alias("n"), F.col("best.word").alias("word")).alias("best"),
    )


def forms(vocabulary: DataFrame, *, shard: int = SHARD) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of (word, n)."""
    joined = vocabulary.join(near(vocabulary, shard=shard), "word", "left")
    more = F.col("best.n") >= 2 * F.col("n")
    rows = written(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(more, F.col("best.word")).alias("form"),
            F.when(more, F.col("best.n")).alias("form_n"),
        )
    )
    # Roots of the words that have a form: each step doubles the number of forms followed.
    links = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    roots = None
    while True:
        step = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = written(
            links.join(step, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"),
            ),
            *([roots] if roots is not None else []),
        )
        roots, links = after, after.select("word", "root")
        if not after.where("moved").limit(1).count():
            break
    out = rows.join(links, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"),
    )
    return written(out, rows, roots)


def variants(docs: DataFrame) -> DataFrame:
    """``forms`` of the words of (doc_id, text)."""
    vocabulary = written(words(docs))
    out = forms(vocabulary)
    discard(vocabulary)
    return out
