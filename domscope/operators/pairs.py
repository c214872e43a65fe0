"""Pairs by shared keys: inverted-index equi self-joins instead of nested loops.

A key shared by n members makes n² pairs, because the result lists each pair; ``max_members`` leaves
out keys with more members and is off by default. The members of a key with more than ``CELL`` are dealt
to blocks, and each two blocks meet in a cell of their own, so no task joins more than two blocks of a
key. Where pairs must share several keys (``overlaps``), common keys are looked at last: see there.

What a pair shares altogether (``shared_lists``, ``overlaps``) is told where the pair meets: members travel
with their lists of keys, and of the keys that a pair shares the first alone emits it. No pair is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import partitions, written
from . import places

#: Members of a key in one block.
CELL = 2000
#: Keys of a member that travel with each of its keys; pairs of a member with more are grouped by a shuffle.
LISTED = 100


def cells(one: DataFrame, *carried: str) -> tuple[DataFrame, DataFrame]:
    """(left, right) sides of (key, m, o), each member with the cells (i, j), i <= j, of its key in which it is
    on this side. In the cell the members of block i meet those of block j. Carried columns come along, their
    names behind the side's."""
    hot = one.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > CELL)
    # A row for each CELL members at most, so it is broadcast while it is small and joined by key beyond.
    blocks = hot.select("key", F.ceil(F.col("c") / CELL).cast("int").alias("p"))
    dealt = one.join(blocks, "key", "left").withColumn("p", F.coalesce("p", F.lit(1)))
    dealt = dealt.withColumn("k", F.pmod(F.xxhash64("m"), F.col("p")).cast("int"))
    left = dealt.select(
        "key", F.col("m").alias("left"), F.col("o").alias("lo"), F.col("k").alias("i"),
        F.explode(F.sequence("k", F.col("p") - 1)).alias("j"), *(F.col(c).alias(f"left_{c}") for c in carried),
    )
    right = dealt.select(
        "key", F.col("m").alias("right"), F.col("o").alias("ro"),
        F.explode(F.sequence(F.lit(0), F.col("k"))).alias("i"), F.col("k").alias("j"),
        *(F.col(c).alias(f"right_{c}") for c in carried),
    )
    return left, right


#: Of two that meet the left one comes first.
_FIRST = "lo < ro OR (lo = ro AND left < right)"


def _met(one: DataFrame, *carried: str) -> DataFrame:
    """All pairs of (key, m, o) that share a key, once for each key, on sides as the cells have them. What Spark takes
    for small are tables before their rows are repeated for cells, so it must not broadcast them; nor must it put
    cells together into few tasks, since their pairs are many more than their rows."""
    n = partitions(one.sparkSession)
    left, right = (side.repartition(n, "key", "i", "j") for side in cells(one, *carried))
    return left.hint("merge").join(right, ["key", "i", "j"]).where((F.col("i") < F.col("j")) | F.expr(_FIRST))


def _turned(*more: Column) -> list[Column]:
    first = F.expr(_FIRST)
    return [
        F.when(first, F.col("left")).otherwise(F.col("right")).alias("left"),
        F.when(first, F.col("right")).otherwise(F.col("left")).alias("right"),
        *more,
    ]


def shared_keys(
    rows: DataFrame,
    key: str,
    member: str,
    *,
    order: str | None = None,
    max_members: int | None = None,
) -> DataFrame:
    """(left, right, key) for members that share a key; left comes before right by ``order`` (or the
    member itself). Repeated (key, member) rows count once; null keys and members are left out."""
    order = order or member
    one = rows.where(
        F.col(key).isNotNull() & F.col(member).isNotNull()
    ).groupBy(F.col(key).alias("key"), F.col(member).alias("m")).agg(F.min(order).alias("o"))
    if max_members is not None:
        few = one.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") <= max_members).select("key")
        one = one.join(few, "key", "left_semi")
    return _met(one).select(*_turned(F.col("key")))


def shared_lists(
    rows: DataFrame, key: str, member: str, *, order: str, about: str | None = None, max_members: int | None = None,
) -> DataFrame:
    """(left, right, shared, about): each pair that ``shared_keys`` has, once, with all its keys in order and what is
    known about the left one (the least value of that column). A member's place is its first one.

    Members with more than ``LISTED`` keys would send long lists with each of them: their pairs alone
    are grouped by a shuffle.
    """
    placed = _placed(rows, key, member, order, about, max_members)
    lists = placed.where(F.col("n") <= LISTED).groupBy("m", "o", "about").agg(
        F.sort_array(F.collect_list("key")).alias("keys")
    )
    # The intersection keeps the order of lists.
    both = F.array_intersect("left_keys", "right_keys")
    few = _met(lists.withColumn("key", F.explode("keys")), "keys", "about").where(F.get(both, F.lit(0)) == F.col("key"))
    return few.select(*_turned(both.alias("shared"), _of_left())).unionByName(_of_long(placed))


def _placed(
    rows: DataFrame, key: str, member: str, order: str, about: str | None, max_members: int | None,
) -> DataFrame:
    """(m, key, o, about, n): the keys that several members have, each member's place, and how many of them it has."""
    known = F.col(about) if about else F.lit(None).cast("string")
    one = rows.select(F.col(key).alias("key"), F.col(member).alias("m"), F.col(order).alias("o"), known.alias("about"))
    # Written, since what follows reads it several times, and plans of rows from many sources would grow as often.
    keyed = written(
        one.where("key IS NOT NULL AND m IS NOT NULL").groupBy("key", "m").agg(
            F.min("o").alias("o"), F.min("about").alias("about"),
        )
    )
    size = keyed.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    if max_members is not None:
        size = size.where(F.col("c") <= max_members)
    one = keyed.join(size.select("key"), "key", "left_semi")
    members = one.groupBy("m").agg(F.min("o").alias("o"), F.min("about").alias("about"), F.count("*").alias("n"))
    return written(one.select("key", "m").join(members, "m"), keyed)


def _of_left() -> Column:
    return F.when(F.expr(_FIRST), F.col("left_about")).otherwise(F.col("right_about")).alias("about")


def _of_long(placed: DataFrame) -> DataFrame:
    """What ``shared_lists`` has of members with more than ``LISTED`` keys."""
    long = placed.withColumn("long", F.col("n") > LISTED)
    theirs = long.join(long.where("long").select("key").distinct(), "key", "left_semi")
    many = _met(theirs, "long", "about").where("left_long OR right_long").select(*_turned(F.col("key"), _of_left()))
    return many.groupBy("left", "right").agg(
        F.sort_array(F.collect_list("key")).alias("shared"), F.min("about").alias("about"),
    )


#: Bits of a place in ``pair``.
PLACE_BITS = 28


def first_shared(
    rows: DataFrame, key: str, member: str, marks: Sequence[str], *, order: str, about: str | None = None,
    max_members: int | None = None,
) -> DataFrame:
    """(left, right, about, pair, bits, and a column for each mark): the pairs of ``shared_lists``, each with the least
    shared key that begins with the mark, or null; its bit is set in ``bits`` if there is one. Every key begins with
    one of the marks. ``pair`` is a number whose order is that of (left, right).

    Keys and places are numbers while members meet, so that a pair costs a comparison for each mark; lists are
    intersected only where a member has several keys of a mark. If keys would bring members together more often than
    there are pairs, all members meet once instead, in cells of the whole.
    """
    placed = _placed(rows, key, member, order, about, max_members)
    known = placed.groupBy("m").agg(F.first("o").alias("o"), F.first("about").alias("about"), F.first("n").alias("n"))
    # A place by the order, and one by the member itself.
    known = places.numbered(known, ["o", "m"], "place").drop("o").withColumnRenamed("place", "o")
    known = places.numbered(known, ["m"], "r")
    sizes = placed.groupBy("key").agg(F.count("*").alias("c"))
    ids = places.numbered(sizes, ["key"], "id")
    of = lambda mark: F.when(F.startswith("key", F.lit(mark)), F.struct("id", "key"))
    lists = placed.join(ids.select("key", "id"), "key").groupBy("m").agg(
        *(F.sort_array(F.collect_list(of(mark))).alias(f"k{x}") for x, mark in enumerate(marks)),
    )
    lists = written(known.join(lists, "m"))
    few = lists.where(F.col("n") <= LISTED)
    most = few.agg(F.count("*").alias("members"), *(F.max(F.size(f"k{x}")).alias(f"k{x}") for x in range(len(marks))))
    often = ids.agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("met"))
    found = most.join(often, F.lit(True)).join(lists.agg(F.max("n").alias("n")), F.lit(True)).first()
    used = [x for x in range(len(marks)) if found[f"k{x}"]]
    several = {x for x in used if found[f"k{x}"] > 1}
    dense = (found["met"] or 0) > found["members"] * (found["members"] - 1) / 2
    columns, carried, keys = [], ["r", "about"], []
    for x in used:
        # 0 where a member has none, which shares nothing.
        columns += [F.expr(f"coalesce(get(k{x}, 0).id, 0L) AS h{x}"), F.expr(f"get(k{x}, 0).key AS f{x}")]
        carried += [f"h{x}", f"f{x}"]
        keys.append(F.expr(f"transform(k{x}, e -> struct(e.id AS id, {1 << x} AS bit))"))
        if x in several:
            bits = f"aggregate(k{x}, 0L, (n, e) -> n | shiftleft(1L, CAST(pmod(e.id, 64) AS INT))) AS b{x}"
            columns += [F.expr(f"k{x}.id AS i{x}"), F.expr(f"k{x}.key AS t{x}"), F.expr(bits)]
            carried += [f"i{x}", f"t{x}", f"b{x}"]
    if dense or not used:
        each = few.select("m", "o", "r", "about", *columns, F.lit(0).cast("long").alias("key"), F.lit(0).alias("bit"))
    else:
        each = few.select("m", "o", "r", "about", *columns, F.explode(F.concat(*keys)).alias("e"))
        each = each.select("*", F.col("e.id").alias("key"), F.col("e.bit").alias("bit")).drop("e")
    bits, text, wrong = "0", {}, "false"
    for x in used:
        same = f"left_h{x} = right_h{x} AND left_h{x} <> 0"
        text[x] = f"left_f{x}"
        if x in several:
            least = f"get(array_intersect(left_i{x}, right_i{x}), 0)"
            least = f"CASE WHEN {same} THEN left_h{x} WHEN left_b{x} & right_b{x} <> 0L THEN coalesce({least}, 0L) ELSE 0L END"
            text[x] = f"CASE WHEN {same} THEN left_f{x} ELSE get(left_t{x}, CAST(array_position(left_i{x}, {least}) AS INT) - 1) END"
            wrong = f"{wrong} OR (left_bit = {1 << x} AND {least} <> key)"
            same = f"({least}) <> 0L"
        bits = f"{bits} | CASE WHEN {same} THEN {1 << x} ELSE 0 END"
    # A pair is emitted by the least bit that it has, and there by the least key.
    met = _met(each, "bit", *carried)
    met = met.where(f"({bits}) <> 0" if dense or not used else f"({bits}) & (left_bit - 1) = 0 AND NOT ({wrong})")
    pair = lambda a, b: F.shiftleft(a, PLACE_BITS).bitwiseOR(F.col(b))
    number = F.when(F.expr(_FIRST), pair("left_r", "right_r")).otherwise(pair("right_r", "left_r"))
    # Of the marks of a pair all members have the same texts.
    out = met.select(
        *_turned(_of_left(), number.alias("pair"), F.expr(bits).alias("bits")),
        *(F.expr(text[x]).alias(f"t{x}") for x in used),
    )
    none = F.lit(None).cast("string")
    value = lambda x: F.when(F.expr(f"bits & {1 << x} <> 0"), F.col(f"t{x}")) if x in used else none
    out = out.select(
        "left", "right", "about", "pair", "bits", *(value(x).alias(mark) for x, mark in enumerate(marks)),
    )
    if (found["n"] or 0) <= LISTED:
        return out
    begun = lambda mark: F.get(F.filter("shared", lambda k: F.startswith(k, F.lit(mark))), F.lit(0))
    many = _of_long(placed).join(lists.select(F.col("m").alias("left"), F.col("r").alias("left_r")), "left").join(
        lists.select(F.col("m").alias("right"), F.col("r").alias("right_r")), "right",
    )
    has = F.lit(0)
    for x, mark in enumerate(marks):
        has = has.bitwiseOR(F.when(begun(mark).isNotNull(), F.lit(1 << x)).otherwise(F.lit(0)))
    return out.unionByName(
        many.select(
            "left", "right", "about", pair("left_r", "right_r").alias("pair"), has.alias("bits"),
            *(begun(mark).alias(mark) for mark in marks),
        )
    )


def pair_counts(rows: DataFrame, key: str, member: str) -> DataFrame:
    """(left, key, n, least, most): how many pairs of ``shared_keys`` a member is the left one of, and the least and the
    greatest right one. The pairs of a member are with all that follow it in its key, so places of the members in
    the order of (key, member) tell them, and no pair is made. Members that nothing follows are left out."""
    one = rows.select(F.col(key).alias("key"), F.col(member).alias("left")).where("key IS NOT NULL AND left IS NOT NULL")
    placed = places.numbered(one.distinct(), ["key", "left"], "place")
    last = placed.groupBy("key").agg(F.max("place").alias("last"), F.max("left").alias("most"))
    after = placed.select((F.col("place") - 1).alias("place"), F.col("left").alias("least"))
    return placed.join(last, "key").where("place < last").join(after, "place").select(
        "left", "key", (F.col("last") - F.col("place")).alias("n"), "least", "most",
    )


def overlaps(
    rows: DataFrame,
    key: str,
    member: str,
    *,
    least: int = 1,
    sample: int = 15,
    max_members: int | None = None,
) -> DataFrame:
    """(left, right, n, least_key, sample) for pairs that share ``least`` keys or more.

    Members with fewer keys can't be in such a pair and go first. With the keys of all members in one
    order, here by rising frequency, two members that share ``least`` keys share one among the first
    size - least + 1 keys of each. Only those are joined, so a key that everybody has makes pairs only
    of members that have little else; each candidate pair is counted on the members' full lists, which
    travel with them up to ``LISTED`` keys.
    """
    base = rows.select(
        F.col(key).alias("key"), F.col(member).alias("member"),
    ).where("key IS NOT NULL AND member IS NOT NULL").distinct()
    if max_members is not None:
        few = base.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") <= max_members).select("key")
        base = base.join(few, "key", "left_semi")
    if least <= 1:
        pairs = shared_keys(base, "key", "member").groupBy("left", "right")
        return pairs.agg(
            F.count("*").alias("n"),
            F.min("key").alias("least_key"),
            F.slice(F.array_sort(F.collect_set("key")), 1, sample).alias("sample"),
        )
    counted = base.join(base.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "key")
    lists = counted.groupBy("member").agg(
        F.array_sort(F.collect_list(F.struct("c", "key"))).alias("keys")
    ).where(F.size("keys") >= least)
    lists = lists.select("member", F.transform("keys", lambda k: k["key"]).alias("keys"))
    lists = lists.select(F.col("member").alias("m"), F.col("member").alias("o"), "keys")
    # The first key that a pair shares, in the order of lists, is among these of both.
    first = lists.withColumn("key", F.explode(F.slice("keys", F.lit(1), F.size("keys") - least + 1)))
    both = F.array_intersect("left_keys", "right_keys")
    few = _met(first.where(F.size("keys") <= LISTED), "keys").where(
        (F.size(both) >= least) & (F.get(both, F.lit(0)) == F.col("key"))
    ).select(*_turned(F.array_sort(both).alias("shared")))
    # Pairs of members with longer lists meet without them, and are looked up.
    long = first.select("key", "m", "o", (F.size("keys") > LISTED).alias("long"))
    theirs = long.join(long.where("long").select("key").distinct(), "key", "left_semi")
    candidates = _met(theirs, "long").where("left_long OR right_long").select(*_turned()).distinct()
    many = candidates.join(lists.select(F.col("m").alias("left"), F.col("keys").alias("a")), "left").join(
        lists.select(F.col("m").alias("right"), F.col("keys").alias("b")),
        "right",
    ).select(
        "left",
        "right",
        F.array_sort(F.array_intersect("a", "b")).alias("shared"),
    ).where(F.size("shared") >= least)
    shared = few.unionByName(many)
    return shared.select(
        "left",
        "right",
        F.size("shared").cast("long").alias("n"),
        F.get("shared", F.lit(0)).alias("least_key"),
        F.slice("shared", 1, sample).alias("sample"),
    )


def reciprocal(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(left, right, both): directed edges folded into unordered pairs; both: seen in either direction."""
    pair = edges.where(F.col(a) != F.col(b)).select(
        F.least(a, b).alias("left"),
        F.greatest(a, b).alias("right"),
        (F.col(a) < F.col(b)).alias("up"),
    )
    return pair.groupBy("left", "right").agg((F.max("up") & ~F.min("up")).alias("both"))


def star(rows: DataFrame, key: str, member: str, order: str) -> DataFrame:
    """(head, member, key): every other member of a key with the key's first member."""
    base = rows.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(member).alias("member"), F.col(order).alias("o"),
    )
    head = base.groupBy("key").agg(F.min_by("member", "o").alias("head"), F.min("o").alias("first"))
    return base.join(head, "key").where("o <> first AND member <> head").select("head", "member", "key")


def complete(rows: DataFrame, key: str, member: str) -> DataFrame:
    """All pairs of the distinct members of each key."""
    return shared_keys(rows, key, member)


def pair_scores(evidence: DataFrame, *, cap: int = 100) -> DataFrame:
    """(left, right, score, evidence): weights of (left, right, rank, type, value, weight) summed and capped,
    evidence in order of rank; pairs without a positive score go."""
    e = F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "type", "value", "weight"))),
        lambda s: F.struct(s["type"].alias("type"), s["value"].alias("value"), s["weight"].alias("weight")),
    )
    out = evidence.groupBy("left", "right").agg(
        F.least(F.sum("weight"), F.lit(cap)).cast("int").alias("score"),
        e.alias("evidence"),
    )
    return out.where("score > 0")
