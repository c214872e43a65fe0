"""Scored pairs of entities and of domains, from shared evidence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import terms as t
from ..functions.hosts import signal_mx_hosts, signal_nameservers
from ..functions.rules import score_label
from ..functions.text import norm_key, strip, text
from ..operators.pairs import PLACE_BITS, first_shared, reciprocal, shared_keys


def _list(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def _each(rows: DataFrame, values: Column) -> DataFrame:
    return rows.select(
        "id",
        "ord",
        F.explode(F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != "")))).alias("key"),
    )


def entity_keys(entities: DataFrame, fingerprints: DataFrame, edges: DataFrame) -> dict[str, DataFrame]:
    """For each signal (id, ord, key): what active entities can share."""
    active = entities.where("status = 'active'").withColumn(
        "ord",
        F.struct("part", "ordinal") if "part" in entities.columns else F.struct("ordinal"),
    )
    rows = active.join(fingerprints.withColumnRenamed("entity_id", "_f"), F.col("id") == F.col("_f"), "left")
    low = lambda c: F.transform(_list(c), F.lower)
    names = F.concat(
        _list(F.col("attributes.provider_names")),
        _list(F.col("content.provider_mentions")),
        _list(F.col("provider_signals.provider_names")),
        F.when(F.col("entity_type") == "provider", F.array("name")).otherwise(F.array().cast("array<string>")),
    )
    tech = lambda x: F.col(f"technical.{x}")
    ends = active.select("id", "ord")
    neighbours = lambda kind, own, other: edges.where(F.col("relationship").isin(*kind)).select(
        F.col(own).alias("id"), F.col(other).alias("key"),
    ).join(ends, "id").select("id", "ord", "key").distinct()
    return {
        "legal": _each(rows, F.array(norm_key(F.col("attributes.legal_entity")))),
        "ids": _each(rows, F.concat(_list(tech("analytics_ids")), _list(tech("tag_manager_ids")))),
        "provider": _each(rows, F.transform(names, lambda n: F.lower(strip(n)))),
        "provider_edge": neighbours(("uses_provider",), "from_id", "to_id"),
        "flow": _each(
            rows,
            F.concat(*(low(F.col(f"flow.{x}")) for x in ("cashier_paths", "redemption_paths", "signup_paths"))),
        ),
        "script": _each(
            rows,
            F.concat(*(low(tech(x)) for x in ("script_domains", "asset_domains", "support_widget_providers"))),
        ),
        "promoter": neighbours(("promotes",), "to_id", "from_id"),
        "registrar": _each(rows, F.array(F.lower(text(tech("registrar"))))),
        "nameserver": _each(rows, low(tech("nameservers"))),
    }


#: Of these signals only the first that a pair shares counts.
EXCLUSIVE = {"provider_edge": "provider", "nameserver": "registrar"}

#: For each signal the two letters in front of its keys, by which lists of keys are in order: its group's and its own.
_MARKS = {
    signal: chr(97 + [s for s, _, _ in t.ENTITY_EVIDENCE].index(EXCLUSIVE.get(signal, signal))) + chr(97 + rank)
    for rank, (signal, _, _) in enumerate(t.ENTITY_EVIDENCE)
}
_MARK = 2


def marked_scores(pairs: DataFrame, kinds: list[tuple[str, str, int]], *, cap: int = 100) -> DataFrame:
    """(left, right, score, pair, about, a column for each mark) of ``first_shared``: weights of (mark, type, weight) summed
    and capped over the first mark of each group that has a key; the others become null. Pairs without a positive
    score go."""
    group, score = [], [0] * (1 << len(kinds))
    for x, (mark, _, _) in enumerate(kinds):
        group.append(sum(1 << y for y in range(x) if kinds[y][0][0] == mark[0]))
    for bits in range(1 << len(kinds)):
        kept = (x for x in range(len(kinds)) if bits & 1 << x and not bits & group[x])
        score[bits] = min(sum(kinds[x][2] or 0 for x in kept), cap)
    first = lambda x, mark: F.when(F.expr(f"bits & {group[x]} = 0"), F.col(mark)) if group[x] else F.col(mark)
    scored = pairs.select(
        "left", "right", F.get(F.expr(f"array({', '.join(map(str, score))})"), F.col("bits")).alias("score"), "pair", "about",
        *(first(x, mark).alias(mark) for x, (mark, _, _) in enumerate(kinds)),
    )
    # Where each key has a positive weight all pairs have a positive score, and a filter would only be pushed into the
    # join and compute it twice.
    return scored if all((w or 0) > 0 for _, _, w in kinds) else scored.where("score > 0")


def best_first(scored: DataFrame) -> DataFrame:
    """Scored pairs by falling score, then by their ends: one number holds all three, so that it alone is sorted."""
    return scored.orderBy(F.shiftleft((F.lit(127) - F.col("score")).cast("long"), 2 * PLACE_BITS).bitwiseOR(F.col("pair")))


def _value(mark: str) -> Column:
    return F.substring(F.col(mark), _MARK + 1, 1 << 30)


def listed(rows: DataFrame, kinds: list[tuple[str, str, int]]) -> DataFrame:
    """(left, right, score, label, evidence), the evidence of kept keys. Made behind a sort, so that it sorts no words
    that follow from marks."""
    one = lambda mark, kind, weight: F.struct(
        F.lit(kind).alias("type"), _value(mark).alias("value"), F.lit(weight).cast("int").alias("weight"),
    )
    some = lambda mark, *more: F.when(F.col(mark).isNotNull(), F.array(one(mark, *more)))
    none = F.array().cast("array<struct<type:string,value:string,weight:int>>")
    return rows.select(
        "left",
        "right",
        "score",
        score_label(F.col("score")).alias("label"),
        F.flatten(F.array(*(some(*kind).otherwise(none) for kind in kinds))).alias("evidence"),
    )


def worded(rows: DataFrame, kinds: list[tuple[str, str, int]]) -> DataFrame:
    """As ``listed``, the evidence in words: type:value:weight, joined by semicolons."""
    words = (
        F.when(F.col(mark).isNotNull(), F.concat(F.lit(f"{kind}:"), _value(mark), F.lit(f":{weight}")))
        for mark, kind, weight in kinds
    )
    return rows.select(
        "left", "right", "score", score_label(F.col("score")).alias("label"), F.concat_ws(";", *words).alias("evidence"),
    )


ENTITY_KINDS = [(_MARKS[signal], kind, weight) for signal, kind, weight in t.ENTITY_EVIDENCE]


def entity_scores(keys: dict[str, DataFrame], entities: DataFrame, *, max_members: int | None = None) -> DataFrame:
    """Pairs with the signals that they share, as ``marked_scores`` has them. A legal entity is written as the left one
    has it."""
    rows = None
    for signal, mark in _MARKS.items():
        one = keys[signal].select("id", "ord", F.concat(F.lit(mark), "key").alias("key"))
        rows = one if rows is None else rows.unionByName(one)
    legal = entities.groupBy("id").agg(F.min(text(F.col("attributes.legal_entity"))).alias("about"))
    pairs = first_shared(
        rows.join(legal, "id", "left"), "key", "id", list(_MARKS.values()), order="ord", about="about",
        max_members=max_members,
    )
    mark = _MARKS["legal"]
    pairs = pairs.withColumn(mark, F.when(F.col(mark).isNotNull(), F.concat(F.lit(mark), "about")))
    return marked_scores(pairs, ENTITY_KINDS)


def entity_affiliations(
    entities: DataFrame,
    fingerprints: DataFrame,
    edges: DataFrame,
    *,
    max_members: int | None = None,
    shown: Callable = listed,
) -> DataFrame:
    """(left, right, score, label, evidence), best first; left comes before right in file order."""
    scored = entity_scores(entity_keys(entities, fingerprints, edges), entities, max_members=max_members)
    return shown(best_first(scored), ENTITY_KINDS)


def _san_pairs(prints: DataFrame) -> DataFrame:
    """(left, right, both): domains one of which, or each, is in the certificate of the other."""
    whole = prints.where("NOT coalesce(tls_partial, false)")
    known = whole.select(F.col("domain").alias("other"))
    lists = whole.select("domain", F.explode(F.array_distinct("sans")).alias("other")).join(known, "other")
    return reciprocal(lists, "domain", "other")


def _host_keys(prints: DataFrame, nameservers: dict | None, mx: dict | None) -> dict[str, DataFrame]:
    """(domain, key) of nameservers and of mail hosts."""
    keys = lambda values: prints.select(
        "domain", F.explode(F.array_distinct(F.transform(values, F.lower))).alias("key"),
    )
    mail = F.coalesce(F.col("mx"), F.array().cast("array<struct<host:string,priority:int>>"))
    return {
        "shared_nameserver_filtered": keys(signal_nameservers(_list(F.col("nameservers")), **(nameservers or {}))),
        "shared_mx_filtered": keys(signal_mx_hosts(mail, **(mx or {}))),
    }


def signal_pairs(prints: DataFrame, *, nameservers: dict | None = None, mx: dict | None = None) -> DataFrame:
    """(left, right, type, detail) of domain fingerprints (schemas.DOMAIN_FINGERPRINT): mutual and one-way
    certificate names, shared nameservers and mail hosts that are no common infrastructure."""
    san = _san_pairs(prints).select(
        "left",
        "right",
        F.when(F.col("both"), "tls_san_reciprocal").otherwise("tls_san_one_way").alias("type"),
        F.array().cast("array<string>").alias("shared"),
    )
    for name, keys in _host_keys(prints, nameservers, mx).items():
        san = san.unionByName(
            shared_keys(keys, "key", "domain").groupBy("left", "right").agg(
                F.array_sort(F.collect_set("key")).alias("shared")
            ).select("left", "right", F.lit(name).alias("type"), "shared")
        )
    return san


def domain_affiliations(
    prints: DataFrame, weights: dict[str, int] = t.DOMAIN_WEIGHTS, *, shown: Callable = listed,
) -> DataFrame:
    """Domain pairs scored by the weights of their signals; evidence by type name."""
    kinds = [(chr(97 + k) * _MARK, kind, weights.get(kind)) for k, kind in enumerate(sorted(t.DOMAIN_WEIGHTS))]
    marks = {kind: mark for mark, kind, _ in kinds}
    # A link of certificates is a key that its two ends share, so it meets what else they share.
    link = lambda kind, way: F.concat(F.lit(marks[kind]), F.concat_ws("|", "left", "right", F.lit(way)))
    links = _san_pairs(prints).select(
        F.explode(F.array("left", "right")).alias("domain"),
        F.when(F.col("both"), link("tls_san_reciprocal", "reciprocal_san"))
        .otherwise(link("tls_san_one_way", "one_way_san"))
        .alias("key"),
    )
    for kind, keys in _host_keys(prints, None, None).items():
        links = links.unionByName(keys.select("domain", F.concat(F.lit(marks[kind]), "key").alias("key")))
    found = first_shared(links, "key", "domain", [mark for mark, _, _ in kinds], order="domain")
    return shown(best_first(marked_scores(found, kinds)), kinds)
