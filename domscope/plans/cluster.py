"""Domain clusters: evidence edges from many sources, then connected components.

A cluster is named after its smallest member. Reference roots depend on the order of links; members
do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hosts import cluster_host
from ..functions.text import norm_key, strip
from ..operators.graph import components
from ..operators.pairs import overlaps, star

#: Fixed value: a domain name anywhere in a text.
DOMAIN_IN_TEXT = r"\b(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z]{2,}\b"


def primary_domain(domains: Column) -> Column:
    return F.lower(strip(F.get(domains, F.lit(0))))


def script_hosts(technical: Column) -> Column:
    lists = [
        F.coalesce(technical[x], F.array().cast("array<string>"))
        for x in ("script_domains", "iframe_domains", "asset_domains")
    ]
    return F.array_distinct(F.filter(F.transform(F.concat(*lists), lambda h: F.lower(strip(h))), lambda h: h != ""))


def _edge(df: DataFrame, a: Column, b: Column, reason: str, **detail: Column) -> DataFrame:
    """(left, right, reason, detail JSON) without blanks and self-links."""
    about = (
        F.to_json(F.struct(*(v.alias(k) for k, v in sorted(detail.items()))), {"ignoreNullFields": "false"})
        if detail
        else F.lit("{}")
    )
    out = df.select(
        F.least(a, b).alias("left"),
        F.greatest(a, b).alias("right"),
        F.lit(reason).alias("reason"),
        about.alias("detail"),
    )
    return out.where("left IS NOT NULL AND right IS NOT NULL AND left <> '' AND right <> '' AND left <> right")


def _stars(rows: DataFrame, key: Column, domain: Column, reason: str, name: str) -> DataFrame:
    keyed = rows.select(
        F.nullif(norm_key(key), F.lit("")).alias("key"),
        domain.alias("domain"),
        F.col("ordinal"),
    ).where("domain <> ''")
    return _edge(
        star(keyed, "key", "domain", "ordinal"),
        F.col("head"),
        F.col("member"),
        reason,
        **{name: F.col("key")},
    )


def _overlap(rows: DataFrame, reason: str, least: int, sample: bool, max_members: int | None) -> DataFrame:
    """rows: (domain, host)."""
    pairs = overlaps(rows, "host", "domain", least=least, max_members=max_members)
    more = {"intersection_sample": F.col("sample")} if sample else {}
    return _edge(pairs, F.col("left"), F.col("right"), reason, overlap_count=F.col("n"), **more)


def evidence_edges(
    entities: DataFrame,
    fingerprints: DataFrame,
    staged: DataFrame | None = None,
    extracted: DataFrame | None = None,
    staged_edges: DataFrame | None = None,
    dump: DataFrame | None = None,
    discovered: DataFrame | None = None,
    san_pairs: DataFrame | None = None,
    *,
    min_script_overlap: int = 2,
    max_members: int | None = None,
) -> DataFrame:
    """All edges of the sources that are given. entities and staged carry ``ordinal``."""
    ents = entities.withColumn("domain", primary_domain(F.col("domains"))).where("domain <> ''")
    parts = [
        _stars(ents, F.col("attributes.legal_entity"), F.col("domain"), "same_legal_entity_normalized", "value"),
        _stars(ents, F.col("attributes.parent_company"), F.col("domain"), "same_parent_company_normalized", "value"),
    ]
    hosts = ents.select("id", "domain").join(fingerprints, F.col("id") == F.col("entity_id")).select(
        "domain",
        F.explode(script_hosts(F.col("technical"))).alias("host"),
    )
    parts.append(_overlap(hosts, "script_domain_overlap", min_script_overlap, True, max_members))
    if staged is not None:
        st = staged.withColumn("domain", F.lower(strip(F.col("domain")))).where("domain <> ''")
        for name in ("legal_entity", "parent_company"):
            parts.append(_stars(st, F.col(name), F.col("domain"), f"staged_same_{name}", name))
            own = st.select(
                F.nullif(norm_key(F.col(name)), F.lit("")).alias("key"),
                F.col("domain").alias("a"),
            ).where("key IS NOT NULL").distinct()
            theirs = ents.select(
                F.nullif(norm_key(F.col(f"attributes.{name}")), F.lit("")).alias("key"),
                F.col("domain").alias("b"),
            ).where("key IS NOT NULL").distinct()
            parts.append(
                _edge(
                    own.join(theirs, "key"),
                    F.col("a"),
                    F.col("b"),
                    f"staged_{name}_match_normalized",
                    **{name: F.col("key")},
                )
            )
    if staged_edges is not None and "raw_row" in staged_edges.columns:
        found = F.array_sort(
            F.array_distinct(F.regexp_extract_all(F.lower(F.to_json("raw_row")), F.lit(DOMAIN_IN_TEXT), F.lit(0)))
        )
        rows = staged_edges.select(found.alias("f"), F.col("relationship_type")).where(F.size("f") >= 2)
        rows = rows.select(
            F.get("f", F.lit(0)).alias("a"),
            F.explode(F.slice("f", F.lit(2), F.size("f") - 1)).alias("b"),
            "relationship_type",
        )
        parts.append(
            _edge(
                rows,
                F.col("a"),
                F.col("b"),
                "staged_relationship_domain_cooccurrence",
                relationship_type=F.col("relationship_type"),
            )
        )
    if extracted is not None:
        rows = extracted.select(
            F.lower(strip(F.col("domain"))).alias("domain"),
            F.explode(script_hosts(F.col("fingerprint.technical"))).alias("host"),
        ).where("domain <> ''")
        parts.append(_overlap(rows, "extracted_script_domain_overlap", min_script_overlap, False, max_members))
    if dump is not None:
        parts.append(
            _edge(
                dump,
                F.lower(strip(F.col("from_domain"))),
                F.lower(strip(F.col("to_domain"))),
                "affiliation_dump_pair",
                relationship=F.col("relationship"),
                notes_present=F.coalesce(F.col("notes"), F.lit("")) != "",
            )
        )
    if discovered is not None:
        chain = F.col("redirect_chain")
        rows = discovered.where(F.size(chain) >= 2).select(
            cluster_host(F.get(chain, F.lit(0))).alias("a"),
            cluster_host(F.try_element_at(chain, F.lit(-1))).alias("b"),
            chain.alias("chain"),
        )
        parts.append(_edge(rows, F.col("a"), F.col("b"), "discovery_redirect_chain", chain=F.col("chain")))
    if san_pairs is not None:
        mutual = san_pairs.where("type = 'tls_san_reciprocal'")
        parts.append(
            _edge(
                mutual,
                F.col("left"),
                F.col("right"),
                "scout_tls_san_reciprocal",
                domain_a=F.col("left"),
                domain_b=F.col("right"),
                san_a_lists_b=F.lit(True),
                san_b_lists_a=F.lit(True),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def clusters(edges: DataFrame) -> DataFrame:
    """(cluster_id, members, member_count, evidence, review_status, evidence_tier), largest first. Members
    of one cluster form one row, so a cluster's lists must fit in memory, as in any listing of it."""
    label = components(edges.select("left", "right"), "left", "right")
    members = label.groupBy("component").agg(
        F.array_sort(F.collect_set("node")).alias("members"),
        F.count("*").cast("int").alias("member_count"),
    )
    about = F.transform(
        F.array_sort(F.collect_list(F.struct("left", "right", "reason", "detail"))),
        lambda e: F.struct(
            F.array(e["left"], e["right"]).alias("domains"),
            e["reason"].alias("reason"),
            e["detail"].alias("detail"),
        ),
    )
    proof = edges.join(
        label.withColumnRenamed("node", "left"),
        "left",
    ).groupBy("component").agg(about.alias("evidence"))
    out = members.join(proof, "component").select(
        F.concat(F.lit("cluster-"), "component").alias("cluster_id"),
        "members",
        "member_count",
        "evidence",
        F.lit("pending").alias("review_status"),
        F.lit("inferred").alias("evidence_tier"),
    )
    return out.orderBy(F.desc("member_count"), "cluster_id")
