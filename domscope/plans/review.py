"""The review queue and the review decisions.

Inputs are staged tables: entities, fingerprints, relationships, extracted, clusters, discovered. Each
decision is one row (record_id, source_type, likely_entity_type, field_confidence, three
recommendations, reasoning).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as r
from ..functions import terms as t
from ..functions.hosts import rule_domain, seed_hosts
from ..functions.text import legal_keys, norm_blob, norm_key, strings, strip, text
from ..operators.keyed import keep_first
from ..sources.shared import written
from .cluster import primary_domain

QUEUE = ("kind", "id", "priority_score", "review_status", "evidence_tier", "sources", "notes", "payload_ref")


def _or(c: Column, default: str) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", default).otherwise(c)


def _item(
    df: DataFrame, kind: str, ident: Column, score: Column, status: Column, tier: Column, sources: Column,
    notes: Column, ref: dict[str, Column],
) -> DataFrame:
    path = F.to_json(F.struct(*(v.alias(k) for k, v in sorted(ref.items()))), {"ignoreNullFields": "false"})
    return df.select(
        F.lit(kind).alias("kind"),
        ident.alias("id"),
        score.cast("int").alias("priority_score"),
        status.alias("review_status"),
        tier.alias("evidence_tier"),
        sources.cast("string").alias("sources"),
        notes.cast("string").alias("notes"),
        path.alias("payload_ref"),
    )


def _filled(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) != "", 15).otherwise(0)


def _count(c: Column) -> Column:
    return F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))


def queue_parts(
    *,
    entities=None,
    fingerprints=None,
    relationships=None,
    extracted=None,
    clusters=None,
    discovered=None,
) -> list[DataFrame]:
    c, none = F.col, F.lit(None)
    tier = r.tier_rank(c("evidence_tier"))
    parts = []
    if entities is not None:
        score = (
            tier
            + F.least(F.lit(40), F.floor(F.length(F.coalesce("sources", F.lit(""))) / 10))
            + _filled(c("legal_entity"))
            + _filled(c("parent_company"))
        )
        parts.append(
            _item(
                entities,
                "staged_entity",
                F.coalesce(F.nullif(c("candidate_id"), F.lit("")), F.col("domain"), F.lit("None")),
                score,
                _or(c("review_status"), "needs_review"),
                c("evidence_tier"),
                c("sources"),
                c("notes"),
                {"candidate_id": c("candidate_id"), "domain": c("domain")},
            )
        )
    if fingerprints is not None:
        parts.append(
            _item(
                fingerprints,
                "staged_fingerprint",
                F.coalesce(c("candidate_id"), F.lit("None")),
                tier + 5,
                _or(c("review_status"), "needs_review"),
                c("evidence_tier"),
                none,
                none,
                {"candidate_id": c("candidate_id")},
            )
        )
    if relationships is not None:
        end = lambda x: F.coalesce(c(x), F.lit("None"))
        parts.append(
            _item(
                relationships,
                "staged_relationship",
                F.concat(end("from_candidate_id"), F.lit("->"), end("to_candidate_id")),
                tier + 8,
                _or(c("review_status"), "needs_review"),
                c("evidence_tier"),
                c("sources"),
                c("notes"),
                {"index": c("ordinal")},
            )
        )
    if extracted is not None:
        score = (
            tier
            + 5 * _count(c("legal_policy_urls"))
            + 3 * _count(c("support_help_urls"))
            + 2 * _count(c("contact_emails"))
            + F.least(F.lit(20), _count(c("fingerprint.technical.script_domains")))
        )
        parts.append(
            _item(
                extracted,
                "extracted_fingerprint",
                F.coalesce("domain", F.lit("")),
                score,
                _or(c("review_status"), "needs_review"),
                c("evidence_tier"),
                c("source_url"),
                none,
                {"domain": c("domain")},
            )
        )
    if clusters is not None:
        score = (
            tier
            + 4 * F.coalesce(F.nullif(c("member_count"), F.lit(0)), _count(c("members")))
            + F.least(F.lit(60), 2 * _count(c("evidence")))
        )
        notes = F.concat(
            F.lit("members=["),
            F.array_join(F.transform("members", lambda m: F.concat(F.lit("'"), m, F.lit("'"))), ", "),
            F.lit("]"),
        )
        parts.append(
            _item(
                clusters,
                "cluster",
                F.coalesce("cluster_id", F.lit("")),
                score,
                _or(c("review_status"), "pending"),
                c("evidence_tier"),
                none,
                notes,
                {"cluster_id": c("cluster_id")},
            )
        )
    if discovered is not None:
        first = keep_first(
            discovered.withColumn("domain", F.lower(strip(c("domain")))).where("domain <> ''"),
            ["domain"],
            ["ordinal"],
        )
        score = (
            F.lit(t.TIER_RANK[t.INFERRED])
            + F.when(_count(c("redirect_chain")) >= 2, 25).otherwise(0)
            + F.least(F.lit(30), 3 * _count(c("source_urls")))
        )
        parts.append(
            _item(
                first, "discovered_domain", c("domain"), score, F.lit("pending"), F.lit(t.INFERRED),
                F.to_json("source_urls"), none, {"domain": c("domain")},
            )
        )
    return parts


def review_queue(**tables) -> DataFrame:
    """All parts in one total order: score, then kind, then id."""
    parts = queue_parts(**tables)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(F.desc("priority_score"), "kind", "id")


# ---------------------------------------------------------------- decisions


def confirmed_domains(seeds: DataFrame, entities: DataFrame) -> DataFrame:
    """(domain): operators of the seed table (but inactive, deprecated, unknown ones) and of the catalogue
    (but inactive and deprecated ones; the difference is intended)."""
    status = lambda: F.lower(text(F.when(F.coalesce("status", F.lit("")) == "", "active").otherwise(F.col("status"))))
    a = seeds.where(~status().isin("inactive", "deprecated", "unknown")).select(
        F.explode(seed_hosts(F.col("domain"))).alias("domain")
    )
    b = entities.where("entity_type = 'operator'").where(
        ~status().isin("inactive", "deprecated")
    ).select(F.explode("domains").alias("d")).select(rule_domain(F.col("d")).alias("domain"))
    return a.unionByName(b).where("domain <> ''").distinct()


def catalogue_keys(entities: DataFrame) -> DataFrame:
    """(kind, key, ids): entities by legal name part, parent and company number."""
    of = lambda kind, keys: entities.where("id <> ''").select(
        F.lit(kind).alias("kind"), F.explode(keys).alias("key"), "id",
    ).where("key <> ''")
    rows = of("legal", legal_keys(F.col("attributes.legal_entity"))).unionByName(
        of("parent", F.array(norm_key(F.col("attributes.parent_company"))))
    ).unionByName(
        of("number", F.array(F.lower(text(F.col("attributes.company_number")))))
    )
    return rows.groupBy("kind", "key").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def edge_counts(relationships: DataFrame) -> DataFrame:
    """(node, promotes, uses_provider): distinct promoted targets, and provider edges."""
    kind = F.lower(F.coalesce("relationship", F.lit("")))
    node = F.lower(text(F.coalesce(F.nullif(F.col("from_candidate_id"), F.lit("")), F.col("from_domain"))))
    to = F.lower(text(F.coalesce(F.nullif(F.col("to_candidate_id"), F.lit("")), F.col("to_domain"))))
    any_ = F.lit(False)
    for x in ("promote", "link_to", "affiliate", "markets"):
        any_ = any_ | F.contains(kind, F.lit(x))
    rows = relationships.select(
        node.alias("node"),
        F.when(any_ & (to != ""), to).alias("target"),
        (F.contains(kind, F.lit("uses_provider")) | (kind == "provider_of")).cast("long").alias("uses"),
    ).where("node <> ''")
    return rows.groupBy("node").agg(F.count_distinct("target").alias("promotes"), F.sum("uses").alias("uses_provider"))


def cluster_facts(clusters: DataFrame, entities: DataFrame, confirmed: DataFrame) -> DataFrame:
    """(domain, verdict, touches): what the first cluster that holds the domain says, and whether any
    cluster with it holds a confirmed domain. clusters carry ``ordinal``."""
    members = clusters.select(
        "ordinal",
        "evidence",
        F.size("members").alias("size"),
        F.explode("members").alias("m"),
    ).select(
        "ordinal",
        "size",
        F.lower(strip(F.col("m"))).alias("member"),
        rule_domain(F.col("m")).alias("key"),
        F.exists(
            F.coalesce("evidence", F.array().cast("array<struct<domains:array<string>,reason:string,detail:string>>")),
            lambda e: e["reason"].isin("discovery_redirect_chain", "affiliation_dump_pair"),
        ).alias("linked"),
    )
    known = entities.select(
        primary_domain(F.col("domains")).alias("member")
    ).where("member <> ''").distinct().withColumn("production", F.lit(True))
    sure = confirmed.select(F.col("domain").alias("key")).distinct().withColumn("confirmed", F.lit(True))
    rows = members.join(known, "member", "left").join(sure, "key", "left")
    whole = rows.groupBy("ordinal").agg(
        F.max(F.coalesce("production", F.lit(False))).alias("production"),
        F.max(F.coalesce("confirmed", F.lit(False))).alias("touches"),
    )
    facts = rows.select("ordinal", "size", "member", "key", "linked").join(whole, "ordinal")
    verdict = F.when(F.col("production"), "touches").when(
        (F.col("size") >= 2) & F.col("linked"),
        "linked",
    ).when(F.col("size") >= 2, "create")
    by_member = facts.withColumn("verdict", verdict).where("verdict IS NOT NULL").groupBy(
        F.col("member").alias("domain")
    ).agg(
        F.min_by("verdict", "ordinal").alias("verdict")
    )
    by_key = facts.groupBy(F.col("key").alias("domain")).agg(F.max("touches").alias("touches"))
    return by_member.join(by_key, "domain", "full")


_CLUSTER_REASON = {
    "touches": "rule:cluster_attach_staged_cluster_touches_production_domain",
    "linked": "rule:cluster_attach_redirect_or_affiliation_evidence",
    "create": "rule:cluster_create_new_staged_cluster_only",
}


def _cluster_rule() -> tuple[Column, Column]:
    """(recommendation, reason) from legal_ids, parent_ids, number_ids and verdict."""
    named = lambda rule, ids: F.concat(F.lit(f"rule:cluster_attach_{rule}:"), F.array_join(ids, ","))
    has = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    attach = has("legal_ids") | has("parent_ids") | has("number_ids") | F.col("verdict").isin("touches", "linked")
    value = F.when(attach, "attach_to_existing_cluster").when(
        F.col("verdict") == "create",
        "create_new_cluster_candidate",
    ).otherwise("no_cluster_action")
    why = F.when(has("legal_ids"), named("shared_legal", F.col("legal_ids"))).when(
        has("parent_ids"),
        named("shared_parent", F.col("parent_ids")),
    ).when(
        has("number_ids"),
        named("company_number", F.col("number_ids")),
    )
    for verdict, text_ in _CLUSTER_REASON.items():
        why = why.when(F.col("verdict") == verdict, text_)
    return value, why.otherwise("rule:cluster_no_action")


def _decision(
    df: DataFrame, ident: Column, source: str, kind: Column, fields: Column, prom: Column, cluster: Column,
    block: Column, reasons: Column,
) -> DataFrame:
    return df.select(
        ident.alias("record_id"),
        F.lit(source).alias("source_type"),
        kind.alias("likely_entity_type"),
        fields.alias("field_confidence"),
        prom.alias("promotion_recommendation"),
        cluster.alias("cluster_recommendation"),
        block.alias("block_recommendation"),
        reasons.alias("reasoning"),
    )


def _joined_words(c: Column) -> Column:
    return F.array_join(F.coalesce(c, F.array().cast("array<string>")), " ")


def _looked_up(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """rows (with rid, legal_entity, parent_company, company_number) with the ids of entities that share each."""
    keys = rows.select(
        "rid",
        F.explode(
            F.concat(
                F.transform(
                    legal_keys(F.col("legal_entity")),
                    lambda k: F.struct(F.lit("legal").alias("kind"), k.alias("key")),
                ),
                F.array(
                    F.struct(
                        F.lit("parent").alias("kind"),
                        F.coalesce(norm_key(F.col("parent_company")), F.lit("")).alias("key"),
                    ),
                    F.struct(F.lit("number").alias("kind"), F.lower(text(F.col("company_number"))).alias("key")),
                ),
            )
        ).alias("k"),
    ).select("rid", "k.*")
    hits = keys.join(catalogue, ["kind", "key"]).groupBy("rid")
    of = lambda kind: F.array_sort(
        F.array_distinct(F.flatten(F.collect_list(F.when(F.col("kind") == kind, F.col("ids")))))
    ).alias(f"{kind}_ids")
    return rows.join(hits.agg(of("legal"), of("parent"), of("number")), "rid", "left")


def entity_decisions(
    staged: DataFrame, fingerprints: DataFrame, catalogue: DataFrame, facts: DataFrame, counts: DataFrame,
    confirmed: DataFrame,
) -> DataFrame:
    """staged carries ``rid`` (unique) and raw_row map<string,string>; fingerprints candidate_id and groups."""
    c = F.col
    fp = keep_first(
        fingerprints.where("candidate_id IS NOT NULL"),
        ["candidate_id"],
        ["ordinal"],
    ).select("candidate_id", F.struct("technical", "content", "flow").alias("fp"))
    rows = _looked_up(staged, catalogue).join(fp, "candidate_id", "left")
    rows = rows.withColumns(
        {
            "dom": text(c("domain")),
            "low": F.lower(text(c("domain"))),
            "dom_key": rule_domain(c("domain")),
            "cid": F.lower(F.coalesce("candidate_id", F.lit(""))),
        }
    )
    rows = rows.join(facts.select(c("domain").alias("low"), "verdict"), "low", "left").join(
        facts.select(c("domain").alias("dom_key"), "touches"),
        "dom_key",
        "left",
    )
    rows = rows.join(
        confirmed.select(c("domain").alias("dom_key")).distinct().withColumn("sure", F.lit(True)),
        "dom_key",
        "left",
    )
    for own, prefix in (("cid", "a"), ("low", "b")):
        rows = rows.join(
            counts.select(
                c("node").alias(own),
                c("promotes").alias(f"{prefix}p"),
                c("uses_provider").alias(f"{prefix}u"),
            ),
            own,
            "left",
        )
    most = lambda x: F.greatest(F.coalesce(f"a{x}", F.lit(0)), F.coalesce(f"b{x}", F.lit(0)))
    blob = norm_blob(
        norm_blob(
            c("notes"),
            c("brand"),
            c("legal_entity"),
            c("parent_company"),
            _joined_words(c("fp.content.title_terms")),
            _joined_words(c("fp.content.footer_phrases")),
        ),
        _joined_words(c("fp.flow.cashier_paths")),
    )
    rows = rows.withColumns(
        {
            "blob": blob,
            "sure": F.coalesce("sure", F.lit(False)),
            "touches": F.coalesce("touches", F.lit(False)),
            "legal": F.coalesce(norm_key(c("legal_entity")), F.lit("")) != "",
            "tier": F.coalesce("evidence_tier", F.lit("")),
            "weak": r.weak_notes(c("notes"), c("sources")),
            "p": most("p"),
            "u": most("u"),
        }
    )
    raw = lambda name: F.coalesce(c("raw_row")[name], F.lit(""))
    kind, why = r.entity_type(
        c("blob"),
        raw_type=F.coalesce(F.nullif(raw("entity_type"), F.lit("")), raw("entity_type_hint")),
        provider_type=raw("provider_type"),
        pattern_fields=(raw("domain_or_pattern") != "") | (raw("path_patterns") != ""),
        promotes=c("p"),
        uses_provider=c("u"),
        domain=c("dom"),
        legal_anchor=c("legal"),
    )
    rows = rows.withColumns(
        {
            "kind0": kind,
            "why0": why,
            "op": r.term_hits(c("blob"), t.OPERATOR_TERMS),
            "pr": r.term_hits(c("blob"), t.PROMOTER_TERMS),
        }
    )
    override = c("sure") & (F.lower(text(raw("entity_type"))) != "provider")
    rows = rows.withColumns(
        {
            "kind": F.when(override, "operator").otherwise(c("kind0")),
            "why": F.concat(
                "why0",
                F.when(
                    override & (c("kind0") != "operator"),
                    strings("rule:confirmed_operator_catalog_override_type"),
                ).otherwise(strings()),
            ),
            "contra": (c("op") >= 2) & (c("pr") >= 2) & ~c("sure"),
        }
    )
    present = (
        {x: text(c(x)) != "" for x in ("legal_entity", "parent_company", "brand", "jurisdiction", "company_number")}
        | {"domain": (c("dom") != "") & ~r.placeholder_domain(c("domain"))}
    )
    more = {
        "support_widget": "technical.support_widget_providers",
        "analytics_ids": "technical.analytics_ids",
        "provider_mentions": "content.provider_mentions",
        "cashier_path": "flow.cashier_paths",
    }
    with_fp = present | {k: strip(_joined_words(c(f"fp.{v}"))) != "" for k, v in more.items()}
    fields = F.when(
        c("fp").isNull(),
        r.field_confidence(c("tier"), c("weak"), present),
    ).otherwise(r.field_confidence(c("tier"), c("weak"), with_fp))
    cluster, cluster_why = _cluster_rule()
    rows = rows.withColumns({"fields": fields, "cluster": cluster, "cluster_why": cluster_why})
    prom, prom_why = r.promotion(
        kind=c("kind"),
        tier=c("tier"),
        legal=c("legal"),
        attach=c("cluster") == "attach_to_existing_cluster",
        strong_cluster=c("cluster") == "create_new_cluster_candidate",
        domain_ok=(c("dom") != "") & ~r.placeholder_domain(c("domain")),
        weak=c("weak"),
        contradictory=c("contra"),
        little_signal=(c("kind") == "unknown") & ~c("legal") & c("fp").isNull(),
        notes=c("notes"),
    )
    notes = F.lower(F.coalesce("notes", F.lit("")))
    block, block_why = r.blocking(
        kind=c("kind"),
        tier=c("tier"),
        legal_level=c("fields")["legal_entity"],
        redirect=r.redirect_shell(c("notes"), c("sources"), c("blob")),
        evidence_only=F.contains(notes, F.lit("evidence_only")) | F.contains(notes, F.lit("evidence only")),
        confirmed=c("sure"),
        touches_confirmed=c("touches"),
        hits=c("op"),
    )
    reasons = F.concat(
        "why",
        F.array("cluster_why"),
        F.array(prom_why),
        block_why,
        F.when(c("contra"), strings("rule:contradictory_operator_promoter_signals")).otherwise(strings()),
    )
    ident = F.coalesce(F.nullif(c("candidate_id"), F.lit("")), F.nullif(c("dom"), F.lit("")), F.lit("unknown_entity"))
    return _decision(rows, ident, "entity", c("kind"), c("fields"), prom, c("cluster"), block, reasons)


def fingerprint_decisions(fingerprints: DataFrame, staged: DataFrame) -> DataFrame:
    """Orphans only: fingerprints without a staged entity."""
    c = F.col
    rows = fingerprints.join(
        staged.select("candidate_id").where("candidate_id <> ''").distinct(),
        "candidate_id",
        "left_anti",
    )
    blob = norm_blob(
        *(
            _joined_words(c(x))
            for x in (
                "content.title_terms", "content.footer_phrases", "content.provider_mentions", "flow.cashier_paths",
            )
        )
    )
    none, zero = F.lit(""), F.lit(0)
    kind, why = r.entity_type(
        blob,
        raw_type=none,
        provider_type=none,
        pattern_fields=F.lit(False),
        promotes=zero,
        uses_provider=zero,
        domain=none,
        legal_anchor=F.lit(False),
    )
    base, weak = r.tier_level(c("evidence_tier")), F.coalesce(
        c("evidence_tier").isin(t.INFERRED, "inferred"),
        F.lit(False),
    )
    lowered = F.when(weak, r.downgraded(base)).otherwise(base)
    has = lambda x: F.coalesce(F.size(c(x)) > 0, F.lit(False))
    fields = F.create_map(
        F.lit("analytics_ids"),
        F.when(has("technical.analytics_ids"), base).otherwise("low"),
        F.lit("cashier_path"),
        F.when(has("flow.cashier_paths"), lowered).otherwise("low"),
        F.lit("provider_mentions"),
        lowered,
        F.lit("script_domains"),
        F.when(has("technical.script_domains"), base).otherwise("low"),
        F.lit("support_widget"),
        F.when(has("technical.support_widget_providers"), base).otherwise("low"),
    )
    tail = strings(
        "rule:fingerprint_orphan_reject_without_domain",
        "rule:fingerprint_no_domain_for_cluster",
        "rule:fingerprint_not_a_standalone_block_target",
    )
    return _decision(
        rows,
        _or(c("candidate_id"), "unknown_fp"),
        "fingerprint",
        kind,
        fields,
        F.lit("reject_for_now"),
        F.lit("no_cluster_action"),
        F.lit("do_not_block"),
        F.concat(why, tail),
    )


def relationship_decisions(relationships: DataFrame) -> DataFrame:
    c = F.col
    kind = F.lower(F.coalesce("relationship", F.lit("")))
    promoter = (
        F.contains(kind, F.lit("promote")) | F.contains(kind, F.lit("affiliate")) | F.contains(kind, F.lit("link"))
    )
    provider = F.contains(kind, F.lit("provider"))
    a, b = F.coalesce("from_candidate_id", F.lit("")), F.coalesce("to_candidate_id", F.lit(""))
    ident = F.when(
        (a != "") & (b != ""),
        F.concat(a, F.lit("->"), b),
    ).otherwise(F.format_string("relationship_%04d", c("ordinal")))
    level = r.tier_level(c("evidence_tier"))
    why = F.concat(
        r.trail(
            F.when(
                promoter,
                "rule:relationship_suggests_promoter_edge",
            ).when(provider, "rule:relationship_suggests_provider_edge")
        ),
        strings("rule:relationship_record_not_domain_blocklist"),
    )
    return _decision(
        relationships,
        ident,
        "relationship",
        F.when(promoter, "promoter").when(provider, "provider").otherwise("unknown"),
        F.create_map(F.lit("evidence"), level, F.lit("relationship"), level),
        F.lit("stage_only"),
        F.lit("no_cluster_action"),
        F.lit("do_not_block"),
        why,
    )


def cluster_decisions(clusters: DataFrame, entities: DataFrame, confirmed: DataFrame) -> DataFrame:
    c = F.col
    members = clusters.select(
        "ordinal",
        F.explode_outer("members").alias("m"),
    ).select("ordinal", rule_domain(c("m")).alias("key"))
    known = entities.select(
        primary_domain(c("domains")).alias("key")
    ).where("key <> ''").distinct().withColumn("production", F.lit(True))
    sure = confirmed.select(c("domain").alias("key")).distinct().withColumn("sure", F.lit(True))
    flags = members.join(known, "key", "left").join(sure, "key", "left").groupBy("ordinal").agg(
        F.max(F.coalesce("production", F.lit(False))).alias("production"),
        F.max(F.coalesce("production", "sure", F.lit(False))).alias("family"),
    )
    rows = clusters.join(flags, "ordinal")
    cluster = F.when(c("production"), "attach_to_existing_cluster").otherwise("create_new_cluster_candidate")
    why = F.array(
        F.when(
            c("production"),
            "rule:cluster_doc_touches_production_domain",
        ).otherwise("rule:cluster_doc_staged_only_members"),
        F.when(
            c("family"),
            "rule:cluster_block_after_review_operator_family",
        ).otherwise("rule:cluster_block_not_operator_family"),
    )
    fields = F.create_map(F.lit("cluster_evidence"), r.tier_level(_or(c("evidence_tier"), "inferred")))
    return _decision(
        rows,
        _or(c("cluster_id"), "unknown_cluster"),
        "cluster",
        F.lit("unknown"),
        fields,
        F.lit("stage_only"),
        cluster,
        F.when(c("family"), "block_after_review").otherwise("do_not_block"),
        why,
    )


def queue_decisions(queue: DataFrame, extracted: DataFrame, facts: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Discovered domains and extracted fingerprints of the queue; extracted carries ``ordinal``, the last of a domain counts."""
    c = F.col
    rows = queue.where("kind IN ('discovered_domain', 'extracted_fingerprint') AND id <> ''")
    rows = rows.withColumn(
        "domain",
        rule_domain(F.coalesce(F.nullif(F.get_json_object("payload_ref", "$.domain"), F.lit("")), c("id"))),
    ).where("domain <> ''")
    words = norm_blob(
        *(
            _joined_words(c(f"fingerprint.{x}"))
            for x in ("content.title_terms", "content.footer_phrases", "flow.cashier_paths", "flow.redemption_paths")
        )
    )
    pages = extracted.where("domain <> ''").groupBy(rule_domain(c("domain")).alias("domain")).agg(
        F.max_by(words, "ordinal").alias("words")
    )
    sure = confirmed.select("domain").distinct().withColumn("sure", F.lit(True))
    rows = rows.join(pages, "domain", "left").join(facts, "domain", "left").join(sure, "domain", "left")
    rows = rows.withColumns(
        {
            "blob": norm_blob(norm_blob(c("notes"), c("sources")), c("words")),
            "sure": F.coalesce("sure", F.lit(False)),
            "touches": F.coalesce("touches", F.lit(False)),
            "tier": F.coalesce("evidence_tier", F.lit("")),
            "weak": r.weak_notes(c("notes"), c("sources")),
        }
    )
    none, zero = F.lit(""), F.lit(0)
    kind, why = r.entity_type(
        c("blob"),
        raw_type=none,
        provider_type=none,
        pattern_fields=F.lit(False),
        promotes=zero,
        uses_provider=zero,
        domain=c("domain"),
        legal_anchor=F.lit(False),
    )
    rows = rows.withColumns(
        {
            "kind0": kind,
            "why0": why,
            "op": r.term_hits(c("blob"), t.OPERATOR_TERMS),
            "pr": r.term_hits(c("blob"), t.PROMOTER_TERMS),
        }
    )
    rows = rows.withColumns(
        {
            "likely": F.when(c("sure"), "operator").otherwise(c("kind0")),
            "why": F.concat(
                "why0",
                F.when(
                    c("sure") & (c("kind0") != "operator"),
                    strings("rule:confirmed_operator_catalog_override_type"),
                ).otherwise(strings()),
            ),
        }
    )
    empty = F.array().cast("array<string>")
    rows = rows.withColumns({"legal_ids": empty, "parent_ids": empty, "number_ids": empty})
    cluster, cluster_why = _cluster_rule()
    rows = rows.withColumns({"cluster": cluster, "cluster_why": cluster_why})
    level = r.tier_level(c("tier"))
    prom, prom_why = r.promotion(
        kind=c("likely"),
        tier=c("tier"),
        legal=F.lit(False),
        attach=c("cluster") == "attach_to_existing_cluster",
        strong_cluster=c("cluster") == "create_new_cluster_candidate",
        domain_ok=F.lit(True),
        weak=c("weak"),
        contradictory=(c("op") >= 2) & (c("pr") >= 2) & ~c("sure"),
        little_signal=(c("likely") == "unknown") & (c("op") == 0) & ~c("sure"),
        notes=c("notes"),
    )
    bad = r.placeholder_domain(c("domain"))
    prom_trail = F.when(bad, strings("rule:queue_discovered_reject_placeholder")).otherwise(
        F.array(F.lit("rule:queue_research_item_stage"), prom_why)
    )
    block, block_why = r.blocking(
        kind=c("likely"),
        tier=c("tier"),
        legal_level=F.lit(""),
        redirect=r.redirect_shell(c("notes"), c("sources"), c("blob")),
        evidence_only=F.lit(False),
        confirmed=c("sure"),
        touches_confirmed=c("touches"),
        hits=c("op"),
    )
    return _decision(
        rows,
        F.concat(F.lit("queue:"), "kind", F.lit(":"), "domain"),
        "entity",
        c("likely"),
        F.create_map(F.lit("domain"), level),
        F.when(bad, "reject_for_now").otherwise(prom),
        c("cluster"),
        block,
        F.concat("why", F.array("cluster_why"), prom_trail, block_why),
    )


def decisions(
    *, seeds: DataFrame, entities: DataFrame, staged: DataFrame, fingerprints: DataFrame, relationships: DataFrame,
    clusters: DataFrame, queue: DataFrame, extracted: DataFrame,
) -> DataFrame:
    """All decisions in order of source type and record; a queue decision gives way to one that is there."""
    confirmed = confirmed_domains(seeds, entities)
    facts = cluster_facts(clusters, entities, confirmed)
    main = entity_decisions(
        staged, fingerprints, catalogue_keys(entities), facts, edge_counts(relationships), confirmed,
    )
    for part in (
        fingerprint_decisions(fingerprints, staged),
        relationship_decisions(relationships),
        cluster_decisions(clusters, entities, confirmed),
    ):
        main = main.unionByName(part)
    main = written(main)  # read twice below
    own = queue_decisions(queue, extracted, facts, confirmed)
    known = main.select("source_type", "record_id").distinct()
    fresh = own.join(known, ["source_type", "record_id"], "left_anti").select(*main.columns)
    return main.unionByName(fresh).orderBy("source_type", "record_id")
