"""Candidate imports, staging, their review and the promotion preview.

Row order matters here (ids are numbered by it), so every input carries ``ordinal``, its place in the
file from 1 on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import terms as t
from ..functions.rules import evidence_tier, row_tier, tier_cap
from ..functions.text import cluster_key, confidence, first_nonempty, operator_id, split_pipe, strip, strings, text
from ..operators import places
from ..operators.keyed import keep_last
from ..operators.pairs import complete

#: Header aliases of candidate tables.
PRIMARY_DOMAIN = ("primary_domain", "domain", "primary_host", "canonical_domain", "primary")
OTHER_DOMAINS = ("other_domains", "alias_domains", "alias_candidates", "additional_domains", "secondary_domains")
NOTES = ("notes", "merge_notes", "description")
SOURCES_TIER = ("sources", "source_set", "source")
DUPLICATE_GROUP = ("duplicate_group_id", "duplicate_group", "merge_group_id", "group_id")
CANONICAL_FLAGS = ("canonical", "is_canonical", "is_primary", "canonical_row")


def _aliases(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Columns that exist under one of the names, case ignored; of equal names the last column."""
    have = {c.lower(): c for c in df.columns}
    return [F.col(f"`{have[n]}`") for n in names if n in have]


def _first(df: DataFrame, names: Sequence[str]) -> Column:
    cells = _aliases(df, names)
    return first_nonempty(*cells) if cells else F.lit("")


def raw_row(df: DataFrame) -> Column:
    """map<string, string> of all cells in key order, for provenance."""
    names = sorted(c for c in df.columns if c != "ordinal")
    return (
        F.create_map(*(x for c in names for x in (F.lit(c.strip()), text(F.col(f"`{c}`")))))
        if names
        else F.create_map().cast("map<string,string>")
    )


def is_canonical(df: DataFrame) -> Column:
    out = F.lit(False)
    for c in _aliases(df, CANONICAL_FLAGS):
        out = out | F.lower(text(c)).isin("1", "true", "yes", "canonical", "primary")
    for c in _aliases(df, ("row_type",)):
        out = out | F.lower(text(c)).isin("canonical", "primary")
    return out


def candidate_entities(rows: DataFrame, hint: str, source_file: str, prefix: str) -> DataFrame:
    """Staged candidates of one file; hint is operator, promoter or corporate."""
    primary, other, sure = _first(rows, PRIMARY_DOMAIN), _first(rows, OTHER_DOMAINS), confidence(
        *_aliases(rows, ("confidence", "score", "conf"))
    )
    alias = other != ""
    return rows.select(
        F.format_string(f"{prefix}_%04d", "ordinal").alias("candidate_id"),
        F.lit("needs_review").alias("review_status"),
        row_tier(_first(rows, NOTES), _first(rows, SOURCES_TIER), sure).alias("evidence_tier"),
        F.lit(hint).alias("entity_type_hint"),
        F.lit("scout").alias("imported_from"),
        F.lit(source_file).alias("raw_source_file"),
        F.col("ordinal").alias("scout_row_index"),
        is_canonical(rows).alias("is_canonical_candidate"),
        _first(rows, DUPLICATE_GROUP).alias("duplicate_group_id"),
        _first(rows, ("merge_notes", "merge_note", "dedupe_notes")).alias("merge_notes"),
        _first(rows, ("source_set", "source_batch", "intake_batch")).alias("source_set"),
        primary.alias("primary_domain"),
        other.alias("other_domains"),
        F.lower(strip(F.substring_index(primary, "/", 1))).alias("domain"),
        _first(rows, ("brand", "name", "display_name", "title")).alias("brand"),
        _first(rows, ("legal_entity", "corporate_name", "entity_name")).alias("legal_entity"),
        _first(rows, ("parent_company", "parent")).alias("parent_company"),
        _first(rows, NOTES).alias("notes"),
        _first(rows, ("sources", "source_urls", "source_url")).alias("sources"),
        sure.alias("confidence"),
        alias.alias("alias_candidates_non_empty"),
        F.when(alias, "needs_manual_verification").otherwise("not_applicable").alias("alias_review_status"),
        raw_row(rows).alias("raw_row"),
    )


def candidate_redirects(rows: DataFrame, source_file: str, prefix: str) -> DataFrame:
    sure = confidence(*_aliases(rows, ("confidence", "score", "conf")))
    return rows.select(
        F.format_string(f"{prefix}_%04d", "ordinal").alias("candidate_id"),
        F.lit("needs_review").alias("review_status"),
        row_tier(_first(rows, NOTES), _first(rows, SOURCES_TIER), sure).alias("evidence_tier"),
        F.lit("scout").alias("imported_from"),
        F.lit(source_file).alias("raw_source_file"),
        F.col("ordinal").alias("scout_row_index"),
        _first(rows, DUPLICATE_GROUP).alias("duplicate_group_id"),
        _first(rows, ("merge_notes", "notes")).alias("merge_notes"),
        _first(rows, ("source_set", "sources")).alias("source_set"),
        raw_row(rows).alias("raw_row"),
    )


def duplicate_edges(entities: DataFrame, order: Sequence[str]) -> DataFrame:
    """(from, to, group): members of a duplicate group with its first flagged member, or else its first.

    Numbering of the edges is a total order over a review table and is left to ``numbered``.
    """
    rows = entities.withColumn("gid", text(F.col("duplicate_group_id"))).where("gid <> ''")
    place = F.struct((~F.col("is_canonical_candidate")).alias("n"), *(F.col(c) for c in order))
    head = rows.groupBy("gid").agg(F.min_by("candidate_id", place).alias("head"))
    out = rows.join(head, "gid").where("candidate_id <> '' AND candidate_id <> head")
    return out.select(
        F.col("candidate_id").alias("from_candidate_id"),
        F.col("head").alias("to_candidate_id"),
        F.col("gid").alias("duplicate_group_id"),
        *order,
    )


def numbered(edges: DataFrame, order: Sequence[str]) -> DataFrame:
    """Duplicate edges with ids scout_dup_0001, ... in order of group and row, and ``ordinal``, that order's places
    (ids of more than four digits don't sort by it)."""
    rows = places.numbered(edges, ["duplicate_group_id", *order], "_k")
    return rows.select(
        F.format_string(t.DUPLICATE_ID, "_k").alias("relationship_id"),
        F.lit(t.DUPLICATE_TYPE).alias("relationship_type"),
        "from_candidate_id",
        "to_candidate_id",
        "duplicate_group_id",
        F.lit(t.INFERRED).alias("evidence_tier"),
        F.lit("needs_review").alias("review_status"),
        F.col("_k").alias("ordinal"),
    )


def import_actions(entities: DataFrame) -> DataFrame:
    """(candidate_id, action, reason) by the default policy, in order of candidate id."""
    hint, alias, sure = F.col("entity_type_hint"), F.coalesce(
        "alias_candidates_non_empty", F.lit(False),
    ), F.col("confidence")
    rules = [
        ((hint == "corporate") & alias, "needs_manual_verification", "policy:corporate_has_other_domains_unusual"),
        (hint == "corporate", "safe_to_promote_now", "policy:corporate_usually_safe_to_promote"),
        ((hint == "operator") & alias, "needs_manual_verification", "policy:other_domains_not_verified_aliases"),
        ((hint == "operator") & (sure >= 0.85), "safe_to_promote_now", "policy:operator_primary_only_high_confidence"),
        ((hint == "operator") & (sure >= 0.7), "stage_only", "policy:operator_primary_moderate_confidence"),
        (hint == "operator", "stage_only", "policy:operator_primary_low_or_missing_confidence"),
        (hint == "promoter", "stage_only", "policy:promoter_stage_only_by_default"),
    ]
    action = reason = F
    for when, a, r in rules:
        action, reason = action.when(when, a), reason.when(when, r)
    return entities.select(
        "candidate_id",
        "entity_type_hint",
        action.otherwise("needs_manual_verification").alias("action"),
        reason.otherwise("policy:unknown_entity_type_hint").alias("reason"),
    ).orderBy("candidate_id")


def import_summary(entities: DataFrame, actions: DataFrame, edges: DataFrame) -> DataFrame:
    """One row of counts."""
    a = entities.agg(
        F.count("*").alias("entities"),
        F.count_if(F.col("alias_candidates_non_empty")).alias("with_aliases"),
        F.count_distinct(F.nullif(text(F.col("duplicate_group_id")), F.lit(""))).alias("duplicate_groups"),
        F.count_if(F.col("is_canonical_candidate")).alias("canonical"),
    )
    b = actions.agg(
        *(
            F.count_if(F.col("action") == x).alias(x)
            for x in ("safe_to_promote_now", "stage_only", "needs_manual_verification")
        )
    )
    c = edges.agg(F.count("*").alias("duplicate_edges"))
    return a.join(b, F.lit(True)).join(c, F.lit(True))  # three single rows


def stage(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entities, fingerprints) of a research table. Rows without domain and brand are left out; ids
    are numbered by file row all the same."""
    cell = lambda n: text(F.col(n)) if n in rows.columns else F.lit("")
    base = rows.where((cell("domain") != "") | (cell("brand") != ""))
    sources = cell("sources")
    listed = F.when(
        F.contains(sources, F.lit("|")),
        split_pipe(sources),
    ).when(sources != "", F.array(sources)).otherwise(strings())
    tier = evidence_tier(cell("notes"), sources)
    ident = F.format_string(t.RESEARCH_ID, "ordinal")
    entities = base.select(
        ident.alias("candidate_id"),
        F.lit("needs_review").alias("review_status"),
        tier.alias("evidence_tier"),
        cell("domain").alias("domain"),
        F.when(cell("brand") == "", cell("domain")).otherwise(cell("brand")).alias("brand"),
        *(cell(n).alias(n) for n in ("legal_entity", "parent_company", "jurisdiction", "company_number", "notes")),
        sources.alias("sources"),
        listed.alias("sources_list"),
        raw_row(rows).alias("raw_row"),
        "ordinal",
    )
    one = lambda n: F.when(cell(n) != "", F.array(cell(n))).otherwise(strings())
    none = strings()
    fingerprints = base.select(
        ident.alias("candidate_id"),
        F.lit("needs_review").alias("review_status"),
        tier.alias("evidence_tier"),
        F.struct(
            split_pipe(cell("analytics_ids")).alias("analytics_ids"),
            none.alias("tag_manager_ids"),
            split_pipe(cell("script_domains")).alias("script_domains"),
            none.alias("iframe_domains"),
            none.alias("asset_domains"),
            one("support_widget").alias("support_widget_providers"),
        ).alias("technical"),
        F.struct(
            one("legal_entity").alias("legal_entity_names"),
            split_pipe(cell("footer_phrase")).alias("footer_phrases"),
            split_pipe(cell("title_phrase")).alias("title_terms"),
            split_pipe(cell("provider_mentions")).alias("provider_mentions"),
        ).alias("content"),
        F.struct(one("cashier_path").alias("cashier_paths")).alias("flow"),
        "ordinal",
    )
    return entities, fingerprints


def corporate_edges(entities: DataFrame) -> DataFrame:
    """All pairs of candidates with the same parent company, or else legal entity."""
    rows = entities.select(cluster_key(F.col("legal_entity"), F.col("parent_company")).alias("key"), "candidate_id")
    return complete(rows, "key", "candidate_id").select(
        F.col("left").alias("from_candidate_id"),
        F.col("right").alias("to_candidate_id"),
        F.lit("related_to").alias("relationship"),
        F.lit(0.55).alias("confidence"),
        F.lit(t.RESEARCH_SOURCE).alias("source"),
        F.lit(t.INFERRED).alias("evidence_tier"),
        F.lit("needs_review").alias("review_status"),
        F.concat(F.lit(t.CORPORATE_NOTE[0]), "key", F.lit(t.CORPORATE_NOTE[1])).alias("notes"),
        F.lit("").alias("sources"),
    )


def resolved_dump(dump: DataFrame, entities: DataFrame) -> DataFrame:
    """Edges of an external dump with both ends looked up by domain; the last candidate of a domain has it."""
    index = keep_last(entities.select(F.lower("domain").alias("d"), "candidate_id", "ordinal"), ["d"], ["ordinal"])
    low = lambda c: F.lower(text(F.col(c)))
    rows = dump.withColumns({"fd": low("from_domain"), "td": low("to_domain")})
    rows = rows.join(
        index.select(F.col("d").alias("fd"), F.col("candidate_id").alias("from_candidate_id")),
        "fd",
        "left",
    ).join(index.select(F.col("d").alias("td"), F.col("candidate_id").alias("to_candidate_id")), "td", "left")
    known = (F.coalesce("from_candidate_id", F.lit("")) != "") & (F.coalesce("to_candidate_id", F.lit("")) != "")
    return rows.select(
        F.format_string(t.DUMP_ID, "ordinal").alias("import_id"),
        "from_candidate_id",
        "to_candidate_id",
        text(F.col("from_domain")).alias("from_domain"),
        text(F.col("to_domain")).alias("to_domain"),
        F.when(text(F.col("relationship")) == "", "related_to")
        .otherwise(text(F.col("relationship")))
        .alias("relationship"),
        F.coalesce("confidence", F.lit(0.5)).alias("confidence"),
        F.lit(t.DUMP_SOURCE).alias("source"),
        evidence_tier(F.col("notes"), F.col("sources")).alias("evidence_tier"),
        F.lit("needs_review").alias("review_status"),
        F.coalesce("notes", F.lit("")).alias("notes"),
        F.coalesce("sources", F.lit("")).alias("sources"),
        F.when(known, "resolved").otherwise("unresolved_domain").alias("resolution_status"),
    )


def promotion_preview(
    entities: DataFrame, fingerprints: DataFrame, relationships: DataFrame,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(operators, partial fingerprints, relationships) that approval would add; always inactive."""
    ok = entities.where("review_status = 'approved'")
    base = F.least(F.lit(0.85), tier_cap(F.col("evidence_tier")))
    notes = strip(
        F.concat(
            F.lit("[research_promote tier="),
            F.coalesce("evidence_tier", F.lit("None")),
            F.lit("] "),
            F.coalesce("notes", F.lit("")),
        )
    )
    domain = text(F.col("domain"))
    operators = ok.select(
        operator_id(domain).alias("id"),
        F.when(F.coalesce("brand", F.lit("")) == "", domain).otherwise(F.col("brand")).alias("name"),
        domain.alias("domain"),
        F.lit("").alias("categories"),
        F.lit("inactive").alias("status"),
        base.cast("string").alias("confidence"),
        "legal_entity",
        F.col("jurisdiction").alias("jurisdictions"),
        text(F.col("raw_row")["provider_mentions"]).alias("provider_names"),
        notes.alias("notes"),
        "sources",
    )
    own = ok.select(
        "candidate_id",
        operator_id(domain).alias("entity_id"),
        F.coalesce("legal_entity", F.lit("")).alias("legal"),
    )
    prints = fingerprints.join(own, "candidate_id")
    cell = lambda c: F.array_join(F.coalesce(F.col(c), strings()), "|")
    partial = prints.select(
        "entity_id",
        *(cell(f"technical.{x}").alias(x) for x in ("analytics_ids", "script_domains", "support_widget_providers")),
        F.col("legal").alias("legal_entity_names"),
        *(cell(f"content.{x}").alias(x) for x in ("footer_phrases", "title_terms", "provider_mentions")),
        cell("flow.cashier_paths").alias("cashier_paths"),
    )
    a, b = own.select(
        F.col("candidate_id").alias("from_candidate_id"),
        F.col("entity_id").alias("from_operator_id"),
    ), own.select(F.col("candidate_id").alias("to_candidate_id"), F.col("entity_id").alias("to_operator_id"))
    edges = relationships.where(
        "review_status = 'approved'"
    ).join(a, "from_candidate_id").join(b, "to_candidate_id").select(
        "from_operator_id",
        "to_operator_id",
        "relationship",
        F.coalesce("confidence", F.lit(0.6)).cast("string").alias("confidence"),
        "source",
        "from_candidate_id",
        "to_candidate_id",
        F.lit("approved").alias("review_status"),
    )
    return operators, partial, edges
