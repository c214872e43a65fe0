"""Seed tables to entities and edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hosts import pattern_cell, seed_domain
from ..functions.text import parse_float, split_pipe, split_tokens, strings, strip, text
from ..operators.keyed import edge_errors, ordered_union, valid_edges
from ..schemas import ATTRIBUTES, EDGE, ENTITY, FINGERPRINT, filled


def _cell(df: DataFrame, name: str) -> Column:
    """The cell, or an empty string where the table has no such column."""
    return F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit("")


def _entity(
    df: DataFrame, kind: str, run_time: str, domains: Column, categories: Column, attributes: dict[str, Column],
) -> DataFrame:
    c = lambda name: _cell(df, name)
    values = {
        "id": text(c("id")),
        "name": strip(F.when(c("name") == "", c("id")).otherwise(c("name"))),
        "entity_type": F.lit(kind),
        "domains": domains,
        "categories": categories,
        "status": F.when(text(c("status")) == "", "active").otherwise(text(c("status"))),
        "confidence": parse_float(c("confidence")),
        "sources": split_pipe(c("sources")),
        "notes": text(c("notes")),
        "first_seen": F.lit(run_time),
        "last_seen": F.lit(run_time),
        "ordinal": F.col("ordinal").cast("long"),
        "attributes": filled(
            ATTRIBUTES,
            {
                "legal_entity": F.lit(""), "jurisdictions": strings(), "blockable": F.lit(True),
                "evidence_only": F.lit(False),
            }
            | attributes,
        ),
    }
    row = filled(ENTITY, values)
    return df.where(text(c("id")) != "").select(row.alias("e")).select("e.*")


def _hosts(df: DataFrame) -> Column:
    return F.transform(split_tokens(_cell(df, "domain")), seed_domain)


def operators(rows: DataFrame, run_time: str) -> DataFrame:
    """Rows need an id and a domain. rows carry ``ordinal``, their place in the file."""
    c = lambda n: _cell(rows, n)
    out = _entity(
        rows,
        "operator",
        run_time,
        _hosts(rows),
        split_pipe(c("categories")),
        {
            "legal_entity": text(c("legal_entity")),
            "jurisdictions": split_pipe(c("jurisdictions")),
            "provider_names": split_pipe(c("provider_names")),
        },
    )
    return out.where(F.size("domains") > 0)


def promoters(rows: DataFrame, run_time: str) -> DataFrame:
    kinds = split_pipe(_cell(rows, "promotes_categories"))
    out = _entity(
        rows,
        "promoter",
        run_time,
        _hosts(rows),
        kinds,
        {"blockable": F.lit(False), "promoter_type": text(_cell(rows, "promoter_type")), "promotes_categories": kinds},
    )
    return out.where(F.size("domains") > 0)


def _or_unknown(c: Column) -> Column:
    return strip(F.when(c == "", "unknown").otherwise(c))


def providers(rows: DataFrame, run_time: str) -> DataFrame:
    """Kept without a domain, and marked as pending then."""
    hosts = _hosts(rows)
    flag = F.lower(rows["blockable"] if "blockable" in rows.columns else F.lit("true"))
    return _entity(
        rows,
        "provider",
        run_time,
        hosts,
        strings(),
        {
            "blockable": F.coalesce(flag.isin("1", "true", "yes", "y"), F.lit(False)),
            "provider_type": _or_unknown(_cell(rows, "provider_type")),
            "domains_pending_verification": F.size(hosts) == 0,
        },
    )


def payments(rows: DataFrame, run_time: str) -> DataFrame:
    """Rows need a domain or a path pattern."""
    raw = _cell(rows, "domain_or_pattern")
    hosts, patterns = pattern_cell(raw)
    out = _entity(
        rows,
        "payment_path",
        run_time,
        hosts,
        strings(),
        {
            "payment_type": _or_unknown(_cell(rows, "payment_type")),
            "domain_or_pattern": text(raw),
            "path_patterns": patterns,
        },
    )
    return out.where((F.size("domains") > 0) | (F.size("attributes.path_patterns") > 0))


def edges(rows: DataFrame) -> DataFrame:
    c = lambda n: _cell(rows, n)
    named = lambda n, default: strip(F.when(c(n) == "", default).otherwise(c(n)))
    url, anchor = text(c("evidence_url")), text(c("evidence_text"))
    values = {
        "from_id": text(c("from_id")),
        "to_id": text(c("to_id")),
        "relationship": named("relationship", "related_to"),
        "confidence": parse_float(c("confidence")),
        "source": named("source", "manual_seed"),
        "evidence": F.when((url != "") | (anchor != ""), F.struct(url.alias("url"), anchor.alias("anchor_text"))),
        "ordinal": F.col("ordinal").cast("long"),
    }
    return rows.where(
        (text(c("from_id")) != "") & (text(c("to_id")) != "")
    ).select(filled(EDGE, values).alias("e")).select("e.*")


def ownership(entities: DataFrame) -> DataFrame:
    """Domains that more than one entity claims, with their owners in file order."""
    claims = entities.select(
        F.explode("domains").alias("domain"),
        F.struct("part", "ordinal", F.concat_ws(":", "entity_type", "id").alias("owner")).alias("o"),
    )
    out = claims.groupBy("domain").agg(
        F.transform(F.array_sort(F.collect_list("o")), lambda s: s["owner"]).alias("owners")
    )
    return out.where(F.size("owners") > 1)


def empty_fingerprints(ids: DataFrame, column: str = "id") -> DataFrame:
    """A fingerprint of empty lists for each id."""
    row = {
        g.name: F.struct(
            *(F.lit("").alias(f.name) if f.name == "registrar" else strings().alias(f.name) for f in g.dataType.fields)
        )
        for g in FINGERPRINT.fields
        if g.name != "entity_id"
    }
    return ids.select(filled(FINGERPRINT, {"entity_id": F.col(column)} | row).alias("f")).select("f.*")


def normalise(tables: dict[str, DataFrame], run_time: str) -> dict[str, DataFrame]:
    """entities, fingerprints, relationships, errors and contested domains from the five seed tables."""
    loaders = (
        ("operators", operators), ("promoters", promoters), ("providers", providers), ("payment_paths", payments),
    )
    entities = ordered_union(*(load(tables[name], run_time) for name, load in loaders))
    found = edges(tables["relationships"])
    return {
        "entities": entities,
        "fingerprints": empty_fingerprints(entities),
        "relationships": valid_edges(found, entities),
        "errors": edge_errors(found, entities),
        "contested": ownership(entities),
    }
