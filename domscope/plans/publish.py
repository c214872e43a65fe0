"""Published lists: block candidates, the reviewed blocklist, hosts-file lines, snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import terms as t
from ..functions.hosts import domain_shaped, plain_domain


def block_provenance(
    entities: DataFrame,
    excluded: Sequence[str] = t.EXCLUDED_DOMAINS,
    payment_confidence: float = 0.75,
    more: Sequence[str] = (),
) -> DataFrame:
    """(entity_id, entity_type, domain) of active, blockable operators, providers and sure payment paths;
    ``more`` names columns to carry along."""
    ok = entities.where("status = 'active'").where(
        F.col("entity_type").isin("operator", "provider", "payment_path")
        & F.coalesce("attributes.blockable", F.lit(True))
    )
    ok = ok.where(
        (F.col("entity_type") != "payment_path") | (F.coalesce("confidence", F.lit(0.0)) >= payment_confidence)
    )
    return ok.select(
        F.col("id").alias("entity_id"),
        "entity_type",
        F.explode("domains").alias("domain"),
        *more,
    ).where(~F.col("domain").isin(*excluded))


def block_candidates(entities: DataFrame, **options) -> DataFrame:
    """Distinct domains in order."""
    return block_provenance(entities, **options).select("domain").distinct().orderBy("domain")


def snapshot(entities, fingerprints, relationships, affiliations=None) -> dict:
    """The parts of a snapshot, tables or documents; affiliations only if there are any."""
    out = {"entities": entities, "fingerprints": fingerprints, "relationships": relationships}
    return out if affiliations is None else out | {"affiliations": affiliations}


def decision_domains(decisions: DataFrame, staged: DataFrame, clusters: DataFrame) -> DataFrame:
    """(record_id, source_type, recommendation, domain): the domains that each decision stands for, by the shape of its id."""
    c = F.col
    rows = decisions.select("record_id", "source_type", c("block_recommendation").alias("recommendation"))
    index = staged.where("candidate_id <> ''").groupBy("candidate_id").agg(
        F.max_by(plain_domain(c("domain")), "ordinal").alias("known")
    ).where("known <> ''")
    queued = F.startswith("record_id", F.lit("queue:"))
    kind, rest = F.split_part("record_id", F.lit(":"), F.lit(2)), F.regexp_extract(
        "record_id", r"(?s)^queue:[^:]*:(.*)$", 1,
    )
    a = rows.where(
        queued & kind.isin("discovered_domain", "extracted_fingerprint")
    ).withColumn("domain", plain_domain(rest))
    rows = rows.where(~queued)
    members = clusters.select(c("cluster_id").alias("record_id"), F.explode("members").alias("m"))
    b = rows.where("source_type = 'cluster'").join(members, "record_id").select(
        *rows.columns,
        plain_domain(c("m")).alias("domain"),
    )
    others = rows.where("source_type <> 'cluster'").join(
        index.withColumnRenamed("candidate_id", "record_id"),
        "record_id",
        "left",
    )
    hit = c("source_type").isin("entity", "fingerprint") & c("known").isNotNull()
    d = others.where(hit).select(*rows.columns, c("known").alias("domain"))
    left = others.where(~hit).drop("known")
    edge = (c("source_type") == "relationship") & F.contains("record_id", F.lit("->"))
    ends = left.where(edge).withColumn(
        "token",
        F.explode(
            F.array(
                F.trim(F.substring_index("record_id", "->", 1)),
                F.trim(F.regexp_extract("record_id", r"(?s)^.*?->(.*)$", 1)),
            )
        ),
    )
    ends = ends.join(index.withColumnRenamed("candidate_id", "token"), "token", "left").withColumn(
        "domain",
        F.coalesce("known", F.when(domain_shaped(c("token")), plain_domain(c("token")))),
    ).select(*rows.columns, "domain")
    bare = left.where(~edge & domain_shaped(c("record_id"))).withColumn("domain", plain_domain(c("record_id")))
    out = a
    for p in (b, d, ends, bare):
        out = out.unionByName(p)
    return out.where("domain <> ''")


def reviewed_blocklist(
    decisions: DataFrame,
    staged: DataFrame,
    clusters: DataFrame,
    *,
    include_after_review: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(entries in order of domain, record and recommendation; distinct domains in order)."""
    wanted = ["block_now", *(["block_after_review"] if include_after_review else [])]
    entries = decision_domains(decisions.where(F.col("block_recommendation").isin(*wanted)), staged, clusters)
    return entries.orderBy(
        "domain", "record_id", "recommendation",
    ), entries.select("domain").distinct().orderBy("domain")


def hosts_lines(domains: DataFrame, address: str = "0.0.0.0") -> DataFrame:
    """Two hosts-file lines for each domain, with and without www."""
    return domains.select(
        F.explode(
            F.array(F.concat(F.lit(f"{address} "), "domain"), F.concat(F.lit(f"{address} www."), "domain"))
        ).alias("value")
    )


def between_markers(text: str, lines: Sequence[str], begin: str, end: str) -> str:
    """A hosts file (small, local) with the block between two marker lines replaced, or added at the end."""
    rows = text.splitlines()
    at = [[k for k, r in enumerate(rows) if r.strip() == m] for m in (begin, end)]
    if any(len(x) > 1 for x in at) or len(at[0]) != len(at[1]) or at[0] and at[0][0] > at[1][0]:
        raise ValueError("markers do not pair up")
    block = [begin, *lines, end]
    out = rows[: at[0][0]] + block + rows[at[1][0] + 1 :] if at[0] else [*rows, *block]
    return "\n".join(out) + "\n"
