"""Queries of the stages over tables made from the driver's, with their SQL.

Inputs of a stage are built by expressions that Spark and DuckDB read alike (``div`` apart); what the
stage makes of them is written a second time in SQL.
"""

from __future__ import annotations


import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import terms as t
from .functions.hosts import monitor_host
from .plans import affiliations, cluster, crawl, enrich, publish, review, seeds, signing, staging
from .queries_text import _TAILS, _pick, _t, _tailed
from .sources import files, shared

RUN = "2026-01-02T03:04:05+00:00"


def _made(spark: SparkSession, sf: str, name: str, /, **cells: str) -> DataFrame:
    """A table of SQL expressions over one of the driver's tables."""
    return _t(spark, sf, name).selectExpr(*(f"{v} AS `{k}`" for k, v in cells.items()))


def _words(df: DataFrame, *names: str, by: str = " ") -> DataFrame:
    return df.withColumns({n: F.array_join(n, by) for n in names})


# ---------------------------------------------------------------- seeds

_OPERATORS = {
    "ordinal": "s_suppkey",
    "id": "CASE WHEN s_suppkey % 10 = 9 THEN ' ' ELSE concat('op', s_suppkey) END",
    "name": "CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE s_name END",
    "domain": "CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE concat('www.s', s_suppkey % 60, '.example,  S', s_suppkey, 'b.example./x') END",
    "categories": "' a | b|'",
    "status": "CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'inactive' ELSE 'active' END",
    "confidence": "CASE s_suppkey % 3 WHEN 0 THEN '0.5' WHEN 1 THEN 'bad' ELSE ' 0.75 ' END",
}
_PROMOTERS = {
    "ordinal": "n_nationkey",
    "id": "concat('pr', n_nationkey)",
    "name": "n_name",
    "domain": "CASE WHEN n_nationkey % 6 = 0 THEN '' ELSE concat('n', n_nationkey, '.example') END",
    "promotes_categories": "'c1|c2'",
    "status": "'active'",
    "confidence": "'1'",
}
_PROVIDERS = {
    "ordinal": "r_regionkey",
    "id": "concat('pv', r_regionkey)",
    "name": "r_name",
    "domain": "CASE WHEN r_regionkey % 2 = 0 THEN '' ELSE concat('r', r_regionkey, '.example') END",
    "blockable": "CASE r_regionkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' ELSE '' END",
    "status": "'active'",
    "confidence": "'0.9'",
}
_PAYMENTS = {
    "ordinal": "n_nationkey",
    "id": "concat('py', n_nationkey)",
    "name": "n_name",
    "status": "'active'",
    "confidence": "'0.8'",
    "domain_or_pattern": "CASE n_nationkey % 4 WHEN 0 THEN '' WHEN 1 THEN '/pay/*' WHEN 2 THEN concat('https://pay', n_nationkey, '.example:444/x') ELSE concat('pay', n_nationkey, '.example /a|/b') END",
}
_EDGES = {
    "ordinal": "c_custkey",
    "from_id": "concat(' pr', c_custkey % 30)",
    "to_id": "concat('op', c_custkey % 120)",
    "relationship": "CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'promotes' END",
    "confidence": "'0.4'",
    "source": "''",
    "evidence_url": "''",
    "evidence_text": "''",
}


def _normalised(spark, sf) -> dict[str, DataFrame]:
    tables = {
        "operators": _made(spark, sf, "supplier", **_OPERATORS),
        "promoters": _made(spark, sf, "nation", **_PROMOTERS),
        "providers": _made(spark, sf, "region", **_PROVIDERS),
        "payment_paths": _made(spark, sf, "nation", **_PAYMENTS),
        "relationships": _made(spark, sf, "customer", **_EDGES),
    }
    return seeds.normalise(tables, RUN)


def seed_entities(spark, sf):
    """The four seed loaders in one catalogue."""
    rows = _normalised(spark, sf)["entities"]
    cells = rows.select(
        "id",
        "name",
        "entity_type",
        "domains",
        "categories",
        "status",
        "confidence",
        F.col("attributes.blockable").alias("blockable"),
        F.coalesce("attributes.path_patterns", F.array().cast("array<string>")).alias("patterns"),
        F.coalesce("attributes.domains_pending_verification", F.lit(False)).alias("pending"),
    )
    return _words(cells, "domains", "categories", "patterns")


_SQL_ENTITIES = """
e AS (
  SELECT 0 AS part, s_suppkey AS k, 'op' || s_suppkey AS id, CASE WHEN s_suppkey % 7 = 0 THEN 'op' || s_suppkey ELSE s_name END AS name, 'operator' AS entity_type, 's' || (s_suppkey % 60) || '.example s' || s_suppkey || 'b.example.' AS domains, 'a b' AS categories,
    CASE WHEN s_suppkey % 4 = 1 THEN 'inactive' ELSE 'active' END AS status, (CASE s_suppkey % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 0 ELSE 0.75 END)::DOUBLE AS confidence, true AS blockable, '' AS patterns, false AS pending FROM supplier WHERE s_suppkey % 10 <> 9 AND s_suppkey % 9 <> 0
  UNION ALL SELECT 1, n_nationkey, 'pr' || n_nationkey, n_name, 'promoter', 'n' || n_nationkey || '.example', 'c1 c2', 'active', 1.0, false, '', false FROM nation WHERE n_nationkey % 6 <> 0
  UNION ALL SELECT 2, r_regionkey, 'pv' || r_regionkey, r_name, 'provider', CASE WHEN r_regionkey % 2 = 0 THEN '' ELSE 'r' || r_regionkey || '.example' END, '', 'active', 0.9, r_regionkey % 3 = 0, '', r_regionkey % 2 = 0 FROM region
  UNION ALL SELECT 3, n_nationkey, 'py' || n_nationkey, n_name, 'payment_path', CASE WHEN n_nationkey % 4 = 1 THEN '' ELSE 'pay' || n_nationkey || '.example' END, '', 'active', 0.8, true, CASE n_nationkey % 4 WHEN 1 THEN '/pay/*' WHEN 3 THEN '/a /b' ELSE '' END, false FROM nation WHERE n_nationkey % 4 <> 0
)"""
SQL_ENTITIES = f"WITH {_SQL_ENTITIES.strip()} SELECT * EXCLUDE (part, k) FROM e"


def seed_checks(spark, sf):
    """Valid edges, errors of the others, and domains that several entities claim."""
    found = _normalised(spark, sf)
    edges = found["relationships"].select(
        F.lit("edge").alias("kind"),
        F.concat_ws(">", "from_id", "to_id").alias("what"),
        F.concat_ws(" ", "relationship", "source", F.col("confidence").cast("string")).alias("detail"),
    )
    errors = found["errors"].select(
        F.lit("error").alias("kind"),
        F.concat_ws(">", "from_id", "to_id").alias("what"),
        F.col("error").alias("detail"),
    )
    contested = found["contested"].select(
        F.lit("contested").alias("kind"),
        F.col("domain").alias("what"),
        F.array_join("owners", " ").alias("detail"),
    )
    return edges.unionByName(errors).unionByName(contested)


SQL_CHECKS = f"""
WITH {_SQL_ENTITIES.strip()},
x AS (SELECT 'pr' || (c_custkey % 30) AS a, 'op' || (c_custkey % 120) AS b, CASE WHEN c_custkey % 2 = 0 THEN 'related_to' ELSE 'promotes' END AS r FROM customer),
y AS (SELECT *, a IN (SELECT id FROM e) AS ka, b IN (SELECT id FROM e) AS kb FROM x),
d AS (SELECT part, k, entity_type || ':' || id AS owner, unnest(string_split(domains, ' ')) AS domain FROM e WHERE domains <> '')
SELECT CASE WHEN ka AND kb THEN 'edge' ELSE 'error' END AS kind, a || '>' || b AS what, CASE WHEN NOT ka THEN 'unknown from_id: ' || a WHEN NOT kb THEN 'unknown to_id: ' || b ELSE r || ' manual_seed 0.4' END AS detail FROM y
UNION ALL SELECT 'contested', domain, string_agg(owner, ' ' ORDER BY part, k) FROM d GROUP BY domain HAVING count(*) > 1
"""

# ---------------------------------------------------------------- enrich


def enriched(spark, sf):
    """Fingerprints from a catalogue, a partial table and pages."""
    k = F.col("k")
    sup = _t(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("k"),
        F.concat(F.lit("e"), F.col("s_suppkey").cast("string")).alias("id"),
    )
    site = F.concat(F.lit("s"), k.cast("string"), F.lit(".example"))
    entities = sup.select(
        "id",
        F.col("id").alias("name"),
        F.when(k % 4 < 3, "operator").otherwise("payment_path").alias("entity_type"),
        F.when(k % 7 == 0, "inactive").otherwise("active").alias("status"),
        F.array(site).alias("domains"),
    )
    have = seeds.empty_fingerprints(sup.where("k % 2 = 0").select("id"))
    arr = lambda *x: F.array(*(F.lit(v) for v in x))
    have = have.withColumn(
        "technical",
        F.col("technical").withField("script_domains", arr("B.example", "a.example", "b.example")),
    )
    have = have.withColumn("flow", F.col("flow").withField("cashier_paths", arr("/Pay", "/pay"))).withColumn(
        "content",
        F.col("content").withField("footer_phrases", arr("Zed", "alpha", "zed")),
    )
    last = sup.where("k % 3 = 0").select(
        F.col("id").alias("entity_id"),
        F.lit("C.example|b.example").alias("script_domains"),
        F.lit("/In").alias("cashier_paths"),
        F.lit("Beta| alpha ").alias("footer_phrases"),
        F.lit(2).alias("ordinal"),
    )
    early = last.select(
        "entity_id",
        F.lit("old.example").alias("script_domains"),
        F.lit("/old").alias("cashier_paths"),
        F.lit("Old").alias("footer_phrases"),
        F.lit(1).alias("ordinal"),
    )
    url = F.concat(F.when(k % 10 == 5, "http://").otherwise("https://"), site, F.lit("/"))
    pages = sup.where("k % 5 = 0").select(
        url.alias("url"),
        F.lit('<title>Grand Casino Town of it</title><script src="https://D.example/x.js"></script>').alias("html"),
    )
    out = enrich.enrich(entities, have, last.unionByName(early), pages)
    return _words(
        out.select(
            "entity_id",
            F.col("technical.script_domains").alias("scripts"),
            F.col("flow.cashier_paths").alias("cashier"),
            F.col("content.footer_phrases").alias("footer"),
            F.col("content.title_terms").alias("titles"),
        ),
        "scripts",
        "cashier",
        "footer",
        "titles",
    )


SQL_ENRICHED = """
WITH f AS (SELECT s_suppkey AS k, s_suppkey % 2 = 0 AS have, s_suppkey % 3 = 0 AS part, s_suppkey % 5 = 0 AND s_suppkey % 7 <> 0 AND s_suppkey % 4 < 3 AS page FROM supplier)
SELECT 'e' || k AS entity_id,
  CASE WHEN part OR page THEN concat_ws(' ', CASE WHEN have THEN 'a.example' END, CASE WHEN have OR part THEN 'b.example' END, CASE WHEN part THEN 'c.example' END, CASE WHEN page THEN 'd.example' END) WHEN have THEN 'a.example B.example' ELSE '' END AS scripts,
  concat_ws(' ', CASE WHEN part THEN '/in' END, CASE WHEN have THEN '/pay' END) AS cashier, concat_ws(' ', CASE WHEN have OR part THEN 'alpha' END, CASE WHEN part THEN 'Beta' END, CASE WHEN have THEN 'Zed' END) AS footer,
  CASE WHEN page THEN 'casino grand town' ELSE '' END AS titles
FROM f
"""

# ---------------------------------------------------------------- pairs of domains and of entities


def domain_affiliations(spark, sf):
    """Certificate names, nameservers and mail hosts that two domains share."""
    k = F.col("s_suppkey")
    name = lambda x: F.concat(F.lit("d"), F.lpad(x.cast("string"), 9, "0"), F.lit(".example"))
    sans = F.when(k % 4 == 0, F.array(name(k + 1), name(k - 1))).otherwise(F.array(name(k + 1), name(k)))
    rows = _t(spark, sf, "supplier").select(
        name(k).alias("domain"),
        sans.alias("sans"),
        F.array(
            F.concat(F.lit("NS"), (k % 25).cast("string"), F.lit(".host.example")),
            F.lit("x.cloudflare.com"),
        ).alias("nameservers"),
        F.array(
            F.struct(
                F.concat(F.lit("mx"), (k % 30).cast("string"), F.lit(".example")).alias("host"),
                F.lit(1).alias("priority"),
            )
        ).alias("mx"),
        (k % 11 == 0).alias("tls_partial"),
        F.lit(False).alias("dns_partial"),
    )
    return affiliations.domain_affiliations(rows, shown=affiliations.worded)


def _label(x: str) -> str:
    return f"CASE WHEN {x} >= 80 THEN 'likely_same_network' WHEN {x} >= 50 THEN 'strong_affiliation' WHEN {x} >= 25 THEN 'possible_affiliation' ELSE 'weak_signal' END"


SQL_DOMAINS = f"""
WITH d AS (SELECT s_suppkey AS k, 'd' || lpad(s_suppkey::VARCHAR, 9, '0') || '.example' AS n, s_suppkey % 11 = 0 AS part FROM supplier),
p AS (
  SELECT a.n AS l, b.n AS r, CASE WHEN b.k = a.k + 1 AND NOT a.part AND NOT b.part THEN CASE WHEN b.k % 4 = 0 THEN 15 ELSE 7 END ELSE 0 END AS san, a.k % 25 = b.k % 25 AS ns, a.k % 30 = b.k % 30 AS mx, a.k
  FROM d a JOIN d b ON a.k < b.k AND (b.k = a.k + 1 OR a.k % 25 = b.k % 25 OR a.k % 30 = b.k % 30)
),
q AS (SELECT *, (san + CASE WHEN ns THEN 5 ELSE 0 END + CASE WHEN mx THEN 4 ELSE 0 END)::INTEGER AS score FROM p)
SELECT l AS "left", r AS "right", score, {_label("score")} AS label, concat_ws(';', CASE WHEN mx THEN 'shared_mx_filtered:mx' || (k % 30) || '.example:4' END, CASE WHEN ns THEN 'shared_nameserver_filtered:ns' || (k % 25) || '.host.example:5' END,
  CASE san WHEN 7 THEN 'tls_san_one_way:' || l || '|' || r || '|one_way_san:7' WHEN 15 THEN 'tls_san_reciprocal:' || l || '|' || r || '|reciprocal_san:15' END) AS evidence
FROM q WHERE score > 0
"""


def entity_affiliations(spark, sf):
    """All nine signals that two entities can share."""
    k = F.col("s_suppkey")
    mod = lambda p, n: F.concat(F.lit(p), (k % n).cast("string"))
    sup = _t(spark, sf, "supplier").withColumn("id", F.concat(F.lit("e"), F.lpad(k.cast("string"), 9, "0")))
    attributes = F.struct(
        F.when(k % 3 == 0, F.concat(F.lit(" Corp "), mod("", 40))).alias("legal_entity"),
        F.array(mod(" P", 35)).alias("provider_names"),
    )
    entities = sup.select(
        "id",
        F.col("s_name").alias("name"),
        F.lit("operator").alias("entity_type"),
        F.when(k % 11 == 0, "inactive").otherwise("active").alias("status"),
        attributes.alias("attributes"),
        k.alias("ordinal"),
    )
    prints = seeds.empty_fingerprints(
        sup.select("id", "s_suppkey").withColumnRenamed("id", "entity_id").select("entity_id"),
        "entity_id",
    )
    prints = prints.join(sup.select(F.col("id").alias("entity_id"), "s_suppkey"), "entity_id")
    tech = F.col("technical").withField("analytics_ids", F.array(mod("UA-", 45))).withField(
        "script_domains", F.array(mod("CDN", 55)),
    ).withField("registrar", mod("R", 28)).withField("nameservers", F.array(mod("ns", 33)))
    prints = prints.select(
        "entity_id",
        tech.alias("technical"),
        "content",
        F.col("flow").withField("cashier_paths", F.array(mod("/C", 50))).alias("flow"),
        "provider_signals",
    )
    edges = sup.select(
        F.col("id").alias("from_id"),
        mod("prov", 30).alias("to_id"),
        F.lit("uses_provider").alias("relationship"),
    ).unionByName(
        sup.select(
            mod("prom", 32).alias("from_id"),
            F.col("id").alias("to_id"),
            F.lit("promotes").alias("relationship"),
        )
    )
    return affiliations.entity_affiliations(entities, prints, edges, shown=affiliations.worded)


SQL_ENTITY_PAIRS = f"""
WITH s AS (SELECT s_suppkey AS k, 'e' || lpad(s_suppkey::VARCHAR, 9, '0') AS id FROM supplier WHERE s_suppkey % 11 <> 0),
p AS (
  SELECT a.id AS l, b.id AS r, a.k, a.k % 3 = 0 AND b.k % 3 = 0 AND a.k % 40 = b.k % 40 AS legal, a.k % 45 = b.k % 45 AS ids, a.k % 35 = b.k % 35 AS prov, a.k % 30 = b.k % 30 AS edge, a.k % 50 = b.k % 50 AS flow, a.k % 55 = b.k % 55 AS script,
    a.k % 32 = b.k % 32 AS prom, a.k % 28 = b.k % 28 AS reg, a.k % 33 = b.k % 33 AS ns FROM s a JOIN s b ON a.k < b.k
),
q AS (
  SELECT *, least(100, CASE WHEN legal THEN 50 ELSE 0 END + CASE WHEN ids THEN 40 ELSE 0 END + CASE WHEN prov OR edge THEN 20 ELSE 0 END + CASE WHEN flow THEN 15 ELSE 0 END + CASE WHEN script THEN 10 ELSE 0 END + CASE WHEN prom THEN 10 ELSE 0 END + CASE WHEN reg OR ns THEN 5 ELSE 0 END)::INTEGER AS score FROM p
)
SELECT l AS "left", r AS "right", score, {_label("score")} AS label, concat_ws(';', CASE WHEN legal THEN 'shared_legal_entity:Corp ' || (k % 40) || ':50' END, CASE WHEN ids THEN 'shared_analytics_or_tag:UA-' || (k % 45) || ':40' END,
  CASE WHEN prov THEN 'shared_provider:p' || (k % 35) || ':20' WHEN edge THEN 'shared_provider:prov' || (k % 30) || ':20' END, CASE WHEN flow THEN 'shared_cashier_pattern:/c' || (k % 50) || ':15' END,
  CASE WHEN script THEN 'shared_script_cdn_or_widget:cdn' || (k % 55) || ':10' END, CASE WHEN prom THEN 'shared_promoter_cluster:prom' || (k % 32) || ':10' END,
  CASE WHEN reg THEN 'shared_registrar:r' || (k % 28) || ':5' WHEN ns THEN 'shared_nameserver:ns' || (k % 33) || ':5' END) AS evidence
FROM q WHERE score > 0
"""

# ---------------------------------------------------------------- crawling

_OUTLINKS = "concat('<a href=\"https://Casino', page_id % 7, '.example/x\">a</a><a href=\"http://known', page_id % 5, '.example\">b</a><a href=\"https://best-review', page_id % 3, '.example/r\">c</a>')"


def _monitored(spark, sf) -> tuple[DataFrame, DataFrame]:
    pages = _t(spark, sf, "pages").select(
        F.col("page_id").alias("ordinal"),
        "url",
        F.concat("html", F.expr(_OUTLINKS)).alias("html"),
    )
    k = F.col("r_regionkey")
    known = _t(spark, sf, "region").where("r_regionkey < 4").select(
        F.concat(F.lit("k"), k.cast("string")).alias("id"),
        F.col("r_name").alias("name"),
        F.expr(_pick("r_regionkey", ("operator", "promoter", "provider", "payment_path"))).alias("entity_type"),
        F.array(F.concat(F.lit("known"), k.cast("string"), F.lit(".example"))).alias("domains"),
        k.cast("long").alias("ordinal"),
    )
    own = pages.groupBy(
        monitor_host(F.col("url")).alias("h")
    ).agg(F.min("ordinal").alias("ordinal")).where("length(h) % 2 = 0").select(
        F.concat(F.lit("h:"), "h").alias("id"),
        F.col("h").alias("name"),
        F.lit("promoter").alias("entity_type"),
        F.array("h").alias("domains"),
        (F.col("ordinal") + 100).alias("ordinal"),
    )
    return crawl.monitor(pages, known.unionByName(own), RUN, "run1")


def monitor_candidates(spark, sf):
    """Unknown hosts that monitored pages link to, with their sightings."""
    c, _ = _monitored(spark, sf)
    return c.select(
        "domain",
        F.array_join("suggested_types", " ").alias("types"),
        "bucket",
        F.size("seen_on_urls").alias("n_urls"),
        F.get("seen_on_urls", F.lit(0)).alias("first_url"),
        "first_seen",
        "confidence",
    )


def monitor_edges(spark, sf):
    """Edges between known entities, by the links of their pages."""
    _, e = _monitored(spark, sf)
    return e.groupBy("from_id", "to_id", "relationship", "confidence", "source").agg(F.count("*").alias("n"))


_HOST = "regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:@]*)', 1)), '^www[.]', '')"
_SQL_LINKS = f"""
p AS (SELECT page_id, url, {_HOST} AS host FROM pages),
l AS (SELECT page_id, url, host, 'casino' || (page_id % 7) || '.example' AS link FROM p UNION ALL SELECT page_id, url, host, 'known' || (page_id % 5) || '.example' FROM p UNION ALL SELECT page_id, url, host, 'best-review' || (page_id % 3) || '.example' FROM p)"""
SQL_CANDIDATES = f"""
WITH {_SQL_LINKS.strip()}
SELECT link AS domain, CASE WHEN starts_with(link, 'casino') THEN 'operator promoter unknown' WHEN starts_with(link, 'best') THEN 'promoter unknown' ELSE 'unknown' END AS types, CASE WHEN starts_with(link, 'best') THEN 'promoters' ELSE 'operators' END AS bucket,
  count(DISTINCT url)::INTEGER AS n_urls, min_by(url, page_id) AS first_url, '{RUN}' AS first_seen, 0.35::DOUBLE AS confidence
FROM l WHERE NOT regexp_matches(link, '^known[0-3][.]') GROUP BY link
"""
SQL_EDGES = f"""
WITH {_SQL_LINKS.strip()}
SELECT 'h:' || host AS from_id, 'k' || (page_id % 5) AS to_id, CASE WHEN page_id % 5 = 0 THEN 'promotes' ELSE 'links_to' END AS relationship, (CASE WHEN page_id % 5 = 0 THEN 0.55 ELSE 0.45 END)::DOUBLE AS confidence, 'monitor_run1' AS source, count(*) AS n
FROM l WHERE regexp_matches(link, '^known[0-3][.]') AND length(host) % 2 = 0 GROUP BY ALL
"""


def extracted_pages(spark, sf):
    """Signals and contact data of each page."""
    rows = _tailed(spark, sf).drop("page").select(
        "url",
        F.when(F.col("page_id") % 4 == 0, "").otherwise(F.col("url")).alias("final_url"),
        F.when(F.col("page_id") % 5 == 0, 403).when(F.col("page_id") % 5 == 1, -1).otherwise(200).alias("status"),
        F.concat("html", F.lit(" mail Info@x.example or info@x.example")).alias("html"),
    )
    got = crawl.extract(rows, ["The"])
    return got.select(
        "domain",
        "source_url",
        "final_url",
        "http_status",
        "review_status",
        "evidence_tier",
        F.size("legal_policy_urls").alias("n_legal"),
        F.array_join("support_help_urls", " ").alias("support"),
        F.array_contains("contact_emails", "Info@x.example").alias("mail"),
        F.array_join("fingerprint.technical.support_widget_providers", " ").alias("widgets"),
    )


SQL_EXTRACTED = f"""
WITH hrefs AS (
  SELECT page_id, regexp_extract(url, '^https?://[^/?#]*', 0) AS root, unnest(regexp_extract_all(html || {_pick("page_id", _TAILS)}, '<a [^>]*href=["'']([^"'']*)["'']', 1)) AS href FROM pages
),
l AS (SELECT page_id, CASE WHEN regexp_matches(href, '^[a-z]+:') THEN href ELSE root || href END AS link FROM (SELECT page_id, root, trim(href) AS href FROM hrefs) WHERE href <> '' AND NOT starts_with(href, '#') AND NOT contains(lower(href), 'javascript:')),
g AS (SELECT page_id, count(DISTINCT lower(link)) FILTER (WHERE regexp_matches(link, '(?i)(terms|privacy|sweep|rules|policy|legal|responsible|eula|conditions)')) AS n FROM l GROUP BY page_id)
SELECT {_HOST} AS domain, url AS source_url, CASE WHEN p.page_id % 4 = 0 THEN '' ELSE url END AS final_url, CASE WHEN p.page_id % 5 = 0 THEN 403 ELSE 200 END::INTEGER AS http_status, 'needs_review' AS review_status, '{t.INFERRED}' AS evidence_tier, coalesce(n, 0)::INTEGER AS n_legal,
  CASE WHEN p.page_id % 6 = 4 THEN 'https://acme.zendesk.com/hc' ELSE '' END AS support, true AS mail, CASE p.page_id % 6 WHEN 0 THEN 'intercom' WHEN 4 THEN 'drift' ELSE '' END AS widgets
FROM pages p LEFT JOIN g ON g.page_id = p.page_id WHERE p.page_id % 5 <> 1
"""


def crawl_seeds(spark, sf):
    """A crawl of the first page of each host, with denied hosts, that takes no further pages."""
    pages = _t(spark, sf, "pages").select("page_id", "url", F.concat("html", F.expr(_OUTLINKS)).alias("html"))
    seeds_ = pages.groupBy(monitor_host(F.col("url")).alias("h")).agg(
        F.min_by("url", "page_id").alias("url"),
        F.min("page_id").alias("ordinal"),
    )
    deny = spark.createDataFrame([("casino3.example",), ("known1.example",)], "host string")
    domains, _ = crawl.discover(seeds_.select("url", "ordinal"), pages.select("url", "html"), max_depth=0, deny=deny)
    return domains.select(
        "domain",
        F.size("source_urls").alias("n_sources"),
        F.array_join("redirect_chain", " ").alias("chain"),
    )


SQL_CRAWL = f"""
WITH p AS (SELECT page_id, url, html, {_HOST} AS host FROM pages),
s AS (SELECT host, min(page_id) AS page_id, min_by(url, page_id) AS url FROM p GROUP BY host),
own AS (SELECT url, min(html) AS html FROM pages GROUP BY url),
l AS (
  SELECT 'casino' || (page_id % 7) || '.example' AS domain, url FROM s UNION ALL SELECT 'known' || (page_id % 5) || '.example', url FROM s UNION ALL SELECT 'best-review' || (page_id % 3) || '.example', url FROM s UNION ALL SELECT host, url FROM s
)
SELECT domain, count(DISTINCT url)::INTEGER AS n_sources, coalesce(max(CASE WHEN domain IN (SELECT host FROM s) THEN url END), '') AS chain FROM l WHERE domain NOT IN ('casino3.example', 'known1.example') GROUP BY domain
"""


def bounded_crawl(spark, sf):
    """A crawl from the first page of each site, whose pages each link to the next one, up to the cap of pages."""
    k, host = F.col("c_custkey"), F.concat(F.lit("h"), (F.col("c_custkey") % 97).cast("string"), F.lit(".example"))
    url = F.concat(F.lit("https://"), host, F.lit("/"), k.cast("string"))
    after = F.concat(F.lit("/"), (k + 97).cast("string"))
    html = F.concat(
        F.lit('<a href="'),
        after,
        F.lit('">n</a><a href="mailto:x@y.example">m</a><a href="https://out'),
        (k % 13).cast("string"),
        F.lit('.example/">o</a>'),
    )
    pages = _t(spark, sf, "customer").select(url.alias("url"), html.alias("html"), k.alias("k"))
    start = pages.where("k < 97").select("url", F.col("k").alias("ordinal"))
    domains, visits = crawl.discover(start, pages.select("url", "html"), max_depth=1, max_same_host_pages=6)
    seen = visits.where("http_status = 200").groupBy(
        monitor_host(F.col("requested_url")).alias("domain")
    ).agg(F.count("*").alias("n_pages"))
    return domains.join(seen, "domain", "left").select(
        "domain",
        F.size("source_urls").alias("n_sources"),
        F.coalesce("n_pages", F.lit(0).cast("long")).alias("n_pages"),
    )


SQL_SITES = """
WITH p AS (SELECT c_custkey AS k, c_custkey % 97 AS h, c_custkey // 97 AS i FROM customer), v AS (SELECT * FROM p WHERE i <= 6),
a AS (SELECT 'h' || h || '.example' AS domain, count(*) AS n FROM v GROUP BY h), b AS (SELECT 'out' || (k % 13) || '.example' AS domain, count(DISTINCT h)::INTEGER AS n FROM v GROUP BY 1)
SELECT domain, 1::INTEGER AS n_sources, n AS n_pages FROM a UNION ALL SELECT domain, n, 0 FROM b
"""

# ---------------------------------------------------------------- imports, staging, promotion

_IMPORT = {
    "Primary_Domain": "CASE WHEN c_custkey % 8 = 0 THEN '' ELSE concat('C', c_custkey % 400, '.example/x ') END",
    "domain": "concat('alt', c_custkey, '.example')",
    "alias_domains": "CASE WHEN c_custkey % 3 = 0 THEN ' a.example ' ELSE '' END",
    "notes": "CASE c_custkey % 4 WHEN 0 THEN 'official site' WHEN 1 THEN 'reported x' WHEN 2 THEN 'blocked' ELSE '' END",
    "score": "CASE c_custkey % 5 WHEN 0 THEN 'high' WHEN 1 THEN '0.3' WHEN 2 THEN 'low' WHEN 3 THEN '0.75' ELSE '' END",
    "conf": "CASE WHEN c_custkey % 2 = 0 THEN '0.6' ELSE 'x' END",
    "merge_group_id": "CASE WHEN c_custkey % 6 = 0 THEN '' ELSE concat('g', c_custkey % 90) END",
    "canonical": "CASE WHEN c_custkey % 50 = 7 THEN 'Yes' ELSE 'no' END",
    "name": "c_name",
    "ordinal": "c_custkey",
}


def _imported(spark, sf) -> DataFrame:
    hint = {"operator": 0, "promoter": 1, "corporate": 2}
    out = None
    for name, rest in hint.items():
        part = staging.candidate_entities(
            _made(spark, sf, "customer", **_IMPORT).where(f"ordinal % 3 = {rest}"),
            name,
            f"{name}.csv",
            f"scout_{name}",
        )
        out = part if out is None else out.unionByName(part)
    return out


def import_candidates(spark, sf):
    """Candidates of three files, by whatever name their columns go."""
    return _imported(spark, sf).select(
        "candidate_id",
        "evidence_tier",
        "entity_type_hint",
        "is_canonical_candidate",
        "duplicate_group_id",
        "domain",
        "brand",
        "other_domains",
        "confidence",
        "alias_review_status",
        F.element_at("raw_row", "name").alias("raw_name"),
    )


_SQL_IMPORT = f"""
c AS (
  SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN 'operator' WHEN 1 THEN 'promoter' ELSE 'corporate' END AS hint, CASE c_custkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS tier,
    CASE c_custkey % 5 WHEN 0 THEN 0.92 WHEN 1 THEN 0.3 WHEN 2 THEN NULL WHEN 3 THEN 0.75 ELSE CASE WHEN c_custkey % 2 = 0 THEN 0.6 END END::DOUBLE AS sure, c_custkey % 3 = 0 AS alias, CASE WHEN c_custkey % 6 = 0 THEN '' ELSE 'g' || (c_custkey % 90) END AS gid, c_custkey % 50 = 7 AS canon, c_name AS name FROM customer
),
m AS (SELECT *, printf('scout_%s_%04d', hint, k) AS id, (['{t.FIRST}', '{t.SECONDARY}', '{t.INFERRED}'])[CASE WHEN sure >= 0.9 AND tier = 3 THEN 2 WHEN sure < 0.5 THEN 3 ELSE tier END] AS evidence_tier FROM c)"""
SQL_IMPORT = f"""
WITH {_SQL_IMPORT.strip()}
SELECT id AS candidate_id, evidence_tier, hint AS entity_type_hint, canon AS is_canonical_candidate, gid AS duplicate_group_id, CASE WHEN k % 8 = 0 THEN 'alt' || k || '.example' ELSE 'c' || (k % 400) || '.example' END AS domain, name AS brand, CASE WHEN alias THEN 'a.example' ELSE '' END AS other_domains, sure AS confidence,
  CASE WHEN alias THEN 'needs_manual_verification' ELSE 'not_applicable' END AS alias_review_status, name AS raw_name FROM m
"""


def import_duplicates(spark, sf):
    """Numbered edges from the members of a duplicate group to its flagged or first member."""
    edges = staging.duplicate_edges(_imported(spark, sf).withColumn("ordinal", F.col("scout_row_index")), ["ordinal"])
    return staging.numbered(edges, ["ordinal"]).select(
        "relationship_id", "from_candidate_id", "to_candidate_id", "duplicate_group_id",
    )


SQL_DUPLICATES = f"""
WITH {_SQL_IMPORT.strip()},
r AS (SELECT *, first_value(id) OVER (PARTITION BY gid ORDER BY CASE WHEN canon THEN 0 ELSE 1 END, k) AS head FROM m WHERE gid <> '')
SELECT printf('{t.DUPLICATE_ID}', row_number() OVER (ORDER BY gid, k)) AS relationship_id, id AS from_candidate_id, head AS to_candidate_id, gid AS duplicate_group_id FROM r WHERE id <> head
"""


def import_review(spark, sf):
    """The default policy on imported candidates."""
    return staging.import_actions(_imported(spark, sf)).select("candidate_id", "action", "reason")


SQL_REVIEW = f"""
WITH {_SQL_IMPORT.strip()},
w AS (SELECT id, CASE WHEN hint = 'corporate' AND alias THEN 'm corporate_has_other_domains_unusual' WHEN hint = 'corporate' THEN 'p corporate_usually_safe_to_promote' WHEN hint = 'promoter' THEN 's promoter_stage_only_by_default' WHEN alias THEN 'm other_domains_not_verified_aliases'
  WHEN sure >= 0.85 THEN 'p operator_primary_only_high_confidence' WHEN sure >= 0.7 THEN 's operator_primary_moderate_confidence' ELSE 's operator_primary_low_or_missing_confidence' END AS x FROM m)
SELECT id AS candidate_id, CASE x[1] WHEN 'm' THEN 'needs_manual_verification' WHEN 'p' THEN 'safe_to_promote_now' ELSE 'stage_only' END AS action, 'policy:' || x[3:] AS reason FROM w
"""


def import_counts(spark, sf):
    """One row of counts over the import."""
    ents = _imported(spark, sf).withColumn("ordinal", F.col("scout_row_index"))
    return staging.import_summary(ents, staging.import_actions(ents), staging.duplicate_edges(ents, ["ordinal"]))


SQL_IMPORT_COUNTS = f"""
WITH {_SQL_IMPORT.strip()},
d AS (SELECT gid, count(*) - 1 AS n FROM m WHERE gid <> '' GROUP BY gid)
SELECT count(*) AS entities, count_if(alias)::BIGINT AS with_aliases, count(DISTINCT CASE WHEN gid <> '' THEN gid END) AS duplicate_groups, count_if(canon)::BIGINT AS canonical,
  count_if((hint = 'corporate' AND NOT alias) OR (hint = 'operator' AND NOT alias AND coalesce(sure >= 0.85, false)))::BIGINT AS safe_to_promote_now, count_if(hint = 'promoter' OR (hint = 'operator' AND NOT alias AND NOT coalesce(sure >= 0.85, false)))::BIGINT AS stage_only,
  count_if(hint <> 'promoter' AND alias)::BIGINT AS needs_manual_verification, (SELECT sum(n) FROM d)::BIGINT AS duplicate_edges FROM m
"""

_RESEARCH = {
    "ordinal": "c_custkey",
    "domain": "CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat('Shop', c_custkey, '.example') END",
    "brand": "CASE WHEN c_custkey % 14 = 0 THEN '' ELSE c_name END",
    "legal_entity": "c_mktsegment",
    "jurisdiction": "'MT'",
    "notes": "CASE c_custkey % 3 WHEN 0 THEN 'official terms' WHEN 1 THEN 'news article' ELSE 'likely x' END",
    "sources": "CASE WHEN c_custkey % 2 = 0 THEN 'a|b' ELSE 'c' END",
    "analytics_ids": "'UA-1| UA-2'",
    "cashier_path": "CASE WHEN c_custkey % 5 = 0 THEN '/pay' ELSE '' END",
    "provider_mentions": "'P1|P2'",
}


def _staged(spark, sf) -> tuple[DataFrame, DataFrame]:
    entities, prints = staging.stage(_made(spark, sf, "customer", **_RESEARCH))
    return entities.withColumn(
        "review_status",
        F.when(F.col("ordinal") % 4 == 0, "approved").otherwise("needs_review"),
    ), prints


def promotion_operators(spark, sf):
    """What approval of staged entities would add."""
    entities, prints = _staged(spark, sf)
    none = spark.createDataFrame(
        [],
        "from_candidate_id string, to_candidate_id string, relationship string, confidence double, source string, review_status string",
    )
    return staging.promotion_preview(entities, prints, none)[0]


_SQL_RESEARCH = f"""
r AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'Shop' || c_custkey || '.example' END AS domain, c_name, c_mktsegment AS legal, CASE c_custkey % 3 WHEN 0 THEN 'official terms' WHEN 1 THEN 'news article' ELSE 'likely x' END AS notes, CASE WHEN c_custkey % 2 = 0 THEN 'a|b' ELSE 'c' END AS sources,
    (['{t.FIRST}', '{t.SECONDARY}', '{t.INFERRED}'])[c_custkey % 3 + 1] AS tier, (['0.85', '0.78', '0.55'])[c_custkey % 3 + 1] AS cap, printf('research_%04d', c_custkey) AS id, CASE WHEN c_custkey % 7 = 0 THEN 'operator_unknown' ELSE 'operator_shop' || c_custkey || '_example' END AS op
  FROM customer WHERE c_custkey % 14 <> 0
)"""
SQL_PROMOTION = f"""
WITH {_SQL_RESEARCH.strip()}
SELECT op AS id, c_name AS name, domain, '' AS categories, 'inactive' AS status, cap AS confidence, legal AS legal_entity, 'MT' AS jurisdictions, 'P1|P2' AS provider_names, '[research_promote tier=' || tier || '] ' || notes AS notes, sources FROM r WHERE k % 4 = 0
"""


def promotion_fingerprints(spark, sf):
    entities, prints = _staged(spark, sf)
    none = spark.createDataFrame(
        [],
        "from_candidate_id string, to_candidate_id string, relationship string, confidence double, source string, review_status string",
    )
    return staging.promotion_preview(entities, prints, none)[1].select(
        "entity_id", "analytics_ids", "legal_entity_names", "provider_mentions", "cashier_paths",
    )


SQL_PROMOTION_PRINTS = f"""
WITH {_SQL_RESEARCH.strip()}
SELECT op AS entity_id, 'UA-1|UA-2' AS analytics_ids, legal AS legal_entity_names, 'P1|P2' AS provider_mentions, CASE WHEN k % 5 = 0 THEN '/pay' ELSE '' END AS cashier_paths FROM r WHERE k % 4 = 0
"""


def promotion_edges(spark, sf):
    """Approved relationships between approved candidates."""
    entities, prints = _staged(spark, sf)
    k = F.col("c_custkey")
    ident = lambda x: F.format_string("research_%04d", x)
    rels = _t(spark, sf, "customer").select(
        ident(k).alias("from_candidate_id"),
        ident(k + 4).alias("to_candidate_id"),
        F.lit("related_to").alias("relationship"),
        F.when(k % 8 == 0, 0.7).alias("confidence"),
        F.lit("s").alias("source"),
        F.when(k % 3 > 0, "approved").otherwise("x").alias("review_status"),
    )
    return staging.promotion_preview(entities, prints, rels)[2]


SQL_PROMOTION_EDGES = f"""
WITH {_SQL_RESEARCH.strip()}
SELECT a.op AS from_operator_id, b.op AS to_operator_id, 'related_to' AS relationship, CASE WHEN a.k % 8 = 0 THEN '0.7' ELSE '0.6' END AS confidence, 's' AS source, a.id AS from_candidate_id, b.id AS to_candidate_id, 'approved' AS review_status
FROM r a JOIN r b ON b.k = a.k + 4 WHERE a.k % 4 = 0 AND a.k % 3 > 0
"""

_DUMP = {
    "ordinal": "s_suppkey",
    "left": "concat(' SHOP', s_suppkey * 2, '.example')",
    "to_domain": "CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE concat('shop', s_suppkey, '.example') END",
    "relationship": "CASE WHEN s_suppkey % 3 = 0 THEN ' ' ELSE 'sibling' END",
    "confidence": "CASE WHEN s_suppkey % 2 = 0 THEN 0.8 END",
    "notes": "CASE WHEN s_suppkey % 4 = 0 THEN 'official terms' END",
    "sources": "'x'",
}


def dump_edges(spark, sf):
    """An external dump of affiliations, its ends looked up among staged candidates."""
    entities, _ = _staged(spark, sf)
    dump = files.dump_rows(_made(spark, sf, "supplier", **_DUMP))
    return staging.resolved_dump(dump, entities).select(
        "import_id", "from_candidate_id", "to_candidate_id", "from_domain", "to_domain", "relationship", "confidence",
        "evidence_tier", "resolution_status",
    )


SQL_DUMP = f"""
WITH {_SQL_RESEARCH.strip()},
i AS (SELECT lower(domain) AS d, max_by(id, k) AS id FROM r GROUP BY 1),
x AS (SELECT s_suppkey AS k, 'SHOP' || (s_suppkey * 2) || '.example' AS f, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'shop' || s_suppkey || '.example' END AS t FROM supplier)
SELECT printf('{t.DUMP_ID}', x.k) AS import_id, a.id AS from_candidate_id, b.id AS to_candidate_id, f AS from_domain, t AS to_domain, CASE WHEN x.k % 3 = 0 THEN 'related_to' ELSE 'sibling' END AS relationship, (CASE WHEN x.k % 2 = 0 THEN 0.8 ELSE 0.5 END)::DOUBLE AS confidence,
  CASE WHEN x.k % 4 = 0 THEN '{t.FIRST}' ELSE '{t.INFERRED}' END AS evidence_tier, CASE WHEN a.id IS NOT NULL AND b.id IS NOT NULL THEN 'resolved' ELSE 'unresolved_domain' END AS resolution_status
FROM x LEFT JOIN i a ON a.d = lower(f) LEFT JOIN i b ON b.d = t
"""

# ---------------------------------------------------------------- clusters and review


def cluster_edges(spark, sf):
    """Evidence edges of every source."""
    k = F.col("s_suppkey")
    text = lambda p, x, s="": F.concat(F.lit(p), x.cast("string"), F.lit(s))
    sup = _t(spark, sf, "supplier")
    domain = text(" S", k, ".example")
    entities = sup.select(
        text("e", k).alias("id"),
        F.array(domain).alias("domains"),
        F.struct(
            F.when(k % 2 == 0, text("Legal  ", k % 40)).alias("legal_entity"),
            F.when(k % 5 == 0, text("PARENT ", k % 30)).alias("parent_company"),
        ).alias("attributes"),
        k.alias("ordinal"),
    )
    prints = sup.select(
        text("e", k).alias("entity_id"),
        F.struct(
            F.array(text("cdn", k % 50), text("js", k % 50)).alias("script_domains"),
            F.array(text("fr", k % 25)).alias("iframe_domains"),
            F.array(F.lit("all.example")).alias("asset_domains"),
        ).alias("technical"),
    )
    staged = sup.where("s_suppkey % 10 = 1").select(
        text("t", k, ".example").alias("domain"),
        text("legal ", (k + 1) % 40).alias("legal_entity"),
        F.lit("").alias("parent_company"),
        k.alias("ordinal"),
    )
    dump = sup.where("s_suppkey % 20 = 3").select(
        text("s", k, ".example").alias("from_domain"),
        text("S", k + 1, ".EXAMPLE").alias("to_domain"),
        F.lit("x").alias("relationship"),
        F.lit(None).cast("string").alias("notes"),
    )
    staged_edges = sup.where("s_suppkey % 20 = 5").select(
        F.lit("x").alias("relationship_type"),
        F.create_map(
            F.lit("note"),
            F.concat(text("see U", k, ".Example, "), text("s", k, ".example and "), text("v", k, ".example ")),
        ).alias("raw_row"),
    )
    mutual = sup.where("s_suppkey % 20 = 6").select(
        text("s", k, ".example").alias("left"),
        text("w", k, ".example").alias("right"),
        F.when(k % 40 == 6, "tls_san_reciprocal").otherwise("tls_san_one_way").alias("type"),
    )
    pages = sup.where("s_suppkey % 20 < 2").select(
        text("P", k, ".example").alias("domain"),
        F.struct(
            F.struct(
                F.array(text("h", k % 3), text("i", k % 3)).alias("script_domains"),
                F.array(text("j", k % 3)).alias("iframe_domains"),
                F.array(F.lit("all.example")).alias("asset_domains"),
            ).alias("technical")
        ).alias("fingerprint"),
    )
    discovered = sup.where("s_suppkey % 20 = 4").select(
        F.array(text("https://www.s", k, ".example:8/x"), text("http://r", k, ".example")).alias("redirect_chain")
    )
    edges = cluster.evidence_edges(
        entities,
        prints,
        staged=staged,
        extracted=pages,
        staged_edges=staged_edges,
        dump=dump,
        discovered=discovered,
        san_pairs=mutual,
        min_script_overlap=3,
    )
    return edges.select("left", "right", "reason")


SQL_CLUSTER_EDGES = """
WITH s AS (SELECT s_suppkey AS k, 's' || s_suppkey || '.example' AS d FROM supplier),
legal AS (SELECT k, d, first_value(d) OVER (PARTITION BY k % 40 ORDER BY k) AS h FROM s WHERE k % 2 = 0),
parent AS (SELECT k, d, first_value(d) OVER (PARTITION BY k % 30 ORDER BY k) AS h FROM s WHERE k % 5 = 0),
st AS (SELECT k, 't' || k || '.example' AS d, (k + 1) % 40 AS l FROM s WHERE k % 10 = 1),
sl AS (SELECT d, first_value(d) OVER (PARTITION BY l ORDER BY k) AS h FROM st),
e AS (
  SELECT d AS a, h AS b, 'same_legal_entity_normalized' AS reason FROM legal UNION ALL SELECT d, h, 'same_parent_company_normalized' FROM parent
  UNION ALL SELECT x.d, y.d, 'script_domain_overlap' FROM s x JOIN s y ON x.k < y.k AND x.k % 25 = y.k % 25 WHERE x.k % 50 = y.k % 50
  UNION ALL SELECT d, h, 'staged_same_legal_entity' FROM sl
  UNION ALL SELECT st.d, s.d, 'staged_legal_entity_match_normalized' FROM st JOIN s ON s.k % 2 = 0 AND s.k % 40 = st.l
  UNION ALL SELECT d, 's' || (k + 1) || '.example', 'affiliation_dump_pair' FROM s WHERE k % 20 = 3
  UNION ALL SELECT d, 'r' || k || '.example', 'discovery_redirect_chain' FROM s WHERE k % 20 = 4
  UNION ALL SELECT 's' || k || '.example', 'u' || k || '.example', 'staged_relationship_domain_cooccurrence' FROM s WHERE k % 20 = 5
  UNION ALL SELECT 's' || k || '.example', 'v' || k || '.example', 'staged_relationship_domain_cooccurrence' FROM s WHERE k % 20 = 5
  UNION ALL SELECT d, 'w' || k || '.example', 'scout_tls_san_reciprocal' FROM s WHERE k % 40 = 6
  UNION ALL SELECT 'p' || x.k || '.example', 'p' || y.k || '.example', 'extracted_script_domain_overlap' FROM s x JOIN s y ON x.k < y.k AND x.k % 3 = y.k % 3 WHERE x.k % 20 < 2 AND y.k % 20 < 2
)
SELECT least(a, b) AS "left", greatest(a, b) AS "right", reason FROM e WHERE a <> b
"""


def confirmed_operators(spark, sf):
    """Domains of sure operators, from the seed table and the catalogue."""
    status = ("", "active", "Inactive", "deprecated", "unknown")
    rows = _t(spark, sf, "supplier")
    seeds_ = rows.select(
        F.expr("concat('www.s', s_suppkey, '.example/x| S', s_suppkey, 'b.example')").alias("domain"),
        F.expr(_pick("s_suppkey", status)).alias("status"),
    )
    ents = _t(spark, sf, "customer").select(
        F.array(F.expr("concat('C', c_custkey, '.example.')")).alias("domains"),
        F.expr(_pick("c_custkey", status)).alias("status"),
        F.expr(_pick("c_custkey", ("operator", "provider"))).alias("entity_type"),
    )
    return review.confirmed_domains(seeds_, ents)


SQL_CONFIRMED = """
SELECT 's' || s_suppkey || '.example' AS domain FROM supplier WHERE s_suppkey % 5 < 2 UNION SELECT 's' || s_suppkey || 'b.example' FROM supplier WHERE s_suppkey % 5 < 2
UNION SELECT 'c' || c_custkey || '.example' FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 5 NOT IN (2, 3)
"""


def catalogue_keys(spark, sf):
    """Entities by the parts of their legal names, parent and company number."""
    rows = _made(
        spark,
        sf,
        "customer",
        id="concat('e', c_custkey)",
        l="concat(c_mktsegment, ', Inc.| X  ', c_nationkey)",
        p="concat(' Group ', c_nationkey % 3)",
        n="CASE WHEN c_custkey % 9 = 0 THEN concat('N', c_custkey % 50) ELSE '' END",
    )
    ents = rows.select(
        "id",
        F.struct(
            F.col("l").alias("legal_entity"),
            F.col("p").alias("parent_company"),
            F.col("n").alias("company_number"),
        ).alias("attributes"),
    )
    return review.catalogue_keys(ents).select(
        "kind",
        "key",
        F.size("ids").alias("n"),
        F.get("ids", F.lit(0)).alias("first"),
    )


SQL_CATALOGUE = """
WITH k AS (
  SELECT 'e' || c_custkey AS id, 'legal' AS kind, lower(c_mktsegment) AS key FROM customer UNION ALL SELECT 'e' || c_custkey, 'legal', 'inc.' FROM customer UNION ALL SELECT 'e' || c_custkey, 'legal', 'x ' || c_nationkey FROM customer
  UNION ALL SELECT 'e' || c_custkey, 'parent', 'group ' || (c_nationkey % 3) FROM customer UNION ALL SELECT 'e' || c_custkey, 'number', 'n' || (c_custkey % 50) FROM customer WHERE c_custkey % 9 = 0
)
SELECT kind, key, count(DISTINCT id)::INTEGER AS n, min(id) AS first FROM k GROUP BY kind, key
"""


def _decided(df: DataFrame) -> DataFrame:
    return df.select(
        "record_id",
        "source_type",
        "likely_entity_type",
        F.to_json("field_confidence").alias("fields"),
        "promotion_recommendation",
        "cluster_recommendation",
        "block_recommendation",
        F.array_join("reasoning", ";").alias("reasons"),
    )


_TIERS = (t.FIRST, t.SECONDARY, t.INFERRED, "other")


def relationship_decisions(spark, sf):
    rows = _made(
        spark,
        sf,
        "customer",
        ordinal="c_custkey",
        relationship=_pick("c_custkey", ("Promotes", "affiliate_of", "uses_provider", "owns", "")),
        from_candidate_id="CASE WHEN c_custkey % 6 = 0 THEN '' ELSE concat('a', c_custkey) END",
        to_candidate_id="concat('b', c_nationkey)",
        evidence_tier=_pick("c_custkey", _TIERS),
    )
    return _decided(review.relationship_decisions(rows))


SQL_RELATIONSHIPS = f"""
WITH r AS (SELECT c_custkey AS k, c_nationkey AS n, {_pick("c_custkey", ("promoter", "promoter", "provider", "unknown", "unknown"))} AS kind, (['high', 'medium', 'low', 'low'])[c_custkey % 4 + 1] AS level FROM customer)
SELECT CASE WHEN k % 6 = 0 THEN printf('relationship_%04d', k) ELSE 'a' || k || '->b' || n END AS record_id, 'relationship' AS source_type, kind AS likely_entity_type, '{{"evidence":"' || level || '","relationship":"' || level || '"}}' AS fields, 'stage_only' AS promotion_recommendation,
  'no_cluster_action' AS cluster_recommendation, 'do_not_block' AS block_recommendation, CASE kind WHEN 'promoter' THEN 'rule:relationship_suggests_promoter_edge;' WHEN 'provider' THEN 'rule:relationship_suggests_provider_edge;' ELSE '' END || 'rule:relationship_record_not_domain_blocklist' AS reasons FROM r
"""


def cluster_decisions(spark, sf):
    rows = _made(
        spark,
        sf,
        "customer",
        ordinal="c_custkey",
        cluster_id="concat('cluster-', c_custkey)",
        evidence_tier=_pick("c_custkey", ("", t.FIRST, t.SECONDARY)),
        m="concat('www.S', c_custkey, '.example')",
    )
    rows = rows.withColumn("members", F.array("m", F.concat(F.lit("x"), "m")))
    known = _made(
        spark,
        sf,
        "supplier",
        d="concat(' s', s_suppkey * 3, '.example')",
    ).select(F.array("d").alias("domains"))
    sure = _made(spark, sf, "supplier", domain="concat('s', s_suppkey * 2, '.example')")
    return _decided(review.cluster_decisions(rows, known, sure))


SQL_CLUSTERS = """
WITH r AS (SELECT c_custkey AS k, c_custkey % 3 = 0 AND c_custkey // 3 IN (SELECT s_suppkey FROM supplier) AS known, c_custkey % 2 = 0 AND c_custkey // 2 IN (SELECT s_suppkey FROM supplier) AS sure, (['low', 'high', 'medium'])[c_custkey % 3 + 1] AS level FROM customer)
SELECT 'cluster-' || k AS record_id, 'cluster' AS source_type, 'unknown' AS likely_entity_type, '{"cluster_evidence":"' || level || '"}' AS fields, 'stage_only' AS promotion_recommendation, CASE WHEN known THEN 'attach_to_existing_cluster' ELSE 'create_new_cluster_candidate' END AS cluster_recommendation,
  CASE WHEN known OR sure THEN 'block_after_review' ELSE 'do_not_block' END AS block_recommendation, CASE WHEN known THEN 'rule:cluster_doc_touches_production_domain' ELSE 'rule:cluster_doc_staged_only_members' END || ';' || CASE WHEN known OR sure THEN 'rule:cluster_block_after_review_operator_family' ELSE 'rule:cluster_block_not_operator_family' END AS reasons FROM r
"""


def fingerprint_decisions(spark, sf):
    """Fingerprints without a staged entity."""
    k = F.col("c_custkey")
    one = lambda when, v: F.when(when, F.array(F.lit(v))).otherwise(F.array().cast("array<string>"))
    rows = _t(spark, sf, "customer").select(
        F.concat(F.lit("f"), k.cast("string")).alias("candidate_id"),
        F.expr(_pick("c_custkey", _TIERS)).alias("evidence_tier"),
        F.struct(
            one(k % 2 == 0, "UA").alias("analytics_ids"),
            one(k % 3 == 0, "js").alias("script_domains"),
            one(k % 5 == 0, "w").alias("support_widget_providers"),
        ).alias("technical"),
        F.struct(
            one(k % 7 == 0, "Social Casino").alias("title_terms"),
            one(k % 11 == 0, "top sweeps reviews").alias("footer_phrases"),
            one(k % 13 == 0, "x").alias("provider_mentions"),
        ).alias("content"),
        F.struct(one(k % 4 == 0, "/pay").alias("cashier_paths")).alias("flow"),
    )
    staged = _made(spark, sf, "customer", candidate_id="concat('f', c_custkey * 3)")
    return _decided(review.fingerprint_decisions(rows, staged))


SQL_FINGERPRINTS = """
WITH r AS (
  SELECT c_custkey AS k, 2 * (CASE WHEN c_custkey % 7 = 0 THEN 2 ELSE 0 END + CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END) AS op, 2 * CASE WHEN c_custkey % 11 = 0 THEN 2 ELSE 0 END AS pr, (['high', 'medium', 'low', 'low'])[c_custkey % 4 + 1] AS level
  FROM customer WHERE NOT (c_custkey % 3 = 0 AND c_custkey // 3 IN (SELECT c_custkey FROM customer))
),
m AS (SELECT *, CASE WHEN greatest(op, pr) = 0 THEN 'unknown' WHEN op >= pr THEN 'operator' ELSE 'promoter' END AS kind FROM r)
SELECT 'f' || k AS record_id, 'fingerprint' AS source_type, kind AS likely_entity_type,
  '{"analytics_ids":"' || CASE WHEN k % 2 = 0 THEN level ELSE 'low' END || '","cashier_path":"' || CASE WHEN k % 4 = 0 THEN level ELSE 'low' END || '","provider_mentions":"' || level || '","script_domains":"' || CASE WHEN k % 3 = 0 THEN level ELSE 'low' END || '","support_widget":"' || CASE WHEN k % 5 = 0 THEN level ELSE 'low' END || '"}' AS fields,
  'reject_for_now' AS promotion_recommendation, 'no_cluster_action' AS cluster_recommendation, 'do_not_block' AS block_recommendation,
  concat_ws(';', CASE WHEN op > 0 THEN 'rule:operator_term_hits:' || (op // 2) END, CASE WHEN pr > 0 THEN 'rule:promoter_term_hits:' || (pr // 2) END, CASE WHEN kind = 'unknown' THEN 'rule:insufficient_entity_type_signals' ELSE 'rule:selected_type:' || kind || '_score_' || greatest(op, pr) END,
    'rule:fingerprint_orphan_reject_without_domain', 'rule:fingerprint_no_domain_for_cluster', 'rule:fingerprint_not_a_standalone_block_target') AS reasons FROM m
"""


_NOTES = (
    "Social casino sweeps",
    "best casinos reviews",
    "slot studio x",
    "wallet deposit",
    "Not verified",
    "nothing",
    "poker slots redeem; top sweeps, promo code, affiliate",
    "evidence_only slot studio x",
    "rebrand of casino, 403",
)


def _rules_input(spark, sf) -> dict[str, DataFrame]:
    """Staged candidates with a catalogue, clusters, edges, fingerprints and sure domains to be held against."""
    empty = F.array().cast("array<string>")
    staged = _made(
        spark,
        sf,
        "customer",
        k="c_custkey",
        ordinal="c_custkey",
        rid="c_custkey",
        candidate_id="concat('c', c_custkey)",
        brand="''",
        jurisdiction="''",
        sources="''",
        notes=_pick("c_custkey", _NOTES),
        evidence_tier=_pick("(c_custkey div 3)", _TIERS),
        domain="CASE WHEN c_custkey % 19 = 0 THEN '' WHEN c_custkey % 17 = 0 THEN concat('pending', c_custkey, '.example') ELSE concat('D', c_custkey, '.example') END",
        legal_entity="CASE WHEN c_custkey % 2 = 0 THEN concat('Legal ', c_custkey % 50) ELSE '' END",
        parent_company="CASE WHEN c_custkey % 5 = 0 THEN concat('Par ', c_custkey % 40) ELSE '' END",
        company_number="CASE WHEN c_custkey % 9 = 0 THEN concat('N', c_custkey % 30) ELSE '' END",
    ).withColumn("raw_row", F.create_map(F.lit("entity_type"), F.when(F.col("k") % 29 == 0, "provider").otherwise("")))
    prints = _made(
        spark,
        sf,
        "customer",
        candidate_id="concat('c', c_custkey)",
        ordinal="c_custkey",
    ).where("ordinal % 3 = 0").select(
        "candidate_id",
        "ordinal",
        F.struct(
            F.array(F.lit("UA")).alias("analytics_ids"),
            empty.alias("support_widget_providers"),
        ).alias("technical"),
        F.struct(
            F.array(F.lit("Poker")).alias("title_terms"),
            empty.alias("footer_phrases"),
            empty.alias("provider_mentions"),
        ).alias("content"),
        F.struct(F.array(F.lit("/pay")).alias("cashier_paths")).alias("flow"),
    )
    j = _made(spark, sf, "nation", j="n_nationkey")
    entities = j.select(
        F.concat(F.lit("e"), "j").alias("id"),
        F.array(F.concat(F.lit("d"), (F.col("j") * 6).cast("string"), F.lit(".example"))).alias("domains"),
        F.struct(
            F.concat(F.lit("LEGAL "), "j").alias("legal_entity"),
            F.concat(F.lit("par "), "j").alias("parent_company"),
            F.concat(F.lit("n"), "j").alias("company_number"),
        ).alias("attributes"),
    )
    sup = _made(spark, sf, "supplier", s="s_suppkey")
    text = lambda p, x: F.concat(F.lit(p), x.cast("string"), F.lit(".example"))
    sk = F.col("s")
    proof = F.when(
        sk % 2 == 0,
        F.array(
            F.struct(
                F.array(F.lit("x")).alias("domains"),
                F.lit("discovery_redirect_chain").alias("reason"),
                F.lit("{}").alias("detail"),
            )
        ),
    ).otherwise(F.array().cast("array<struct<domains:array<string>,reason:string,detail:string>>"))
    groups = sup.select(
        sk.alias("ordinal"),
        F.array(text("d", sk * 3), text("x", sk)).alias("members"),
        proof.alias("evidence"),
    )
    sure = sup.where("s % 4 = 0").select(text("x", sk).alias("domain")).unionByName(
        staged.where("k % 23 = 0").select(text("d", F.col("k")).alias("domain"))
    )
    more = _made(spark, sf, "customer", k="c_custkey", n="c_nationkey").where("k % 11 = 0 OR k % 13 = 0")
    edges = more.select(
        F.concat(F.lit("c"), "k").alias("from_candidate_id"),
        F.lit("").alias("from_domain"),
        F.explode(F.array(F.lit("a"), F.lit("b"))).alias("to_candidate_id"),
        F.lit("").alias("to_domain"),
        F.when(F.col("k") % 11 == 0, "promotes").otherwise("uses_provider").alias("relationship"),
    )
    return {"staged": staged, "prints": prints, "entities": entities, "clusters": groups, "sure": sure, "edges": edges}


def entity_decisions(spark, sf):
    """Decisions on staged candidates: type, confidence of fields, promotion, cluster and block rules."""
    x = _rules_input(spark, sf)
    facts = review.cluster_facts(x["clusters"], x["entities"], x["sure"])
    return _decided(
        review.entity_decisions(
            x["staged"],
            x["prints"],
            review.catalogue_keys(x["entities"]),
            facts,
            review.edge_counts(x["edges"]),
            x["sure"],
        )
    )


def _level(present: str, weak: str = "") -> str:
    low = f"CASE WHEN {weak} THEN CASE base WHEN 'high' THEN 'medium' ELSE 'low' END ELSE base END" if weak else "base"
    return f"CASE WHEN {present} THEN {low} ELSE 'low' END"


_FIELDS = (
    ("analytics_ids", _level("fp", "weak"), True),
    ("brand", "'low'", False),
    ("cashier_path", _level("fp", "weak"), True),
    ("company_number", _level("k % 9 = 0"), False),
    ("domain", _level("dom <> '' AND NOT hold"), False),
    ("jurisdiction", "'low'", False),
    ("legal_entity", _level("k % 2 = 0"), False),
    ("parent_company", _level("k % 5 = 0", "weak"), False),
    ("provider_mentions", "'low'", True),
    ("support_widget", "'low'", True),
)
_OP, _PR, _PV, _PAY = (
    [sum(w in n.lower() for w in words) for n in _NOTES]
    for words in (t.OPERATOR_TERMS, t.PROMOTER_TERMS, ("slot studio", "studio "), t.PAYMENT_TERMS)
)


def _at(values, key: str = "c_custkey") -> str:
    return f"([{', '.join(map(str, values))}])[{key} % {len(values)} + 1]"


SQL_DECISIONS = f"""
WITH a AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 19 = 0 THEN '' WHEN c_custkey % 17 = 0 THEN 'pending' || c_custkey || '.example' ELSE 'd' || c_custkey || '.example' END AS dom, c_custkey % 19 <> 0 AND c_custkey % 17 = 0 AS hold, c_custkey % 3 = 0 AS fp, (c_custkey // 3) % 4 AS tier, c_custkey % 9 AS note,
    {_at(_OP)} + CASE WHEN c_custkey % 3 = 0 AND c_custkey % 9 <> 6 THEN 1 ELSE 0 END AS op, {_at(_PR)} AS pr, {_at(_PV)} AS pv, {_at(_PAY)} AS pay, c_custkey % 29 = 0 AS raw, c_custkey % 2 = 0 AS legal, c_custkey % 11 = 0 AS many, c_custkey % 13 = 0 AND c_custkey % 11 <> 0 AS uses FROM customer
),
b AS (
  SELECT *, dom = 'd' || k || '.example' AS plain, (['high', 'medium', 'low', 'low'])[tier + 1] AS base, note IN (4, 8) AS weak, dom = 'd' || k || '.example' AND k % 3 = 0 AND k // 3 IN (SELECT s_suppkey FROM supplier) AS grouped, dom = 'd' || k || '.example' AND k % 23 = 0 AS own FROM a
),
c AS (
  SELECT *, CASE WHEN grouped THEN CASE WHEN k % 6 = 0 AND k // 6 IN (SELECT n_nationkey FROM nation) THEN 'touches' WHEN (k // 3) % 2 = 0 THEN 'linked' ELSE 'create' END END AS verdict, grouped AND ((k // 3) % 4 = 0 OR k % 23 = 0) AS near, own AS sure,
    CASE WHEN legal AND k % 50 IN (SELECT n_nationkey FROM nation) THEN 'e' || (k % 50) END AS l, CASE WHEN k % 5 = 0 AND k % 40 IN (SELECT n_nationkey FROM nation) THEN 'e' || (k % 40) END AS p, CASE WHEN k % 9 = 0 AND k % 30 IN (SELECT n_nationkey FROM nation) THEN 'e' || (k % 30) END AS n,
    2 * op + CASE WHEN legal THEN 2 ELSE 0 END AS s1, 2 * pv + CASE WHEN raw THEN 6 ELSE 0 END + CASE WHEN uses THEN 6 ELSE 0 END AS s2, 2 * pay AS s3, 2 * pr + CASE WHEN many THEN 6 ELSE 0 END AS s4 FROM b
),
d AS (
  SELECT *, greatest(s1, s2, s3, s4) AS top, CASE WHEN greatest(s1, s2, s3, s4) = 0 THEN 'unknown' WHEN s1 = greatest(s1, s2, s3, s4) THEN 'operator' WHEN s2 = greatest(s1, s2, s3, s4) THEN 'provider' WHEN s3 = greatest(s1, s2, s3, s4) THEN 'payment_path' ELSE 'promoter' END AS kind0,
    op >= 2 AND pr >= 2 AND NOT sure AS contra, l IS NOT NULL OR p IS NOT NULL OR n IS NOT NULL OR verdict IN ('touches', 'linked') AS attach0 FROM c
),
e AS (SELECT *, coalesce(attach0, false) AS attach, CASE WHEN sure AND NOT raw THEN 'operator' ELSE kind0 END AS kind, NOT coalesce(attach0, false) AND coalesce(verdict = 'create', false) AS strong FROM d),
f AS (
  SELECT *, CASE WHEN contra THEN 'reject_contradictory_signals' WHEN dom = '' OR hold THEN 'reject_domain_placeholder_or_missing' WHEN note = 8 AND tier = 1 THEN 'stage_403_secondary' WHEN kind = 'unknown' AND strong AND tier = 1 THEN 'stage_unknown_but_cluster_and_secondary' WHEN kind = 'unknown' THEN 'reject_weak_or_unknown'
      WHEN tier = 0 AND (legal OR attach OR strong) AND NOT weak THEN 'promote_first_party_strong_anchor' WHEN tier = 1 AND legal THEN 'promote_secondary_with_legal_anchor' WHEN strong AND tier <= 1 THEN 'promote_strong_cluster_multiple_signals' WHEN weak OR tier = 2 THEN 'stage_mixed_or_inferred' WHEN tier = 1 THEN 'stage_secondary_without_legal' ELSE 'stage_default' END AS prom,
    CASE WHEN note = 7 AND kind = 'provider' THEN 'do_not_evidence_only_provider' WHEN kind = 'promoter' THEN 'do_not_promoter_listing_domain' WHEN kind = 'provider' THEN 'do_not_provider_studio_domain' WHEN sure THEN 'now_confirmed_operator_seed_or_catalog' WHEN kind = 'operator' AND tier = 0 THEN 'now_operator_first_party'
      WHEN note = 8 AND kind = 'operator' AND ((legal AND base = 'high') OR tier <= 1 OR op >= 2) THEN 'now_redirect_shell_operator' WHEN note = 8 AND kind = 'operator' THEN 'after_review_redirect_shell_operator' WHEN kind = 'operator' AND near THEN 'after_review_operator_cluster_known_family'
      WHEN kind = 'operator' AND op >= 4 THEN 'now_high_confidence_sweeps_operator_signals' WHEN kind = 'operator' AND op >= 2 THEN 'after_review_operator_sweeps_signals' WHEN kind = 'operator' THEN 'after_review_operator_mixed' ELSE 'do_not_weak_or_unknown' END AS blk FROM e
)
SELECT 'c' || k AS record_id, 'entity' AS source_type, kind AS likely_entity_type, '{{' || concat_ws(',', {", ".join(f"""{"CASE WHEN fp THEN " if only else ""}'"{name}":"' || {level} || '"'{" END" if only else ""}""" for name, level, only in _FIELDS)}) || '}}' AS fields,
  CASE WHEN prom LIKE 'reject%' THEN 'reject_for_now' WHEN prom LIKE 'promote%' THEN 'promote_now' ELSE 'stage_only' END AS promotion_recommendation, CASE WHEN attach THEN 'attach_to_existing_cluster' WHEN strong THEN 'create_new_cluster_candidate' ELSE 'no_cluster_action' END AS cluster_recommendation,
  CASE WHEN blk LIKE 'now%' THEN 'block_now' WHEN blk LIKE 'after%' THEN 'block_after_review' ELSE 'do_not_block' END AS block_recommendation,
  concat_ws(';', CASE WHEN raw THEN 'rule:raw_entity_type_provider' END, CASE WHEN legal THEN 'rule:legal_entity_anchor_operator_hint' END, CASE WHEN op > 0 THEN 'rule:operator_term_hits:' || op END, CASE WHEN pr > 0 THEN 'rule:promoter_term_hits:' || pr END, CASE WHEN pv > 0 THEN 'rule:provider_term_hits:' || pv END,
    CASE WHEN pay > 0 THEN 'rule:payment_term_hits:' || pay END, CASE WHEN many THEN 'rule:multiple_promote_targets:2' END, CASE WHEN uses THEN 'rule:multiple_uses_provider_refs:2' END, CASE WHEN top = 0 THEN 'rule:insufficient_entity_type_signals' ELSE 'rule:selected_type:' || kind0 || '_score_' || top END,
    CASE WHEN sure AND NOT raw AND kind0 <> 'operator' THEN 'rule:confirmed_operator_catalog_override_type' END,
    CASE WHEN l IS NOT NULL THEN 'rule:cluster_attach_shared_legal:' || l WHEN p IS NOT NULL THEN 'rule:cluster_attach_shared_parent:' || p WHEN n IS NOT NULL THEN 'rule:cluster_attach_company_number:' || n WHEN verdict = 'touches' THEN 'rule:cluster_attach_staged_cluster_touches_production_domain'
      WHEN verdict = 'linked' THEN 'rule:cluster_attach_redirect_or_affiliation_evidence' WHEN verdict = 'create' THEN 'rule:cluster_create_new_staged_cluster_only' ELSE 'rule:cluster_no_action' END,
    'rule:promotion_' || prom, CASE WHEN blk = 'now_operator_first_party' AND note = 8 THEN 'rule:block_now_redirect_shell_operator' END, 'rule:block_' || blk, CASE WHEN contra THEN 'rule:contradictory_operator_promoter_signals' END) AS reasons
FROM f
"""


def queue_decisions(spark, sf):
    """Decisions on discovered domains and extracted pages of the queue."""
    x = _rules_input(spark, sf)
    queue = _made(
        spark,
        sf,
        "customer",
        kind=_pick("c_custkey", ("discovered_domain", "extracted_fingerprint")),
        id="CASE WHEN c_custkey % 17 = 0 THEN concat('tbd', c_custkey, '.example') ELSE concat('WWW.D', c_custkey, '.example/x.') END",
        notes=_pick("c_custkey", _NOTES),
        sources="''",
        evidence_tier=_pick("(c_custkey div 3)", _TIERS),
        payload_ref="CASE WHEN c_custkey % 4 = 0 THEN concat('{\"domain\":\"d', c_custkey, '.example\"}') ELSE '{\"domain\":null}' END",
    ).where("id NOT LIKE 'tbd%' OR payload_ref LIKE '%null%'")
    words = lambda w: F.struct(
        F.struct(
            F.array(F.lit(w)).alias("title_terms"),
            F.array().cast("array<string>").alias("footer_phrases"),
        ).alias("content"),
        F.struct(
            F.array(F.lit("/pay")).alias("cashier_paths"),
            F.array().cast("array<string>").alias("redemption_paths"),
        ).alias("flow"),
    )
    pages = _made(
        spark,
        sf,
        "customer",
        ordinal="c_custkey",
        domain="concat('www.d', c_custkey, '.example')",
    ).where("ordinal % 3 = 0")
    pages = pages.withColumn("fingerprint", words("Poker")).unionByName(
        pages.withColumns({"fingerprint": words("deposit wallet"), "ordinal": F.col("ordinal") - 1})
    )
    facts = review.cluster_facts(x["clusters"], x["entities"], x["sure"])
    return _decided(review.queue_decisions(queue, pages, facts, x["sure"]))


SQL_QUEUE_DECISIONS = f"""
WITH a AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 17 = 0 AND c_custkey % 4 <> 0 THEN 'tbd' || c_custkey || '.example' ELSE 'd' || c_custkey || '.example' END AS dom, c_custkey % 17 = 0 AS bad, (c_custkey // 3) % 4 AS tier, c_custkey % 9 AS note,
    {_at(_OP)} + CASE WHEN c_custkey % 17 <> 0 AND c_custkey % 3 = 0 AND c_custkey % 9 <> 6 THEN 1 ELSE 0 END AS op, {_at(_PR)} AS pr, {_at(_PV)} AS pv, {_at(_PAY)} AS pay, c_custkey % 3 = 0 AND c_custkey % 17 <> 0 AS fp FROM customer WHERE c_custkey % 17 <> 0 OR c_custkey % 4 <> 0
),
b AS (SELECT *, note IN (4, 8) AS weak, NOT bad AND k % 3 = 0 AND k // 3 IN (SELECT s_suppkey FROM supplier) AS grouped, NOT bad AND k % 23 = 0 AS sure, 2 * op AS s1, 2 * pv AS s2, 2 * pay AS s3, 2 * pr AS s4 FROM a),
c AS (
  SELECT *, CASE WHEN grouped THEN CASE WHEN k % 6 = 0 AND k // 6 IN (SELECT n_nationkey FROM nation) THEN 'touches' WHEN (k // 3) % 2 = 0 THEN 'linked' ELSE 'create' END END AS verdict, grouped AND ((k // 3) % 4 = 0 OR k % 23 = 0) AS near, greatest(s1, s2, s3, s4) AS top,
    CASE WHEN greatest(s1, s2, s3, s4) = 0 THEN 'unknown' WHEN s1 = greatest(s1, s2, s3, s4) THEN 'operator' WHEN s2 = greatest(s1, s2, s3, s4) THEN 'provider' WHEN s3 = greatest(s1, s2, s3, s4) THEN 'payment_path' ELSE 'promoter' END AS kind0 FROM b
),
e AS (SELECT *, CASE WHEN sure THEN 'operator' ELSE kind0 END AS kind, op >= 2 AND pr >= 2 AND NOT sure AS contra, coalesce(verdict IN ('touches', 'linked'), false) AS attach, coalesce(verdict = 'create', false) AS strong FROM c),
f AS (
  SELECT *, CASE WHEN contra THEN 'reject_contradictory_signals' WHEN note = 8 AND tier = 1 THEN 'stage_403_secondary' WHEN kind = 'unknown' AND strong AND tier = 1 THEN 'stage_unknown_but_cluster_and_secondary' WHEN kind = 'unknown' THEN 'reject_weak_or_unknown' WHEN tier = 0 AND (attach OR strong) AND NOT weak THEN 'promote_first_party_strong_anchor'
      WHEN strong AND tier <= 1 THEN 'promote_strong_cluster_multiple_signals' WHEN weak OR tier = 2 THEN 'stage_mixed_or_inferred' WHEN tier = 1 THEN 'stage_secondary_without_legal' ELSE 'stage_default' END AS prom,
    CASE WHEN kind = 'promoter' THEN 'do_not_promoter_listing_domain' WHEN kind = 'provider' THEN 'do_not_provider_studio_domain' WHEN sure THEN 'now_confirmed_operator_seed_or_catalog' WHEN kind = 'operator' AND tier = 0 THEN 'now_operator_first_party' WHEN note = 8 AND kind = 'operator' AND (tier <= 1 OR op >= 2) THEN 'now_redirect_shell_operator'
      WHEN note = 8 AND kind = 'operator' THEN 'after_review_redirect_shell_operator' WHEN kind = 'operator' AND near THEN 'after_review_operator_cluster_known_family' WHEN kind = 'operator' AND op >= 4 THEN 'now_high_confidence_sweeps_operator_signals' WHEN kind = 'operator' AND op >= 2 THEN 'after_review_operator_sweeps_signals'
      WHEN kind = 'operator' THEN 'after_review_operator_mixed' ELSE 'do_not_weak_or_unknown' END AS blk FROM e
)
SELECT 'queue:' || CASE WHEN k % 2 = 0 THEN 'discovered_domain' ELSE 'extracted_fingerprint' END || ':' || dom AS record_id, 'entity' AS source_type, kind AS likely_entity_type, '{{"domain":"' || (['high', 'medium', 'low', 'low'])[tier + 1] || '"}}' AS fields,
  CASE WHEN bad OR prom LIKE 'reject%' THEN 'reject_for_now' WHEN prom LIKE 'promote%' THEN 'promote_now' ELSE 'stage_only' END AS promotion_recommendation, CASE WHEN attach THEN 'attach_to_existing_cluster' WHEN strong THEN 'create_new_cluster_candidate' ELSE 'no_cluster_action' END AS cluster_recommendation,
  CASE WHEN blk LIKE 'now%' THEN 'block_now' WHEN blk LIKE 'after%' THEN 'block_after_review' ELSE 'do_not_block' END AS block_recommendation,
  concat_ws(';', CASE WHEN op > 0 THEN 'rule:operator_term_hits:' || op END, CASE WHEN pr > 0 THEN 'rule:promoter_term_hits:' || pr END, CASE WHEN pv > 0 THEN 'rule:provider_term_hits:' || pv END, CASE WHEN pay > 0 THEN 'rule:payment_term_hits:' || pay END,
    CASE WHEN top = 0 THEN 'rule:insufficient_entity_type_signals' ELSE 'rule:selected_type:' || kind0 || '_score_' || top END, CASE WHEN sure AND kind0 <> 'operator' THEN 'rule:confirmed_operator_catalog_override_type' END,
    CASE verdict WHEN 'touches' THEN 'rule:cluster_attach_staged_cluster_touches_production_domain' WHEN 'linked' THEN 'rule:cluster_attach_redirect_or_affiliation_evidence' WHEN 'create' THEN 'rule:cluster_create_new_staged_cluster_only' ELSE 'rule:cluster_no_action' END,
    CASE WHEN bad THEN 'rule:queue_discovered_reject_placeholder' ELSE 'rule:queue_research_item_stage;rule:promotion_' || prom END, CASE WHEN blk = 'now_operator_first_party' AND note = 8 THEN 'rule:block_now_redirect_shell_operator' END, 'rule:block_' || blk) AS reasons
FROM f
"""


def evidence_clusters(spark, sf):
    """Components of evidence edges, with their members and their evidence."""
    k = F.col("c_custkey")
    name = lambda x: F.concat(F.lit("d"), F.lpad(x.cast("string"), 9, "0"))
    base = _t(spark, sf, "customer")
    chain = base.where("c_custkey % 7 <> 6").select(
        name(k).alias("left"), name(k + 1).alias("right"), F.lit("chain").alias("reason"), F.lit("{}").alias("detail"),
    )
    star = base.where("c_custkey % 14 = 0").select(
        name(k).alias("left"),
        name(k + 7).alias("right"),
        F.lit("pair").alias("reason"),
        F.concat(F.lit('{"n":'), k.cast("string"), F.lit("}")).alias("detail"),
    )
    found = cluster.clusters(chain.unionByName(star))
    return found.select(
        "cluster_id",
        "member_count",
        F.array_join(F.slice("members", 1, 3), " ").alias("first"),
        F.size("evidence").alias("n_evidence"),
        F.get("evidence", F.lit(0))["reason"].alias("reason"),
        "review_status",
        "evidence_tier",
    )


SQL_EVIDENCE_CLUSTERS = """
WITH e AS (
  SELECT c_custkey AS a, c_custkey + 1 AS b FROM customer WHERE c_custkey % 7 <> 6 UNION ALL SELECT c_custkey, c_custkey + 7 FROM customer WHERE c_custkey % 14 = 0
),
n AS (SELECT DISTINCT x, x // 14 AS g FROM (SELECT a AS x FROM e UNION ALL SELECT b FROM e)),
m AS (SELECT g, min(x) AS root, count(*)::INTEGER AS c, list_sort(list('d' || lpad(x::VARCHAR, 9, '0'))) AS ms FROM n GROUP BY g), p AS (SELECT a // 14 AS g, count(*)::INTEGER AS c FROM e GROUP BY 1)
SELECT 'cluster-d' || lpad(root::VARCHAR, 9, '0') AS cluster_id, m.c AS member_count, array_to_string(ms[:3], ' ') AS first, p.c AS n_evidence, 'chain' AS reason, 'pending' AS review_status, 'inferred' AS evidence_tier FROM m JOIN p ON m.g = p.g
"""


def reviewed_blocklist(spark, sf):
    """The domains that review decisions stand for, whatever the shape of their ids."""
    ident = _pick(
        "c_custkey",
        (
            "queue:discovered_domain:WWW.q{k}.example.",
            "cluster-{k}",
            "f{k}",
            "f{k}->  g{k}.example",
            "bare{k}.example",
            "queue:cluster:x",
            "f{k}->gone",
            "nodomain",
        ),
    )
    kind = _pick(
        "c_custkey",
        ("entity", "cluster", "entity", "relationship", "entity", "entity", "relationship", "entity"),
    )
    rows = _made(
        spark,
        sf,
        "customer",
        record_id=f"replace({ident}, '{{k}}', cast(c_custkey AS STRING))",
        source_type=kind,
        block_recommendation=_pick("(c_custkey div 8)", ("block_now", "block_after_review", "do_not_block")),
    )
    staged = _made(
        spark,
        sf,
        "customer",
        candidate_id="concat('f', c_custkey)",
        domain="concat(' F', c_custkey, '.example')",
        ordinal="c_custkey",
    )
    groups = _made(
        spark,
        sf,
        "customer",
        cluster_id="concat('cluster-', c_custkey)",
        a="concat('m', c_custkey, '.example')",
    ).select("cluster_id", F.array("a", F.lit("WWW.shared.example")).alias("members"))
    return publish.reviewed_blocklist(rows, staged, groups, include_after_review=True)[0]


SQL_BLOCKLIST = """
WITH r AS (SELECT c_custkey AS k, c_custkey % 8 AS s, (['block_now', 'block_after_review', 'do_not_block'])[(c_custkey // 8) % 3 + 1] AS recommendation FROM customer), w AS (SELECT * FROM r WHERE recommendation <> 'do_not_block')
SELECT 'queue:discovered_domain:WWW.q' || k || '.example.' AS record_id, 'entity' AS source_type, recommendation, 'q' || k || '.example' AS domain FROM w WHERE s = 0
UNION ALL SELECT 'cluster-' || k, 'cluster', recommendation, 'm' || k || '.example' FROM w WHERE s = 1 UNION ALL SELECT 'cluster-' || k, 'cluster', recommendation, 'shared.example' FROM w WHERE s = 1
UNION ALL SELECT 'f' || k, 'entity', recommendation, 'f' || k || '.example' FROM w WHERE s = 2
UNION ALL SELECT 'f' || k || '->  g' || k || '.example', 'relationship', recommendation, 'f' || k || '.example' FROM w WHERE s = 3 UNION ALL SELECT 'f' || k || '->  g' || k || '.example', 'relationship', recommendation, 'g' || k || '.example' FROM w WHERE s = 3
UNION ALL SELECT 'bare' || k || '.example', 'entity', recommendation, 'bare' || k || '.example' FROM w WHERE s = 4 UNION ALL SELECT 'f' || k || '->gone', 'relationship', recommendation, 'f' || k || '.example' FROM w WHERE s = 6
"""

# ---------------------------------------------------------------- documents


def canonical_hashes(spark, sf):
    """Hashes of canonical JSON, as they are signed."""
    @F.pandas_udf("string")
    def hashed(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(
            [
                signing.payload_hash(
                    {"turn": int(r.turn), "conv_id": int(r.conv_id), "role": r.role, "list": [1.5, None, True]}
                )
                for r in rows.itertuples()
            ]
        )

    return _t(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        hashed(F.struct("conv_id", "turn", "role")).alias("hash"),
    )


SQL_CANONICAL = """
SELECT conv_id, turn, sha256('{"conv_id":' || conv_id || ',"list":[1.5,null,true],"role":"' || role || '","turn":' || turn || '}') AS hash FROM conversations
"""

_RECORDS = "concat('{\"WWW.S', s_suppkey, '.example.\": {\"san\": \"A', s_suppkey, '.example\", \"dns\": {\"nameservers\": [\"ns1\", \" \", \"ns', s_suppkey % 7, '\"]}, \"mx\": [{\"host\": \"m', s_suppkey % 3, '\", \"priority\": 5}], \"tls\": {\"partial\": ', CASE WHEN s_suppkey % 4 = 0 THEN 'true' ELSE 'false' END, '}}, \"bad', s_suppkey, '\": 3, \"\": {}}')"


def domain_records(spark, sf):
    """Fingerprints by domain from JSON objects, under whichever of their names fields stand."""
    rows = files.domain_records(_made(spark, sf, "supplier", value=_RECORDS))
    return _words(
        rows.select(
            "domain",
            "sans",
            "nameservers",
            F.get("mx.host", F.lit(0)).alias("mail"),
            "tls_partial",
            "dns_partial",
        ),
        "sans",
        "nameservers",
    )


SQL_RECORDS = """
SELECT 's' || s_suppkey || '.example' AS domain, 'a' || s_suppkey || '.example' AS sans, 'ns1 ns' || (s_suppkey % 7) AS nameservers, 'm' || (s_suppkey % 3) AS mail, s_suppkey % 4 = 0 AS tls_partial, false AS dns_partial FROM supplier
"""


def list_lines(spark, sf):
    """URLs and hosts of lists with comments and blanks."""
    rows = _made(
        spark,
        sf,
        "customer",
        value=f"replace({_pick('c_custkey', ('# no', ' https://a{k}.example/x ', '', 'WWW.b{k}.Example./p', '  #x'))}, '{{k}}', cast(c_nationkey AS STRING))",
        ordinal="c_custkey",
    )
    urls = crawl.seed_urls(rows).select(
        F.lit("url").alias("kind"),
        F.col("url").alias("value"),
        F.col("ordinal").cast("long").alias("n"),
    )
    return urls.unionByName(
        crawl.domain_list(rows).select(
            F.lit("host").alias("kind"),
            F.col("host").alias("value"),
            F.lit(0).cast("long").alias("n"),
        )
    )


SQL_LINES = """
SELECT 'url' AS kind, CASE WHEN c_custkey % 5 = 1 THEN 'https://a' || c_nationkey || '.example/x' ELSE 'WWW.b' || c_nationkey || '.Example./p' END AS value, c_custkey AS n FROM customer WHERE c_custkey % 5 IN (1, 3)
UNION ALL SELECT DISTINCT 'host', CASE WHEN c_custkey % 5 = 1 THEN 'https:' ELSE 'www.b' || c_nationkey || '.example' END, 0 FROM customer WHERE c_custkey % 5 IN (1, 3)
"""

def _written_text(spark: SparkSession, lines: DataFrame) -> str:
    """A text file in the shared folder, for queries that read files."""
    folder = shared.new_folder(spark)
    lines.coalesce(1).write.mode("append").text(folder)
    return folder


_CSV_CELL = "concat('a \"q', c_custkey, '\", b', char({nl}), ' c ')"


def csv_source(spark, sf):
    """Cells with quotes, commas and line ends, written as CSV and read as a source."""
    rows = _made(
        spark,
        sf,
        "customer",
        id="cast(c_custkey AS STRING)",
        name="CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END",
        cell=_CSV_CELL.format(nl=10),
    )
    folder = shared.new_folder(spark)
    files.csv_file(rows, folder, ("id", "name", "cell"))
    found = files.csv_table(spark, folder, ("id", "cell", "missing"), trimmed=True)
    return shared.held(found.select("id", "name", "cell", "missing"), folder)


SQL_CSV = "SELECT c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS name, 'a \"q' || c_custkey || '\", b' || chr(10) || ' c' AS cell, '' AS missing FROM customer"


def json_source(spark, sf):
    """A document with a list of rows, read under a schema, with the place of each row."""
    row = F.to_json(
        F.struct(
            F.col("n_nationkey").alias("id"),
            F.array("n_name", F.col("n_regionkey").cast("string")).alias("domains"),
            F.lit("x").alias("unknown"),
        )
    )
    doc = _t(spark, sf, "nation").groupBy().agg(
        F.concat(
            F.lit('{"generated_at": null, "entities": ['),
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", row.alias("r")))), lambda x: x["r"]),
                ",\n",
            ),
            F.lit("]}"),
        ).alias("value")
    )
    folder = _written_text(spark, doc)
    found = files.json_rows(
        spark,
        folder,
        T.StructType(
            [
                T.StructField("id", T.LongType()),
                T.StructField("domains", T.ArrayType(T.StringType())),
                T.StructField("none", T.StringType()),
            ]
        ),
        "entities",
    )
    return shared.held(found.select("id", F.array_join("domains", "|").alias("domains"), "none", "ordinal"), folder)


SQL_JSON = "SELECT n_nationkey::BIGINT AS id, n_name || '|' || n_regionkey AS domains, NULL::VARCHAR AS none, row_number() OVER (ORDER BY n_nationkey) - 1 AS ordinal FROM nation"


def worklist(spark, sf):
    """Addresses to extract: home pages of found domains, then pages seen, each once."""
    k = F.col("s_suppkey")
    domains = _t(spark, sf, "supplier").select(
        F.concat(F.lit("s"), (k % 40).cast("string"), F.lit(".example")).alias("domain")
    ).distinct()
    site = F.concat(F.lit("https://s"), (F.col("c_custkey") % 60).cast("string"), F.lit(".example/"))
    visits = _t(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 4 == 0, "ftp://x").otherwise(site).alias("final_url"),
        F.concat(F.lit("http://p"), (F.col("c_custkey") % 90).cast("string"), F.lit(".example/")).alias("requested_url"),
    )
    return crawl.worklist(domains, visits, 1_000_000)


SQL_WORKLIST = """
SELECT 'https://s' || (s_suppkey % 40) || '.example/' AS url FROM supplier UNION SELECT 'https://s' || (c_custkey % 60) || '.example/' FROM customer WHERE c_custkey % 4 <> 0 UNION SELECT 'http://p' || (c_custkey % 90) || '.example/' FROM customer
"""

ALL: dict[str, tuple] = {
    "seed_entities": (seed_entities, SQL_ENTITIES),
    "seed_checks": (seed_checks, SQL_CHECKS),
    "enriched": (enriched, SQL_ENRICHED),
    "domain_affiliations": (domain_affiliations, SQL_DOMAINS),
    "entity_affiliations": (entity_affiliations, SQL_ENTITY_PAIRS),
    "monitor_candidates": (monitor_candidates, SQL_CANDIDATES),
    "monitor_edges": (monitor_edges, SQL_EDGES),
    "extracted_pages": (extracted_pages, SQL_EXTRACTED),
    "crawl_seeds": (crawl_seeds, SQL_CRAWL),
    "bounded_crawl": (bounded_crawl, SQL_SITES),
    "import_candidates": (import_candidates, SQL_IMPORT),
    "import_duplicates": (import_duplicates, SQL_DUPLICATES),
    "import_review": (import_review, SQL_REVIEW),
    "import_counts": (import_counts, SQL_IMPORT_COUNTS),
    "promotion_operators": (promotion_operators, SQL_PROMOTION),
    "promotion_fingerprints": (promotion_fingerprints, SQL_PROMOTION_PRINTS),
    "promotion_edges": (promotion_edges, SQL_PROMOTION_EDGES),
    "dump_edges": (dump_edges, SQL_DUMP),
    "cluster_edges": (cluster_edges, SQL_CLUSTER_EDGES),
    "confirmed_operators": (confirmed_operators, SQL_CONFIRMED),
    "catalogue_keys": (catalogue_keys, SQL_CATALOGUE),
    "relationship_decisions": (relationship_decisions, SQL_RELATIONSHIPS),
    "cluster_decisions": (cluster_decisions, SQL_CLUSTERS),
    "fingerprint_decisions": (fingerprint_decisions, SQL_FINGERPRINTS),
    "entity_decisions": (entity_decisions, SQL_DECISIONS),
    "queue_decisions": (queue_decisions, SQL_QUEUE_DECISIONS),
    "evidence_clusters": (evidence_clusters, SQL_EVIDENCE_CLUSTERS),
    "reviewed_blocklist": (reviewed_blocklist, SQL_BLOCKLIST),
    "canonical_hashes": (canonical_hashes, SQL_CANONICAL),
    "domain_records": (domain_records, SQL_RECORDS),
    "list_lines": (list_lines, SQL_LINES),
    "csv_source": (csv_source, SQL_CSV),
    "json_source": (json_source, SQL_JSON),
    "worklist": (worklist, SQL_WORKLIST),
}
