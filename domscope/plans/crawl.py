"""Crawling stages over a table of pages (url, html, and optionally final_url and status).

Fetching is outside the engine: the pages table stands for it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.hosts import crawl_host, monitor_host
from ..functions.html import address_hints, emails, legal_urls, links, parsed, signals, support_urls, with_names
from ..functions.rules import evidence_tier
from ..functions.text import strip
from ..operators.keyed import keep_first, lookup_first, sightings
from ..sources.shared import discard, written


def domain_index(entities: DataFrame) -> DataFrame:
    """(domain, kind, entity_id, name) of known kinds; the first entity that names a domain has it."""
    known = entities.where(F.col("entity_type").isin("operator", "promoter", "provider", "payment_path"))
    order = [c for c in ("part", "ordinal") if c in entities.columns]
    rows = known.select(
        F.explode("domains").alias("domain"),
        F.col("entity_type").alias("kind"),
        F.col("id").alias("entity_id"),
        "name",
        *order,
    ).where("domain <> ''")
    return keep_first(rows, ["domain"], [*order, "entity_id"])


def outbound(pages: DataFrame, limit: int = 800) -> DataFrame:
    """(page_order, link_order, url, page_host, link, link_host) of links to other hosts. pages carry ``ordinal``."""
    host = monitor_host(F.col("url"))
    rows = parsed(
        pages.where("html <> ''").select("ordinal", "url", "html")
    ).withColumn("page_host", host).where("page_host <> ''")
    out = rows.select(
        F.col("ordinal").alias("page_order"),
        "url",
        "page_host",
        F.posexplode(links(F.col("page"), F.col("url"), limit=limit)).alias("link_order", "link"),
    )
    return out.withColumn("link_host", monitor_host(F.col("link"))).where("link_host <> '' AND link_host <> page_host")


def monitor(
    pages: DataFrame,
    entities: DataFrame,
    run_time: str,
    run_tag: str,
    *,
    limit: int = 800,
) -> tuple[DataFrame, DataFrame]:
    """(candidates, edges): unknown hosts with their sightings, and edges between known entities. Both parse the
    pages; where both are wanted, write ``outbound`` and give it to ``monitored``."""
    return monitored(outbound(pages, limit), entities, run_time, run_tag)


def monitored(found: DataFrame, entities: DataFrame, run_time: str, run_tag: str) -> tuple[DataFrame, DataFrame]:
    """(candidates, edges) of ``outbound`` links."""
    index = domain_index(entities)
    order = [c for c in ("part", "ordinal") if c in index.columns]
    hits = lookup_first(
        lookup_first(found, index, "page_host", "domain", [*order, "entity_id"], "page_"),
        index,
        "link_host",
        "domain",
        [*order, "entity_id"],
        "link_",
    )
    unknown = hits.where("link_entity_id IS NULL").withColumn("seen", F.lit(run_time))
    seen = sightings(unknown, "link_host", "url", "seen", ["page_order", "link_order"])
    operatorish = F.col("domain").rlike("(casino|sweeps|slots|poker|betting)")
    promoterish = ~operatorish & F.col("domain").rlike("(review|bonus|codes|aff)")
    kinds = F.when(
        operatorish,
        F.array(F.lit("operator"), F.lit("promoter"), F.lit("unknown")),
    ).when(promoterish, F.array(F.lit("promoter"), F.lit("unknown"))).otherwise(F.array(F.lit("unknown")))
    candidates = seen.withColumnRenamed("link_host", "domain").select(
        "domain",
        kinds.alias("suggested_types"),
        F.when(promoterish, "promoters").otherwise("operators").alias("bucket"),
        "seen_on_urls",
        "first_seen",
        "last_seen",
        F.lit(0.35).alias("confidence"),
        F.lit(run_tag).alias("source_run"),
        F.lit("Outbound link from monitored seed page").alias("notes"),
    )
    promotes = (F.col("page_kind") == "promoter") & (F.col("link_kind") == "operator")
    edges = hits.where("page_entity_id IS NOT NULL AND link_entity_id IS NOT NULL").select(
        F.col("page_entity_id").alias("from_id"),
        F.col("link_entity_id").alias("to_id"),
        F.when(promotes, "promotes").otherwise("links_to").alias("relationship"),
        F.when(promotes, 0.55).otherwise(0.45).alias("confidence"),
        F.lit(f"monitor_{run_tag}").alias("source"),
        F.struct(F.col("link").alias("url"), F.lit("").alias("anchor_text")).alias("evidence"),
        F.struct("page_order", "link_order").alias("ordinal"),
    )
    return candidates, edges


def discover(
    seeds: DataFrame,
    pages: DataFrame,
    *,
    max_depth: int = 1,
    max_same_host_pages: int = 12,
    deny: DataFrame | None = None,
    allow: DataFrame | None = None,
    max_rounds: int = 1000,
) -> tuple[DataFrame, DataFrame]:
    """(domains, visits) of a bounded breadth-first crawl.

    seeds: url and ``ordinal``; pages: url, html, optionally final_url and status; deny, allow: host.
    Each round joins the frontier with the pages; the frontier keeps first-in-first-out order, since
    the cap on pages of one host takes links in that order, repeats included. What a round gives is
    written, so the plan does not grow. A crawl that is not done after max_rounds is an error.
    """
    have = pages.columns
    table = pages.select(
        "url",
        F.col("html") if "html" in have else F.lit("").alias("html"),
        (F.coalesce("final_url", "url") if "final_url" in have else F.col("url")).alias("final_url"),
        (F.col("status") if "status" in have else F.lit(200)).alias("status"),
    )
    table = keep_first(table, ["url"], ["html", "final_url", "status"])

    def allowed(rows: DataFrame, host: str) -> DataFrame:
        rows = rows.where(F.col(host).isNotNull())
        if deny is not None:
            rows = rows.join(deny.select(F.col("host").alias(host)).distinct(), host, "left_anti")
        if allow is not None:
            rows = rows.join(allow.select(F.col("host").alias(host)).distinct(), host, "left_semi")
        return rows

    frontier = written(
        keep_first(
            seeds.select("url", F.col("url").alias("source"), F.array(F.col("ordinal").cast("long")).alias("place")),
            ["url"],
            ["place"],
        )
    )
    seen = frontier.select("url")
    used = None
    visits = found = None
    for _ in range(max_rounds):
        open_ = allowed(frontier.withColumn("host", crawl_host(F.col("url"))), "host")
        got = open_.join(table, "url", "left")
        read = parsed(got.where("html <> '' AND status > 0").withColumn("base", F.col("final_url")), url="base")
        read = written(
            read.withColumn("final_host", crawl_host(F.col("final_url")))
            .select(
                "url",
                "source",
                "place",
                "final_url",
                "status",
                "final_host",
                F.posexplode_outer(links(F.col("page"), F.col("final_url"), limit=600, mail=True)).alias("k", "link"),
            )
            .withColumn("link_host", crawl_host(F.col("link")))
        )
        out = allowed(read.where("link IS NOT NULL"), "link_host").select(
            "url",
            "source",
            F.col("link_host").alias("domain"),
        )
        landed = read.where("final_host IS NOT NULL").groupBy(
            "url", "source", "place", "final_url",
        ).agg(F.first("final_host").alias("domain"))
        credit = out.select(
            "domain",
            "source",
            F.lit(None).cast("array<string>").alias("chain"),
            F.lit(None).cast("array<bigint>").alias("place"),
        ).unionByName(
            landed.select(
                "domain",
                "source",
                F.when(F.col("final_url") == F.col("url"), F.array("url"))
                .otherwise(F.array("url", "final_url"))
                .alias("chain"),
                "place",
            )
        )
        outs = out.groupBy("url").agg(F.array_sort(F.collect_set("domain")).alias("outbound_domains"))
        visit = got.join(outs, "url", "left").select(
            F.col("url").alias("requested_url"),
            "final_url",
            F.coalesce("status", F.lit(-1)).alias("http_status"),
            F.col("source").alias("source_seed_or_page"),
            F.coalesce("outbound_domains", F.array().cast("array<string>")).alias("outbound_domains"),
        )
        visit, credit = written(visit), written(credit)
        visits = visit if visits is None else visits.unionByName(visit)
        found = credit if found is None else found.unionByName(credit)
        if max_depth < 1:
            break
        inner = read.where("link IS NOT NULL AND link_host = final_host").join(
            seen.withColumnRenamed("url", "link"),
            "link",
            "left_anti",
        )
        # At most max_same_host_pages of a host pass, so ranks beyond the cap need not be told apart.
        rank = F.row_number().over(W.partitionBy("final_host").orderBy("place", "k"))
        inner = inner.withColumn("r", rank).where(F.col("r") <= max_same_host_pages)
        if used is not None:
            inner = inner.join(used, "final_host", "left")
        taken = F.coalesce(F.col("n"), F.lit(0)) if used is not None else F.lit(0)
        passed = written(
            inner.where(F.col("r") + taken <= max_same_host_pages).select(
                "final_host",
                F.col("link").alias("url"),
                "source",
                F.concat("place", F.array(F.col("k").cast("long"))).alias("place"),
            )
        )
        count = passed.groupBy("final_host").agg(F.count("*").alias("n"))
        before = [] if used is None else [used]
        used = written(
            count if used is None else used.unionByName(count).groupBy("final_host").agg(F.sum("n").alias("n")),
            *before,
        )
        frontier = written(keep_first(passed.select("url", "source", "place"), ["url"], ["place"]))
        discard(read, passed)
        if not frontier.head(1):
            break
        seen = written(seen.unionByName(frontier.select("url")), seen)
    else:
        raise RuntimeError(f"the crawl did not end in {max_rounds} rounds")
    chains = found.where("chain IS NOT NULL").groupBy("domain").agg(F.max_by("chain", "place").alias("redirect_chain"))
    domains = found.groupBy("domain").agg(
        F.array_sort(F.collect_set("source")).alias("source_urls")
    ).join(chains, "domain", "left")
    return domains.withColumn(
        "redirect_chain",
        F.coalesce("redirect_chain", F.array().cast("array<string>")),
    ).orderBy("domain"), visits


def worklist(domains: DataFrame, visits: DataFrame, limit: int = 30) -> DataFrame:
    """(url, ordinal): home pages of discovered domains, then pages seen, each once, the first ``limit``."""
    home = domains.select(
        F.concat(F.lit("https://"), "domain", F.lit("/")).alias("url"),
        F.lit(0).alias("a"),
        F.col("domain").alias("b"),
        F.lit(0).alias("c"),
    )
    web = lambda c, k: visits.select(
        F.col(c).alias("url"),
        F.lit(1).alias("a"),
        F.col("requested_url").alias("b"),
        F.lit(k).alias("c"),
    ).where(F.col("url").rlike("^https?://"))
    rows = keep_first(
        home.unionByName(web("final_url", 0)).unionByName(web("requested_url", 1)),
        ["url"],
        ["a", "b", "c"],
    )
    return rows.orderBy("a", "b", "c").limit(limit).select("url")


def extract(pages: DataFrame, providers: Sequence[str] | Callable[[Column], Column]) -> DataFrame:
    """Fingerprint, contact data and evidence tier of each page (url, final_url, status, html). providers: names, or
    what finds them (``html.with_names``)."""
    read = pages.withColumn(
        "base",
        F.coalesce(F.nullif(F.col("final_url"), F.lit("")), F.col("url")),
    ).where("html <> '' AND status >= 0")
    rows = parsed(read, url="base").where(crawl_host(F.col("base")).isNotNull())
    urls = links(F.col("page"), F.col("base"), limit=400, mail=True)
    rows, names = with_names(rows, "html", providers, "names")
    rows = rows.withColumns(
        {
            "domain": crawl_host(F.col("base")),
            "urls": urls,
            "fingerprint": signals(F.col("page"), F.col("html"), names),
        }
    )
    return rows.select(
        "domain",
        F.col("url").alias("source_url"),
        "final_url",
        F.col("status").alias("http_status"),
        F.lit("needs_review").alias("review_status"),
        evidence_tier(
            F.concat(F.lit("extract status="), F.col("status").cast("string"), F.lit(" final="), F.col("base")),
            F.col("url"),
        ).alias("evidence_tier"),
        "fingerprint",
        legal_urls(F.col("urls")).alias("legal_policy_urls"),
        support_urls(F.col("urls")).alias("support_help_urls"),
        emails(F.col("html")).alias("contact_emails"),
        address_hints(F.col("html")).alias("mailing_address_hints"),
    )


def seed_urls(lines: DataFrame) -> DataFrame:
    """(url, ordinal) of lines that are neither blank nor comments."""
    s = strip(F.col("value"))
    return lines.select(s.alias("url"), "ordinal").where((F.col("url") != "") & ~F.startswith(F.col("url"), F.lit("#")))


def domain_list(lines: DataFrame) -> DataFrame:
    """Distinct hosts of a list: lower case, without path and trailing dots."""
    s = F.regexp_replace(F.substring_index(strip(F.lower(F.col("value"))), "/", 1), r"\.+$", "")
    return lines.where(
        ~F.startswith(strip(F.col("value")), F.lit("#"))
    ).select(s.alias("host")).where("host <> ''").distinct()


