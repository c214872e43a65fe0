"""Fingerprints filled from partial tables and pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import parsed, signals, with_names
from ..functions.text import dedupe_sorted, merge_lists, split_pipe, strip
from ..operators.keyed import keep_first, keep_last
from ..operators.matching import finder
from ..schemas import FILLED, GROUPS, lowered_leaf
from .seeds import empty_fingerprints


def _rebuilt(value) -> Column:
    """The four groups with each leaf replaced by value(group, leaf)."""
    groups = []
    for group, leaves in GROUPS.items():
        members = [value(group, leaf).alias(leaf) for leaf in leaves]
        if group == "technical":
            members.insert(0, F.col("technical.registrar").alias("registrar"))
        groups.append(F.struct(*members).alias(group))
    return groups


def normalised(fingerprints: DataFrame) -> DataFrame:
    """Every list distinct up to case and sorted; flow in lower case."""
    leaf = lambda g, x: dedupe_sorted(F.col(f"{g}.{x}"), g == "flow") if x in FILLED[g] else F.col(f"{g}.{x}")
    return fingerprints.select("entity_id", *_rebuilt(leaf))


def provider_finder(entities: DataFrame) -> Callable[[Column], Column]:
    """The names of the provider catalogue, of three characters or more, that stand in a lower-cased text."""
    names = entities.where("entity_type = 'provider'").select(strip(F.col("name")).alias("value"))
    return finder(names.where(F.length("value") >= 3).select(F.lower("value").alias("key"), "value"))


def enrich(
    entities: DataFrame,
    fingerprints: DataFrame,
    partial: DataFrame,
    pages: DataFrame | None = None,
) -> DataFrame:
    """One normalised fingerprint for each id of the three tables.

    partial: entity_id and piped list columns, with ``ordinal``; the last row of an id counts.
    pages: url, html. The first domain of active operators, promoters and providers is looked up,
    https before http.
    """
    ids = fingerprints.select("entity_id").unionByName(
        entities.select(F.col("id").alias("entity_id"))
    ).unionByName(partial.select("entity_id")).where("entity_id IS NOT NULL AND entity_id <> ''").distinct()
    missing = empty_fingerprints(ids.join(fingerprints.select("entity_id"), "entity_id", "left_anti"), "entity_id")
    base = fingerprints.unionByName(missing)
    leaves = [(g, x) for g, xs in FILLED.items() for x in xs]
    last = keep_last(partial, ["entity_id"], ["ordinal"])
    cells = last.select(
        "entity_id",
        *(
            (split_pipe(F.col(x)) if x in last.columns else F.array().cast("array<string>")).alias(f"p_{g}_{x}")
            for g, x in leaves
        ),
    )
    rows = base.join(cells, "entity_id", "left")

    def merged(prefix: str, from_page: bool):
        def leaf(g: str, x: str) -> Column:
            if x not in FILLED[g]:
                return F.col(f"{g}.{x}")
            more = F.col(f"{prefix}_{g}_{x}")
            return F.when(
                F.size(F.coalesce(more, F.array().cast("array<string>"))) > 0,
                merge_lists(F.col(f"{g}.{x}"), more, lowered_leaf(g, x, from_page)),
            ).otherwise(F.col(f"{g}.{x}"))

        return leaf

    rows = rows.select("entity_id", *_rebuilt(merged("p", False)))
    if pages is not None:
        wanted = entities.where("status = 'active' AND entity_type IN ('operator', 'promoter', 'provider')").select(
            F.col("id").alias("entity_id"),
            F.get(F.filter("domains", lambda d: d != ""), F.lit(0)).alias("d"),
        ).where("d IS NOT NULL")
        tries = wanted.select(
            "entity_id",
            F.posexplode(
                F.array(F.concat(F.lit("https://"), "d", F.lit("/")), F.concat(F.lit("http://"), "d", F.lit("/")))
            ).alias("try", "url"),
        )
        hit = keep_first(
            tries.join(pages.where("html <> ''").select("url", "html"), "url"),
            ["entity_id"],
            ["try", "html"],
        )
        read = parsed(hit.select("entity_id", "url", "html"))
        read, names = with_names(read, "html", provider_finder(entities), "names")
        found = read.withColumn("s", signals(F.col("page"), F.col("html"), names))
        from_page = [
            (g, x)
            for g, xs in {
                "technical": FILLED["technical"],
                "content": ("title_terms", "footer_phrases", "provider_mentions"),
                "flow": ("cashier_paths", "signup_paths", "redemption_paths"),
            }.items()
            for x in xs
        ]
        none = [F.array().cast("array<string>").alias(f"h_{g}_{x}") for g, x in leaves if (g, x) not in from_page]
        rows = rows.join(
            found.select("entity_id", *(F.col(f"s.{g}.{x}").alias(f"h_{g}_{x}") for g, x in from_page), *none),
            "entity_id",
            "left",
        ).select("entity_id", *_rebuilt(merged("h", True)))
    return normalised(rows)
