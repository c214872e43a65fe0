"""Incremental sightings of unknown hosts: a Structured Streaming extension of the monitor stage.

The batch monitor is run again and again; this keeps its counts as pages arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hosts import monitor_host
from ..functions.html import links, parsed


def unknown_sightings(
    pages: DataFrame,
    known: DataFrame,
    *,
    seen: str = "seen_at",
    late: str = "1 hour",
    window: str = "1 day",
) -> DataFrame:
    """(window, domain, pages, first_seen, last_seen) of hosts that no known entity has, by event time.

    pages: a stream of url, html and the event time; known: a static table (domain).
    """
    rows = parsed(
        pages.withWatermark(seen, late).where("html <> ''").select("url", "html", seen)
    ).withColumn("page_host", monitor_host(F.col("url")))
    out = rows.select(
        "url",
        seen,
        "page_host",
        F.explode(links(F.col("page"), F.col("url"))).alias("link"),
    ).withColumn("domain", monitor_host(F.col("link"))).where("domain <> '' AND domain <> page_host")
    fresh = out.join(
        known.select(F.col("domain").alias("_known")).distinct(),
        F.col("domain") == F.col("_known"),
        "left_anti",
    )
    return fresh.groupBy(F.window(seen, window), "domain").agg(
        F.approx_count_distinct("url").alias("pages"),
        F.min(seen).alias("first_seen"),
        F.max(seen).alias("last_seen"),
    )
