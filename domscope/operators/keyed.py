"""Keep-first and keep-last rules, lookups and referential checks. Order is always an explicit column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    """One whole row for each key by min_by or max_by: combined before the shuffle, no sort of a key's rows."""
    row = F.struct(*(F.col(c) for c in df.columns))
    marks = F.struct(*(F.col(c) for c in order))
    return df.groupBy(*keys).agg(pick(row, marks).alias("_row")).select("_row.*")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of rows with equal keys the first by order (nulls first)."""
    return _one(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one(df, keys, order, F.max_by)


def ordered_union(*parts: DataFrame, order: str = "ordinal") -> DataFrame:
    """Union in the order given: ``part`` numbers the inputs, ``order`` numbers rows inside them."""
    out = None
    for k, p in enumerate(parts):
        p = p.withColumn("part", F.lit(k))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def merge_first(parts: Sequence[DataFrame], keys: Sequence[str], order: str = "ordinal") -> DataFrame:
    """Keyed union: of equal keys the row of the earliest part, and there the first."""
    return keep_first(ordered_union(*parts), keys, ["part", order]).drop("part")


def lookup_first(
    left: DataFrame,
    index: DataFrame,
    left_key: str,
    index_key: str,
    order: Sequence[str],
    prefix: str = "hit_",
) -> DataFrame:
    """left with the first index row of its key (null: no hit)."""
    one = keep_first(index.where(F.col(index_key).isNotNull()), [index_key], order)
    named = one.select(*(F.col(c).alias(prefix + c) for c in one.columns))
    return left.join(named, F.col(left_key) == F.col(prefix + index_key), "left")


def valid_edges(
    edges: DataFrame,
    nodes: DataFrame,
    *,
    a: str = "from_id",
    b: str = "to_id",
    node: str = "id",
) -> DataFrame:
    """Edges both of whose ends are known."""
    known = nodes.select(F.col(node).alias("_node")).where("_node IS NOT NULL").distinct()
    return edges.join(
        known,
        F.col(a) == F.col("_node"),
        "left_semi",
    ).join(known, F.col(b) == F.col("_node"), "left_semi")


def edge_errors(
    edges: DataFrame,
    nodes: DataFrame,
    *,
    a: str = "from_id",
    b: str = "to_id",
    node: str = "id",
) -> DataFrame:
    """One error for each bad edge; an unknown start is told before an unknown end."""
    known = nodes.select(F.col(node).alias("_node")).where("_node IS NOT NULL").distinct()
    left = known.withColumnRenamed("_node", "_a")
    right = known.withColumnRenamed("_node", "_b")
    both = edges.join(left, F.col(a) == F.col("_a"), "left").join(right, F.col(b) == F.col("_b"), "left")
    error = F.when(
        F.col("_a").isNull(),
        F.concat(F.lit("unknown from_id: "), F.coalesce(F.col(a).cast("string"), F.lit(""))),
    ).when(F.col("_b").isNull(), F.concat(F.lit("unknown to_id: "), F.coalesce(F.col(b).cast("string"), F.lit(""))))
    return both.withColumn("error", error).where("error IS NOT NULL").drop("_a", "_b")


def sightings(rows: DataFrame, key: str, url: str, seen: str, order: Sequence[str]) -> DataFrame:
    """(key, first_seen, last_seen, urls in order of first sight)."""
    # One row for each address of a key first, so a key's repeats are combined before the shuffle.
    one = rows.groupBy(key, url).agg(
        F.min(F.struct(*(F.col(c) for c in order))).alias("_at"),
        F.min(seen).alias("_first"),
        F.max(seen).alias("_last"),
    )
    urls = F.transform(F.array_sort(F.collect_list(F.struct("_at", F.col(url).alias("_u")))), lambda s: s["_u"])
    return one.groupBy(key).agg(
        F.min("_first").alias("first_seen"), F.max("_last").alias("last_seen"), urls.alias("seen_on_urls"),
    )


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(*keys)
