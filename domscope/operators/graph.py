"""Connected components of an edge table.

First every partition contracts its own edges by union-find, which leaves at most one edge for each of
its nodes; a table of at most ``LOCAL_EDGES`` edges is one partition and done then. Larger tables go
on in alternating large-star and small-star rounds: each star is a minimum per node (combined before
the shuffle) joined back to the edges, so a node of any degree never gathers its neighbours in one
task, and every round ends in a table in the shared folder, which replaces that of the round before.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import kept_with, written

LOCAL_EDGES = 200_000


def contract(pairs: list[tuple]) -> list[tuple]:
    """(node, smallest node of its part) for nodes that are not the smallest."""
    parent: dict = {}

    def find(x):
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            x, parent[x] = parent.get(x, x), root
        return root

    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return [(x, find(x)) for x in list(parent) if find(x) != x]


def _contracted(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stars: list[tuple] = []
        schema = None
        for b in batches:
            schema = b.schema
            stars = contract([*stars, *zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)])
        if schema is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in stars], schema.types[0]), pa.array([y for _, y in stars], schema.types[1])],
                names=["u", "v"],
            )

    return edges.select("u", "v").mapInArrow(run, edges.select("u", "v").schema)


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large(edges: DataFrame) -> DataFrame:
    """Neighbours above u hang on the smallest of u and its neighbours."""
    e = _both(edges)
    least = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return e.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours hang on the smallest of them. Edges point from larger to smaller."""
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    joined = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str, *, local_edges: int | None = None, max_rounds: int = 60) -> DataFrame:
    """(node, component) of each node that has an edge; component is the smallest node reachable.
    Edges with a null end are left out; a node with self-links only has no row. The result can be
    discarded (``shared.discard``) once it has been read."""
    size = LOCAL_EDGES if local_edges is None else local_edges
    e = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    parts = max(1, -(-e.count() // size))
    e = written(_contracted(e.coalesce(parts)), e)
    before = None
    for _ in range(max_rounds if parts > 1 else 0):
        e = written(_small(_large(e)), e)
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    else:
        if parts > 1:
            raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return kept_with(e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), e)
