"""Exact top-k search: tiled matrix products, partial selection per tile, tree merging.

Vectors become integers floor(scale * x). Rows are dealt to tiles of about ``TILE`` rows or
``TILE_BYTES`` at most, queries to blocks of ``BLOCK`` rows or as many bytes; each block meets each tile once (a stated query set against all rows,
in blocks). A worker multiplies pieces of the two, keeps the k best of each piece for every query,
and lists of one block are merged ``FAN_IN`` at a time until one is left. No task holds more than a
tile, a block, or FAN_IN lists of one block.

Defined results: ties go to the smaller vec_id; a row is never a candidate of its own query, but a
repeated row is; vectors that are null, or hold null or non-finite components, and rows whose vec_id
is null take no part; vectors of different lengths are not compared; fewer than k candidates give
fewer rows; scores are exact, and saturate at the limits of a long. Extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import partitions, written
from .vectext import released

TILE = 32_768
BLOCK = 2048
TILE_BYTES = 4 << 20
FAN_IN = 8
_PIECE = 4096
_LONG = (-(1 << 63), (1 << 63) - 1)


def quantised(rows: DataFrame, scale: float, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(rid, id, dim, v array<double>) of the rows that take part; v holds whole numbers."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    used = rows.where(F.col(ident).isNotNull() & F.col(vector).isNotNull()).where(~bad)
    # Spark's floor() gives a long; doubles beyond its range are whole already.
    whole = F.transform(
        vector,
        lambda c: F.when(
            F.abs(F.lit(float(scale)) * c.cast("double")) < 2.0**62,
            F.floor(F.lit(float(scale)) * c.cast("double")).cast("double"),
        ).otherwise(F.lit(float(scale)) * c.cast("double")),
    )
    return used.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(ident).cast("long").alias("id"),
        F.size(vector).alias("dim"),
        whole.alias("v"),
    )


def _packed(rows: DataFrame, key: str) -> DataFrame:
    """One row for each (dim, key): rids, ids and the matrix as bytes, ordered by id."""

    def pack(t: pa.Table) -> pa.Table:
        dim = t["dim"][0].as_py()
        ids = t["id"].to_numpy()
        order = np.lexsort((t["rid"].to_numpy(), ids))
        values = (
            t["v"].combine_chunks().flatten().to_numpy().reshape(-1, dim)[order] if dim else np.zeros((len(ids), 0))
        )
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                key: t[key].slice(0, 1),
                "rids": pa.array([t["rid"].to_numpy()[order].tobytes()]),
                "ids": pa.array([ids[order].tobytes()]),
                "m": pa.array([np.ascontiguousarray(values, np.float64).tobytes()]),
            }
        )

    return rows.groupBy("dim", key).applyInArrow(pack, f"dim int, {key} long, rids binary, ids binary, m binary")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of whole numbers, exactly: in doubles where no sum can leave 2**53, else in Python's integers."""
    top = (np.abs(a).max(initial=0.0) or 0.0) * (np.abs(b).max(initial=0.0) or 0.0) * max(1, a.shape[1])
    if top < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m.tolist()], dtype=object).reshape(m.shape)
    return np.clip(whole(a) @ whole(b).T, *_LONG).astype(np.int64)


def best(
    scores: np.ndarray,
    ids: np.ndarray,
    k: int,
    alive: np.ndarray | None = None,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each row of scores the k best (ids, scores), ties to the smaller id. ids: one row or one for each."""
    out = []
    for q in range(len(scores)):
        s = scores[q]
        i = ids if ids.ndim == 1 else ids[q]
        if alive is not None:
            s, i = s[alive[q]], i[alive[q]]
        if len(s) > 4 * k:
            least = np.partition(s, len(s) - k)[len(s) - k]
            above, equal = np.flatnonzero(s > least), np.flatnonzero(s == least)
            if len(equal) > k:
                equal = equal[np.argpartition(i[equal], k)[:k]]
            keep = np.concatenate([above, equal])
            s, i = s[keep], i[keep]
        order = np.lexsort((i, -s.astype(np.float64) if abs(s).max(initial=0) < 2**53 else [-int(x) for x in s]))[:k]
        out.append((i[order], s[order]))
    return out


def _lists(dim: int, block: int, part: int, rows: list[tuple[np.ndarray, np.ndarray]]) -> dict:
    return {
        "dim": dim,
        "block": block,
        "part": part,
        "sizes": np.array([len(i) for i, _ in rows], np.int32).tobytes(),
        "ids": np.concatenate([i for i, _ in rows]).astype(np.int64).tobytes(),
        "scores": np.concatenate([s for _, s in rows]).astype(np.int64).tobytes(),
    }


_LISTS = "dim int, block long, part long, sizes binary, ids binary, scores binary"
_ARROW = pa.schema(
    [
        ("dim", pa.int32()), ("block", pa.int64()), ("part", pa.int64()), ("sizes", pa.binary()), ("ids", pa.binary()),
        ("scores", pa.binary()),
    ]
)


def top_k(
    rows: DataFrame,
    k: int,
    *,
    scale: float = 64,
    every: int = 20,
    tile: int = TILE,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row whose vec_id is divisible by ``every``."""
    spark = rows.sparkSession
    base = written(quantised(rows, scale))
    n, entries = base.agg(F.count("*"), F.coalesce(F.sum("dim"), F.lit(0))).first()
    bytes_ = 8 * int(entries)
    tiles = max(-(-n // tile), -(-bytes_ // TILE_BYTES), min(2 * partitions(spark), -(-n // 1024)), 1)
    blocks = max(-(-n // every // block), -(-bytes_ // every // TILE_BYTES), 1)
    spread = lambda parts: F.pmod(F.xxhash64("rid"), F.lit(parts))
    tiled = _packed(base.withColumn("tile", spread(tiles)), "tile")
    asked = base.where(F.pmod("id", F.lit(every)) == 0)
    blocked = written(_packed(asked.withColumn("block", spread(blocks)), "block"))
    sent = blocked.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
    # ``sent`` holds the queries once for each tile, though Spark takes it for no larger than the file it comes from; the
    # hint keeps it out of a broadcast, which the driver would have to hold. The tile, one row for each key, is what
    # the merge buffers.
    met = sent.select("dim", "tile", "block", F.col("rids").alias("q_rids"), F.col("m").alias("q")).hint("merge").join(
        tiled, ["dim", "tile"],
    )

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rids, ids, q_rids = (np.frombuffer(r[x], np.int64) for x in ("rids", "ids", "q_rids"))
                m, q = np.frombuffer(r["m"]).reshape(len(ids), r["dim"]), np.frombuffer(r["q"]).reshape(
                    len(q_rids), r["dim"],
                )
                out: list[tuple[np.ndarray, np.ndarray]] = []
                for a in range(0, len(q), 256):
                    part: list[tuple[np.ndarray, np.ndarray]] | None = None
                    for b in range(0, len(m), _PIECE):
                        scores = products(q[a : a + 256], m[b : b + _PIECE])
                        alive = q_rids[a : a + 256, None] != rids[None, b : b + _PIECE]
                        got = best(scores, ids[b : b + _PIECE], k, alive)
                        part = (
                            got
                            if part is None
                            else [
                                best(np.concatenate([x[1], y[1]])[None], np.concatenate([x[0], y[0]]), k)[0]
                                for x, y in zip(part, got, strict=True)
                            ]
                        )
                    out += part or []
                yield pa.RecordBatch.from_pylist([_lists(r["dim"], r["block"], r["tile"], out)], _ARROW)

    lists = written(
        met.select("dim", "tile", "block", "rids", "ids", "m", "q_rids", "q").mapInArrow(released(multiply), _LISTS)
    )

    def merge(t: pa.Table) -> pa.Table:
        parts = t.to_pylist()
        sizes = [np.frombuffer(p["sizes"], np.int32) for p in parts]
        ids = [
            np.split(np.frombuffer(p["ids"], np.int64), np.cumsum(z)[:-1]) for p, z in zip(parts, sizes, strict=True)
        ]
        scores = [
            np.split(np.frombuffer(p["scores"], np.int64), np.cumsum(z)[:-1]) for p, z in zip(parts, sizes, strict=True)
        ]
        rows = [
            best(np.concatenate(s)[None], np.concatenate(i), k)[0]
            for i, s in zip(zip(*ids, strict=True), zip(*scores, strict=True), strict=True)
        ]
        return pa.Table.from_pylist(
            [_lists(parts[0]["dim"], parts[0]["block"], parts[0]["part"] // FAN_IN, rows)],
            _ARROW,
        )

    left = tiles
    while left > 1:
        lists = lists.withColumn("group", F.floor(F.col("part") / FAN_IN)).groupBy("dim", "block", "group").applyInArrow(
            lambda t: merge(t.drop_columns(["group"])),
            _LISTS,
        )
        left = -(-left // FAN_IN)
    names = blocked.select("dim", "block", F.col("rids").alias("q_rids"), F.col("ids").alias("q_ids"))

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                sizes = np.frombuffer(r["sizes"], np.int32)
                rank = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.frombuffer(r["q_ids"], np.int64), sizes)),
                        pa.array(rank.astype(np.int32)),
                        pa.array(np.frombuffer(r["ids"], np.int64)),
                        pa.array(np.frombuffer(r["scores"], np.int64)),
                    ],
                    names=["query_id", "rank", "vec_id", "score"],
                )

    return lists.join(names, ["dim", "block"]).select("sizes", "ids", "scores", "q_ids").mapInArrow(
        unfold,
        "query_id long, rank int, vec_id long, score long",
    )
