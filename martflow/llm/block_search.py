"""Nearest neighbours by a block matrix join of int8 product tiles.

Queries and candidates are cut into blocks; each pair of blocks is one tile.
In a tile both sides are rounded to int8 with a scale per vector, and one
product of the int8 matrices gives all approximate inner products.  With
``x = s * q + e`` and ``|e| <= s / 2`` per component, the rounding error of an
inner product is at most ``s_x/2 * |y|_1 + s_y/2 * |q_x s_x|_1``: pairs whose
upper bound is below the k-th largest lower bound of their query cannot be
among its k nearest.  The pairs that survive are computed again in double
precision, a heap keeps the k best of each tile, and the heaps of a query are
merged.  So the result is exact.

Every tile has bounded size.  Vectors that are null, zero or hold null or
non-finite components take no part; repeated rows are candidates each, and one
query, unless their vectors differ (then each gives its own neighbours); a query
never meets rows with its own id; ties go to the smaller id; an empty table or
a single vector gives no rows; vectors of another length than most are matched
among their own length only; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, read
from .vectors import dots, matrix, usable

BLOCK = 4096
#: Relative room for the rounding of the bounds' own arithmetic.
ROOM = 1e-9


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1.0
    return np.rint(x / scale[:, None]).astype(np.int8), scale


def tile_best(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int,
              step: int = 256) -> Iterator[tuple[int, int, float]]:
    """``query, vec_id, score`` of each query's k best in one tile; a query is
    told by its row."""
    cq, cs = quantise(c)
    c8 = cq.astype(np.float32).T        # products of int8 are exact in float32 up to 1,000 dimensions
    c_one = np.abs(c).sum(axis=1)
    exact = np.float32 if q.shape[1] * 127 * 127 < 2 ** 24 else np.float64
    for at in range(0, len(q), step):
        x, ids = q[at:at + step], q_ids[at:at + step]
        xq, xs = quantise(x)
        near = (xq.astype(exact) @ c8.astype(exact, copy=False)).astype(np.float64) * xs[:, None] * cs
        x_one = np.abs(xq.astype(np.float64)).sum(axis=1) * xs
        error = (xs[:, None] / 2 * c_one + cs / 2 * x_one[:, None]) * (1 + ROOM) + ROOM
        near[ids[:, None] == c_ids[None, :]] = -np.inf
        low = near - error
        if len(c_ids) > k:
            floor = np.partition(low, len(c_ids) - k, axis=1)[:, len(c_ids) - k]
        else:
            floor = np.full(len(ids), -np.inf)
        rows, cols = np.nonzero((near + error >= floor[:, None]) & (near > -np.inf))
        scores = dots(x[rows], c[cols])
        bounds = np.searchsorted(rows, np.arange(len(ids) + 1))
        for i in range(len(ids)):
            mine = slice(bounds[i], bounds[i + 1])
            found = zip(scores[mine].tolist(), c_ids[cols[mine]].tolist())
            for score, vec in heapq.nsmallest(k, found, key=lambda p: (-p[0], p[1])):
                yield at + i, vec, score


def _tile(k: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        is_query = table["is_query"].to_numpy()
        ids, v = table["vec_id"].to_numpy(), matrix(table["v"])
        out = list(tile_best(ids[is_query], v[is_query], ids[~is_query], v[~is_query], k)) \
            if is_query.any() and not is_query.all() else []
        cols = list(zip(*out)) or [(), (), ()]
        row = np.array(cols[0], np.int64)
        return pa.table({"query_id": pa.array(ids[is_query][row], pa.int64()),
                         "which": pa.array(table["h"].to_numpy()[is_query][row], pa.int64()),
                         "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products of every
    row of ``vectors (vec_id, embedding)`` for which ``is_query`` holds, nearest
    first.  ``is_query`` is a condition on ``vec_id``."""
    base = keep(usable(vectors).withColumn("dim", F.size("v")), "vectors")
    sizes = base.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    c_blocks, q_blocks = max(1, -(-sizes["n"] // block)), max(1, -(-sizes["q"] // block))
    base = base.withColumn("h", F.xxhash64("vec_id", F.monotonically_increasing_id()))
    asked = base.where(is_query).select("dim", "vec_id", "v").distinct().withColumn("h", F.xxhash64("vec_id", "v"))
    candidates = base.select(
        "dim", "h", F.pmod("h", F.lit(c_blocks)).alias("cb"), F.lit(False).alias("is_query"), "vec_id", "v",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))).alias("qb"))
    queries = asked.select(
        "dim", "h", F.pmod("h", F.lit(q_blocks)).alias("qb"), F.lit(True).alias("is_query"), "vec_id", "v",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c_blocks - 1).cast("long"))).alias("cb"))
    tiles = candidates.unionByName(queries).groupBy("dim", "cb", "qb").applyInArrow(
        _tile(k), "query_id long, which long, vec_id long, score double")
    order = Window.partitionBy("query_id", "which").orderBy(F.desc("score"), "vec_id")
    return (tiles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op7_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, q.e AS asked, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS score
  FROM (SELECT DISTINCT vec_id, e FROM v) q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id, asked ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 20
"""
