"""Embedding near-duplicates by sorted projection passes.

Each pass gives a vector the signs of random projections as a bit string,
sorts all vectors by it and compares every vector with its next ``WINDOW``
neighbours in that order; pairs verified by cosine in double precision are
united over the passes (of a block's pairs, those that connect its rows).  Close vectors share long bit prefixes, so they meet
in some pass: the number of first passes follows from the number of vectors and
the recall wanted.  Each pass also measures how crowded a vector's place is: the
bits it shares with the vector one window away are those a pair must agree on.
Vectors whose measured chance leaves more misses than wanted get further passes
among themselves, or, where passes would cost more, are compared all with all by
tiles of bounded size.

The order is cut into blocks of bounded size that overlap by one window, so no
task holds more than a block.  Equal vectors are one class with a count.  A
window cannot see all pairs of a large group, so links are counted afterwards
inside the components, by tiles of bounded size; only counts leave a tile.

Vectors that are null, zero or hold null or non-finite components link with
nothing and form their own component; rows with a null id are kept unlinked;
repeated rows are linked copies; vectors of different lengths never link; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, keep, read, row_numbers, union_all
from .vectors import dots, matrix, usable

COSINE = 0.95
WINDOW = 64
BLOCK = 4096
BITS = 64
CHUNK = 1024
MISSED = 1e-3


def passes(n: int, cosine: float = COSINE, window: int = WINDOW, missed: float = MISSED) -> int:
    """Passes after which a pair at the threshold is missed with at most the
    given probability, when it must agree on as many bits as leave about one
    window of vectors."""
    depth = max(1.0, math.log2(max(2.0, 2 * n / window)))
    agree = (1 - math.acos(cosine) / math.pi) ** depth
    return max(4, math.ceil(math.log(missed) / math.log(1 - agree)))


def _codes(rounds: int, seed: int):
    """One row per pass: the bit string as bytes whose order is the bits'."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            ids, v = batch.column(0), batch.column(1)
            dims = np.asarray(v.value_lengths())
            for dim in np.unique(dims).tolist():
                pick = pa.array(np.nonzero(dims == dim)[0])
                x, own = matrix(v.take(pick)), ids.take(pick)
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, rounds * BITS))
                bits = np.packbits((x @ planes[dim]) > 0, axis=1)
                width = BITS // 8
                for r in range(rounds):
                    code = np.ascontiguousarray(bits[:, r * width:(r + 1) * width])
                    yield pa.RecordBatch.from_arrays(
                        [own, pa.array(np.full(len(own), dim), pa.int32()), pa.array(np.full(len(own), r), pa.int32()),
                         pa.array([row.tobytes() for row in code], pa.binary())],
                        names=["vec_id", "dim", "pass", "code"])
    return run


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(dots(x, x))[:, None]


def _windows(window: int, cosine: float):
    """Verified pairs of a block, as many as it takes to connect its linked rows;
    and, with ``depth``, the bits that row ``a`` must share to meet a row on one
    side of it in the pass."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        ids, own = table["vec_id"].to_numpy(), table["own"].to_numpy()
        group = table["dim"].to_numpy().astype(np.int64) * 100_000 + table["pass"].to_numpy()
        lists = table["v"].combine_chunks()
        left: list[int] = []
        right: list[int] = []
        codes = np.frombuffer(b"".join(table["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
        crowding = []
        for g in np.unique(group).tolist():
            at = np.nonzero(group == g)[0]
            x, vid, first = _unit(matrix(lists.take(pa.array(at)))), ids[at], own[at]
            root = np.arange(len(at))
            if len(at) > window:
                apart = np.unpackbits(codes[at[:-window]] ^ codes[at[window:]], axis=1)[first[:-window]]
                depth = np.where(apart.any(axis=1), apart.argmax(axis=1), BITS) + 1
                for who in (vid[:-window], vid[window:]):
                    crowding.append((who[first[:-window]], np.full(len(depth), g % 100_000), depth))
            for d in range(1, min(window, len(at) - 1) + 1):
                hit = np.nonzero((dots(x[:-d], x[d:]) >= cosine) & first[:-d])[0]
                for i in hit[root[hit] != root[hit + d]].tolist():
                    a, b = root[i], root[i + d]
                    while a != root[a]:
                        a = root[a]
                    while b != root[b]:
                        b = root[b]
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        left.append(vid[i])
                        right.append(vid[i + d])
                while (root[root] != root).any():
                    root = root[root]
        a, b = np.array(left, np.int64), np.array(right, np.int64)
        who, turn, depth = (np.concatenate(c) for c in zip(*crowding)) if crowding else (np.empty(0),) * 3
        blank = [None] * len(a)
        return pa.table({"a": pa.array(np.concatenate([np.minimum(a, b), who.astype(np.int64)])),
                         "b": pa.array(np.concatenate([np.maximum(a, b), who.astype(np.int64)])),
                         "pass": pa.array(blank + turn.tolist(), pa.int32()),
                         "depth": pa.array(blank + depth.tolist(), pa.int32())})
    return run


def _all_pairs(cosine: float):
    """Pairs of a tile of two chunks: each row's links, by what they connect."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        i, j = int(key[0].as_py()), int(key[1].as_py())
        ids, chunk = table["vec_id"].to_numpy(), table["chunk"].to_numpy()
        lists = table["v"].combine_chunks()
        dims = np.asarray(lists.value_lengths())
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for dim in np.unique(dims).tolist():
            at = np.nonzero(dims == dim)[0]
            x, vid = _unit(matrix(lists.take(pa.array(at)))), ids[at]
            root = np.arange(len(at))
            a, b = np.nonzero(chunk[at] == i)[0], np.nonzero(chunk[at] == j)[0]
            for s in range(0, len(a), 512):
                rows = a[s:s + 512]
                near = x[rows] @ x[b].T
                link = near >= cosine
                r, c = np.nonzero(np.abs(near - cosine) < 1e-9)
                link[r, c] = dots(x[rows[r]], x[b[c]]) >= cosine
                for m in range(len(rows)):
                    to = b[link[m]]
                    own = root[rows[m]]
                    # one link to every tree not yet joined to this row's
                    trees, one = np.unique(root[to], return_index=True)
                    one, trees = one[trees != own], trees[trees != own]
                    if len(one):
                        left.append(np.full(len(one), vid[rows[m]]))
                        right.append(vid[to[one]])
                        root[np.isin(root, trees)] = own
        p, q = np.concatenate(left), np.concatenate(right)
        return pa.table({"a": np.minimum(p, q), "b": np.maximum(p, q)})
    return run


def _counts(cosine: float):
    """Links inside one tile, as the copies that each member gains.  A tile
    holds two chunks of one large component, or many small ones whole."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        i, j = int(key[1].as_py()), int(key[2].as_py())
        chunk, ids, group = (table[c].to_numpy() for c in ("chunk", "vec_id", "component"))
        gained = np.zeros(len(ids))
        weight = table["copies"].to_numpy().astype(np.float64)
        dims = np.asarray(table["v"].combine_chunks().value_lengths())
        for dim in np.unique(dims).tolist():
            at = np.nonzero(dims == dim)[0]
            x = np.zeros((len(ids), dim))
            x[at] = _unit(matrix(table["v"].combine_chunks().take(pa.array(at))))
            a, b = at[chunk[at] == i], at[chunk[at] == j]
            for s in range(0, len(a), 512):
                rows = a[s:s + 512]
                near = x[rows] @ x[b].T
                link = near >= cosine
                # pairs at the threshold are decided by the product used everywhere
                r, c = np.nonzero(np.abs(near - cosine) < 1e-9)
                link[r, c] = dots(x[rows[r]], x[b[c]]) >= cosine
                link &= group[rows][:, None] == group[b][None, :]
                if i == j:
                    link[ids[rows][:, None] == ids[b][None, :]] = False
                gained[rows] += link @ weight[b]
                if i != j:
                    gained[b] += weight[rows] @ link
        return pa.table({"vec_id": ids, "gained": gained.astype(np.int64)})
    return run


def _meet(reps: DataFrame, some: DataFrame, rounds: int, seed: int, cosine: float, window: int,
          block: int) -> tuple[DataFrame, DataFrame]:
    """Pairs that passes over ``some`` of the vectors find, and those (``vec_id,
    log_missed``) that may still miss more of theirs than ``MISSED``."""
    vectors = reps.select("vec_id", "v")
    before = some.select("vec_id", (F.col("log_missed") if "log_missed" in some.columns else F.lit(0.0)).alias("so_far"))
    chosen = vectors.join(before.select("vec_id"), "vec_id") if "log_missed" in some.columns else vectors
    codes = chosen.mapInArrow(_codes(rounds, seed), "vec_id long, dim int, pass int, code binary")
    ranked = row_numbers(codes, F.col("dim"), F.col("pass"), F.col("code"), F.col("vec_id"))
    home = F.floor(F.col("rank") / block)
    spread = F.when((F.col("rank") % block < window) & (F.col("rank") >= block), F.array(home, home - 1)) \
              .otherwise(F.array(home))
    placed = (ranked.withColumn("home", home).withColumn("block", F.explode(spread))
              .withColumn("own", F.col("home") == F.col("block")).drop("home"))
    met = keep(placed.join(vectors, "vec_id").groupBy("block").applyInArrow(
        _windows(window, cosine), "a long, b long, pass int, depth int"), "met")

    agree = 1 - math.acos(cosine) / math.pi

    # by the more crowded side, and by the mean over the passes: a pass in which a
    # vector stands alone is one in which its bits are near zero, and its partner's differ
    each = met.where("depth is not null").groupBy(F.col("a").alias("vec_id"), "pass").agg(F.max("depth").alias("depth"))
    total = (each.groupBy("vec_id").agg(F.count("*").alias("n"), F.avg("depth").alias("depth"))
             .withColumn("gained", rounds * F.log1p(-F.pow(F.lit(agree), F.col("depth")))))
    # a pass without a row saw the vector's whole side of the table: nothing is missed
    crowd = (total.where(F.col("n") == rounds).join(before, "vec_id")
             .select("vec_id", (F.col("so_far") + F.col("gained")).alias("log_missed"))
             .where(F.col("log_missed") > math.log(MISSED)))
    return met.where("depth is null").select("a", "b"), keep(crowd, "crowd")


def _tiled(vectors: DataFrame, n: int, cosine: float) -> DataFrame:
    chunks = -(-n // CHUNK)
    tiles = vectors.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    return (tiles.select(F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"),
                         "chunk", "vec_id", "v")
            .groupBy("lo", "hi").applyInArrow(_all_pairs(cosine), "a long, b long"))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, window: int = WINDOW, block: int = BLOCK,
                    rounds: int | None = None, seed: int = 7) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of
    ``vectors (vec_id, embedding)``."""
    rows = keep(usable(vectors).withColumn("h", F.xxhash64("v")), "vectors")
    # equal vectors are one class; its smallest id stands for it
    sized = rows.groupBy("h", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = keep(sized, "classes")
    reps = classes.select(F.col("rep").alias("vec_id"), "v", "copies").dropDuplicates(["vec_id"])
    rounds = rounds or passes(classes.count(), cosine, window)

    found, crowd = _meet(reps, reps, rounds, seed, cosine, window, block)
    pairs, spent = [found], rounds
    while n := crowd.count():
        if 2 * spent * window >= n:
            pairs.append(_tiled(reps.join(crowd, "vec_id").select("vec_id", "v"), n, cosine))
            break
        found, crowd = _meet(reps, crowd, spent, seed + spent, cosine, window, block)
        pairs.append(found)
        spent *= 2
    pairs = keep(union_all(pairs).distinct(), "pairs")
    label = keep(components(pairs), "components")

    # all links lie inside components: count them there, tile by tile
    members = keep(label.join(reps, F.col("node") == F.col("vec_id")).drop("node"), "members")
    sizes = members.groupBy("component").agg(F.count("*").alias("members"))
    bins = max(1, -(-members.count() // CHUNK))
    sized = members.join(sizes, "component").withColumn("chunks", F.ceil(F.col("members") / CHUNK))
    whole = sized.where("chunks = 1").select(
        F.pmod(F.xxhash64("component"), F.lit(bins)).alias("tile"), F.lit(0).cast("long").alias("lo"),
        F.lit(0).cast("long").alias("hi"), F.lit(0).cast("long").alias("chunk"), "component", "vec_id", "v", "copies")
    split = sized.where("chunks > 1").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    split = split.select((-1 - F.col("component")).alias("tile"), F.least("chunk", "other").alias("lo"),
                         F.greatest("chunk", "other").alias("hi"), "chunk", "component", "vec_id", "v", "copies")
    counted = (whole.unionByName(split).groupBy("tile", "lo", "hi")
               .applyInArrow(_counts(cosine), "vec_id long, gained long")
               .groupBy("vec_id").agg(F.sum("gained").alias("counted")))

    info = (classes.select("h", "v", "rep", F.col("copies").alias("same"))
            .join(label, F.col("rep") == F.col("node"), "left")
            .join(counted.withColumnRenamed("vec_id", "rep"), "rep", "left")
            .select("h", "v", F.coalesce("component", "rep").alias("component"),
                    (F.col("same") - 1 + F.coalesce("counted", F.lit(0))).alias("links")))
    found = keep(rows.join(info, ["h", "v"]).groupBy("vec_id").agg(
        F.max("links").alias("links"), F.min("component").alias("component")), "found")
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    return (every.join(found, "vec_id", "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def op10_projection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))
