"""Vector codes: product quantisation trained over anchors-hierarchy metric trees.

Vectors become integers and are cut into parts; every part position has a
codebook, trained by rounds that give each part to its nearest entry and
replace each entry by the floored mean of its parts.

The rows are cut into blocks, and for each block and part position a metric
tree of balls is built once, middle-out: about the square root of the points are
taken as anchors (each new one is the point farthest from the anchor of the
widest ball, and takes the points nearer to it, skipping balls that the triangle
inequality rules out); the anchors' balls are joined upwards, the two that
give the smallest ball first, and cut downwards by the same step.  A ball caches
the sum and the number of its parts.

A round goes down a tree with a list of entries that may still be the nearest
one of some point of the ball.  A ball inherits its parent's list and drops
every entry ``e`` that another one, ``b``, beats all over the ball:
``|c-b|^2 - |c-e|^2 + 2 r |e-b| < 0`` for centre ``c`` and radius ``r``.  With one
entry left the ball is owned by it, and its cached sum and count are added
at once; at the leaves the rest is compared in integers.  Room for rounding is
left on the side that keeps an entry, so the result is that of comparing all.

Trees are a table in the shared folder; a round sends out the codebooks (parts x
entries, a fixed size) and brings back sums and counts, added up in decimals.

Defined cases: vectors that are null, or hold null or non-finite components, are
dropped; so are those whose length is not that of the smallest id left, and
those with a component of 65,536 or more in size, whose squares would not
fit.  Fewer than 16 rows give fewer entries.  Parts end at ``p * length // parts``.
Repeated ids are rows of their own, ordered by their vectors where they tie;
null ids come last.  Entries that are equal stay, the lower one is used.  An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, read, with_group
from .vectors import matrix

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Rows of a block, and points of a ball that is cut no further.
BLOCK, LEAF = 2048, 64
LARGEST = float(1 << 28)
#: Relative room for the rounding of distances between balls and entries.
ROOM = 1e-9


# ---------------------------------------------------------------- trees

@dataclass
class Tree:
    """A metric tree over the points of one block and part position.  Points
    are reordered so that those of a ball are one stretch."""

    points: np.ndarray      # int64, in tree order
    order: np.ndarray       # row in the block of each point
    centre: np.ndarray
    radius: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    sums: np.ndarray
    left: np.ndarray        # child balls; -1: a leaf
    right: np.ndarray


def _anchors(x: np.ndarray, k: int) -> list[np.ndarray]:
    """Up to ``k`` groups of rows around anchors."""
    d = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    pivots, owned, reach = [x[0]], [np.arange(len(x))], [d]
    while len(pivots) < k:
        wide = max(range(len(pivots)), key=lambda a: reach[a].max())
        far = reach[wide].argmax()
        if reach[wide][far] == 0:      # the rest are copies
            break
        new = x[owned[wide][far]]
        taken, dist = [], []
        for a, pivot in enumerate(pivots):
            apart = np.sqrt(((pivot - new) ** 2).sum())
            near = reach[a] > apart / 2     # nearer ones cannot be nearer to the new anchor
            if not near.any():
                continue
            rows = owned[a][near]
            d = np.sqrt(((x[rows] - new) ** 2).sum(axis=1))
            moves = d < reach[a][near]
            taken.append(rows[moves])
            dist.append(d[moves])
            stay = np.ones(len(reach[a]), bool)
            stay[np.flatnonzero(near)[moves]] = False
            owned[a], reach[a] = owned[a][stay], reach[a][stay]
        pivots.append(new)
        owned.append(np.concatenate(taken))
        reach.append(np.concatenate(dist))
    return [o for o in owned if len(o)]


class _Builder:
    def __init__(self, x: np.ndarray, leaf: int):
        self.x, self.leaf = x.astype(np.float64), leaf
        self.balls: list[tuple] = []        # centre, radius, left, right
        self.rows: list[np.ndarray | None] = []

    def _ball(self, rows: np.ndarray, left: int = -1, right: int = -1) -> int:
        c = self.x[rows].mean(axis=0)
        r = np.sqrt(((self.x[rows] - c) ** 2).sum(axis=1).max())
        self.balls.append((c, r, left, right))
        self.rows.append(rows)
        return len(self.balls) - 1

    def build(self, rows: np.ndarray) -> int:
        if len(rows) <= self.leaf:
            return self._ball(rows)
        groups = _anchors(self.x[rows], max(2, int(np.sqrt(len(rows)))))
        if len(groups) == 1:
            return self._ball(rows)
        return self._join([self.build(rows[g]) for g in groups])

    def _join(self, nodes: list[int]) -> int:
        """Balls joined in pairs, the pair of the smallest common ball first."""
        c = np.array([self.balls[n][0] for n in nodes])
        r = np.array([self.balls[n][1] for n in nodes])
        size = (np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2)) + r[:, None] + r[None]) / 2
        np.fill_diagonal(size, np.inf)
        for _ in range(len(nodes) - 1):
            a, b = divmod(int(size.argmin()), len(nodes))
            rows = np.concatenate([self.rows[nodes[a]], self.rows[nodes[b]]])
            nodes[a] = self._ball(rows, nodes[a], nodes[b])
            c[a], r[a] = self.balls[nodes[a]][:2]
            dead = ~np.isfinite(size).any(axis=1)
            row = (np.sqrt(((c - c[a]) ** 2).sum(axis=1)) + r + r[a]) / 2
            row[dead] = np.inf
            row[[a, b]] = np.inf
            size[b], size[:, b] = np.inf, np.inf
            size[a], size[:, a] = row, row
            last = nodes[a]
        return last


def build_tree(x: np.ndarray, leaf: int = LEAF) -> Tree:
    b = _Builder(x, leaf)
    root = b.build(np.arange(len(x)))
    order, begin = [], np.zeros(len(b.balls), np.int64)
    # depth first from the root, so that a ball's points follow one another
    stack, at, top_down = [root], 0, []
    while stack:
        node = stack.pop()
        top_down.append(node)
        _, _, left, right = b.balls[node]
        begin[node] = at
        if left < 0:
            order.append(b.rows[node])
            at += len(b.rows[node])
        else:
            stack += [right, left]
    place = {node: i for i, node in enumerate(top_down)}
    size = np.array([len(b.rows[n]) for n in top_down])
    begin = begin[top_down]
    order = np.concatenate(order)
    points = x[order]
    upto = np.concatenate([np.zeros((1, x.shape[1]), np.int64), np.cumsum(points, axis=0)])
    return Tree(points=points, order=order, centre=np.array([b.balls[n][0] for n in top_down]),
                radius=np.array([b.balls[n][1] for n in top_down]), begin=begin, end=begin + size,
                sums=upto[begin + size] - upto[begin],
                left=np.array([place.get(b.balls[n][2], -1) for n in top_down]),
                right=np.array([place.get(b.balls[n][3], -1) for n in top_down]))


def descend(tree: Tree, entries: np.ndarray, owned: Callable, compared: Callable) -> None:
    """Go down a tree.  ``owned(nodes, winners)`` gets the balls owned by one
    entry, ``compared(points, winners)`` the points that had to be compared."""
    e = entries.astype(np.float64)
    apart = np.sqrt(((e[:, None] - e[None]) ** 2).sum(axis=2))
    first = [next(j for j in range(len(e)) if apart[i, j] == 0) for i in range(len(e))]
    nodes = np.array([0])
    lists = np.array([[first[i] == i for i in range(len(e))]])     # of equal entries the lowest
    while len(nodes):
        c, r = tree.centre[nodes], tree.radius[nodes]
        d = ((c[:, None] - e[None]) ** 2).sum(axis=2)
        best = np.where(lists, d, np.inf).argmin(axis=1)
        least = d[np.arange(len(nodes)), best]
        turn = 2 * r[:, None] * apart[best]
        room = ROOM * (d + least[:, None] + turn) + 1e-6
        lists = lists & ~(least[:, None] - d + turn < -room)
        alone = lists.sum(axis=1) == 1
        owned(nodes[alone], best[alone])
        nodes, lists = nodes[~alone], lists[~alone]
        leaf = tree.left[nodes] < 0
        for node, cand in zip(nodes[leaf], lists[leaf]):
            where = np.arange(tree.begin[node], tree.end[node])
            index = np.flatnonzero(cand)
            dist = ((tree.points[where][:, None] - entries[index][None]) ** 2).sum(axis=2)
            compared(where, index[dist.argmin(axis=1)])     # argmin takes the lower index
        inner, lists = nodes[~leaf], lists[~leaf]
        nodes = np.concatenate([tree.left[inner], tree.right[inner]])
        lists = np.concatenate([lists, lists])              # inherited


def sums_of(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the parts of each entry."""
    sums = np.zeros(entries.shape, np.int64)
    counts = np.zeros(len(entries), np.int64)

    def owned(nodes: np.ndarray, winners: np.ndarray) -> None:
        np.add.at(sums, winners, tree.sums[nodes])
        np.add.at(counts, winners, tree.end[nodes] - tree.begin[nodes])

    def compared(where: np.ndarray, winners: np.ndarray) -> None:
        np.add.at(sums, winners, tree.points[where])
        np.add.at(counts, winners, 1)

    descend(tree, entries, owned, compared)
    return sums, counts


def codes_of(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each row of the block."""
    code = np.zeros(len(tree.points), np.int64)

    def owned(nodes: np.ndarray, winners: np.ndarray) -> None:
        for node, w in zip(nodes, winners):
            code[tree.begin[node]:tree.end[node]] = w

    def compared(where: np.ndarray, winners: np.ndarray) -> None:
        code[where] = winners

    descend(tree, entries, owned, compared)
    error = ((tree.points - entries[code]) ** 2).sum(axis=1)
    out, miss = np.empty_like(code), np.empty_like(error)
    out[tree.order], miss[tree.order] = code, error
    return out, miss


# ---------------------------------------------------------------- on Spark

FIELDS = ("points", "order", "centre", "radius", "begin", "end", "sums", "left", "right")


def _pack(tree: Tree) -> bytes:
    """Arrays one after another, as an Arrow stream."""
    arrays = [getattr(tree, f) for f in FIELDS]
    batch = pa.record_batch({"data": pa.array([np.ascontiguousarray(a).tobytes() for a in arrays], pa.binary()),
                             "kind": pa.array([a.dtype.str for a in arrays]),
                             "shape": pa.array([list(a.shape) for a in arrays], pa.list_(pa.int64()))})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> Tree:
    return Tree(*[np.frombuffer(r["data"], dtype=r["kind"]).reshape(r["shape"])
                  for r in pa.ipc.open_stream(data).read_all().to_pylist()])


def cuts(length: int, parts: int) -> list[int]:
    return [p * length // parts for p in range(parts + 1)]


def _trees(length: int, parts: int, block: int):
    """Rows to blocks: ids and labels, and a tree for each part position."""
    def made(ids: list, keys: list, x: np.ndarray) -> pa.RecordBatch:
        at = cuts(length, parts)
        trees = [_pack(build_tree(np.ascontiguousarray(x[:, a:b]))) for a, b in zip(at, at[1:])]
        return pa.record_batch({"ids": pa.array([ids], pa.list_(pa.int64())),
                                "groups": pa.array([keys], pa.list_(pa.string())),
                                "trees": pa.array([trees], pa.list_(pa.binary()))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, block - n)
                held.append(part)
                n += part.num_rows
                batch = batch.slice(part.num_rows)
                if n == block:
                    yield close(held)
                    held, n = [], 0
        if held:
            yield close(held)

    def close(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        x = matrix(table["q"]) if length else np.zeros((len(table), 0))
        return made(table["vec_id"].to_pylist(), table["label"].to_pylist(), x.astype(np.int64))
    return run


def _round(codebooks: list[np.ndarray]):
    """Sums and counts of each part position and entry, over a task's blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(c.shape, np.int64) for c in codebooks]
        counts = [np.zeros(len(c), np.int64) for c in codebooks]
        for batch in batches:
            for trees in batch.column("trees"):
                for p, data in enumerate(trees):
                    s, n = sums_of(_unpack(data.as_py()), codebooks[p])
                    sums[p] += s
                    counts[p] += n
        rows = [(p, e, int(counts[p][e]), sums[p][e].tolist()) for p in range(len(sums)) for e in range(len(sums[p]))
                if counts[p][e]]
        cols = list(zip(*rows)) or [()] * 4
        yield pa.record_batch({"part": pa.array(cols[0], pa.int32()), "entry": pa.array(cols[1], pa.int32()),
                               "n": pa.array(cols[2], pa.int64()), "sums": pa.array(cols[3], pa.list_(pa.int64()))})
    return run


def _coded(codebooks: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, groups, trees in zip(*[batch.column(c) for c in ("ids", "groups", "trees")]):
                got = [codes_of(_unpack(t.as_py()), codebooks[p]) for p, t in enumerate(trees)]
                code = ["".join(f"{c:02x}" for c in row) for row in np.stack([g[0] for g in got], axis=1).tolist()]
                yield pa.record_batch({"vec_id": ids.values, "label": groups.values, "code": pa.array(code, pa.string()),
                                       "error": pa.array(sum(g[1] for g in got), pa.int64())})
    return run


def integers(vectors: DataFrame, label: Column | None, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, q array<long>``: floored multiples of the components of
    the rows that take part; the label as text."""
    v = F.col("embedding").cast("array<double>")
    key = F.lit(None) if label is None else label
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"),
                           F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("")).alias("label"))
            .where(F.col("v").isNotNull())
            .where(~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * scale >= LARGEST)))
            .select("vec_id", "label", F.transform("v", lambda c: F.floor(c * scale).cast("long")).alias("q")))


def train(trees: DataFrame, codebooks: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks after ``rounds`` rounds over the tables of trees."""
    for _ in range(rounds):
        found = (trees.select("trees").mapInArrow(_round(codebooks), "part int, entry int, n long, sums array<long>")
                 .select("part", "entry", "n", F.posexplode("sums").alias("at", "x"))
                 .groupBy("part", "entry", "at")
                 .agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")))
        codebooks = [c.copy() for c in codebooks]
        for r in found.collect():       # a row per component of the codebooks: a fixed number
            codebooks[r["part"]][r["entry"], r["at"]] = int(r["x"]) // r["n"]
    return codebooks


def compress(vectors: DataFrame, label: Column | None = None, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, block: int = BLOCK) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, code, error`` of every vector that takes part, and the
    codebooks: per part position an array of entries."""
    rows = integers(vectors, label)
    smallest = rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(1).collect()
    length = len(smallest[0]["q"]) if smallest else 0
    rows = rows.where(F.size("q") == length)
    first = [r["q"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).collect()]
    start = np.array(first, np.int64).reshape(len(first), length)
    at = cuts(length, parts)
    books = [np.ascontiguousarray(start[:, a:b]) for a, b in zip(at, at[1:])]
    trees = keep(rows.mapInArrow(_trees(length, parts, block),
                                 "ids array<long>, groups array<string>, trees array<binary>"), "trees")
    books = train(trees, books, rounds)
    return trees.mapInArrow(_coded(books), "vec_id long, label string, code string, error long"), books


def books_digest(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for c in codebooks for x in c.ravel().tolist()).encode()).hexdigest()


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(read(spark, sf_dir, "embeddings"), F.col("label"))
    rows = keep(coded, "codes")
    # a label may hold a third of all rows: summed before it is shuffled
    sums = keep(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "labels")
    out = with_group(rows, sums, "label", "n", ["label_error"])
    return out.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The rounds written out one after another."""
    steps = [f"""
kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, q) AS id, vec_id, label, q FROM (
    SELECT vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda c: CAST(floor(c * {SCALE}) AS BIGINT)) AS q
    FROM embeddings WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)),
part AS (
  SELECT id, p, list_slice(q, p * len(q) // {parts} + 1, (p + 1) * len(q) // {parts}) AS x
  FROM kept, generate_series(0, {parts - 1}) AS s(p)),
book0 AS (SELECT p, CAST(id - 1 AS BIGINT) AS e, x AS c FROM part WHERE id <= {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
near{i} AS (
  SELECT id, p, min(d) AS d, arg_min(e, d * {entries} + e) AS e FROM (
    SELECT id, t.p, e, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM part t JOIN book{i} b ON t.p = b.p) GROUP BY id, p)""")
        if i < rounds:
            steps.append(f"""
mean{i} AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, e, i, CAST(sum(v) AS BIGINT) // count(*) - CASE WHEN CAST(sum(v) AS BIGINT) % count(*) < 0 THEN 1 ELSE 0 END AS m
    FROM (SELECT n.p, n.e, unnest(x) AS v, generate_subscripts(x, 1) AS i
          FROM near{i} n JOIN part t ON n.id = t.id AND n.p = t.p) GROUP BY p, e, i) GROUP BY p, e),
book{i + 1} AS (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{i} b LEFT JOIN mean{i} m ON b.p = m.p AND b.e = m.e)""")
    return f"""
WITH {','.join(steps)},
digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}),
coded AS (
  SELECT id, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (id), digest
"""


OP12_SQL = _sql()
