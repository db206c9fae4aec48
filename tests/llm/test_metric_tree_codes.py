from __future__ import annotations

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from martflow.llm import metric_tree_codes as m

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, code string, n string, q string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)


def brute(rows, parts=8, entries=16, rounds=6):
    """Every part against every entry, in Python's integers."""
    kept = [(i, [math.floor(4096 * x) for x in v], g) for i, v, g in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = len(kept[0][1]) if kept else 0
    kept = [r for r in kept if len(r[1]) == length]
    at = [p * length // parts for p in range(parts + 1)]
    cut = [[v[a:b] for _, v, _ in kept] for a, b in zip(at, at[1:])]
    books = [[list(x) for x in c[:entries]] for c in cut]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            won = [nearest(x, books[p])[1] for x in cut[p]]
            for j in range(len(books[p])):
                mine = [x for x, w in zip(cut[p], won) if w == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [[nearest(x, books[p]) for x in cut[p]] for p in range(parts)]
    out = []
    for i, (vec_id, _, label) in enumerate(kept):
        out.append((vec_id, label, "".join(f"{last[p][i][1]:02x}" for p in range(parts)),
                    sum(last[p][i][0] for p in range(parts))))
    return out, books


def cloud(n=260, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((9, dim)) * 0.3
    x = centre[rng.integers(0, 9, n)] + 0.05 * rng.standard_normal((n, dim))
    x[5::7] = x[5]                      # a third or so are copies
    x[::11] = np.round(x[::11] * 8) / 8   # ties
    rows = [(1000 - i, [float(v) for v in r], int(rng.integers(0, 3)) if i % 4 else None) for i, r in enumerate(x)]
    return rows


ODD = [(1, None, 1), (2, [float("nan")] * 16, 1), (3, [None] * 16, 1), (5, [float("inf")] * 16, 2),
       (None, [0.5] * 16, 7), (2000, [0.0] * 16, 2), (2000, [0.0] * 16, 2), (2001, [0.1, 0.2], 2), (2002, [], 2)]


def told(coded):
    return sorted(((r["vec_id"], None if not r["label"] else int(r["label"][1:]), r["code"], r["error"])
                   for r in coded.collect()), key=repr)


@pytest.mark.parametrize("rows,block", [(cloud() + ODD, 64), (cloud(40, 10, 4), 8192), (cloud(7, 3, 5), 2), ([], 8)])
def test_codes_equal_brute_force(spark, rows, block):
    coded, books = m.compress(frame(spark, rows), F.col("label"), block=block)
    want, want_books = brute(rows)
    assert told(coded) == sorted(want, key=repr)
    assert [b.tolist() for b in books] == want_books


def test_huge_components_are_dropped(spark):
    rows = cloud(30) + [(0, [1e300] + [0.0] * 15, 1), (3000, [65_536.0] + [0.0] * 15, 1)]
    coded, _ = m.compress(frame(spark, rows))
    assert coded.count() == 30


@pytest.mark.parametrize("n,copies", [(1, 0), (30, 0), (700, 0), (700, 600)])
def test_trees_hold_every_point_and_their_balls(n, copies):
    x = np.random.default_rng(n).integers(-300, 300, (n, 4))
    x[:copies] = x[0]
    t = m.build_tree(x, leaf=8)
    assert sorted(t.order.tolist()) == list(range(n)) and (t.points == x[t.order]).all()
    for i in range(len(t.begin)):
        inside = t.points[t.begin[i]:t.end[i]]
        assert (t.sums[i] == inside.sum(axis=0)).all()
        assert np.sqrt(((inside - t.centre[i]) ** 2).sum(axis=1)).max() <= t.radius[i] + 1e-6
        if t.left[i] >= 0:
            l, r = t.left[i], t.right[i]
            assert (t.begin[l], t.end[l], t.end[r]) == (t.begin[i], t.begin[r], t.end[i])


def test_owned_balls_spare_comparisons():
    """Well apart clusters are owned whole; sums equal those of comparing all."""
    rng = np.random.default_rng(8)
    entries = rng.integers(-100_000, 100_000, (16, 8))
    x = entries[rng.integers(0, 16, 4000)] + rng.integers(-50, 50, (4000, 8))
    t, compared = m.build_tree(x), []
    m.descend(t, entries, lambda nodes, w: None, lambda where, w: compared.append(len(where)))
    assert sum(compared) < 400
    sums, counts = m.sums_of(t, entries)
    near = ((x[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    for j in range(16):
        assert counts[j] == (near == j).sum() and (sums[j] == x[near == j].sum(axis=0)).all()


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_query_equals_its_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want, got = con.execute(m.OP12_SQL).df(), m.op12_vector_codes(spark, SF).toPandas()
    cols = sorted(got.columns)
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b) and (a == b).all().all()
