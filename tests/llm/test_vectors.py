import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import groups
from martflow.llm.block_search import nearest, quantise, tile_best
from martflow.llm.projection_dedup import near_duplicates, passes

SCHEMA = "vec_id long, embedding array<float>, label int, v string, rank string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "clash", "clash") for i, v in vectors], SCHEMA)


def cloud(seed=1, n=300, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim)).astype(np.float32)
    for i in range(0, n, 10):
        base[i + 1] = base[i]                                         # an exact copy
        base[i + 2] = base[i] + 0.05 * rng.standard_normal(dim)       # a near one
        base[i + 3] = 3 * base[i]                                     # the same direction
    return [(i, [float(x) for x in v]) for i, v in enumerate(base)]


ODD = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15),
       (904, [None] + [1.0] * 15), (905, [float("inf")] + [1.0] * 15), (906, [1.0, 2.0]), (907, [1.0, 2.0])]


def usable(vectors):
    return {i: np.array(v, float) for i, v in vectors
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}


@pytest.mark.parametrize("block", [64, 4096])
def test_search_equals_brute_force(spark, block):
    vectors = cloud() + ODD
    got = {}
    for r in nearest(frame(spark, vectors), F.col("vec_id") % 20 == 0, k=7, block=block).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    own = usable(vectors)
    queries = [i for i in own if i % 20 == 0]
    assert set(got) == set(queries)
    for q in queries:
        scores = [(-float(np.cumsum(own[q] * v)[-1]), i) for i, v in own.items() if i != q and len(v) == len(own[q])]
        want = [(rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:7], 1)]
        assert sorted(got[q]) == want


def test_search_of_few_or_no_vectors(spark):
    assert nearest(frame(spark, []), F.lit(True)).count() == 0
    assert nearest(frame(spark, [(1, [1.0, 0.0])]), F.lit(True)).count() == 0
    two = nearest(frame(spark, [(1, [1.0, 0.0]), (2, [0.5, 0.5])]), F.lit(True)).collect()
    assert sorted((r["query_id"], r["vec_id"], r["score"]) for r in two) == [(1, 2, 0.5), (2, 1, 0.5)]


def test_repeated_query_rows_are_one_query(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.standard_normal(4)]) for i in range(1, 30)]
    twice = rows + [rows[0], (1, [1.0, 0.0, 0.0, 0.0]), rows[5]]
    got = [tuple(r) for r in nearest(frame(spark, twice), F.col("vec_id") == 1, k=6).collect()]
    once = [tuple(r) for r in nearest(frame(spark, rows + [rows[5]]), F.col("vec_id") == 1, k=6).collect()]
    assert sorted(r[1] for r in got) == sorted([1, 2, 3, 4, 5, 6] * 2)      # two vectors of one id
    assert set(once) <= set(got) and [r[1] for r in sorted(once)] == [1, 2, 3, 4, 5, 6]


def test_rounding_stays_inside_its_bound():
    x = np.random.default_rng(3).standard_normal((50, 24))
    q, s = quantise(x)
    assert (np.abs(x - q * s[:, None]) <= s[:, None] / 2 + 1e-12).all()
    found = list(tile_best(np.arange(50), x, np.arange(50), x, 5))
    exact = x @ x.T
    np.fill_diagonal(exact, -np.inf)
    assert {(a, b) for a, b, _ in found} == {(i, j) for i in range(50) for j in np.argsort(-exact[i])[:5]}


def expected(vectors):
    own = usable(vectors)
    unit = {i: v / math.sqrt(v @ v) for i, v in own.items()}

    def linked(a, b):
        return a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95

    items = {i: unit.get(i) for i, _ in vectors}
    component = groups(items, linked)
    links = {i: sum(linked(items[i], items[j]) for j in items if j != i) for i in items}
    return {i: (links[i], component[i], component[i] == i) for i in items}


@pytest.mark.parametrize("window,block", [(8, 64), (64, 4096)])
def test_near_duplicates_equal_brute_force(spark, window, block):
    rng = np.random.default_rng(9)
    centre = rng.standard_normal(16)
    group = [(2000 + i, [float(x) for x in centre + 0.02 * rng.standard_normal(16)]) for i in range(120)]
    vectors = cloud() + ODD + group
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in near_duplicates(frame(spark, vectors), window=window, block=block).collect()}
    assert got == expected(vectors)


def test_links_of_large_groups_are_counted_by_tiles(spark, monkeypatch):
    import martflow.llm.projection_dedup as m
    monkeypatch.setattr(m, "CHUNK", 16)
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(16)
    vectors = [(i, [float(x) for x in centre + 0.02 * rng.standard_normal(16)]) for i in range(70)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(frame(spark, vectors)).collect()}
    assert got == expected(vectors)


def test_near_duplicates_of_empty_tables_and_repeated_rows(spark):
    assert near_duplicates(frame(spark, [])).count() == 0
    rows = near_duplicates(frame(spark, [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])])).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in rows) == [(1, 1, 1), (1, 1, 1), (2, 0, 2)]


def test_more_vectors_need_more_passes():
    assert passes(10 ** 3) <= passes(10 ** 6) <= passes(10 ** 9)
    random.seed(0)


def test_pairs_inside_a_dense_cone_are_found(spark):
    """Unlinked vectors at mutual cosine 0.9 stand between the true pairs."""
    rng = np.random.default_rng(11)
    n, dim, planted = 2400, 64, 100
    axis = np.zeros(dim)
    axis[0] = 3.0

    def flat(size):
        x = rng.standard_normal((size, dim))
        x[:, 0] = 0
        return x / np.linalg.norm(x, axis=1)[:, None]

    cone = axis + flat(n)
    side = flat(planted)
    twins = axis + (cone[:planted] - axis) * 0.6 + 0.8 * side
    vectors = [(i, [float(v) for v in x]) for i, x in enumerate(np.concatenate([cone, twins]))]
    x = np.array([v for _, v in vectors], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    assert near.sum() >= planted
    got = {r["vec_id"]: r["n_links"] for r in near_duplicates(frame(spark, vectors), window=8).collect()}
    assert sum(got.values()) >= 0.99 * near.sum()
