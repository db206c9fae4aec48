from __future__ import annotations

import math
import os
from fractions import Fraction

import numpy as np
import pytest

from martflow.llm import spectrum_whitening as m

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, x string, component string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)


def spectrum(dim, values, seed):
    """A symmetric matrix with the given eigenvalues."""
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    list(range(40, 0, -1)),
    [5.0] * 6 + [4.0] * 6 + list(range(1, 29)),                 # multiple eigenvalues
    [5 + 1e-9 * i for i in range(10)] + [1.0] * 30,             # close ones
    [10.0 ** -i for i in range(40)],                            # most of them zero to working precision
    [2.0] * 40, [1.0] + [0.0] * 39])
def test_leading_eigenpairs(values):
    a = spectrum(40, values, 3)
    want = np.sort(np.linalg.eigvalsh(a))[::-1]
    got = m.leading(a, 16, m.ZERO * a.trace())
    assert len(got) == min(16, int((want > m.ZERO * a.trace()).sum()))
    q = np.array([g.vector for g in got])
    assert np.abs(q @ q.T - np.eye(len(got))).max() < 1e-12
    for g, w in zip(got, want):
        assert abs(g.value - w) < 1e-13 * want[0] * 40
        assert np.linalg.norm(a @ g.vector - g.value * g.vector) < 1e-12 * want[0]


def test_inertia_counts():
    a = spectrum(24, np.arange(-11.5, 12.5), 5)
    for s in np.arange(-13, 14):
        assert m.count_above(a, float(s)) == sum(v > s for v in np.arange(-11.5, 12.5))
    assert m.count_above(np.diag([3.0, 0.0, -1.0]), 0.0) == 1
    assert m.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1      # no pivot on the diagonal


def test_convergence_is_fast():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((900, 64))
    assert max(s.steps for s in m.leading(x.T @ x / 900, 16, 0.0)) <= 12


def brute(rows):
    """The contract in Python integers, with numpy's eigenvectors."""
    kept = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    points = sorted({x for _, x in kept})
    n, sums = len(points), [sum(c) for c in zip(*points)]
    y = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(p, sums)] for p in points])
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    keep = int((e[:16] > 1e-10 * v.trace()).sum())
    out = {}
    for i, x in kept:
        dev = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        z = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums)]) @ q[:, :keep] / np.sqrt(e[:keep])
        out.setdefault(i, []).append((dev, z))
    return n, out, e[:keep] / v.trace()


def cloud(n=200, dim=20, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)) * np.linspace(3, 0.2, dim)
    x[3::6] = x[3]
    return [(900 - i, [float(c) for c in r]) for i, r in enumerate(x)]


ODD = [(1, None), (2, [float("nan")] * 20), (3, [None] * 20), (5, [float("-inf")] * 20), (None, [0.5] * 20),
       (2000, [0.25] * 20), (2000, [0.25] * 20), (2001, [1.0, 2.0]), (2002, [])]


@pytest.mark.parametrize("rows", [cloud() + ODD, cloud(60, 5), cloud(6, 30)])
def test_whitening_equals_brute_force(spark, rows):
    n, want, explained = brute(rows)
    df, model, error = m.whiten(frame(spark, rows))
    got = {}
    for r in df.collect():
        got.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(
            (r["whitened"], r["explained"]))
    assert model.n == n and error <= 1e-9
    assert set(got) == {(i, dev) for i, all_ in want.items() for dev, _ in all_}
    sign = None
    for (i, dev), parts in sorted(got.items(), key=repr):
        z = next(z for d, z in want[i] if d == dev)
        mine = np.array([parts[c][0][0] for c in range(1, len(explained) + 1)])
        assert len(parts) == len(explained)
        assert all(len(p) == sum(d == dev for d, _ in want[i]) for p in parts.values())
        if sign is None:
            sign = np.where(np.abs(z) > 1e-6, np.sign(z * mine), 0)
        sign = np.where(sign == 0, np.sign(z * mine), sign)
        assert np.abs(z - sign * mine).max() < 1e-6
        assert np.allclose([parts[c][0][1] for c in range(1, len(explained) + 1)], explained, rtol=1e-9)


def test_few_rows(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, [])], [(1, None)]):
        df, _, _ = m.whiten(frame(spark, rows))
        assert df.count() == 0 and df.columns == ["vec_id", "component", "deviation", "whitened", "explained"]


def test_products_and_deviations_are_exact():
    rng = np.random.default_rng(6)
    for top in (100, 1 << 27, 1 << 40):
        y = rng.integers(-top, top, (50, 4))
        wide = y.astype(object)
        assert (m.products(y) == wide.T @ wide).all()
        over = [0, 1, 6, 3]
        want = [sum((7 * int(c) - o) ** 2 for c, o in zip(r, over)) for r in y.tolist()]
        assert m.deviations(y, 7, over) == [d if d < 1 << 63 else None for d in want]
    assert m._words([(0, [-5, 1 << 90])]) is not None


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_query_on_the_test_table(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    n, want, explained = brute(rows)
    got = m.op13_spectrum_whitening(spark, SF).collect()
    assert len(got) == 16 * len(rows) and {r["n"] for r in got} == {n}
    assert {r["identity_error"] for r in got}.pop() <= 1e-9
    for r in got:
        assert (r["deviation"],) == tuple({d for d, _ in want[r["vec_id"]]})
        assert abs(r["explained"] - explained[r["component"] - 1]) < 1e-9
        assert abs(abs(r["whitened"]) - abs(want[r["vec_id"]][0][1][r["component"] - 1])) < 1e-6
