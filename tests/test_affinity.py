import random
from collections import Counter

from martflow import session
from martflow.operators import affinity
from martflow.operators.affinity import co_purchase_counts, top_pairs


def brute_force(lines):
    counts = Counter()
    for o1, p1 in lines:
        for o2, p2 in lines:
            if o1 == o2 and p1 != p2:
                counts[(p1, p2)] += 1
    return counts


def test_pairs_match_brute_force_with_hot_order(spark):
    rnd = random.Random(7)
    lines = [(o, rnd.randrange(12)) for o in range(60) for _ in range(rnd.randrange(1, 5))]
    # one hot order holding a large share of all lines, with repeated products
    lines += [(999, rnd.randrange(12)) for _ in range(400)]
    df = spark.createDataFrame(lines, "Order_ID long, Product_ID long")
    got = {(r.Product_A, r.Product_B): r.Times_Bought_Together
           for r in co_purchase_counts(df).collect()}
    want = brute_force(lines)
    assert got == dict(want)
    assert all(got[(a, b)] == got[(b, a)] for a, b in got)
    # the hot order split into blocks of 3 products gives the same counts
    split = {(r.Product_A, r.Product_B): r.Times_Bought_Together
             for r in co_purchase_counts(df, block_size=3).collect()}
    assert split == dict(want)


def test_block_split_spreads_a_hot_order(spark):
    lines = [(1, p) for p in range(60)] + [(2, 1), (2, 2)]
    df = spark.createDataFrame(lines, "Order_ID long, Product_ID long")
    got = {(r.Product_A, r.Product_B): r.Times_Bought_Together
           for r in co_purchase_counts(df, block_size=8).collect()}
    assert len(got) == 60 * 59
    assert got[(1, 2)] == 2 and got[(2, 1)] == 2 and got[(0, 59)] == 1


def test_many_pairs_are_dealt_out(spark, monkeypatch):
    rnd = random.Random(8)
    lines = [(o, rnd.randrange(30)) for o in range(80) for _ in range(rnd.randrange(1, 6))]
    lines += [(None, 1), (3, None)] + [(500, rnd.randrange(30)) for _ in range(300)]
    df = spark.createDataFrame(lines, "Order_ID long, Product_ID long")
    want = brute_force([x for x in lines if None not in x])
    monkeypatch.setattr(session, "ROWS_PER_TASK", 20)
    monkeypatch.setattr(affinity, "FEW_PAIRS", 0)
    counted = co_purchase_counts(df, block_size=7)
    assert {(r.Product_A, r.Product_B): r.Times_Bought_Together for r in counted.collect()} == dict(want)
    best = sorted((-n, a, b) for (a, b), n in want.items())[:4]
    top = top_pairs(df, 4)
    assert [(-r.Times_Bought_Together, r.Product_A, r.Product_B) for r in top.collect()] == best
    # tasks of a fixed size: the order lines by order, the pairs by pair
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 3
