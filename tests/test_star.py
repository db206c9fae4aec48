"""The eager-aggregation path (dimensions over the broadcast bound) gives
the same answers as the broadcast path."""

import contextlib
import io
import os

import pytest

from martflow import session
from martflow.plans import olap, star
from martflow.plans.star import BROADCAST_LIMIT_CONF
from martflow.plans.warehouse import open_warehouse

SF = "/root/testdata/sf0.001"
NAMES = ["q03_occupation_category", "q08_avg_by_stay_gender", "q09_age_daytype",
         "q12_store_supplier_category", "q14_store_quarter_year",
         "q17_rollup_store_supplier_category_year", "q18_half_year", "q19_revenue_spikes"]


def _rows(df):
    return sorted(tuple((v is None, v if v is not None else 0) for v in r) for r in df.collect())


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_large_dimension_path_matches(spark):
    wh = open_warehouse(spark, SF)
    broadcast = {n: _rows(olap.QUERIES[n](wh)) for n in NAMES}
    spark.conf.set(BROADCAST_LIMIT_CONF, "0")
    # also keep the planner from broadcasting the (tiny) test dimensions
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(olap.q3(wh))
        for n in NAMES:
            assert _rows(olap.QUERIES[n](wh)) == broadcast[n], n
    finally:
        spark.conf.unset(BROADCAST_LIMIT_CONF)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("limit", ["0", None])
def test_many_groups_are_dealt_out_and_match(spark, monkeypatch, limit):
    wh = open_warehouse(spark, SF)
    names = ["q08_avg_by_stay_gender", "q09_age_daytype", "q12_store_supplier_category",
             "q17_rollup_store_supplier_category_year"]
    expected = {n: _rows(olap.QUERIES[n](wh)) for n in names}
    monkeypatch.setattr(star, "MANY_GROUPS_BYTES", 0)
    monkeypatch.setattr(session, "ROWS_PER_TASK", 600)
    if limit is not None:
        spark.conf.set(BROADCAST_LIMIT_CONF, limit)
    try:
        for n in names:
            df = olap.QUERIES[n](wh)
            assert "REPARTITION_BY_NUM" in _plan(df), n
            assert _rows(df) == expected[n], n
    finally:
        spark.conf.unset(BROADCAST_LIMIT_CONF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_few_groups_are_summed_before_the_shuffle(spark):
    assert "REPARTITION_BY_NUM" not in _plan(olap.q3(open_warehouse(spark, SF)))
