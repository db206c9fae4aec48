"""Loads of more keys than are broadcast, and deliveries that come twice."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from martflow.operators import keys as K
from martflow.operators import load as L
from martflow.operators.enrich import MASTER_BROADCAST_CONF, _bounded
from martflow.plans.warehouse import Warehouse
from martflow.schemas import ARRIVAL_ORDER, DIM_CUSTOMER_COLUMNS, DIM_PRODUCT_COLUMNS
from martflow.session import CLEAN, path_exists, session_setting, shuffles_freed
from martflow.sources.csv_files import csv_feed, read_customer_master, read_product_master, write_transaction_files
from martflow.sources.feed import Feed
from martflow.streaming.ingest import run_ingest
from test_csv_etl import CUSTOMERS, PRODUCTS, files  # noqa: F401  the fixture
from test_scale import _plan


def _rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def _staged(spark):
    """Sales of 60 customers and 20 products; customer 7 has two sets of attributes, customer 8
    one with nulls, and a product's supplier differs from sale to sale."""
    return spark.range(600).selectExpr(
        "id AS Order_ID", "CAST(id % 3 AS INT) AS Line_Number", "id * 7 % 20 AS Product_ID",
        "CASE WHEN id % 4 > 0 THEN id * 11 % 6 END AS Supplier_ID", "id % 60 AS Customer_ID", "CAST(id % 5 AS INT) AS Quantity",
        "TIMESTAMP_NTZ '2020-01-01' + make_dt_interval(CAST(id * 13 % 40 AS INT)) AS Date",
        "CASE WHEN id % 60 = 7 AND id % 7 = 0 THEN 'M' WHEN id % 60 <> 8 THEN 'F' END AS Gender", "'0-17' AS Age",
        "CAST(id % 60 AS INT) AS Occupation", "CASE WHEN id % 60 = 7 AND id % 2 = 0 THEN 'B' ELSE 'A' END AS City_Category",
        "1 AS Stay_In_Current_City_Years", "0 AS Marital_Status", "concat('c', id * 7 % 20) AS Product_Category",
        "CAST(1.5 AS DECIMAL(10,2)) AS Price", "CAST(id * 7 % 20 % 3 AS INT) AS Store_ID",
        "'s' AS Store_Name", "'x' AS Supplier_Name")


def test_replay_of_a_small_batch_ends_with_the_lookup(spark):
    cols = ["k", "s", "o", "v"]
    target = spark.createDataFrame([(i, None if i % 3 else 1, 0, 0) for i in range(100)], "k long, s long, o int, v int")
    batch = spark.createDataFrame([(i, None if i % 3 else 1, 1, i) for i in range(10, 20)] * 2, target.schema)

    def load(batch, **known):
        return K.insert_ignore_rare(batch, ["k", "s"], ["o"], cols, target, required=["k"], **known)
    again = load(batch, batch_rows=20, target_rows=100, limit_bytes=0)      # five times the batch, keys not few
    assert "Join" not in _plan(again) and again.count() == 0
    more = batch.unionByName(spark.createDataFrame([(300, None, 2, 2), (300, None, 1, 1)], target.schema))
    for limit in (0, 600, 10**9):
        assert _rows(load(more, batch_rows=22, target_rows=100, limit_bytes=limit)) == _rows(load(more)) == [
            "(300, None, 1, 1)"]


def test_many_new_keys_of_a_dimension_do_not_move_the_sales(spark):
    staged = _staged(spark)
    for key, columns, own in (("Customer_ID", DIM_CUSTOMER_COLUMNS, True), ("Product_ID", DIM_PRODUCT_COLUMNS, False)):
        fresh = staged.select(key).distinct().where(f"{key} <> 3")
        expected = _rows(K.first_per_key(staged, [key], ARRIVAL_ORDER, columns).select(*columns).where(f"{key} <> 3"))
        for limit in (0, 10**9):
            assert _rows(L.rows_of_many_keys(staged, fresh, key, columns, own, limit)) == expected
    alike = staged.where("Customer_ID <> 7")
    keys = L.batch_keys(alike)
    rows, _ = L.dimension_rows(alike, keys, {}, limit_bytes=0)
    assert "Join" not in _plan(rows["dim_customer"]) and rows["dim_customer"].count() == 59
    assert _plan(rows["dim_product"]).count("Join") == 1 and rows["dim_product"].count() == 20     # reduced rows with new keys


def test_sales_are_not_sorted_to_meet_a_master_of_bounded_parts(spark):
    master = spark.range(1000).selectExpr("id AS Customer_ID", "id AS v")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with session_setting(spark, MASTER_BROADCAST_CONF, str(1000 * 32 // parts)):
        assert "shuffle_hash" in _plan(spark.range(9).selectExpr("id AS Customer_ID").join(
            _bounded(master, 1000), "Customer_ID", "left"))
        assert "hint" not in _plan(spark.range(9).selectExpr("id AS Customer_ID").join(
            _bounded(master, 2000), "Customer_ID", "left")).lower()
    assert spark.conf.get(MASTER_BROADCAST_CONF, None) is None


def test_masters_of_delivered_files_are_counted(spark, files):  # noqa: F811
    feed = csv_feed(spark, files["customer"], files["product"], files["txn"])
    assert feed.master_rows == {"customers": len(CUSTOMERS), "products": len(PRODUCTS)}


def test_staging_is_written_without_sorting_the_rows(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    schema = wh.schema("staging")
    rows = spark.range(50).select(*[(F.when(F.col("id") % 2 == 0, "staged").otherwise("quarantined") if f.name == "Status"
                                     else F.lit("b1") if f.name == "batch" else F.col("id") if f.name == "Order_ID"
                                     else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    wh.write("staging", wh.path("staging"), rows.repartition(1), "overwrite")
    for status, first in (("staged", 0), ("quarantined", 1)):
        names = [n for n in os.listdir(f"{scratch}/wh/staging/batch=b1/Status={status}") if n.startswith("part-")]
        assert len(names) == 1
        assert sorted(r[0] for r in wh.staged_all().where(F.col("Status") == status).select("Order_ID").collect()) == [
            *range(first, 50, 2)]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) is None


def test_stream_keeps_each_key_of_duplicates_once_on_disk(spark, files):  # noqa: F811
    """No micro-batch without rows rewrites the state; compressed deliveries are read."""
    drop, root = f"{files['root']}/drop", files["root"]
    sales = spark.range(400).selectExpr(
        "id AS Order_ID", "1 AS Line_Number", "1000001L AS Customer_ID", "'P00000001' AS Product_ID", "5L AS Supplier_ID",
        "2 AS Quantity", "TIMESTAMP_NTZ '2020-01-01' + make_dt_interval(CAST(id % 40 AS INT)) AS Date")
    for turn in ("first", "again"):
        write_transaction_files(sales, f"{drop}/{turn}", 4, compression="gzip")
    assert sum(n.endswith(".csv.gz") for n in os.listdir(f"{drop}/again")) == 4
    masters = Feed(transactions=None, customers=read_customer_master(spark, files["customer"]),
                   products=read_product_master(spark, files["product"]))
    wh = Warehouse(spark, f"{root}/wh")
    run_ingest(spark, wh, f"{drop}/*", masters, f"{root}/ckpt", max_files_per_trigger=2, lines=True, dedupe_masters=True,
               dedupe_within="7 days", keep_staging=True)
    assert wh.staged_all().count() == wh.staged_all().select("Order_ID").distinct().count() == 400
    assert path_exists(spark, f"{root}/ckpt/commits/3") and not path_exists(spark, f"{root}/ckpt/commits/4")


def test_settings_of_a_load_end_with_it(spark):
    before = spark.conf.get(CLEAN, None)
    with shuffles_freed(spark):
        assert spark.conf.get(CLEAN) == "true"
    assert spark.conf.get(CLEAN, None) == before
