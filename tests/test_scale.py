"""Plans that must hold when the tables grow."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from martflow.operators import keys as K
from martflow.operators import load as L
from martflow.operators.enrich import MASTER_BROADCAST_CONF, enrich
from martflow.plans import etl_queries
from martflow.schemas import FACT_FOREIGN_KEYS
from martflow.sources.csv_files import read_transactions
from martflow.sources.feed import Feed
from martflow.streaming.events import run_hourly


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_number_of_micro_batches_does_not_grow(spark, monkeypatch):
    for size in (40, 4 << 30, 4 << 40):
        monkeypatch.setattr(etl_queries, "folder_bytes", lambda spark, path, size=size: size)
        assert size // etl_queries.micro_batch_bytes(spark, "drop") == etl_queries.MIN_MICRO_BATCHES


def test_delivered_line_is_parsed_once(spark, scratch):
    with open(f"{scratch}/a.csv", "w") as out:
        out.write("_c0,orderID,lineNumber,Customer_ID,Product_ID,supplierID,quantity,date\n0,1,1,2,3,4,5,2020-01-01\n0,2,1\n")
    df = read_transactions(spark, scratch, lines=True, product_type="bigint")
    assert _plan(df).count("from_csv(") == 1
    assert sorted((r.Order_ID, r.Quantity, r.Parse_Error) for r in df.collect()) == [
        (1, 5, None), (2, None, "unparsable Date")]


def test_redelivered_keys_are_not_aggregated_again(spark):
    cols = ["k", "o", "v"]
    batch = spark.createDataFrame([(i, 1, i) for i in range(50)] + [(7, 0, 70), (60, 3, 1), (60, 2, 2)], cols)
    target = spark.createDataFrame([(i, 0, 0) for i in range(40)], cols)
    wide = K.insert_ignore_rare(batch.where("k < 50"), ["k"], ["o"], cols, target, limit_bytes=0)
    assert "min(struct" not in _plan(wide)
    assert sorted(tuple(r) for r in wide.collect()) == [(i, 1, i) for i in range(40, 50)]
    both = K.insert_ignore_rare(batch, ["k"], ["o"], cols, target, limit_bytes=100)
    assert sorted(tuple(r) for r in both.collect()) == [(i, 1, i) for i in range(40, 50)] + [(60, 2, 2)]


def test_many_keys_meet_their_leads_without_sorting_all_rows(spark, monkeypatch):
    cols = ["k", "d", "o", "v"]
    rows = [(i % 30, (i * 7) % 11, i, i) for i in range(300)] + [(3, 0, -i, i) for i in range(1, 40)]
    df = spark.createDataFrame(rows, cols)
    expected = sorted(tuple(r) for r in K.first_per_key(df, ["k"], ["d", "o"], cols).select(*cols).collect())
    monkeypatch.setattr(K, "HOT_KEY_ROWS", 20)     # key 3 is hot
    got = K.first_per_key_few(df, ["k"], ["d", "o"], cols, limit_bytes=0)
    assert "left_anti" in _plan(got).lower().replace("leftanti", "left_anti")
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == expected


def test_foreign_keys_are_looked_up_by_key(spark):
    fact = spark.createDataFrame([(1, 10, 1, 1, 20200101), (2, 10, 1, None, 20200101), (None, 11, 2, 1, 20200102)],
                                 "Customer_ID long, Product_ID long, Store_ID int, Supplier_ID long, Time_ID int")
    has = {"dim_customer": [(1,)], "dim_product": [(10,)], "dim_store": [(1,), (2,)], "dim_supplier": [(1,)],
           "dim_time": [(20200101,), (20200102,)]}
    dims = {d: spark.createDataFrame(has[d], f"{c} {dict(fact.dtypes)[c]}") for c, d, _ in FACT_FOREIGN_KEYS}
    checked = L.foreign_key_check(fact, dims)
    assert _plan(checked).count("Join") == 2       # customers and products lack rows, the others take no join
    assert {(r.Customer_ID, r.Reject_Reason) for r in checked.collect()} == {
        (1, None), (2, "no dim_customer row for Customer_ID"), (None, "no dim_product row for Product_ID")}


def test_hourly_sums_are_written_by_several_tasks(spark, scratch):
    events = spark.range(2000).select(
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, CAST(id % 200 AS INT))").alias("ts"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"))
    events.write.parquet(f"{scratch}/in")
    run_hourly(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt", events.schema)
    parts = [n for d, _, names in os.walk(f"{scratch}/out/epoch=0") for n in names if n.startswith("part-")]
    assert len(parts) > 1


def test_loaded_keys_are_looked_up_in_the_shuffle_that_counts_them(spark):
    cols = ["k", "s", "o", "v"]
    types = "k long, s long, o int, v int"
    rows = [(i, None if i % 3 else 1, 1, i) for i in range(30)] + [(7, None, 0, 70), (40, None, 2, 2), (40, None, 1, 1),
                                                                  (None, 1, 1, 1)]
    batch = spark.createDataFrame(rows, types)
    target = spark.createDataFrame([(i, None if i % 3 else 1, 0, 0) for i in range(20)] + [(99, None, 0, 0)], types)

    def load(batch, target, **known):
        return K.insert_ignore_rare(batch, ["k", "s"], ["o"], cols, target, required=["k"], **known)

    def rows_of(df):
        return sorted(map(repr, map(tuple, df.collect())))
    n, m = batch.count(), target.count()
    assert rows_of(load(batch, target, batch_rows=n, target_rows=m)) == rows_of(load(batch, target))
    for limit in (0, 10**9):
        assert rows_of(load(batch, target, batch_rows=n, target_rows=m, limit_bytes=limit)) == rows_of(load(batch, target))
    again = load(batch.where("k < 20"), target, batch_rows=batch.where("k < 20").count(), target_rows=m)
    assert "Join" not in _plan(again) and again.count() == 0       # a replay ends with the lookup


def test_sales_meet_a_large_customer_master_by_profile(spark):
    tx = spark.createDataFrame([(1, 1, 1, 5), (2, 1, 2, 5), (3, 1, 9, 5), (4, 1, None, 5), (5, 1, 3, 6)],
                               "Order_ID long, Line_Number int, Customer_ID long, Product_ID long").selectExpr(
        "*", "CAST(NULL AS BIGINT) AS Supplier_ID", "2 AS Quantity", "TIMESTAMP_NTZ '2020-01-01' AS Date",
        "CAST(NULL AS STRING) AS Parse_Error")
    customers = spark.createDataFrame([(1, "F", "0-17", 4, "A", 2, 0), (2, None, "0-17", None, "B", 2, 1),
                                       (3, "F", "0-17", 4, "A", 2, 0), (3, "M", None, None, None, None, None)],
                                      "Customer_ID long, Gender string, Age string, Occupation int, City_Category string,"
                                      " Stay_In_Current_City_Years int, Marital_Status int")
    products = spark.createDataFrame([(5, "c", 1, "s", 8, "x")], "Product_ID long, Product_Category string, Store_ID int,"
                                     " Store_Name string, Supplier_ID long, Supplier_Name string").withColumn(
        "Price", F.lit("1.5").cast("decimal(18,6)"))
    feed = Feed(transactions=tx, customers=customers, products=products, master_rows={"customers": 4, "products": 1})
    expected = sorted(map(repr, map(tuple, enrich(feed).collect())))
    spark.conf.set(MASTER_BROADCAST_CONF, "600")     # less than the four customers, no less than their profiles
    try:
        large = enrich(feed)
        assert "_profile" in _plan(large)
        assert sorted(map(repr, map(tuple, large.collect()))) == expected
    finally:
        spark.conf.unset(MASTER_BROADCAST_CONF)
