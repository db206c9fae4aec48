"""Commits, the key index, the kept summary, re-drive, types and headers."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import CUSTOMER_HEADER, PRODUCT_HEADER, TXN_HEADER, write_csv
from martflow.operators.keys import KEY_BUCKETS, order_bucket
from martflow.plans import warehouse as w
from martflow.plans.olap import store_quarterly_sales
from martflow.plans.views import VIEW_NAMES, register_tables, register_views
from martflow.plans.warehouse import Warehouse, compact, load_feed, redrive, reset_warehouse, vacuum
from martflow.session import path_exists
from martflow.sources.csv_files import csv_feed, read_customer_master, read_product_master, read_transactions
from martflow.sources.feed import Feed
from martflow.streaming.ingest import run_ingest
from test_csv_etl import (  # noqa: F401  the fixture
    CUSTOMERS, EXPECTED_FACT, PRODUCTS, TXNS_A, TXNS_B, _fact, _load, files,
)

DIMS = ["dim_customer", "dim_product", "dim_store", "dim_supplier", "dim_time"]


class Killed(RuntimeError):
    pass


def dying(spark, root, at):
    class Dying(Warehouse):
        def add(self, name, *args, **kwargs):
            if name == at:
                raise Killed(name)
            return super().add(name, *args, **kwargs)
    return Dying(spark, root)


# ------------------------------------------------------------------ commits
@pytest.mark.parametrize("at", ["fact_sales", "load_report"])
def test_a_killed_load_leaves_nothing_to_see(spark, files, at):  # noqa: F811
    root = f"{files['root']}/wh"
    with pytest.raises(Killed):
        _load(spark, files, wh=dying(spark, root, at))
    seen = Warehouse(spark, root)
    assert all(not seen.exists(t) and seen.table(t).count() == 0 for t in w.TABLES)
    wh, result = _load(spark, files, wh=Warehouse(spark, root))     # the same batch again
    assert _fact(wh) == EXPECTED_FACT and result.rows["dim_customer"] == 3
    assert vacuum(wh) and _fact(Warehouse(spark, root)) == EXPECTED_FACT
    assert not vacuum(wh)


def test_a_reader_keeps_its_state_while_others_load(spark, files):  # noqa: F811
    write_csv(files["txn"], TXN_HEADER, TXNS_A)
    wh, _ = _load(spark, files)
    reader = Warehouse(spark, wh.root)
    before = _fact(reader)
    write_csv(files["txn"], TXN_HEADER, TXNS_B)
    _load(spark, files, batch="b2", wh=wh)
    compact(wh, "fact_sales")
    assert _fact(reader) == before and _fact(Warehouse(spark, wh.root)) == EXPECTED_FACT


def test_two_loads_at_once_are_noticed(spark, files):  # noqa: F811
    wh, _ = _load(spark, files)
    other = Warehouse(spark, wh.root)
    state = other.manifest
    _load(spark, files, batch="b2", wh=wh)
    with pytest.raises(RuntimeError, match="another load"):
        other.commit(state)


def test_small_folders_are_folded(spark, files, monkeypatch):  # noqa: F811
    monkeypatch.setattr(w, "FOLD", 2)
    wh = Warehouse(spark, f"{files['root']}/wh")
    rows = TXNS_A + TXNS_B
    for i in range(3):
        write_csv(files["txn"], TXN_HEADER, rows[4 * i:4 * i + 4])
        _load(spark, files, batch=f"b{i}", wh=wh)
    assert all(len(wh.manifest.folders(t)) <= 6 for t in w.TABLES)
    # rows 1 and 10 share a key: the first delivered stays
    assert _fact(wh) == EXPECTED_FACT
    lost = sorted(map(repr, wh.quarantine().collect()))
    report = wh.table("load_report").groupBy("table_name").agg(F.sum("rows_loaded")).collect()
    write_csv(files["txn"], TXN_HEADER, rows[4:8])
    _load(spark, files, batch="b1", wh=wh)          # replayed after its rejects were folded with others
    assert sorted(map(repr, wh.quarantine().collect())) == lost
    assert sorted(wh.table("load_report").groupBy("table_name").agg(F.sum("rows_loaded")).collect()) == sorted(report)


# ------------------------------------------------------------------ key index
def test_a_micro_batch_reads_the_keys_of_its_orders_only(spark, files):  # noqa: F811
    """Batches of orders numbered as they come: a later one reads few buckets."""
    wh = Warehouse(spark, f"{files['root']}/wh")
    for i in range(4):
        rows = [f"{k},{i * 102_400 + k},1000001,P0000000{1 + k % 3},1,2021-01-{1 + i:02d}" for k in range(40)]
        write_csv(files["txn"], TXN_HEADER, rows)
        _load(spark, files, batch=f"b{i}", wh=wh)
    assert wh.fact.count() == 160 == wh.table("fact_keys").count()
    assert wh.table("fact_keys").where(F.col("bucket") != order_bucket(F.col("Order_ID"))).isEmpty()
    again = [f"{k},{307_200 + k},1000001,P0000000{1 + k % 3},7,2022-01-01" for k in range(40)]     # sent again, changed
    write_csv(files["txn"], TXN_HEADER, again)
    _, result = _load(spark, files, batch="again", wh=wh)
    assert result.rows["fact_sales"] == 0
    touched = [r[0] for r in wh.staged("again").select(order_bucket(F.col("Order_ID"))).distinct().collect()]
    assert len(touched) == 1 < KEY_BUCKETS
    known = w.known_keys(wh, touched)
    read = known.select(F.input_file_name().alias("f")).distinct().count()
    assert read < len(wh.table("fact_keys").inputFiles()) / 2
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1]


# ------------------------------------------------------------------ summary
def test_summary_follows_loads_and_replays(spark, files):  # noqa: F811
    wh = Warehouse(spark, f"{files['root']}/wh")
    for batch, rows in [("a", TXNS_A), ("b", TXNS_B), ("a", TXNS_A)]:
        write_csv(files["txn"], TXN_HEADER, rows)
        _load(spark, files, batch=batch, wh=wh)
        fresh = Warehouse(spark, wh.root)
        assert register_views(fresh)["STORE_QUARTERLY_SALES"] == "store_quarter_sums"
        seen = sorted(map(tuple, spark.sql("SELECT * FROM STORE_QUARTERLY_SALES").collect()))
        assert seen == sorted(map(tuple, store_quarterly_sales(fresh).collect())) and seen
    assert len(wh.manifest.folders("store_quarter_sums")) == 1
    assert wh.table("store_quarter_sums").agg(F.sum("Sales")).first()[0] == wh.fact.where("Store_ID IS NOT NULL").count()


# ------------------------------------------------------------------ re-drive
def test_redrive_empties_the_quarantine(spark, files):  # noqa: F811
    write_csv(files["customer"], CUSTOMER_HEADER, CUSTOMERS[1:])
    write_csv(files["product"], PRODUCT_HEADER, PRODUCTS[:2])
    wh, _ = _load(spark, files)
    assert _fact(wh) != EXPECTED_FACT
    write_csv(files["customer"], CUSTOMER_HEADER, CUSTOMERS)
    write_csv(files["product"], PRODUCT_HEADER, PRODUCTS)
    masters = Feed(transactions=None, customers=read_customer_master(spark, files["customer"]),
                   products=read_product_master(spark, files["product"]))
    for batch in ("redrive", "redrive"):
        redrive(wh, masters, batch, dedupe_masters=True)
        assert _fact(wh) == EXPECTED_FACT
        assert sorted(r.Reject_Reason for r in wh.quarantine().collect()) == [
            "unknown Customer_ID", "unknown Product_ID", "unparsable Date", "unparsable Order_ID"]


def test_redrive_of_an_empty_quarantine(spark, files):  # noqa: F811
    write_csv(files["txn"], TXN_HEADER, TXNS_A[:2])
    wh, _ = _load(spark, files)
    masters = Feed(transactions=None, customers=read_customer_master(spark, files["customer"]),
                   products=read_product_master(spark, files["product"]))
    assert redrive(wh, masters, "r", dedupe_masters=True) is None and wh.fact.count() == 2


# ------------------------------------------------------------------ types
def test_text_ids_in_a_warehouse_of_numbers_are_rejects(spark, files):  # noqa: F811
    number = {k: write_csv(f"{files['root']}/n/{k}.csv", h, rows) for k, h, rows in [
        ("customer", CUSTOMER_HEADER, CUSTOMERS), ("product", PRODUCT_HEADER, ["0,1,Toys,2.00,1,11,Shop,Maker"]),
        ("txn", TXN_HEADER, ["0,1,1000001,1,1,2020-12-26"])]}
    wh = Warehouse(spark, f"{files['root']}/wh")
    masters = Feed(transactions=None, customers=read_customer_master(spark, number["customer"]),
                   products=read_product_master(spark, number["product"]).withColumn("Product_ID", F.col("Product_ID").cast("long")))
    load_feed(wh, replace(masters, transactions=read_transactions(spark, number["txn"], product_type="bigint")), "numbers")
    assert dict(wh.fact.dtypes)["Product_ID"] == "bigint"
    _load(spark, files, batch="text", wh=wh)
    assert wh.fact.count() == 1
    assert "Product_ID P00000001 is no bigint" in {r.Reject_Reason for r in wh.quarantine().collect()}
    reset_warehouse(wh)
    _load(spark, files, batch="fresh", wh=wh)
    assert dict(wh.fact.dtypes)["Product_ID"] == "string" and _fact(wh) == EXPECTED_FACT


# ------------------------------------------------------------------ catalog
def test_tables_of_the_catalog(spark, files):  # noqa: F811
    wh, _ = _load(spark, files)
    db = register_tables(wh)
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()} == {v.lower() for v in VIEW_NAMES.values()}
    assert spark.sql(f"SELECT count(*), sum(Quantity) FROM {db}.FactSales WHERE Year = 2020").first()[:] == (5, 9)
    made = spark.sql(f"SHOW CREATE TABLE {db}.DimProduct").first()[0]
    assert "Product_ID STRING COMMENT 'never null'" in made and "Price DECIMAL(10,2)" in made
    write_csv(files["txn"], TXN_HEADER, ["0,77,1000001,P00000001,1,2021-01-01"])
    _load(spark, files, batch="later", wh=wh)
    assert spark.sql(f"SELECT count(*) FROM {db}.FactSales").first()[0] == 5      # the state registered
    register_tables(wh)
    assert spark.sql(f"SELECT count(*) FROM {db}.FactSales").first()[0] == 6
    reset_warehouse(wh)
    register_tables(wh)
    assert spark.sql(f"SELECT count(*) FROM {db}.FactSales").first()[0] == 0
    spark.sql(f"DROP DATABASE {db} CASCADE")
    assert not wh.exists("fact_sales") and path_exists(spark, wh.path("staging"))


# ------------------------------------------------------------------ headers
SWAPPED = ",quantity,Product_ID,date,Customer_ID,orderID"


def swapped(row):
    i, order, customer, product, quantity, date = row.split(",")
    return f"{i},{quantity},{product},{date},{customer},{order}"


def test_every_file_is_read_by_its_own_header(spark, files):  # noqa: F811
    drop = f"{files['root']}/drop"
    write_csv(f"{drop}/1.csv", TXN_HEADER, TXNS_A)
    write_csv(f"{drop}/2.csv", '"","quantity","Product_ID","date","Customer_ID","orderID"', [swapped(r) for r in TXNS_B])
    open(f"{drop}/3.csv", "w").close()
    for i in (1, 2, 3):     # delivered in this order
        os.utime(f"{drop}/{i}.csv", (10 ** 9 + i, 10 ** 9 + i))
    wh, _ = _load(spark, {**files, "txn": drop})
    assert _fact(wh) == EXPECTED_FACT
    masters = Feed(transactions=None, customers=read_customer_master(spark, files["customer"]),
                   products=read_product_master(spark, files["product"]))
    for trigger in (1,):
        stream = Warehouse(spark, f"{files['root']}/stream{trigger}")
        run_ingest(spark, stream, drop, masters, f"{files['root']}/ckpt{trigger}", max_files_per_trigger=trigger,
                   lines=False, dedupe_masters=True)
        assert _fact(stream) == EXPECTED_FACT


def test_masters_of_two_column_orders(spark, files):  # noqa: F811
    write_csv(f"{files['root']}/m/1.csv", CUSTOMER_HEADER, CUSTOMERS[:1])
    write_csv(f"{files['root']}/m/2.csv", "Marital_Status,Customer_ID,Gender,Age,Occupation,City_Category,Stay_In_Current_City_Years",
              ['1,1000002,M,"26-35",16,C,4'])
    got = {r.Customer_ID: tuple(r)[1:7] for r in read_customer_master(spark, f"{files['root']}/m").collect()}
    assert got == {1000001: ("F", "0-17", 10, "A", 2, 0), 1000002: ("M", "26-35", 16, "C", 4, 1)}


def test_a_file_without_a_header_is_a_reject_in_the_stream(spark, files):  # noqa: F811
    drop = f"{files['root']}/drop"
    write_csv(f"{drop}/1.csv", TXN_HEADER, TXNS_A)
    write_csv(f"{drop}/2.csv", TXNS_B[0], TXNS_B[1:])
    with pytest.raises(ValueError, match="header lacks"):
        _load(spark, {**files, "txn": drop})
    masters = Feed(transactions=None, customers=read_customer_master(spark, files["customer"]),
                   products=read_product_master(spark, files["product"]))
    wh = Warehouse(spark, f"{files['root']}/stream")
    run_ingest(spark, wh, drop, masters, f"{files['root']}/ckpt", max_files_per_trigger=1, lines=False, dedupe_masters=True)
    assert wh.fact.count() == 3
    assert wh.quarantine().where("Reject_Reason LIKE 'file without%'").count() == len(TXNS_B)


# ------------------------------------------------------------------ stream
def test_stream_drops_what_is_sent_twice(spark, files):  # noqa: F811
    drop = f"{files['root']}/drop"
    write_csv(f"{drop}/1.csv", "_c0" + TXN_HEADER, TXNS_A)
    write_csv(f"{drop}/2.csv", "_c0" + TXN_HEADER, TXNS_A[:2] + TXNS_B)
    write_csv(f"{drop}/3.csv", "_c0" + TXN_HEADER, TXNS_B)
    masters = Feed(transactions=None, customers=read_customer_master(spark, files["customer"]),
                   products=read_product_master(spark, files["product"]))
    wh = Warehouse(spark, f"{files['root']}/wh")
    run_ingest(spark, wh, drop, masters, f"{files['root']}/ckpt", max_files_per_trigger=1, lines=False,
               dedupe_masters=True, dedupe_within="1 day", keep_staging=True)
    assert wh.staged_all().count() == len(TXNS_A + TXNS_B)      # each once
    assert _fact(wh) == EXPECTED_FACT


def test_progress_is_kept(spark, files):  # noqa: F811
    drop = f"{files['root']}/drop"
    for i, rows in enumerate([TXNS_A[:2], TXNS_A[2:], TXNS_B]):
        write_csv(f"{drop}/{i}.csv", TXN_HEADER, rows)
    masters = Feed(transactions=None, customers=read_customer_master(spark, files["customer"]),
                   products=read_product_master(spark, files["product"]))
    wh = Warehouse(spark, f"{files['root']}/wh")

    def run():
        run_ingest(spark, wh, drop, masters, f"{files['root']}/ckpt", max_files_per_trigger=1, lines=False, dedupe_masters=True)
        return [(r.batch_id, r.rows_read, r.files_read, r.files_left, r.seconds is not None and r.seconds > 0)
                for r in wh.table("stream_progress").orderBy("batch_id").collect()]

    rows = run()
    assert sorted(r[1] for r in rows) == [2, 3, 5] and [r[2:] for r in rows] == [(1, 2, True), (1, 1, True), (1, 0, True)]
    write_csv(f"{drop}/9.csv", TXN_HEADER, TXNS_A)      # after a restart it goes on counting
    assert run()[3] == (3, 5, 1, 0, True)
    assert wh.table("stream_progress").select("run").distinct().count() == 1


def test_late_events_are_dropped_and_counted(spark, scratch):
    from martflow.streaming.events import deliver_events, hourly, hourly_sums, run_hourly
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(minutes=7 * i), i % 5, "click" if i % 3 else None, 0.1 * i, "{}") for i in range(200)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    events = spark.createDataFrame(rows + [(900, None, 1, "click", 1.0, "{}")], schema)
    deliver_events(events.where("event_id < 900"), f"{scratch}/drop", 5)
    run_hourly(spark, f"{scratch}/drop", f"{scratch}/t", f"{scratch}/c", events.schema, 1)
    table = sorted(map(repr, hourly_sums(events).withColumn("value", F.col("value").cast("double")).collect()))
    assert sorted(map(repr, hourly(spark, f"{scratch}/t").collect())) == table
    late = spark.createDataFrame([(1000, base, 1, "click", 5.0, "{}")], schema)
    late.write.mode("append").parquet(f"{scratch}/drop")
    progress = run_hourly(spark, f"{scratch}/drop", f"{scratch}/t", f"{scratch}/c", events.schema, 1)
    assert sorted(map(repr, hourly(spark, f"{scratch}/t").collect())) == table
    assert sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"]) == 1
    assert hourly(spark, f"{scratch}/none").count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test data not present")
def test_steady_loads_scan_the_batch_for_dimensions_once(spark):
    """No new key: no second scan, nothing written to a dimension."""
    from martflow.operators import load as L
    from martflow.plans.warehouse import open_warehouse
    wh = open_warehouse(spark, "/root/testdata/sf0.001")
    keys = L.batch_keys(wh.staged())
    rows, new = L.dimension_rows(wh.staged(), keys, {t: wh.table(t) for t in DIMS})
    assert rows == {} and set(new.values()) == {0}
    assert L.missing_parents(keys, {t: wh.table(t) for t in DIMS}) == {}
    one = dict.fromkeys(DIMS) | {t: wh.table(t) for t in DIMS} | {"dim_store": wh.store.where("Store_ID <> 3")}
    assert L.missing_parents(keys, one) == {"Store_ID": 1}
    # all at once equals each by itself
    fresh, new = L.dimension_rows(wh.staged(), keys, {})
    assert new == {t: wh.row_count(t) for t in DIMS}
    for t in DIMS:
        assert sorted(map(repr, fresh[t].collect())) == sorted(map(repr, L.LOADERS[t](wh.staged()).collect())), t
    small, _ = L.dimension_rows(wh.staged(), keys, {}, limit_bytes=0)
    assert sorted(map(repr, small["dim_store"].collect())) == sorted(map(repr, fresh["dim_store"].collect()))
