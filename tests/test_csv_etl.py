"""The whole load path on small files shaped like the delivered CSVs."""

import hashlib
import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import CUSTOMER_HEADER, PRODUCT_HEADER, TXN_HEADER, write_csv
from martflow.plans.warehouse import Warehouse, load_feed
from martflow.sources.csv_files import csv_feed, read_customer_master, read_product_master
from martflow.sources.feed import Feed
from martflow.streaming.ingest import run_ingest


def _slot(key) -> int:
    return int(hashlib.md5(str(key).encode()).hexdigest(), 16) % 10000


def _collider(base: int) -> int:
    c = base + 1
    while _slot(c) != _slot(base):
        c += 1
    return c


COLLIDER = _collider(1000001)

CUSTOMERS = [
    "0,1000001,F,0-17,10,A,2,0",
    "1,1000002,M,26-35,16,C,4,1",
    f"2,{COLLIDER},M,55+,3,B,1,1",
]
PRODUCTS = [
    "0,P00000001,Electronics,25.835,1,11,Tech Haven,Samsung Electronics",
    "1,P00000002,Home & Kitchen,10.00,2,12,Home Hub,Acme",
    "2,P00000003,Toys,5.50,,,,",
]
TXNS_A = [
    "0,1,1000001,P00000001,3,2020-12-26",
    "1,2,1000002,P00000002,1,2020-12-27",
    "2,2,1000002,P00000001,2,2020-12-27",
    "3,3,9999999,P00000001,1,2020-12-28",
    "4,4,1000001,P99999999,1,2020-12-28",
]
TXNS_B = [
    "5,x,1000001,P00000001,1,2020-12-28",
    "6,5,1000001,P00000001,1,not-a-date",
    f"7,6,{COLLIDER},P00000002,2,2020-12-28",
    "8,7,1000001,P00000003,1,2020-12-28",
    "9,1,1000001,P00000001,5,2020-12-29",
]


@pytest.fixture()
def files(scratch):
    return {
        "customer": write_csv(f"{scratch}/in/customer_master_data.csv", CUSTOMER_HEADER, CUSTOMERS),
        "product": write_csv(f"{scratch}/in/product_master_data.csv", PRODUCT_HEADER, PRODUCTS),
        "txn": write_csv(f"{scratch}/in/transactional_data.csv", TXN_HEADER, TXNS_A + TXNS_B),
        "root": scratch,
    }


def _load(spark, files, batch="b1", wh=None):
    wh = wh or Warehouse(spark, f"{files['root']}/wh")
    feed = csv_feed(spark, files["customer"], files["product"], files["txn"])
    return wh, load_feed(wh, feed, batch=batch, dedupe_masters=True)


def _fact(wh):
    return sorted((r.Order_ID, r.Product_ID, r.Quantity, str(r.Revenue), r.Store_ID, r.Customer_ID)
                  for r in wh.fact.collect())


EXPECTED_FACT = [
    (1, "P00000001", 3, "77.51", 1, 1000001),
    (2, "P00000001", 2, "51.67", 1, 1000002),
    (2, "P00000002", 1, "10.00", 2, 1000002),
    (6, "P00000002", 2, "20.00", 2, COLLIDER),
    (7, "P00000003", 1, "5.50", None, 1000001),
]


def test_batch_load(spark, files):
    wh, result = _load(spark, files)
    assert _fact(wh) == EXPECTED_FACT
    reasons = sorted(r.Reject_Reason for r in wh.quarantine().collect())
    assert reasons == ["unknown Customer_ID", "unknown Product_ID", "unparsable Date",
                       "unparsable Order_ID"]
    # every transaction is staged or quarantined
    assert wh.staged().count() + wh.quarantine().count() == len(TXNS_A + TXNS_B)
    stores = {r.Store_ID: (r.Store_Name, r.City_Category) for r in wh.store.collect()}
    assert stores == {1: ("Tech Haven", "A"), 2: ("Home Hub", "C")}  # earliest sale decides
    assert sorted(r.Supplier_ID for r in wh.supplier.collect()) == [11, 12]
    days = {str(r.Date): (r.Weekday_Name, r.Is_Weekend, r.Time_ID) for r in wh.time.collect()}
    assert days["2020-12-26"] == ("Saturday", 1, 20201226)
    assert days["2020-12-27"][:2] == ("Sunday", 1)
    assert days["2020-12-28"][:2] == ("Monday", 0)
    price = {r.Product_ID: str(r.Price) for r in wh.product.collect()}
    assert price["P00000001"] == "25.84"
    # the customer sharing an md5 slot with 1000001 keeps its own attributes
    col = wh.fact.filter(F.col("Customer_ID") == COLLIDER).join(wh.customer, "Customer_ID")
    assert [(r.Gender, r.Age, r.City_Category) for r in col.collect()] == [("M", "55+", "B")]
    report = {r.table_name: r.rows_loaded for r in result.report(spark).collect()}
    assert report["fact_sales"] == 5 and report["dim_time"] == 4


def test_reload_and_changed_attributes_change_nothing(spark, files):
    wh, _ = _load(spark, files)
    before = _fact(wh)
    customers_before = sorted(tuple(r) for r in wh.customer.collect())
    # replay of the same batch (e.g. after a failure)
    _load(spark, files, batch="b1", wh=wh)
    # a later delivery where a customer's attributes changed
    changed = [c.replace("1000001,F,0-17", "1000001,M,51-55") for c in CUSTOMERS]
    write_csv(files["customer"], CUSTOMER_HEADER, changed)
    _, result = _load(spark, files, batch="b2", wh=wh)
    assert _fact(wh) == before
    assert sorted(tuple(r) for r in wh.customer.collect()) == customers_before
    assert wh.time.count() == 4
    assert all(v == 0 for v in (r.rows_loaded for r in result.report(spark).collect()))


def test_master_readers_keep_first_file_row(spark, scratch):
    path = write_csv(f"{scratch}/p.csv", PRODUCT_HEADER, PRODUCTS + [
        "3,P00000001,Other,1.00,9,99,Dup Store,Dup Supplier"])
    from martflow.operators.enrich import unique_master
    df = unique_master(read_product_master(spark, path), "Product_ID", ["_row"])
    row = df.filter(F.col("Product_ID") == "P00000001").first()
    assert row.Product_Category == "Electronics"
    assert read_customer_master(spark, files_path(scratch)).count() == 3


def files_path(scratch):
    return write_csv(f"{scratch}/c.csv", CUSTOMER_HEADER, CUSTOMERS)


def test_stream_equals_batch_and_absorbs_redelivery(spark, files, scratch):
    drop = f"{scratch}/drop"
    os.makedirs(drop)
    write_csv(f"{drop}/part-1.csv", TXN_HEADER, TXNS_A)
    masters = Feed(transactions=None,
                   customers=read_customer_master(spark, files["customer"]),
                   products=read_product_master(spark, files["product"]))
    wh = Warehouse(spark, f"{scratch}/stream_wh")
    ckpt = f"{scratch}/ckpt"
    run_ingest(spark, wh, drop, masters, ckpt, max_files_per_trigger=1, lines=False,
               dedupe_masters=True)
    assert wh.fact.count() == 3
    # a new file arrives; the restarted query reads only that file
    write_csv(f"{drop}/part-2.csv", TXN_HEADER, TXNS_B)
    totals = run_ingest(spark, wh, drop, masters, ckpt, max_files_per_trigger=1, lines=False,
                        dedupe_masters=True)
    assert totals["micro_batches"] == 2     # not re-read: one epoch for each file
    assert totals["fact_rows"] + totals["quarantined"] + 1 == len(TXNS_A + TXNS_B)   # one repeats a key
    assert not os.path.isdir(f"{wh.root}/staging/batch=epoch-00000000")   # consumed
    assert _fact(wh) == EXPECTED_FACT
    # the same content delivered again under a new name is absorbed by the keys
    shutil.copy(f"{drop}/part-1.csv", f"{drop}/part-3.csv")
    run_ingest(spark, wh, drop, masters, ckpt, max_files_per_trigger=1, lines=False,
               dedupe_masters=True)
    assert _fact(wh) == EXPECTED_FACT
    batch_wh, _ = _load(spark, files)
    assert _fact(batch_wh) == _fact(wh)


def test_reset_then_reload(spark, files):
    from martflow.plans.warehouse import reset_warehouse
    wh, _ = _load(spark, files)
    schema = wh.fact.schema
    reset_warehouse(wh)
    assert wh.fact.count() == 0 and wh.customer.count() == 0
    assert wh.fact.schema == schema
    _load(spark, files, batch="again", wh=wh)
    assert _fact(wh) == EXPECTED_FACT


def test_continuous_ingest_picks_up_new_files(spark, files, scratch):
    from martflow.streaming.ingest import start_ingest
    drop = f"{scratch}/live"
    os.makedirs(drop)
    masters = Feed(transactions=None,
                   customers=read_customer_master(spark, files["customer"]),
                   products=read_product_master(spark, files["product"]))
    wh = Warehouse(spark, f"{scratch}/live_wh")
    query = start_ingest(spark, wh, drop, masters, f"{scratch}/live_ckpt", lines=False,
                         available_now=False, processing_time="1 second", dedupe_masters=True)
    try:
        write_csv(f"{drop}/a.csv", TXN_HEADER, TXNS_A)
        query.processAllAvailable()
        assert wh.fact.count() == 3
        write_csv(f"{drop}/b.csv", TXN_HEADER, TXNS_B)
        query.processAllAvailable()
        assert _fact(wh) == EXPECTED_FACT
        assert query.isActive
    finally:
        query.stop()


def test_compact_after_many_micro_batches(spark, files):
    from martflow.plans.warehouse import compact
    wh = Warehouse(spark, f"{files['root']}/wh_many")
    # many small loads, like a stream's micro-batches
    for i, rows in enumerate([TXNS_A[:2], TXNS_A[2:], TXNS_B[:3], TXNS_B[3:], TXNS_A]):
        write_csv(files["txn"], TXN_HEADER, rows)
        _load(spark, files, batch=f"mb{i}", wh=wh)
    before = {t: sorted(map(repr, wh.table(t).collect())) for t in ("dim_customer", "fact_sales")}
    many = len(wh.table("dim_customer").inputFiles())
    compact(wh, "dim_customer")
    compact(wh, "fact_sales")
    assert len(wh.table("dim_customer").inputFiles()) == 1 < many
    for t, rows in before.items():
        assert sorted(map(repr, wh.table(t).collect())) == rows
    # later loads append to the compacted version; a re-delivery adds nothing
    write_csv(files["txn"], TXN_HEADER, TXNS_A + TXNS_B)
    _load(spark, files, batch="later", wh=wh)
    assert _fact(wh) == EXPECTED_FACT
    assert Warehouse(spark, wh.root).fact.count() == len(EXPECTED_FACT)


# ------------------------------------------------------------- bad deliveries
LINE_HEADER = ",orderID,lineNumber,Customer_ID,Product_ID,supplierID,quantity,date"


def test_all_rejected_batch_keeps_its_rejects(spark, files):
    write_csv(files["txn"], TXN_HEADER, ["0,1,9999999,P00000001,1,2020-12-26", "1,x,1000001,P00000001,1,2020-12-26"])
    wh, result = _load(spark, files)
    assert result is None and wh.quarantine().count() == 2
    assert {r.rows_loaded for r in wh.table("load_report").collect()} == {0}
    assert not wh.exists("fact_sales")
    write_csv(files["txn"], TXN_HEADER, TXNS_A)
    _load(spark, files, batch="good", wh=wh)
    assert wh.fact.count() == 3 and wh.quarantine().count() == 4


def test_replay_changes_nothing(spark, files):
    wh, _ = _load(spark, files)
    tables = ["quarantine", "load_report", "dim_customer", "dim_store", "dim_time", "fact_sales", "staging"]
    before = {t: sorted(map(repr, wh.table(t).collect())) for t in tables}
    _load(spark, files, wh=wh)
    assert {t: sorted(map(repr, wh.table(t).collect())) for t in tables} == before


def test_bad_values_become_rejects(spark, files):
    write_csv(files["product"], PRODUCT_HEADER, PRODUCTS[:1] + [
        "1,P00000002,Toys,abc,1,11,Shop,Maker", "2,P00000003,Toys,99999999.99,1,11,Shop,Maker",
        "3,P00000004,Toys,999999999.99,1,11,Shop,Maker"])
    write_csv(files["txn"], TXN_HEADER, [
        "0,1,1000001,P00000001,1,2020-03-08 02:30:00", "1,2,1000001,P00000002,1,2020-12-26",
        "2,3,1000001,P00000003,3,2020-12-26", "3,4,1000001,P00000004,1,2020-12-26"])
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")   # the hour does not exist there
    try:
        wh, _ = _load(spark, files)
        assert [str(r.Date) for r in wh.staged().collect()] == ["2020-03-08 02:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted(r.Reject_Reason for r in wh.quarantine().collect()) == [
        "Price out of range", "Revenue out of range", "unreadable Price"]
    assert wh.fact.filter("Revenue IS NULL").isEmpty()


def test_columns_are_found_by_name(spark, files):
    write_csv(files["txn"], ",date,quantity,Product_ID,Customer_ID,orderID", ["0,2020-12-26,3,P00000001,1000001,1"])
    wh, _ = _load(spark, files)
    assert _fact(wh) == EXPECTED_FACT[:1]
    write_csv(files["txn"], ",orderID,Customer_ID,Product_ID,date", ["0,1,1000001,P00000001,2020-12-26"])
    with pytest.raises(ValueError, match="quantity"):
        _load(spark, files, batch="b2", wh=wh)


def test_batch_load_of_order_lines(spark, files):
    from martflow.__main__ import main
    write_csv(files["txn"], LINE_HEADER, ["0,1,1,1000001,P00000001,77,3,2020-12-26", "1,1,2,1000001,P00000001,78,1,2020-12-26"])
    whp = f"{files['root']}/line_wh"
    assert main(["load", "--customers", files["customer"], "--products", files["product"], "--transactions",
                 files["txn"], "--warehouse", whp, "--lines"], spark=spark) == 0
    got = sorted((r.Line_Number, r.Customer_ID, r.Supplier_ID, r.Quantity) for r in Warehouse(spark, whp).fact.collect())
    assert got == [(1, 1000001, 77, 3), (2, 1000001, 78, 1)]


def test_fact_rows_without_a_parent_are_quarantined(spark, files, monkeypatch):
    from martflow.plans import warehouse as w
    all_rows = w.dimension_rows

    def withheld(staged, keys, targets):
        rows, new = all_rows(staged, keys, targets)
        return rows | {"dim_product": rows["dim_product"].filter("Product_ID <> 'P00000002'")}, new

    monkeypatch.setattr(w, "dimension_rows", withheld)
    wh, _ = _load(spark, files)
    assert _fact(wh) == [r for r in EXPECTED_FACT if r[1] != "P00000002"]
    lost = wh.quarantine().filter("Product_ID = 'P00000002'").collect()
    assert {r.Reject_Reason for r in lost} == {"no dim_product row for Product_ID"} and len(lost) == 2


def test_tables_keep_their_contract(spark, files):
    from martflow.schemas import contract
    from pyspark.sql import types as T
    wh, _ = _load(spark, files)
    for name in ["staging", "quarantine", "dim_customer", "dim_product", "dim_store", "dim_supplier",
                 "dim_time", "fact_sales", "load_report"]:
        want = {f.name: f.dataType for f in contract(name, T.StringType()).fields}
        assert {f.name: f.dataType for f in wh.table(name).schema.fields} == want, name
        folders = [f"{wh.root}/{f.path}" for f in wh.manifest.folders(name)] or [wh.path(name)]
        stored = spark.read.parquet(folders[0]).schema     # what the files themselves say
        parts = {"batch", "Status", "Year", "load"}
        assert all(want[f.name] == f.dataType for f in stored.fields if f.name not in parts), name


def test_reset_is_not_taken_for_loaded(spark, files):
    from martflow.plans.warehouse import reset_warehouse
    from martflow.session import path_exists, write_marker
    wh, _ = _load(spark, files)
    write_marker(spark, wh.path("_COMPLETE"), "x")
    reset_warehouse(wh)
    assert not path_exists(spark, wh.path("_COMPLETE")) and wh.quarantine().count() == 0


def test_paths_belong_to_the_default_filesystem(spark, files):
    """A path without a scheme is looked up where Spark writes it, not on the
    driver's disk: here the default filesystem maps /wh to another folder."""
    conf = spark._jsc.hadoopConfiguration()
    target = f"{files['root']}/cluster"
    os.makedirs(target)
    conf.set("fs.viewfs.mounttable.cluster.link./wh", f"file://{target}")
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://cluster")
    try:
        wh = Warehouse(spark, "/wh/star")
        feed = csv_feed(spark, *[f"file://{files[k]}" for k in ("customer", "product", "txn")])
        for batch in ("one", "two"):
            load_feed(wh, feed, batch=batch, dedupe_masters=True)
        assert _fact(wh) == EXPECTED_FACT and wh.customer.count() == 3
        assert os.path.isdir(f"{target}/star/fact_sales") and not os.path.exists("/wh")
    finally:
        if before:
            conf.set("fs.defaultFS", before)
        else:
            conf.unset("fs.defaultFS")


def test_a_denied_read_is_not_an_absent_table(spark, scratch):
    from martflow.session import path_exists
    with pytest.raises(Exception, match="[Nn]o FileSystem|UnsupportedFileSystem"):
        path_exists(spark, "nosuchscheme://host/table")
    assert path_exists(spark, f"{scratch}/absent") is False


def test_results_come_in_their_order(spark):
    from martflow.plans import olap
    from martflow.plans.warehouse import open_warehouse
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("test data not present")
    wh = open_warehouse(spark, "/root/testdata/sf0.001")
    keys = [(r.Product_Category, r.Month) for r in olap.q2(wh).collect()]
    assert keys == sorted(keys)
    sales = [(-r.Total_Sales, r.Occupation, r.Product_Category) for r in olap.q3(wh).collect()]
    assert sales == sorted(sales)
