"""The load path as queries: what the ETL wrote, and load scenarios.

``staging`` / ``quarantine`` / ``dim_*`` / ``fact`` / ``load_report`` read
what the batch load wrote.  The scenario queries replay the load operators
on the staged rows:

* recent-then-backfill: the warehouse is first loaded with the sales from
  ``cutoff`` on, then the whole history is delivered.  Insert-ignore must
  keep every dimension row of the first load unchanged (SCD type 0) and add
  only keys it has not seen.
* foreign-key check: the whole fact checked against dimensions that were
  loaded from the recent sales only.
* the same through a written warehouse, fact included.
* partial masters: customers and products withheld, one product listed twice;
  their sales must be quarantined, the others loaded.
* stream: the transactions delivered as CSV files and loaded by the
  Structured Streaming ingest, in four micro-batches at least, must give the same
  fact and stores as the batch load, also when a file is delivered a second time.
* duplicates in the stream: files sent twice within the watermark reach the
  load once.
* mixed headers: files of two column orders in one folder.
* re-drive: masters that arrive after their sales empty the quarantine.
* a load that dies before the fact: nothing of it is seen.
* constraints: sales with null keys and over-long text, and a batch of rejects only.
* events: hourly sums of the event stream.
"""

from __future__ import annotations

import hashlib
import threading
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.operators import load as L
from martflow.plans.views import store_quarterly_view
from martflow.plans.warehouse import (
    BUILD_VERSION, Warehouse, _fingerprint, load_feed, open_warehouse, redrive,
)
from martflow.schemas import STAGED_COLUMNS, STAR_TABLES
from martflow.session import delete_path, folder_bytes, input_identity, path_exists, shared_dir, shuffles_freed, write_marker
from martflow.sources import testdata
from martflow.sources.csv_files import csv_feed, read_transactions, write_transaction_files
from martflow.sources.feed import Feed
from martflow.streaming.events import deliver_events, hourly, run_hourly
from martflow.streaming.ingest import run_ingest

INCREMENTAL_CUTOFF = "1998-01-01"
_stream_lock = threading.Lock()


def staging(wh: Warehouse) -> DataFrame:
    return wh.staged()


def quarantine(wh: Warehouse) -> DataFrame:
    return wh.quarantine().select(*STAGED_COLUMNS, "Reject_Reason")


def load_report(wh: Warehouse) -> DataFrame:
    return wh.table("load_report").select("table_name", "rows_loaded")


def _recent(wh: Warehouse, cutoff: str) -> DataFrame:
    return wh.staged().filter(F.col("Date") >= F.lit(cutoff).cast("timestamp_ntz"))


def recent_then_backfill(wh: Warehouse, loader, cutoff: str = INCREMENTAL_CUTOFF) -> DataFrame:
    """Dimension after a recent-first load followed by the full history."""
    first = loader(_recent(wh, cutoff))
    backfill = loader(wh.staged(), first)
    return first.unionByName(backfill)


def fk_check_recent_dims(wh: Warehouse, cutoff: str = INCREMENTAL_CUTOFF) -> DataFrame:
    """Fact rows whose parent is missing from dimensions loaded from the
    sales since ``cutoff`` only, with the first missing parent."""
    recent = _recent(wh, cutoff)
    dims = {
        "dim_customer": L.dim_customer(recent),
        "dim_product": L.dim_product(recent),
        "dim_store": L.dim_store(recent),
        "dim_supplier": L.dim_supplier(recent),
        "dim_time": L.dim_time(recent),
    }
    _, rejected = L.foreign_key_split(wh.fact, dims)
    return rejected


ROWS_PER_DELIVERED_FILE = 1_000_000
MIN_DELIVERED_FILES = 4
#: Least intake of one micro-batch where the delivery need not be cut.
MICRO_BATCH_BYTES = 512 << 20
MIN_MICRO_BATCHES = 4


def micro_batch_bytes(spark: SparkSession, drop: str) -> int:
    """Intake of one micro-batch: a share of the delivery.  A micro-batch looks its
    orders up in the keys of what is loaded and joins the whole masters, so the
    number of micro-batches must not grow with the delivery."""
    return max(1, folder_bytes(spark, drop) // MIN_MICRO_BATCHES)


def delivered_files(spark: SparkSession, sf_dir: str) -> int:
    """Number of CSV files the feed is delivered in: grows with the data."""
    rows = testdata.count_rows({"lines": testdata.table(spark, sf_dir, "lineitem")})["lines"]
    return max(MIN_DELIVERED_FILES, -(-rows // ROWS_PER_DELIVERED_FILE))


def _lines(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """The feed's transactions, joined once and written: to cut them into files by
    ranges reads them twice, and a scenario may deliver them several times."""
    with shuffles_freed(spark):
        testdata.transactions(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/lines")
    return spark.read.parquet(f"{root}/lines")


def _masters(spark: SparkSession, sf_dir: str) -> Feed:
    return Feed(transactions=None, customers=testdata.customers(spark, sf_dir),
                products=testdata.products(spark, sf_dir),
                suppliers=testdata.suppliers(spark, sf_dir),
                master_rows=testdata.master_rows(spark, sf_dir))


def _built(spark: SparkSession, sf_dir: str, name: str, build) -> Warehouse:
    """A scenario's warehouse, built once per data set by ``build(wh, root)``."""
    key = hashlib.sha1(f"{BUILD_VERSION}|{_fingerprint(spark, sf_dir)}|{name}".encode()).hexdigest()[:16]
    root = f"{shared_dir(spark)}/martflow/{name}-{key}"
    wh = Warehouse(spark, f"{root}/warehouse")
    with _stream_lock:
        if not path_exists(spark, f"{root}/_COMPLETE"):
            build(wh, root)
            write_marker(spark, f"{root}/_COMPLETE", "ok")
    wh.invalidate()
    return wh


def streamed(spark: SparkSession, sf_dir: str, files: int | None = None,
             max_files_per_trigger: int | None = None) -> Warehouse:
    """Warehouse loaded by the streaming ingest from CSV deliveries of the feed."""
    files = files or delivered_files(spark, sf_dir)

    def build(wh: Warehouse, root: str) -> None:
        drop = f"{root}/drop"
        write_transaction_files(_lines(spark, sf_dir, root), drop, files)
        bound = ({"max_files_per_trigger": max_files_per_trigger} if max_files_per_trigger
                 else {"max_bytes_per_trigger": micro_batch_bytes(spark, drop)})
        run_ingest(spark, wh, drop, _masters(spark, sf_dir), f"{root}/checkpoint", lines=True,
                   product_type="bigint", **bound)

    return _built(spark, sf_dir, f"stream-{files}-{max_files_per_trigger or 'bytes'}", build)


def stream_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamed(spark, sf_dir).fact


def stream_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files come in the order of their dates, so a store's first buyer is in the
    first micro-batch that sells there."""
    return streamed(spark, sf_dir).store


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: what the stream has read, and what it says is left, at its end."""
    p = streamed(spark, sf_dir).table("stream_progress")
    return p.agg(F.sum("rows_read").alias("rows_read"), F.min("files_left").alias("files_left"),
                 (F.count(F.lit(1)) >= MIN_MICRO_BATCHES).alias("several_micro_batches"))


def stream_redelivered_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivered file arrives twice, the second time under another name."""
    def build(wh: Warehouse, root: str) -> None:
        drop, masters = f"{root}/drop", _masters(spark, sf_dir)
        lines, files = _lines(spark, sf_dir, root), delivered_files(spark, sf_dir)
        for turn in ("first", "again"):
            write_transaction_files(lines, f"{drop}/{turn}", files)
            run_ingest(spark, wh, f"{drop}/*", masters, f"{root}/checkpoint", lines=True, product_type="bigint",
                       max_bytes_per_trigger=max(MICRO_BATCH_BYTES, micro_batch_bytes(spark, f"{drop}/{turn}")))

    return _built(spark, sf_dir, "redelivered", build).fact


def stream_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file is sent twice before the stream reads them, one by one; how
    often each row reached the load."""
    def build(wh: Warehouse, root: str) -> None:
        lines, files = _lines(spark, sf_dir, root), delivered_files(spark, sf_dir)
        for turn in ("first", "again"):
            write_transaction_files(lines, f"{root}/drop/{turn}", files, compression="gzip")
        delete_path(spark, f"{root}/lines")     # delivered
        run_ingest(spark, wh, f"{root}/drop/*", _masters(spark, sf_dir), f"{root}/checkpoint", lines=True,
                   product_type="bigint", max_files_per_trigger=-(-2 * files // MIN_MICRO_BATCHES), dedupe_within="7 days",
                   keep_staging=True)

    wh = _built(spark, sf_dir, "deduplicated", build)
    return wh.staged().groupBy("Order_ID", "Line_Number", "Product_ID", "Supplier_ID", "Customer_ID", "Quantity", "Date") \
        .agg(F.count(F.lit(1)).alias("times_loaded"))


def mixed_headers_fact(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Half of the sales are delivered with their columns in another
    order, into the same folder."""
    other = ["quantity", "Product_ID", "date", "lineNumber", "supplierID", "_c0", "Customer_ID", "orderID"]

    def build(wh: Warehouse, root: str) -> None:
        drop, lines = f"{root}/drop", _lines(spark, sf_dir, root)
        half = -(-delivered_files(spark, sf_dir) // 2)
        write_transaction_files(lines.where(F.col("Order_ID") % 2 == 0), drop, half)
        write_transaction_files(lines.where(F.col("Order_ID") % 2 == 1), drop, half, order=other, mode="append")
        masters = _masters(spark, sf_dir)
        if streaming:
            run_ingest(spark, wh, drop, masters, f"{root}/checkpoint", lines=True, product_type="bigint",
                       max_files_per_trigger=half)
        else:
            rows = read_transactions(spark, drop, lines=True, product_type="bigint")
            load_feed(wh, replace(masters, transactions=rows), batch="mixed")

    return _built(spark, sf_dir, f"mixed-{'stream' if streaming else 'batch'}", build).fact


def summary_after_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept summary after two loads and a replay of the second, opened
    anew as another session would."""
    wh = backfilled(spark, sf_dir)
    lines = spark.read.parquet(f"{wh.root.rsplit('/', 1)[0]}/lines")
    load_feed(wh, replace(_masters(spark, sf_dir), transactions=lines), batch="history")
    return store_quarterly_view(Warehouse(spark, wh.root))


def committed_only(spark: SparkSession, sf_dir: str, cutoff: str = INCREMENTAL_CUTOFF) -> DataFrame:
    """Recent sales are loaded; a load of the whole history then dies when its
    dimensions are written and its fact is not.  The rows that readers see."""
    class Killed(RuntimeError):
        pass

    class Dying(Warehouse):
        def add(self, name: str, *args, **kwargs):
            if name == "fact_sales":
                raise Killed
            return super().add(name, *args, **kwargs)

    def build(wh: Warehouse, root: str) -> None:
        feed = testdata.testdata_feed(spark, sf_dir)
        recent = feed.transactions.filter(F.col("Date") >= F.lit(cutoff).cast("timestamp_ntz"))
        load_feed(wh, replace(feed, transactions=recent), batch="recent")
        try:
            load_feed(Dying(spark, wh.root), feed, batch="history")
        except Killed:
            return
        raise AssertionError("the load should have died")

    wh = _built(spark, sf_dir, f"killed-{cutoff}", build)
    tables = [wh.table(t).agg(F.count(F.lit(1)).alias("rows_seen")).select(F.lit(t).alias("table_name"), "rows_seen")
              for t in STAR_TABLES]
    return reduce(DataFrame.unionByName, tables)


def redriven(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The masters of :func:`partial_masters`, then the withheld ones."""
    def build(wh: Warehouse, root: str) -> None:
        feed = testdata.testdata_feed(spark, sf_dir)
        load_feed(wh, replace(feed, customers=feed.customers.filter(F.col("Customer_ID") % 7 != 0),
                              products=feed.products.filter(F.col("Product_ID") % 11 != 0)),  # no more than all
                  batch="partial")
        redrive(wh, feed, batch="redrive")

    return _built(spark, sf_dir, "redriven", build)


def constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales without a customer or a date, of a product whose category
    is too long and of a store without an id; and before them a batch of rejects only.
    Rows per table and reason after both loads."""
    def build(wh: Warehouse, root: str) -> None:
        feed = testdata.testdata_feed(spark, sf_dir)
        order = F.col("Order_ID")
        load_feed(wh, replace(feed, transactions=feed.transactions.where(order % 5 == 0)
                              .withColumn("Parse_Error", F.lit("unparsable Quantity"))), batch="rejects")
        sales = (feed.transactions.withColumn("Date", F.when(order % 13 != 0, F.col("Date")))
                 .withColumn("Customer_ID", F.when(order % 11 != 0, F.col("Customer_ID"))))
        products = (feed.products.withColumn("Product_Category", F.when(F.col("Product_ID") % 17 == 0, F.repeat(
            F.col("Product_Category"), 60)).otherwise(F.col("Product_Category")))
            .withColumn("Store_ID", F.when(F.col("Product_ID") % 3 != 0, F.col("Store_ID"))))
        wide = {**feed.master_rows, "products": 2 * feed.master_rows["products"]}      # long categories, as rows
        load_feed(wh, replace(feed, transactions=sales, products=products, master_rows=wide), batch="sales")

    wh = _built(spark, sf_dir, "constraints", build)
    held = wh.quarantine().groupBy("batch", F.col("Reject_Reason").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    stores = wh.store.agg(F.count(F.lit(1)).alias("n")).select(F.lit("sales").alias("batch"), F.lit("stores").alias("what"), "n")
    fact = wh.fact.groupBy(F.when(F.col("Store_ID").isNull(), "sales without a store").otherwise("sales of a store")
                           .alias("what")).agg(F.count(F.lit(1)).alias("n"))
    loads = (wh.table("load_report").where("table_name = 'fact_sales' AND rows_loaded = 0")
             .select("batch", F.lit("loads of nothing").alias("what"), F.lit(1).cast("long").alias("n")))
    return held.unionByName(stores).unionByName(fact.withColumn("batch", F.lit("sales"))).unionByName(loads)


def backfilled(spark: SparkSession, sf_dir: str, cutoff: str = INCREMENTAL_CUTOFF) -> Warehouse:
    """Recent sales loaded first, then the full history into the same tables."""
    def build(wh: Warehouse, root: str) -> None:
        feed = replace(_masters(spark, sf_dir), transactions=_lines(spark, sf_dir, root))
        recent = feed.transactions.filter(F.col("Date") >= F.lit(cutoff).cast("timestamp_ntz"))
        load_feed(wh, replace(feed, transactions=recent), batch="recent")
        load_feed(wh, feed, batch="history")

    return _built(spark, sf_dir, f"backfill-{cutoff}", build)


def partial_masters(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Masters without the customers divisible by 7 and the products divisible
    by 11, and with the products divisible by 5 listed twice (the second time
    at another price): which rows are withheld is the scenario."""
    def build(wh: Warehouse, root: str) -> None:
        feed = testdata.testdata_feed(spark, sf_dir)
        products = feed.products.filter(F.col("Product_ID") % 11 != 0).withColumn("_row", F.lit(0).cast("bigint"))
        twice = (products.filter(F.col("Product_ID") % 5 == 0).withColumn("_row", F.lit(1).cast("bigint"))
                 .withColumn("Price", (F.col("Price") + 1).cast(dict(products.dtypes)["Price"])))
        load_feed(wh, replace(feed, customers=feed.customers.filter(F.col("Customer_ID") % 7 != 0),
                              products=products.unionByName(twice),
                              master_rows={**feed.master_rows, "products": 2 * feed.master_rows["products"]}),
                  batch="partial", dedupe_masters=True)

    return _built(spark, sf_dir, "partial", build)


def partial_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partial_masters(spark, sf_dir).quarantine().select(
        "Order_ID", "Line_Number", "Product_ID", "Customer_ID", "Quantity", "Reject_Reason")


def csv_batch_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact loaded through the delivered-CSV batch path (S1-S3, renames,
    text parsing, master de-duplication by file row)."""
    def build(wh: Warehouse, root: str) -> None:
        paths = testdata.export_delivered_csv(spark, sf_dir, f"{root}/delivered")
        feed = csv_feed(spark, paths["customer"], paths["product"], paths["transaction"], lines=True)
        load_feed(wh, feed, batch="csv", dedupe_masters=True)

    return _built(spark, sf_dir, "csv", build).fact


def hourly_events_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly count and value of each event type, from the event files read as a
    stream in several micro-batches."""
    key = hashlib.sha1(f"{BUILD_VERSION}|{input_identity(spark, f'{sf_dir.rstrip('/')}/events.parquet')}|{sf_dir}"
                       .encode()).hexdigest()[:16]
    root = f"{shared_dir(spark)}/martflow/events-{key}"
    with _stream_lock:
        if not path_exists(spark, f"{root}/_COMPLETE"):
            events = testdata.table(spark, sf_dir, "events")
            rows = testdata.count_rows({"events": events})["events"]
            files = max(MIN_DELIVERED_FILES, -(-rows // ROWS_PER_DELIVERED_FILE))
            deliver_events(events, f"{root}/drop", files)
            run_hourly(spark, f"{root}/drop", f"{root}/hourly", f"{root}/checkpoint", events.schema,
                       max_files_per_trigger=-(-files // MIN_MICRO_BATCHES))
            write_marker(spark, f"{root}/_COMPLETE", "ok")
    return hourly(spark, f"{root}/hourly")


def _wh(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(open_warehouse(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "etl_query")
    return run


QUERIES = {
    "etl_staging": _wh(staging),
    "etl_quarantine": _wh(quarantine),
    "etl_load_report": _wh(load_report),
    "load_dim_customer": _wh(lambda wh: wh.customer),
    "load_dim_product": _wh(lambda wh: wh.product),
    "load_dim_store": _wh(lambda wh: wh.store),
    "load_dim_supplier": _wh(lambda wh: wh.supplier),
    "load_dim_time": _wh(lambda wh: wh.time),
    "load_fact_sales": _wh(lambda wh: wh.fact),
    "load_backfill_dim_store": _wh(lambda wh: recent_then_backfill(wh, L.dim_store)),
    "load_backfill_dim_product": _wh(lambda wh: recent_then_backfill(wh, L.dim_product)),
    "load_backfill_dim_customer": _wh(lambda wh: recent_then_backfill(wh, L.dim_customer)),
    "load_fk_check_recent_dims": _wh(fk_check_recent_dims),
    "load_backfill_fact_sales": lambda spark, sf_dir: backfilled(spark, sf_dir).fact,
    "load_partial_masters_fact": lambda spark, sf_dir: partial_masters(spark, sf_dir).fact,
    "etl_quarantine_partial_masters": partial_quarantine,
    "stream_fact_sales": stream_fact,
    "stream_dim_store": stream_store,
    "stream_redelivered_fact": stream_redelivered_fact,
    "stream_deduplicated_rows": stream_deduplicated,
    "stream_progress_totals": stream_progress,
    "stream_mixed_headers_fact": lambda spark, sf_dir: mixed_headers_fact(spark, sf_dir, streaming=True),
    "csv_mixed_headers_fact": mixed_headers_fact,
    "stream_hourly_events": hourly_events_streamed,
    "view_store_quarterly_after_replay": summary_after_replay,
    "load_killed_before_fact": committed_only,
    "load_redriven_fact": lambda spark, sf_dir: redriven(spark, sf_dir).fact,
    "etl_quarantine_redriven": lambda spark, sf_dir: quarantine(redriven(spark, sf_dir)),
    "etl_constraints": constraints,
    "csv_batch_fact_sales": csv_batch_fact,
}
