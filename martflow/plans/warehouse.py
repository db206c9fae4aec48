"""The star-schema warehouse on disk and the batch load into it.

Layout under one root folder (parquet):

    staging/batch=<id>/Status=staged|quarantined   enriched rows of a load (S6)
    <table>/load=<batch>-<attempt>/                what one load added to a table
    _manifest/<number>.json                        the folders that count (D8)

Tables: the five dimensions and the fact (``fact_sales``, by ``Year``), the
``quarantine`` (J8), the ``load_report`` (S11), ``fact_keys`` (the keys of the fact
by blocks of orders), ``store_quarter_sums`` (the summary behind
STORE_QUARTERLY_SALES) and ``stream_progress``.  A load writes into folders of its
own and publishes them all with one new manifest: a load that is killed leaves
every table as it was.

The root lives in the shared folder named by ``spark.checkpoint.dir``, so
every executor sees it and a lost executor never loses a table.  Queries
read the written tables; the expensive part of the load (the
lineitem-orders join, the fact de-duplication) runs once per load, not per
query.
"""

from __future__ import annotations

import hashlib
import re
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martflow.operators.enrich import REASON, enrich
from martflow.operators.keys import order_bucket
from martflow.operators.load import (
    LoadResult, batch_keys, dimension_rows, fact_sales, foreign_key_check, missing_parents,
)
from martflow.operators.summary import merge_sums, partial_sums
from martflow.plans import manifest as M
from martflow.schemas import (
    FACT_KEY, PARTITIONS, STAGED_COLUMNS, STAR_TABLES, TRANSACTION_COLUMNS, contract,
)
from pyspark.sql import types as T

from martflow.session import (
    apply_runtime_defaults, delete_path, input_identity, list_names, path_exists, shared_dir,
    session_setting, shuffles_freed, write_marker,
)
from martflow.sources.feed import Feed
from martflow.sources.testdata import testdata_feed

# Bump when the load semantics change, so stale warehouses are not reused.
BUILD_VERSION = "wh-31"
TESTDATA_TABLES = ("lineitem", "orders", "customer", "nation", "region", "part", "supplier")

DIMENSIONS = [t for t in STAR_TABLES if t.startswith("dim_")]
#: Tables whose folders the manifest names.
TABLES = [*STAR_TABLES, "quarantine", "load_report", "fact_keys", "store_quarter_sums", "stream_progress"]
# Target size of a compacted file, in rows.
COMPACT_ROWS_PER_FILE = 4_000_000
#: Folders of about one size (a power of this number) that are folded into one.
FOLD = 16
#: Files that a task keeps open for parts of a table; with more parts it sorts its rows by them.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Batch of a folder that holds rows of several (no batch id has this form).
MIXED = "+folded"

_lock = threading.Lock()
_opened: dict[tuple[str, str], "Warehouse"] = {}


class Warehouse:
    """Reads one committed state: that of its first read, until
    :meth:`invalidate` (which every load through this object calls)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._manifest: M.Manifest | None = None
        self._tables: dict[str, DataFrame] = {}

    @property
    def manifest(self) -> M.Manifest:
        if self._manifest is None:
            self._manifest = M.current(self.spark, self.root)
        return self._manifest

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        """Whether a table has been loaded into."""
        return path_exists(self.spark, self.path(name)) if name == "staging" else bool(self.manifest.folders(name))

    def read(self, name: str, folders: list[M.Folder] | tuple[M.Folder, ...]) -> DataFrame:
        schema = self.schema(name)
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path(name))
        found = reader.parquet(*[f"{self.root}/{f.path}" for f in folders])
        return found.select(*schema.names)

    def table(self, name: str) -> DataFrame:
        """The table as a DataFrame under its contract; the file listing is
        reused until the next load into this warehouse."""
        if name == "staging":
            return self.staged_all()
        if name not in self._tables:
            self._tables[name] = self.read(name, self.manifest.folders(name))
        return self._tables[name]

    @property
    def product_type(self) -> T.DataType:
        """Type of Product_ID, set by the first load after a reset."""
        return T.LongType() if self.manifest.product_type == "bigint" else T.StringType()

    def schema(self, name: str, product_type: T.DataType | None = None) -> T.StructType:
        return contract(name, product_type or self.product_type)

    def write(self, name: str, path: str, df: DataFrame, mode: str = "errorifexists",
              count: Observation | None = None, product_type: T.DataType | None = None) -> None:
        """Write rows under the table's contract: its columns in its order,
        cast to its types.  ``count`` gets the number of rows written, as ``rows``."""
        out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                          for f in self.schema(name, product_type).fields])
        parts = PARTITIONS.get(name, [])
        if name == "fact_sales":   # files of about one size per year, not one per task and year
            out = out.hint("rebalance", "Year").sortWithinPartitions("Year", "Time_ID")
        elif name == "fact_keys":
            out = out.hint("rebalance", "bucket").sortWithinPartitions("bucket", "Order_ID")
        if count is not None:
            out = out.observe(count, F.count(F.lit(1)).alias("rows"))
        writer = out.write.mode(mode)
        if parts:
            writer = writer.partitionBy(*parts).option("partitionOverwriteMode", "dynamic")
        # the two parts of a batch's staging are open together: its wide rows need no sort by them
        with session_setting(df.sparkSession, WRITERS, "2" if name == "staging" else None):
            writer.parquet(path)

    def add(self, name: str, batch: str, df: DataFrame, files: int | None = None) -> M.Folder:
        """Write rows into a new folder of a table.  Nothing reads it before a
        manifest names it."""
        path = f"{name}/load={batch}-{uuid.uuid4().hex[:8]}"
        obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        self.write(name, f"{self.root}/{path}", df if files is None else df.coalesce(files), count=obs)
        # a plan found empty while it runs reports no metrics
        return M.Folder(path, batch, int(obs.get.get("rows") or 0))

    def commit(self, changed: M.Manifest) -> None:
        """Publish a state made from this object's manifest."""
        M.commit(self.spark, self.root, changed)
        self.invalidate()

    def invalidate(self) -> None:
        self._tables = {}
        self._manifest = None

    def maybe_table(self, name: str) -> DataFrame | None:
        return self.table(name) if self.exists(name) else None

    def row_count(self, name: str) -> int | None:
        """Exact row count of a table, from the manifest (None when it does not exist)."""
        return self.manifest.rows(name) if self.exists(name) else None

    @property
    def fact(self) -> DataFrame:
        return self.table("fact_sales")

    @property
    def customer(self) -> DataFrame:
        return self.table("dim_customer")

    @property
    def product(self) -> DataFrame:
        return self.table("dim_product")

    @property
    def store(self) -> DataFrame:
        return self.table("dim_store")

    @property
    def supplier(self) -> DataFrame:
        return self.table("dim_supplier")

    @property
    def time(self) -> DataFrame:
        return self.table("dim_time")

    def staged_all(self, batch: str | None = None) -> DataFrame:
        """Staged and quarantined rows; of one batch, only its folder is listed."""
        reader = self.spark.read.schema(self.schema("staging")).option("basePath", self.path("staging"))
        return reader.parquet(self.path("staging") + (f"/batch={batch}" if batch else ""))

    def staged(self, batch: str | None = None) -> DataFrame:
        return self.staged_all(batch).filter(F.col("Status") == "staged").select(*STAGED_COLUMNS)

    def quarantine(self) -> DataFrame:
        return self.table("quarantine")


def _fitting(wh: Warehouse, enriched: DataFrame) -> DataFrame:
    """Rows whose Product_ID is not of the warehouse's type become rejects (P6);
    the reason keeps the value."""
    kind, own = dict(enriched.dtypes)["Product_ID"], wh.product_type.simpleString()
    if kind == own:
        return enriched
    cast = F.col("Product_ID").try_cast(own)
    misfit = F.when(F.col("Product_ID").isNotNull() & cast.isNull(),
                    F.concat(F.lit("Product_ID "), F.col("Product_ID").cast("string"), F.lit(f" is no {own}")))
    return enriched.withColumn(REASON, F.coalesce(misfit, F.col(REASON))).withColumn("Product_ID", cast)


def stage(wh: Warehouse, enriched: DataFrame, batch: str) -> tuple[int, int, list[int]]:
    """Write one batch of enriched rows, staged and quarantined, in one
    pass (the status is a partition column).  Returns the numbers of staged
    and quarantined rows and the buckets of the staged orders, collected during
    the write.  A batch staged again replaces what it staged before."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError(f"batch id {batch!r}: letters, digits, '_', '.' and '-' only")
    if wh.manifest.product_type is None:     # the first load decides; published with it
        wh._manifest = replace(wh.manifest, product_type=dict(enriched.dtypes)["Product_ID"])
    enriched = _fitting(wh, enriched)
    if path_exists(wh.spark, f"{wh.path('staging')}/batch={batch}"):
        delete_path(wh.spark, f"{wh.path('staging')}/batch={batch}")
    good = F.col(REASON).isNull()
    status = F.when(good, F.lit("staged")).otherwise(F.lit("quarantined"))
    out = enriched.withColumn("Status", status).withColumn("batch", F.lit(batch))
    obs = Observation(f"staging_{batch}")
    out = out.observe(obs, F.sum(F.when(good, 1).otherwise(0)).alias("staged"),
                      F.sum(F.when(good, 0).otherwise(1)).alias("rejected"),
                      F.collect_set(F.when(good, order_bucket(F.col("Order_ID")))).alias("buckets"))
    wh.write("staging", wh.path("staging"), out, "overwrite")
    got = obs.get
    return int(got.get("staged") or 0), int(got.get("rejected") or 0), list(got.get("buckets") or [])


def known_keys(wh: Warehouse, buckets: list[int]) -> DataFrame | None:
    """Keys of the loaded fact in some buckets: only their folders are read."""
    if not wh.exists("fact_keys"):
        return None
    return wh.table("fact_keys").where(F.col("bucket").isin(buckets)).select(*FACT_KEY)


def load_staged(wh: Warehouse, batch: str, staged_rows: int | None = None,
                rejected_rows: int | None = None, keep_staging: bool = True,
                check_parents: bool = True, buckets: list[int] | None = None,
                quarantine: DataFrame | None = None) -> LoadResult | None:
    """Staging -> star for one batch (D2-D8, J7, S7-S9, S11), in one commit.

    Every star table is insert-ignore on its key against what is committed, and
    the batch's quarantine and report replace those it left before, so
    replaying a batch changes nothing.  Dimensions are written before the fact;
    with ``check_parents``, fact rows without their dimension row are
    quarantined.  ``quarantine`` replaces the rejects of earlier batches.  Returns
    None for a batch without staged rows (S7).
    """
    if staged_rows is None or rejected_rows is None:
        counts = {r.Status: r["count"] for r in wh.staged_all(batch).groupBy("Status").count().collect()}
        staged_rows, rejected_rows = counts.get("staged", 0), counts.get("quarantined", 0)
    if buckets is None and staged_rows:
        buckets = [r[0] for r in wh.staged(batch).select(order_bucket(F.col("Order_ID"))).distinct().collect()]
    state = _forgetting(wh, wh.manifest, "quarantine", batch)
    if staged_rows or rejected_rows:
        rejected = wh.staged_all(batch).filter(F.col("Status") == "quarantined").drop("Status")
    earlier = list(state.folders("quarantine"))
    if quarantine is not None:
        kept = wh.add("quarantine", MIXED, quarantine)
        earlier = [kept] if kept.rows else []
    if not staged_rows:
        mine = [wh.add("quarantine", batch, rejected)] if rejected_rows else []
        _finish(wh, state.with_folders("quarantine", earlier + mine), batch, dict.fromkeys(STAR_TABLES, 0), keep_staging)
        return None
    staged = wh.staged(batch)
    keys = batch_keys(staged)
    rows, new_keys = dimension_rows(staged, keys, {t: wh.maybe_table(t) for t in DIMENSIONS})
    # The dimensions are independent: their (small) jobs run concurrently
    # and share the executors.  The fact is written only after all of them.
    with ThreadPoolExecutor(max_workers=max(1, len(rows))) as pool:
        added = dict(zip(rows, pool.map(lambda t: wh.add(t, batch, rows[t]), rows)))
    for t, folder in added.items():
        if folder.rows:
            state = state.adding(t, folder)
    fact = fact_sales(staged, known_keys(wh, buckets), staged_rows, wh.row_count("fact_keys"))
    # Every key of the batch was there, or is new and has its row; if the
    # numbers say otherwise the keys are looked up, and only then the rows
    complete = all(new_keys[t] == (added[t].rows if t in added else 0) for t in DIMENSIONS)
    lost = {}
    if check_parents and not complete:
        lost = missing_parents(keys, {t: wh.read(t, state.folders(t)) for t in DIMENSIONS})
    if lost:
        checked = foreign_key_check(fact, {t: bounded_dimension(wh, t, state) for t in DIMENSIONS}, list(lost))
        fact = checked.filter(F.col(REASON).isNull()).drop(REASON)
        key = ["Order_ID", "Line_Number", "Product_ID"]
        orphans = staged.join(checked.filter(F.col(REASON).isNotNull()).select(*key, REASON).distinct(), key)
        rejected = rejected.unionByName(orphans.withColumn("batch", F.lit(batch)).select(*rejected.columns))
    mine = [wh.add("quarantine", batch, rejected)] if rejected_rows or lost else []
    state = state.with_folders("quarantine", earlier + mine)
    added["fact_sales"] = wh.add("fact_sales", batch, fact)
    if added["fact_sales"].rows:
        new = wh.read("fact_sales", [added["fact_sales"]])
        bucketed = new.select(*FACT_KEY, order_bucket(F.col("Order_ID")).alias("bucket"))
        sums = merge_sums(*[t for t in (wh.maybe_table("store_quarter_sums"), partial_sums(new)) if t is not None])
        with ThreadPoolExecutor(max_workers=2) as pool:
            index = pool.submit(wh.add, "fact_keys", batch, bucketed)
            summary = pool.submit(wh.add, "store_quarter_sums", batch, sums, 1)
        state = state.adding("fact_sales", added["fact_sales"]).adding("fact_keys", index.result())
        state = state.with_folders("store_quarter_sums", [summary.result()])
    appended = {t: added[t].rows if t in added else 0 for t in STAR_TABLES}
    _finish(wh, state, batch, appended, keep_staging)
    return LoadResult(rows=appended)


def bounded_dimension(wh: Warehouse, name: str, state: M.Manifest | None = None) -> DataFrame:
    """A dimension's rows, broadcast only where its counted size allows it."""
    from martflow.plans.star import broadcast_limit, row_bytes
    state = state or wh.manifest
    rows = wh.read(name, state.folders(name))
    return F.broadcast(rows) if state.rows(name) * row_bytes(rows.schema) <= broadcast_limit(wh) else rows


def _forgetting(wh: Warehouse, state: M.Manifest, name: str, batch: str) -> M.Manifest:
    """A state without a batch's earlier rows of a table, also where they stand
    in a folder with those of other batches."""
    folders = [f for f in state.folders(name) if f.batch != batch]
    mixed = [f for f in folders if f.batch == MIXED]
    if mixed and not wh.read(name, mixed).where(F.col("batch") == batch).isEmpty():
        rest = wh.add(name, MIXED, wh.read(name, mixed).where(F.col("batch") != batch))
        folders = [f for f in folders if f not in mixed] + [rest]
    return state.with_folders(name, folders)


def _finish(wh: Warehouse, state: M.Manifest, batch: str, appended: dict[str, int], keep_staging: bool) -> None:
    """Report (S11), commit, and clear the batch's staging (S8).  The report of a
    batch counts what all its loads have appended."""
    loads = [f for f in state.folders("load_report") if f.batch in (batch, MIXED)]
    earlier = wh.read("load_report", loads).where(F.col("batch") == batch).collect() if loads else []
    before = {r["table_name"]: r["rows_loaded"] for r in earlier}
    values = ", ".join(f"('{t}', CAST({n + before.get(t, 0)} AS BIGINT), '{batch}')" for t, n in appended.items())
    report = wh.spark.sql(f"SELECT * FROM VALUES {values} AS report(table_name, rows_loaded, batch)")
    state = _forgetting(wh, state, "load_report", batch)
    wh.commit(state.adding("load_report", wh.add("load_report", batch, report, 1)))
    if not keep_staging:
        delete_path(wh.spark, f"{wh.path('staging')}/batch={batch}")
    fold(wh)


def _tier(rows: int) -> int:
    """Power of ``FOLD`` that a number of rows reaches."""
    tier = 0
    while rows >= FOLD:
        rows, tier = rows // FOLD, tier + 1
    return tier


def _rewritten(wh: Warehouse, name: str, folders: list[M.Folder], rows_per_file: int) -> M.Folder:
    rows = sum(f.rows for f in folders)
    df = wh.read(name, folders)
    if not PARTITIONS.get(name):     # partitioned tables are rebalanced by their partition
        df = df.repartition(max(1, -(-rows // rows_per_file)))  # round-robin: no key, so no hot key
    return wh.add(name, MIXED, df)


def fold(wh: Warehouse, rows_per_file: int = COMPACT_ROWS_PER_FILE) -> None:
    """Fold many small folders of a table into one, those of one size together,
    so a stream of small loads rewrites each row a few times only (a power of
    ``FOLD`` of its table) and readers list few folders."""
    state = wh.manifest
    for name in TABLES:
        tiers: dict[int, list[M.Folder]] = {}
        for f in state.folders(name):
            tiers.setdefault(_tier(f.rows), []).append(f)
        for same in tiers.values():
            if len(same) >= FOLD:
                one = _rewritten(wh, name, same, rows_per_file)
                state = state.with_folders(name, [f for f in state.folders(name) if f not in same] + [one])
    if state is not wh.manifest:
        wh.commit(state)


def compact(wh: Warehouse, name: str, rows_per_file: int = COMPACT_ROWS_PER_FILE) -> str:
    """Rewrite a table into about ``rows / rows_per_file`` files of one folder.

    Readers of the old folders keep working (their files are left in place, see
    :func:`vacuum`).  Run it between loads."""
    folder = _rewritten(wh, name, list(wh.manifest.folders(name)), rows_per_file)
    wh.commit(wh.manifest.with_folders(name, [folder]))
    return f"{wh.root}/{folder.path}"


def vacuum(wh: Warehouse) -> list[str]:
    """Delete the folders that the current manifest does not name: those of
    loads that were killed and those that were folded.  Only while nothing else
    reads or loads."""
    wh.invalidate()
    gone = []
    for name in TABLES:
        named = {f.path for f in wh.manifest.folders(name)}
        for entry in list_names(wh.spark, wh.path(name)):
            if f"{name}/{entry}" not in named:
                delete_path(wh.spark, f"{wh.path(name)}/{entry}")
                gone.append(f"{name}/{entry}")
    return gone


def reset_warehouse(wh: Warehouse) -> None:
    """S10 drop / recreate: every table is empty again, the type of Product_ID is
    open, and nothing says any more that it was loaded."""
    delete_path(wh.spark, f"{wh.root}/_COMPLETE")
    if wh.exists("staging"):
        empty = wh.spark.createDataFrame([], wh.schema("staging"))
        delete_path(wh.spark, wh.path("staging"))
        empty.write.parquet(wh.path("staging"))
    wh.commit(M.Manifest(version=wh.manifest.version))
    with _lock:
        for key in [k for k, w in _opened.items() if w.root == wh.root]:
            del _opened[key]


def load_feed(wh: Warehouse, feed: Feed, batch: str, dedupe_masters: bool = False,
              keep_staging: bool = True, quarantine: DataFrame | None = None) -> LoadResult | None:
    """Enrich, stage and load one batch of transactions."""
    apply_runtime_defaults(wh.spark)
    wh.invalidate()
    with shuffles_freed(wh.spark):
        staged_rows, rejected_rows, buckets = stage(wh, enrich(feed, dedupe_masters=dedupe_masters), batch)
        return load_staged(wh, batch, staged_rows, rejected_rows, keep_staging, buckets=buckets, quarantine=quarantine)


def redrive(wh: Warehouse, masters: Feed, batch: str, dedupe_masters: bool = False) -> LoadResult | None:
    """Load the rejects whose customer or product has meanwhile been delivered.

    Rows in quarantine for an unknown key are semi-joined with the masters; those
    found are enriched and loaded as a batch of their own, and leave the
    quarantine in the same commit (or come back with what else is wrong)."""
    wh.invalidate()
    held = wh.quarantine()
    waiting = {"unknown Customer_ID": ("Customer_ID", masters.customers),
               "unknown Product_ID": ("Product_ID", masters.products)}
    released, rest = None, held.where(~F.col(REASON).isin(list(waiting)))
    for reason, (key, master) in waiting.items():
        mine, known = held.where(F.col(REASON) == reason), master.select(key).distinct()
        found = mine.join(known, key, "left_semi").select(*held.columns)
        released = found if released is None else released.unionByName(found)
        rest = rest.unionByName(mine.join(known, key, "left_anti").select(*held.columns))
    feed = Feed(transactions=released.select(*TRANSACTION_COLUMNS, F.lit(None).cast("string").alias("Parse_Error")),
                customers=masters.customers, products=masters.products, suppliers=masters.suppliers,
                master_rows=masters.master_rows)
    return load_feed(wh, feed, batch, dedupe_masters, quarantine=rest)


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Identity of the input tables: length, files and last change of each, so
    changed data never reuses an old warehouse."""
    parts = [BUILD_VERSION, sf_dir.rstrip("/")]
    for name in TESTDATA_TABLES:
        parts.append(f"{name}:{input_identity(spark, f'{sf_dir.rstrip('/')}/{name}.parquet')}")
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


def warehouse_root(spark: SparkSession, sf_dir: str) -> str:
    return f"{shared_dir(spark)}/martflow/warehouse-{_fingerprint(spark, sf_dir)}"


def open_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse loaded from the test tables in ``sf_dir``; built on
    first use, then reused (also across sessions, via the shared folder)."""
    root = warehouse_root(spark, sf_dir)
    key = (spark.sparkContext.applicationId, root)
    with _lock:
        if key in _opened:
            return _opened[key]
        wh = Warehouse(spark, root)
        if not path_exists(spark, wh.path("_COMPLETE")):
            build_warehouse(wh, sf_dir)
        _opened[key] = wh
        return wh


def build_warehouse(wh: Warehouse, sf_dir: str) -> LoadResult | None:
    result = load_feed(wh, testdata_feed(wh.spark, sf_dir), batch="initial")
    write_marker(wh.spark, wh.path("_COMPLETE"), BUILD_VERSION)
    return result
