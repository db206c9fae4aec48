"""Near-real-time ingest.

A file stream of transactions is read micro-batch by micro-batch; each
micro-batch is enriched against the static master data, staged and loaded
into the star schema inside ``foreachBatch``, in one commit.  Every table is
insert-ignore on its key, so a micro-batch replayed after a failure
(at-least-once delivery) leaves the tables as if it had run once.  Offsets live in
the checkpoint folder, so a restarted query resumes where it stopped instead of
re-reading the files.

With ``dedupe_within`` (T3) rows delivered a second time within that time are
dropped by the stream's state store before they reach the load; the load's keys
absorb what comes later than that.  The time is that of arrival, so no
row is ever too late.

Progress (T5) goes into the table ``stream_progress``: per micro-batch the records
and files read, the files left in the drop folder, and the time taken as a
listener on the stream reports it.
"""

from __future__ import annotations

import json
import threading
import time
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from martflow.plans.warehouse import Warehouse, load_staged, stage
from martflow.operators.enrich import enrich
from martflow.session import apply_runtime_defaults, read_marker, session_setting, shuffles_freed
from martflow.sources.csv_files import read_micro_batch, transaction_lines, transaction_stream
from martflow.sources.feed import Feed, spread

#: Progress is written after so many micro-batches, and when a run ends.
PROGRESS_EVERY = 16
#: The state of a stream that drops duplicates: its files are compressed well, since each key
#: is kept on an executor's disk and in the checkpoint; no micro-batch without rows is run only
#: to look for what has expired, which rewrites those files: the next one with rows does that.
STATE_SETTINGS = {"spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
                  "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
#: Keeps the state of a stream on the executors' disks, not on their heaps.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
MEMORY = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Progress(StreamingQueryListener):
    """Collects what each micro-batch read, and how long the stream says it took."""

    def __init__(self) -> None:
        self.took: dict[int, float] = {}
        self.read: dict[int, tuple[int, int, int]] = {}     # records, files, files left
        self.run: str | None = None
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if self.run is None or str(event.progress.id) == self.run:
            with self.lock:
                self.took[event.progress.batchId] = event.progress.batchDuration / 1000

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def loaded(self, epoch: int, records: int, files: int, left: int) -> None:
        with self.lock:
            self.read[epoch] = (records, files, left)

    def take(self, wait: float = 0) -> list[tuple]:
        """Rows of the micro-batches whose time is known (after ``wait`` seconds:
        of all), each given out once."""
        until = time.monotonic() + wait
        while wait and self.read.keys() - self.took.keys() and time.monotonic() < until:
            time.sleep(0.05)
        with self.lock:
            ready = sorted(e for e in self.read if wait or e in self.took)
            out = []
            for e in ready:
                records, files, left = self.read.pop(e)
                took = self.took.pop(e, None)
                out.append((self.run, e, records, took, records / took if took else None, files, left))
            return out


PROGRESS_SCHEMA = ("run string, batch_id long, rows_read long, seconds double, rows_per_second double, files_read long, "
                   "files_left long")


def write_progress(wh: Warehouse, progress: Progress, wait: float = 0) -> None:
    rows = progress.take(wait)
    if rows:
        wh.invalidate()
        df = wh.spark.createDataFrame(rows, PROGRESS_SCHEMA)
        wh.commit(wh.manifest.adding("stream_progress", wh.add("stream_progress", "progress", df, 1)))


def start_ingest(spark: SparkSession, wh: Warehouse, drop_dir: str, masters: Feed,
                 checkpoint: str, max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int | None = None, lines: bool = True, product_type: str = "string",
                 available_now: bool = True, processing_time: str | None = None,
                 dedupe_masters: bool = False, keep_staging: bool = False,
                 dedupe_within: str | None = None, progress: Progress | None = None) -> StreamingQuery:
    """Start the ingest query.

    ``available_now`` drains what is in ``drop_dir`` (in bounded
    micro-batches) and stops; otherwise the query keeps polling every
    ``processing_time``."""
    progress = progress if progress is not None else Progress()
    apply_runtime_defaults(spark)
    if dedupe_within:
        if spark.conf.get(STATE_STORE) == MEMORY:
            spark.conf.set(STATE_STORE, ROCKSDB)
        stream = transaction_stream(spark, drop_dir, max_files_per_trigger, lines=lines,
                                    product_type=product_type, max_bytes_per_trigger=max_bytes_per_trigger)
        delivered = stream.columns
        stream = (stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", dedupe_within)
                  .dropDuplicatesWithinWatermark(delivered).drop("_arrived"))
    else:
        stream = transaction_lines(spark, drop_dir, max_files_per_trigger, max_bytes_per_trigger)
    done = {"files": _files_read_before(wh, checkpoint)}

    def load_micro_batch(batch: DataFrame, epoch_id: int) -> None:
        if dedupe_within:
            files, transactions = 0, spread(batch)
        else:
            transactions, files = read_micro_batch(spread(batch), lines, product_type)
        done["files"] += files
        feed = Feed(transactions=transactions, customers=masters.customers, products=masters.products,
                    suppliers=masters.suppliers, master_rows=masters.master_rows)
        name = f"epoch-{epoch_id:08d}"
        wh.invalidate()
        with shuffles_freed(wh.spark, batch.sparkSession):      # the stream has a session of its own
            staged, rejected, buckets = stage(wh, enrich(feed, dedupe_masters=dedupe_masters), name)
            load_staged(wh, name, staged, rejected, keep_staging, buckets=buckets)
        left = max(0, len(spark.read.text(drop_dir).inputFiles()) - done["files"]) if files else 0
        if staged + rejected:
            progress.loaded(epoch_id, staged + rejected, files, left)
        if len(progress.read) >= PROGRESS_EVERY:
            write_progress(wh, progress)

    writer = (stream.writeStream.foreachBatch(load_micro_batch)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    spark.streams.addListener(progress)
    with ExitStack() as stack:      # the query copies the session's settings when it starts
        for key, value in STATE_SETTINGS.items() if dedupe_within else ():
            if spark.conf.get(key, None) is None:
                stack.enter_context(session_setting(spark, key, value))
        query = writer.start()
    progress.run = str(query.id)        # of the checkpoint: the same after a restart
    return query


def _files_read_before(wh: Warehouse, checkpoint: str) -> int:
    """Files that earlier runs of a checkpoint have read."""
    told = read_marker(wh.spark, f"{checkpoint}/metadata")
    if not told or not wh.exists("stream_progress"):
        return 0
    own = wh.table("stream_progress").where(F.col("run") == json.loads(told)["id"])
    return own.agg(F.sum("files_read")).first()[0] or 0


def run_ingest(spark: SparkSession, wh: Warehouse, drop_dir: str, masters: Feed,
               checkpoint: str, **kwargs) -> dict[str, int]:
    """Drain ``drop_dir`` into ``wh``; returns how many micro-batches the
    warehouse has consumed and the rows it has loaded and quarantined so far
    (T5), taken from its own report however long the stream ran."""
    progress = Progress()
    query = start_ingest(spark, wh, drop_dir, masters, checkpoint, available_now=True, progress=progress, **kwargs)
    query.awaitTermination()
    try:
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
        write_progress(wh, progress, wait=10)
    finally:
        spark.streams.removeListener(progress)
    return ingest_totals(wh)


def ingest_totals(wh: Warehouse) -> dict[str, int]:
    wh.invalidate()
    if not wh.exists("load_report"):
        return {"micro_batches": 0, "fact_rows": 0, "quarantined": 0}
    epochs = wh.table("load_report").filter(F.col("batch").startswith("epoch-"))
    row = epochs.agg(F.countDistinct("batch"),
                     F.sum(F.when(F.col("table_name") == "fact_sales", F.col("rows_loaded")))).first()
    lost = wh.quarantine().filter(F.col("batch").startswith("epoch-")).count() if wh.exists("quarantine") else 0
    return {"micro_batches": row[0], "fact_rows": int(row[1] or 0), "quarantined": lost}
