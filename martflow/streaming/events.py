"""Hourly sums of the event stream: event-time windows with a watermark.

Events arrive as files and are added up per hour and type.  The stream emits what
has changed (update mode); each micro-batch writes its changed hours into a
partition of its own, which a replay replaces, and a reader takes the last state
of each hour.  State of an hour is dropped once the watermark has passed its end;
events that come later than the watermark allows are dropped by Spark, which
counts them (``numRowsDroppedByWatermark`` of the progress).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.session import list_names, path_exists, set_modified

#: How much later than the newest event one may arrive.
LATENESS = "1 hour"
SCHEMA = "hour timestamp_ntz, event_type string, events long, value decimal(38,6), epoch long"


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def deliver_events(events: DataFrame, directory: str, files: int) -> None:
    """Write events as ``files`` parquet files by time, oldest first, as a feed would."""
    events.repartitionByRange(files, "ts", "event_id").write.mode("overwrite").parquet(directory)
    spark = events.sparkSession
    for i, name in enumerate(sorted(n for n in list_names(spark, directory) if n.startswith("part-"))):
        set_modified(spark, f"{directory}/{name}", 1_000_000_000_000 + 1000 * i)


def hourly_sums(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """``hour, event_type, events, value`` of events with a time (a stream or a table)."""
    # watermarks want an instant: the wall-clock time as if it were UTC
    ts = F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), F.col("ts").cast("timestamp_ntz")))
    rows = events.select(ts.alias("ts"), "event_type", F.col("value").cast("decimal(18,6)").alias("value"))
    if events.isStreaming:
        rows = rows.withWatermark("ts", lateness)
    return (rows.where("ts IS NOT NULL").groupBy(F.window("ts", "1 hour").alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
            .select(F.timestamp_add("SECOND", F.unix_seconds("w.start"), _epoch()).alias("hour"), "event_type", "events", F.col("value").cast("decimal(38,6)").alias("value")))


def run_hourly(spark: SparkSession, directory: str, table: str, checkpoint: str, schema: T.StructType,
               max_files_per_trigger: int | None = None, lateness: str = LATENESS) -> list[dict]:
    """Add up what is in ``directory`` and stop; the progress of each micro-batch."""
    reader = spark.readStream.schema(schema).option("latestFirst", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def write(changed: DataFrame, epoch: int) -> None:
        # only the sums are dealt anew: to coalesce would put the whole aggregate into as few tasks
        rows = changed.withColumn("epoch", F.lit(epoch).cast("long"))
        rows.repartition(spark.sparkContext.defaultParallelism, "hour", "event_type").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("epoch").parquet(table)

    query = (hourly_sums(reader.parquet(directory), lateness).writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return [json.loads(p.json) for p in query.recentProgress]


def hourly(spark: SparkSession, table: str) -> DataFrame:
    """The last state of each hour and type."""
    if not path_exists(spark, table):
        return spark.createDataFrame([], SCHEMA).select("hour", "event_type", "events", F.col("value").cast("double").alias("value"))
    rows = spark.read.schema(SCHEMA).parquet(table)
    last = rows.groupBy("hour", "event_type").agg(F.max_by(F.struct("events", "value"), "epoch").alias("s"))
    return last.select("hour", "event_type", "s.events", F.col("s.value").cast("double").alias("value"))
