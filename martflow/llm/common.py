"""Helpers the operators share: kept tables, ranks, connected components."""

from __future__ import annotations

import ctypes
import gc
import sys
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martflow.session import shared_dir

#: A word: a run of anything but ASCII white space (bytes.split() in Python).
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Frees the shuffle files of a query when it ends; a written table needs them
#: no more.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the
    lineage, and survives the loss of any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN, before)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_path = path
    return kept


def forget(*tables: DataFrame) -> None:
    """Delete tables made by :func:`keep` that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.kept_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of so many rows at most."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows)


def give_back() -> None:
    """Return freed memory to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # where the C library has it
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function over batches that leaves its worker small.  Python workers live on
    beside the stages after theirs: what one keeps for its life (an encoder) goes
    when another operator's task begins, and freed memory goes back to the system."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name in [n for n in sys.modules if n.startswith("_martflow_")]:
            del sys.modules[name]
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


def row_numbers(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Number all rows from 0 in the given order without one task seeing them
    all: range partitions, numbers inside each, plus the counts before it."""
    part = keep(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    counts = sorted((r["_part"], r["count"]) for r in part.groupBy("_part").count().collect())
    before, total = [], 0
    for p, n in counts:        # one entry per partition
        before.append((p, total))
        total += n
    start = part.sparkSession.createDataFrame(before or [(0, 0)], "_part int, _before long")
    inside = Window.partitionBy("_part").orderBy(*order)
    return (part.withColumn("_n", F.row_number().over(inside))
            .join(F.broadcast(start), "_part")
            .withColumn(name, F.col("_before") + F.col("_n") - 1)
            .drop("_part", "_before", "_n"))


def with_group(rows: DataFrame, groups: DataFrame, key: str, size: str, columns: list[str],
               small: int = 1 << 17) -> DataFrame:
    """``rows`` with ``columns`` of the row of ``groups`` that has their ``key``
    (text; null has none), null where there is none.  ``groups`` has one row per
    key, of a few numbers, and ``size`` counts the rows of the group.

    Up to ``small`` groups are counted and broadcast.  Beyond that the groups
    with a thousandth of all rows or more, 1,000 at most, are broadcast, and the
    others joined by a shuffle in which the rows of those large ones are spread."""
    told = groups.select(F.col(key).alias("_k"), F.col(size).alias("_n"), F.struct(*columns).alias("_g"))
    sums = told.agg(F.count("*").alias("groups"), F.sum("_n").alias("rows")).first()
    plain = [F.col(c) for c in rows.columns if c not in columns]

    def joined(left: DataFrame, right: DataFrame, on: Column, into: str) -> DataFrame:
        return left.join(right.select(F.col("_k").alias("_key"), F.col("_g").alias(into)),
                         on == F.col("_key"), "left").drop("_key")

    if sums["groups"] <= small:
        out = joined(rows, F.broadcast(told), F.col(key), "_found")
    else:
        large = F.col("_n") * 1000 >= sums["rows"]
        near = joined(rows, F.broadcast(told.where(large)), F.col(key), "_near")
        spread = F.when(F.col("_near").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(
            F.concat(F.lit("~"), F.pmod(F.monotonically_increasing_id(), F.lit(4096)).cast("string")))
        far = joined(near.withColumn("_spread", spread), told.where(~large), F.col("_spread"), "_far")
        out = far.withColumn("_found", F.coalesce("_near", "_far"))
    return out.select(*plain, *[F.col("_found").getField(c).alias(c) for c in columns])


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``: the component
    is its smallest node.  Labels take the minimum of the neighbourhood and then
    jump to their own label's label, until nothing changes."""
    both = keep(edges.select("a", "b").where("a <> b")
                .unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b"))
                .distinct(), "edges")
    labels = keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component"))
                  .withColumnRenamed("a", "node"), "labels")
    while True:     # every round shortens the longest way to the smallest node
        lab = labels.select(F.col("node").alias("b"), F.col("component").alias("near"))
        best = (both.join(lab, "b").groupBy("a").agg(F.min("near").alias("near"))
                .withColumnRenamed("a", "node"))
        step = (labels.join(best, "node")
                .select("node", F.col("component").alias("old"), F.least("component", "near").alias("mid")))
        jump = labels.select(F.col("node").alias("mid"), F.col("component").alias("far"))
        new = keep(step.join(jump, "mid", "left")
                   .select("node", "old", F.least("mid", F.coalesce("far", "mid")).alias("component")), "labels")
        labels = new.select("node", "component")
        if new.where("old <> component").isEmpty():
            return labels


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
