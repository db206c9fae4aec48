"""The logical input of one load: a transaction feed plus master data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


def spread(scan: DataFrame) -> DataFrame:
    """Round-robin an under-partitioned *scan* over the cluster's cores.

    A feed that arrives as one file (or one parquet row group) would run
    the whole enrich-and-stage pipeline in a single task.  When the scan
    has fewer partitions than the cluster has cores it is redistributed
    round-robin (no key, so no hot key can pile up); a large input already
    has enough partitions and is left alone.  Call it on a plain scan only:
    counting the partitions of a plan with exchanges would execute them."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


@dataclass
class Feed:
    """Inputs of the enrich step.

    transactions: Order_ID, Line_Number, Customer_ID, Product_ID, Supplier_ID
        (NULL when the supplier comes from the product), Quantity, Date
        (TIMESTAMP_NTZ), plus Parse_Error (NULL for a well-formed row).
    customers: customer master, one row per Customer_ID.
    products: product master; Price is the unrounded price.
    suppliers: optional supplier master (Supplier_ID, Supplier_Name) for feeds
        whose supplier is an attribute of the transaction.
    master_rows: row counts of the masters ("customers", "products",
        "suppliers"), when known: exact, or more than there are.
    """

    transactions: DataFrame
    customers: DataFrame
    products: DataFrame
    suppliers: DataFrame | None = None
    # Exact master row counts when the source knows them (None: unknown).
    # A master is broadcast only when its count proves it small.
    master_rows: dict[str, int] | None = None
