"""Store x quarter summary, kept up to date load by load.

The summary holds partial sums per store, year and quarter.  A load adds up its
own new fact rows only and merges the result with what is there, so keeping it
costs the batch, never the fact.  Sums and counts combine exactly (decimals), and
insert-ignore gives each fact row to one load, so the merged sums are those of
the whole fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["Store_ID", "Year", "Quarter"]


def partial_sums(fact: DataFrame) -> DataFrame:
    """Sums of fact rows that have a store; the quarter is in the yyyymmdd key."""
    month = F.floor(F.col("Time_ID") / 100) % 100
    rows = fact.where("Store_ID IS NOT NULL").select(
        "Store_ID", "Year", F.floor((month + 2) / 3).cast("int").alias("Quarter"), "Revenue")
    return rows.groupBy(*KEYS).agg(F.sum("Revenue").cast("decimal(38,2)").alias("Revenue"),
                                   F.count(F.lit(1)).alias("Sales"))


def merge_sums(*parts: DataFrame) -> DataFrame:
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy(*KEYS).agg(F.sum("Revenue").cast("decimal(38,2)").alias("Revenue"), F.sum("Sales").alias("Sales"))


def store_quarterly(sums: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue per store name and quarter, all years together."""
    named = sums.join(stores.select("Store_ID", "Store_Name"), "Store_ID")
    return named.groupBy("Store_Name", "Quarter").agg(F.sum("Revenue").cast("double").alias("Total_Sales"))
