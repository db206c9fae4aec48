"""SQL access: the star tables as views under the warehouse's table names,
so analytical SQL written against the star schema runs unchanged in Spark
SQL (``spark.sql(...)``).

STORE_QUARTERLY_SALES (S12) is backed by a summary on disk that every load
brings up to date, so it is there in any session and costs no scan of the fact."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame

from martflow.operators.summary import store_quarterly
from martflow.plans.warehouse import Warehouse
from martflow.schemas import NOT_NULL, PARTITIONS, STAGED_COLUMNS
from martflow.session import list_names

# The table names of the star schema and of the staging table.
VIEW_NAMES = {
    "dim_customer": "DimCustomer",
    "dim_product": "DimProduct",
    "dim_store": "DimStore",
    "dim_supplier": "DimSupplier",
    "dim_time": "DimTime",
    "fact_sales": "FactSales",
}
STAGING_VIEW = "StagingSales"
SUMMARY_VIEW = "STORE_QUARTERLY_SALES"


def store_quarterly_view(wh: Warehouse) -> DataFrame:
    """Create or replace the view of the summary, and read it."""
    store_quarterly(wh.table("store_quarter_sums"), wh.store).createOrReplaceTempView(SUMMARY_VIEW)
    return wh.spark.table(SUMMARY_VIEW)


def register_views(wh: Warehouse) -> dict[str, str]:
    """Create or replace one temporary view per existing table; returns
    {view name: table}."""
    out = {}
    for table, view in VIEW_NAMES.items():
        if wh.exists(table):
            wh.table(table).createOrReplaceTempView(view)
            out[view] = table
    if wh.exists("store_quarter_sums"):
        store_quarterly_view(wh)
        out[SUMMARY_VIEW] = "store_quarter_sums"
    if wh.exists("staging"):
        wh.staged().select(*STAGED_COLUMNS).createOrReplaceTempView(STAGING_VIEW)
        out[STAGING_VIEW] = "staging"
    return out


NEVER_NULL = " COMMENT 'never null'"


def create_table_sql(wh: Warehouse, table: str, name: str) -> str:
    """DDL of a star table (S10): its contract over the table's folder, with a note
    on the columns that a load never leaves empty (the session's catalog drops NOT
    NULL).  The folders of loads are partitions."""
    parts = ["load", *PARTITIONS.get(table, [])]
    own = [f"{f.name} {f.dataType.simpleString()}{NEVER_NULL if f.name in NOT_NULL[table] else ''}"
           for f in wh.schema(table).fields if f.name not in parts]
    keys = ["load string", *[f"{f.name} {f.dataType.simpleString()}" for f in wh.schema(table).fields if f.name in parts]]
    return (f"CREATE TABLE {name} ({', '.join(own + keys)}) USING parquet PARTITIONED BY ({', '.join(parts)}) "
            f"LOCATION '{wh.path(table)}'")


def register_tables(wh: Warehouse, database: str | None = None) -> str:
    """The star tables as tables of the session's catalog, in a database of the
    warehouse's own; returns its name.  The partitions are the folders that the
    current manifest names, so the tables show what was committed when they were
    registered; dropping them deletes no data."""
    spark = wh.spark
    database = database or f"mart_{hashlib.sha1(wh.root.encode()).hexdigest()[:10]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{wh.path('_catalog')}'")
    for table, view in VIEW_NAMES.items():
        name = f"{database}.{view}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(create_table_sql(wh, table, name))
        places = []
        for folder in wh.manifest.folders(table):
            load, path = folder.path.split("load=", 1)[1], f"{wh.root}/{folder.path}"
            inner = [n.split("=", 1) for n in list_names(spark, path) if "=" in n] if PARTITIONS.get(table) else [None]
            for kv in inner:
                spec = f"load='{load}'" + (f", {kv[0]}={kv[1]}" if kv else "")
                places.append(f"PARTITION ({spec}) LOCATION '{path}{'/' + '='.join(kv) if kv else ''}'")
        if places:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(places)}")
    return database
