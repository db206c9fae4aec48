"""The parquet test tables mapped onto the retail feed.

lineitem + orders form the transaction feed (one transaction per order
line), customer + nation + region the customer master, part the product
master and supplier the supplier master.  The demographic attributes the
test tables lack are derived by fixed rules from the customer row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.schemas import (
    CUSTOMER_COLUMNS, PRODUCT_COLUMNS, RAW_PRICE, SUPPLIER_COLUMNS, TRANSACTION_COLUMNS,
)
from martflow.session import shuffles_freed
from martflow.sources.feed import Feed, spread

# Account-balance upper bounds of the seven age bands.
AGE_BANDS = [
    (0.0, "0-17"),
    (1500.0, "18-25"),
    (3000.0, "26-35"),
    (4500.0, "36-45"),
    (6000.0, "46-50"),
    (7500.0, "51-55"),
]
OLDEST_AGE_BAND = "55+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _age_band(balance: Column) -> Column:
    expr = None
    for bound, label in AGE_BANDS:
        expr = (F.when(balance < bound, F.lit(label)) if expr is None
                else expr.when(balance < bound, F.lit(label)))
    return expr.otherwise(F.lit(OLDEST_AGE_BAND))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the buyer and the order date (lineitem x orders).

    Both sides are large, so this is a shuffle join on the order key; it
    runs once per load, never per query."""
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return joined.select(
        F.col("l_orderkey").alias("Order_ID"),
        F.col("l_linenumber").cast("int").alias("Line_Number"),
        F.col("o_custkey").alias("Customer_ID"),
        F.col("l_partkey").alias("Product_ID"),
        F.col("l_suppkey").alias("Supplier_ID"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("Date"),
        F.lit(None).cast("string").alias("Parse_Error"),
    ).select(*TRANSACTION_COLUMNS, "Parse_Error")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    re = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = na.join(re, na.n_regionkey == re.r_regionkey).select("n_nationkey", "r_name")
    df = cu.join(geo, cu.c_nationkey == geo.n_nationkey, "left")
    return df.select(
        F.col("c_custkey").alias("Customer_ID"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("Gender"),
        _age_band(F.col("c_acctbal")).alias("Age"),
        F.col("c_nationkey").cast("int").alias("Occupation"),
        F.substring("r_name", 1, 1).alias("City_Category"),
        (F.col("c_custkey") % 5).cast("int").alias("Stay_In_Current_City_Years"),
        (F.col("c_nationkey") % 2).cast("int").alias("Marital_Status"),
    ).select(*CUSTOMER_COLUMNS)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_retailprice")
    return pa.select(
        F.col("p_partkey").alias("Product_ID"),
        F.col("p_type").alias("Product_Category"),
        F.col("p_retailprice").cast(RAW_PRICE).alias("Price"),
        F.expr("try_cast(substr(p_brand, 7) AS INT)").alias("Store_ID"),
        F.col("p_brand").alias("Store_Name"),
        F.lit(None).cast("bigint").alias("Supplier_ID"),
        F.lit(None).cast("string").alias("Supplier_Name"),
    ).select(*PRODUCT_COLUMNS)


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return su.select(F.col("s_suppkey").alias("Supplier_ID"),
                     F.col("s_name").alias("Supplier_Name")).select(*SUPPLIER_COLUMNS)


def master_rows(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """Exact master sizes: each master has one row per source row, and a
    column-less parquet count is answered from file metadata."""
    sources = {"customers": "customer", "products": "part", "suppliers": "supplier"}
    return count_rows({name: table(spark, sf_dir, t) for name, t in sources.items()})


def count_rows(frames: dict[str, DataFrame]) -> dict[str, int]:
    """Row counts of several tables in one job (no column is read)."""
    tagged = None
    for name, df in frames.items():
        part = df.select(F.lit(name).alias("t"))
        tagged = part if tagged is None else tagged.unionByName(part)
    got = {r.t: int(r["count"]) for r in tagged.groupBy("t").count().collect()}
    return {name: got.get(name, 0) for name in frames}


def testdata_feed(spark: SparkSession, sf_dir: str) -> Feed:
    return Feed(
        transactions=transactions(spark, sf_dir),
        customers=customers(spark, sf_dir),
        products=products(spark, sf_dir),
        suppliers=suppliers(spark, sf_dir),
        master_rows=master_rows(spark, sf_dir),
    )


def export_delivered_csv(spark: SparkSession, sf_dir: str, directory: str) -> dict[str, str]:
    """Write the feed in the delivered CSV layout (leading row index,
    original column names, ISO dates); returns the three paths.

    The transactions are delivered by order line, with its number and its
    supplier; products carry no supplier in the test tables."""
    out = {k: f"{directory.rstrip('/')}/{k}" for k in ("customer", "product", "transaction")}
    cu = customers(spark, sf_dir)
    cu.select(F.col("Customer_ID").alias("idx"), *CUSTOMER_COLUMNS) \
        .write.mode("overwrite").option("header", True).csv(out["customer"])
    pr = products(spark, sf_dir)
    pr.select(F.col("Product_ID").alias("idx"), "Product_ID", "Product_Category",
              F.col("Price").alias("price$"), F.col("Store_ID").alias("storeID"),
              F.col("Supplier_ID").alias("supplierID"), F.col("Store_Name").alias("storeName"),
              F.col("Supplier_Name").alias("supplierName")) \
        .write.mode("overwrite").option("header", True).csv(out["product"])
    tx = transactions(spark, sf_dir)
    with shuffles_freed(spark):
        tx.select(F.lit(0).alias("idx"), F.col("Order_ID").alias("orderID"),
                  F.col("Line_Number").alias("lineNumber"), "Customer_ID",
                  "Product_ID", F.col("Supplier_ID").alias("supplierID"), F.col("Quantity").alias("quantity"),
                  F.date_format("Date", "yyyy-MM-dd").alias("date")) \
            .write.mode("overwrite").option("header", True).csv(out["transaction"])
    return out
