"""Transaction enrichment.

Each transaction is joined with its customer and its product (and, when
the feed carries the supplier, with the supplier master), priced, narrowed
to the staging types and checked against the staging constraints.  Rows
that fail are kept with a reason instead of being lost, so every
transaction ends up either staged or quarantined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.measures import exact_revenue, revenue
from martflow.operators.keys import first_per_key
from martflow.schemas import (
    CUSTOMER_COLUMNS, PRICE, PRODUCT_COLUMNS, STAGED_COLUMNS, STAGED_MAX_LENGTH,
    STAGED_NOT_NULL,
)
from martflow.sources.feed import Feed

REASON = "Reject_Reason"
PROFILE_COLUMNS = [c for c in CUSTOMER_COLUMNS if c != "Customer_ID"]
# A master is broadcast when rows x row width is known to be under this.
MASTER_BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
MASTER_BROADCAST_CONF = "martflow.enrich.broadcastLimitBytes"


def _bounded(master: DataFrame, rows: int | None) -> DataFrame:
    """Broadcast hint only behind a proven size bound.  A larger master is dealt out
    by key, and where its part in a task is known to be no larger than that bound,
    the task holds it as a hash table: the sales are not sorted.  Otherwise the
    planner decides."""
    if rows is None:
        return master
    from martflow.plans.star import row_bytes
    spark = master.sparkSession
    limit = int(spark.conf.get(MASTER_BROADCAST_CONF, str(MASTER_BROADCAST_LIMIT_BYTES)))
    size = rows * row_bytes(master.schema)
    if size <= limit:
        return F.broadcast(master)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return master.hint("shuffle_hash") if size <= limit * parts else master


def _profiles(customers: DataFrame, rows: int | None) -> DataFrame | None:
    """For a customer master that is too large to broadcast: its distinct attributes by
    a number made of them, where they are few and no two share a number.  Then
    the sales are shuffled with that number, not with the attributes."""
    from martflow.plans.star import row_bytes
    from martflow.session import shared_dir
    limit = int(customers.sparkSession.conf.get(MASTER_BROADCAST_CONF, str(MASTER_BROADCAST_LIMIT_BYTES)))
    if rows is None or rows * row_bytes(customers.schema) <= limit:
        return None
    shared_dir(customers.sparkSession)
    found = customers.select(_profile().alias("_profile"), *PROFILE_COLUMNS).distinct().checkpoint(eager=True)
    n = found.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("_profile").alias("numbers")).first()
    few = n["rows"] * row_bytes(found.schema) <= limit
    return found if few and n["rows"] == n["numbers"] else None


def _profile() -> Column:
    return F.hash(*PROFILE_COLUMNS)


def unique_master(master: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One master row per key: the first by ``order`` (J2: first matching
    product row).  Uses a partial aggregate, so a duplicated hot key costs
    one row per task before the shuffle."""
    order = order or [c for c in master.columns if c != key]
    payload = [c for c in master.columns if c != key]
    return first_per_key(master, [key], order, payload)


def _file_order(master: DataFrame) -> list[str] | None:
    return ["_row"] if "_row" in master.columns else None


def _constraint_reason(df: DataFrame) -> Column:
    checks = [(F.col(c).isNull(), f"{c} is NULL") for c in STAGED_NOT_NULL]
    checks += [(F.length(F.col(c).cast("string")) > n, f"{c} longer than {n}")
               for c, n in STAGED_MAX_LENGTH.items()]
    expr = None
    for cond, text in checks:
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return expr


def enrich(feed: Feed, dedupe_masters: bool = False) -> DataFrame:
    """All transactions of ``feed`` with the staged columns and a
    ``Reject_Reason`` (NULL for a row that may be staged).

    The master joins are equi-joins on the key; Spark broadcasts a master
    when its measured size is under the broadcast threshold and shuffles
    otherwise, so a master that grows with the data is never forced into
    memory.  ``dedupe_masters`` enforces one row per key when the master
    files do not guarantee it.
    """
    customers, products = feed.customers, feed.products
    if dedupe_masters:
        customers = unique_master(customers, "Customer_ID", _file_order(customers))
        products = unique_master(products, "Product_ID", _file_order(products))
    customers = customers.select(*CUSTOMER_COLUMNS)
    products = products.select(*PRODUCT_COLUMNS)
    sizes = feed.master_rows or {}
    profiles = _profiles(customers, sizes.get("customers"))
    if profiles is not None:
        customers = customers.select("Customer_ID", _profile().alias("_profile"))
    else:
        customers = customers.withColumn("_cust_hit", F.lit(True))
    products = (products.withColumnRenamed("Supplier_ID", "_prod_supplier")
                .withColumnRenamed("Supplier_Name", "_prod_supplier_name")
                .withColumnRenamed("Price", "_raw_price")
                .withColumn("_prod_hit", F.lit(True)))

    df = feed.transactions.join(_bounded(customers, sizes.get("customers")), "Customer_ID", "left")
    df = df.join(_bounded(products, sizes.get("products")), "Product_ID", "left")
    supplier_id = F.coalesce(F.col("Supplier_ID"), F.col("_prod_supplier"))
    df = df.withColumn("Supplier_ID", supplier_id)
    if feed.suppliers is not None:
        sup = feed.suppliers.select("Supplier_ID", F.col("Supplier_Name").alias("_sup_name"))
        if dedupe_masters:
            sup = unique_master(sup, "Supplier_ID")
        df = df.join(_bounded(sup, sizes.get("suppliers")), "Supplier_ID", "left")
        supplier_name = F.coalesce(F.col("_sup_name"), F.col("_prod_supplier_name"))
    else:
        supplier_name = F.col("_prod_supplier_name")
    if profiles is not None:
        df = df.join(F.broadcast(profiles.withColumn("_cust_hit", F.lit(True))), "_profile", "left")

    staged = df.select(
        "Order_ID", "Line_Number", "Date", "Quantity",
        revenue(F.col("Quantity"), F.col("_raw_price"), precision=10).alias("Revenue"),
        "Customer_ID", "Gender", "Age", "Occupation", "City_Category",
        "Stay_In_Current_City_Years", "Marital_Status",
        "Product_ID", "Product_Category",
        F.col("_raw_price").try_cast(PRICE).alias("Price"),
        "Store_ID", "Store_Name", "Supplier_ID",
        supplier_name.alias("Supplier_Name"),
        "Parse_Error", "_cust_hit", "_prod_hit", "_raw_price",
        exact_revenue(F.col("Quantity"), F.col("_raw_price")).alias("_exact"),
    )
    reason = F.coalesce(
        F.col("Parse_Error"),
        F.when(F.col("_cust_hit").isNull(), F.lit("unknown Customer_ID")),
        F.when(F.col("_prod_hit").isNull(), F.lit("unknown Product_ID")),
        F.when(F.col("_raw_price").isNull(), F.lit("unreadable Price")),
        F.when(F.col("Price").isNull(), F.lit("Price out of range")),
        F.when(F.col("_exact").isNotNull() & F.col("Revenue").isNull(), F.lit("Revenue out of range")),
        _constraint_reason(staged),
    )
    return staged.withColumn(REASON, reason).select(*STAGED_COLUMNS, REASON)
