"""Table contracts (S10): input files, staging and the star schema.

Types follow the warehouse DDL: ids INT (BIGINT where the feed carries 64-bit
keys), money DECIMAL(10,2) / DECIMAL(12,2), calendar parts INT.  Where the
staging and dimension DDL disagree the dimension type wins
(Stay_In_Current_City_Years INT, Age / Gender / City_Category STRING).
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
REVENUE_STAGED = T.DecimalType(10, 2)
REVENUE_FACT = T.DecimalType(12, 2)
# CSV prices are read unrounded; revenue is computed from this, Price is
# narrowed to DECIMAL(10,2) afterwards.
RAW_PRICE = T.DecimalType(18, 6)

# ---------------------------------------------------------------- CSV inputs
# Column names as they appear in the delivered CSV files (the unnamed pandas
# index column comes first and is never selected).
CUSTOMER_CSV = T.StructType([
    T.StructField("_c0", T.LongType()),
    T.StructField("Customer_ID", T.LongType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("Age", T.StringType()),
    T.StructField("Occupation", T.IntegerType()),
    T.StructField("City_Category", T.StringType()),
    T.StructField("Stay_In_Current_City_Years", T.StringType()),
    T.StructField("Marital_Status", T.IntegerType()),
])

PRODUCT_CSV = T.StructType([
    T.StructField("_c0", T.LongType()),
    T.StructField("Product_ID", T.StringType()),
    T.StructField("Product_Category", T.StringType()),
    T.StructField("price$", RAW_PRICE),
    T.StructField("storeID", T.IntegerType()),
    T.StructField("supplierID", T.LongType()),
    T.StructField("storeName", T.StringType()),
    T.StructField("supplierName", T.StringType()),
])

# Transactions are read as text and parsed explicitly, so that one bad value
# becomes a quarantined row instead of a failed job or a widened column type.
TRANSACTION_CSV = T.StructType([
    T.StructField("_c0", T.StringType()),
    T.StructField("orderID", T.StringType()),
    T.StructField("Customer_ID", T.StringType()),
    T.StructField("Product_ID", T.StringType()),
    T.StructField("quantity", T.StringType()),
    T.StructField("date", T.StringType()),
])

# Order-line feed: the same file with the line number and the supplier of
# each line (used when one order holds several lines).
TRANSACTION_LINE_CSV = T.StructType([
    T.StructField("_c0", T.StringType()),
    T.StructField("orderID", T.StringType()),
    T.StructField("lineNumber", T.StringType()),
    T.StructField("Customer_ID", T.StringType()),
    T.StructField("Product_ID", T.StringType()),
    T.StructField("supplierID", T.StringType()),
    T.StructField("quantity", T.StringType()),
    T.StructField("date", T.StringType()),
])

# The renames applied to the delivered files.
PRODUCT_RENAMES = {
    "price$": "Price",
    "storeID": "Store_ID",
    "supplierID": "Supplier_ID",
    "storeName": "Store_Name",
    "supplierName": "Supplier_Name",
}
TRANSACTION_RENAMES = {"orderID": "Order_ID", "quantity": "Quantity", "date": "Date"}

# ------------------------------------------------------------ logical feeds
# What every source adapter produces; the enrich / load operators only rely
# on these names.
TRANSACTION_COLUMNS = ["Order_ID", "Line_Number", "Customer_ID", "Product_ID",
                       "Supplier_ID", "Quantity", "Date"]
CUSTOMER_COLUMNS = ["Customer_ID", "Gender", "Age", "Occupation", "City_Category",
                    "Stay_In_Current_City_Years", "Marital_Status"]
PRODUCT_COLUMNS = ["Product_ID", "Product_Category", "Price", "Store_ID",
                   "Store_Name", "Supplier_ID", "Supplier_Name"]
SUPPLIER_COLUMNS = ["Supplier_ID", "Supplier_Name"]

# --------------------------------------------------------------- staging
STAGED_COLUMNS = [
    "Order_ID", "Line_Number", "Date", "Quantity", "Revenue",
    "Customer_ID", "Gender", "Age", "Occupation", "City_Category",
    "Stay_In_Current_City_Years", "Marital_Status",
    "Product_ID", "Product_Category", "Price",
    "Store_ID", "Store_Name", "Supplier_ID", "Supplier_Name",
]
STAGED_NOT_NULL = ["Order_ID", "Date", "Customer_ID", "Product_ID"]
# VARCHAR / CHAR limits of the staging DDL.
STAGED_MAX_LENGTH = {
    "Gender": 1,
    "Age": 20,
    "City_Category": 1,
    "Stay_In_Current_City_Years": 10,
    "Product_ID": 255,
    "Product_Category": 255,
    "Store_Name": 255,
    "Supplier_Name": 255,
}

# A transaction is one order line.  The line number alone is not unique in
# every feed, so product and supplier complete the key.
FACT_KEY = ["Order_ID", "Line_Number", "Product_ID", "Supplier_ID"]
# Supplier_ID may be NULL (a product without a supplier); the rest may not.
FACT_KEY_REQUIRED = ["Order_ID", "Line_Number", "Product_ID"]
# Total order that decides which delivery of a key is "first".
ARRIVAL_ORDER = ["Date", "Order_ID", "Line_Number", "Product_ID", "Supplier_ID",
                 "Customer_ID", "Quantity"]

# ------------------------------------------------------------ star schema
DIM_CUSTOMER_COLUMNS = CUSTOMER_COLUMNS
DIM_PRODUCT_COLUMNS = ["Product_ID", "Product_Category", "Price", "Store_ID", "Supplier_ID"]
DIM_STORE_COLUMNS = ["Store_ID", "Store_Name", "City_Category"]
DIM_SUPPLIER_COLUMNS = ["Supplier_ID", "Supplier_Name"]
DIM_TIME_COLUMNS = ["Time_ID", "Date", "Day", "Month", "Quarter", "Year",
                    "Weekday_Name", "Is_Weekend"]
FACT_COLUMNS = ["Order_ID", "Line_Number", "Customer_ID", "Product_ID", "Store_ID",
                "Supplier_ID", "Time_ID", "Quantity", "Revenue", "Year"]

# Foreign keys of the fact: (fact column, dimension table, dimension column).
FACT_FOREIGN_KEYS = [
    ("Customer_ID", "dim_customer", "Customer_ID"),
    ("Product_ID", "dim_product", "Product_ID"),
    ("Store_ID", "dim_store", "Store_ID"),
    ("Supplier_ID", "dim_supplier", "Supplier_ID"),
    ("Time_ID", "dim_time", "Time_ID"),
]

# Columns that are never NULL.
NOT_NULL = {
    "dim_customer": ["Customer_ID"], "dim_product": ["Product_ID"], "dim_store": ["Store_ID"],
    "dim_supplier": ["Supplier_ID"], "dim_time": ["Time_ID", "Date"],
    "fact_sales": ["Order_ID", "Line_Number", "Customer_ID", "Product_ID", "Time_ID"],
}

STAR_TABLES = ["dim_customer", "dim_product", "dim_store", "dim_supplier",
               "dim_time", "fact_sales"]

# ------------------------------------------------------------ table contracts
# Types of every column the warehouse stores.  Product_ID is text in the
# delivered files and a number in the test tables; a warehouse keeps the type
# of its first load.
_TYPES = {
    "Order_ID": T.LongType(), "Line_Number": T.IntegerType(), "Date": T.TimestampNTZType(),
    "Quantity": T.IntegerType(), "Revenue": REVENUE_STAGED, "Customer_ID": T.LongType(),
    "Gender": T.StringType(), "Age": T.StringType(), "Occupation": T.IntegerType(),
    "City_Category": T.StringType(), "Stay_In_Current_City_Years": T.IntegerType(),
    "Marital_Status": T.IntegerType(), "Product_Category": T.StringType(), "Price": PRICE,
    "Store_ID": T.IntegerType(), "Store_Name": T.StringType(), "Supplier_ID": T.LongType(),
    "Supplier_Name": T.StringType(), "Reject_Reason": T.StringType(), "Time_ID": T.IntegerType(),
    "Day": T.IntegerType(), "Month": T.IntegerType(), "Quarter": T.IntegerType(),
    "Year": T.IntegerType(), "Weekday_Name": T.StringType(), "Is_Weekend": T.IntegerType(),
    "batch": T.StringType(), "Status": T.StringType(), "table_name": T.StringType(),
    "rows_loaded": T.LongType(), "bucket": T.IntegerType(), "Sales": T.LongType(),
    "run": T.StringType(), "batch_id": T.LongType(), "rows_read": T.LongType(), "seconds": T.DoubleType(),
    "rows_per_second": T.DoubleType(), "files_read": T.LongType(), "files_left": T.LongType(),
}
_TABLES = {
    "staging": [*STAGED_COLUMNS, "Reject_Reason", "batch", "Status"],
    "quarantine": [*STAGED_COLUMNS, "Reject_Reason", "batch"],
    "dim_customer": DIM_CUSTOMER_COLUMNS, "dim_product": DIM_PRODUCT_COLUMNS,
    "dim_store": DIM_STORE_COLUMNS, "dim_supplier": DIM_SUPPLIER_COLUMNS,
    "dim_time": DIM_TIME_COLUMNS, "fact_sales": FACT_COLUMNS,
    "load_report": ["table_name", "rows_loaded", "batch"],
    # keys of the fact by blocks of orders, for telling what is already loaded
    "fact_keys": [*FACT_KEY, "bucket"],
    # partial sums of the store x quarter summary, one row per cell
    "store_quarter_sums": ["Store_ID", "Year", "Quarter", "Revenue", "Sales"],
    "stream_progress": ["run", "batch_id", "rows_read", "seconds", "rows_per_second", "files_read", "files_left"],
}
_OWN_TYPES = {("dim_time", "Date"): T.DateType(), ("fact_sales", "Revenue"): REVENUE_FACT,
              ("store_quarter_sums", "Revenue"): T.DecimalType(38, 2)}
PARTITIONS = {"staging": ["batch", "Status"], "fact_sales": ["Year"], "fact_keys": ["bucket"]}


def contract(table: str, product_id: T.DataType) -> T.StructType:
    """Columns and types of a warehouse table."""
    types = _TYPES | {"Product_ID": product_id}
    return T.StructType([T.StructField(c, _OWN_TYPES.get((table, c), types[c])) for c in _TABLES[table]])
