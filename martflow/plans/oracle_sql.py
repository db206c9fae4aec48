"""Independent DuckDB SQL for every registered query.

The SQL starts from the raw test tables (lineitem, orders, customer, nation,
region, part, supplier) and re-derives the feed, the staging rows, the
dimensions and the fact with plain joins, CASE expressions and
``row_number()`` - a different formulation from the Spark plans, which use
aggregates, written tables and the DataFrame API.
"""

from __future__ import annotations

# The oracle's own statement of the rules; nothing is taken from the engine.
FACT_KEY = ["Order_ID", "Line_Number", "Product_ID", "Supplier_ID"]
FACT_KEY_REQUIRED = FACT_KEY[:3]
ARRIVAL_ORDER = ["Date", "Order_ID", "Line_Number", "Product_ID", "Supplier_ID", "Customer_ID", "Quantity"]


def _age_case(col: str) -> str:
    return f"""CASE WHEN {col} < 0 THEN '0-17' WHEN {col} < 1500 THEN '18-25'
              WHEN {col} < 3000 THEN '26-35' WHEN {col} < 4500 THEN '36-45'
              WHEN {col} < 6000 THEN '46-50' WHEN {col} < 7500 THEN '51-55' ELSE '55+' END"""


def _time_key(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def _first_order(payload: list[str]) -> str:
    cols = list(dict.fromkeys(ARRIVAL_ORDER + payload))
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


# Recent-first load date used by the incremental-load checks.
INCREMENTAL_CUTOFF = "1998-01-01"


def _ctes(staged_filter: str = "TRUE") -> str:
    """CTEs txn, cust, prod, supp, enriched, staged, quarantine."""
    return f"""
txn AS (
  SELECT l.l_orderkey AS Order_ID, CAST(l.l_linenumber AS INTEGER) AS Line_Number,
         o.o_custkey AS Customer_ID, l.l_partkey AS Product_ID, l.l_suppkey AS Supplier_ID,
         CAST(l.l_quantity AS INTEGER) AS Quantity, o.o_orderdate AS Date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
cust AS (
  SELECT c.c_custkey AS Customer_ID,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS Gender,
         {_age_case('c.c_acctbal')} AS Age,
         CAST(c.c_nationkey AS INTEGER) AS Occupation,
         substr(r.r_name, 1, 1) AS City_Category,
         CAST(c.c_custkey % 5 AS INTEGER) AS Stay_In_Current_City_Years,
         CAST(c.c_nationkey % 2 AS INTEGER) AS Marital_Status
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
prod AS (
  SELECT p_partkey AS Product_ID, p_type AS Product_Category,
         CAST(p_retailprice AS DECIMAL(18,6)) AS Raw_Price,
         TRY_CAST(substr(p_brand, 7) AS INTEGER) AS Store_ID, p_brand AS Store_Name
  FROM part
),
supp AS (SELECT s_suppkey AS Supplier_ID, s_name AS Supplier_Name FROM supplier),
enriched AS (
  SELECT t.Order_ID, t.Line_Number, t.Date, t.Quantity,
         CAST(CAST(t.Quantity AS DECIMAL(10,0)) * p.Raw_Price AS DECIMAL(10,2)) AS Revenue,
         t.Customer_ID, c.Gender, c.Age, c.Occupation, c.City_Category,
         c.Stay_In_Current_City_Years, c.Marital_Status,
         t.Product_ID, p.Product_Category, CAST(p.Raw_Price AS DECIMAL(10,2)) AS Price,
         p.Store_ID, p.Store_Name, t.Supplier_ID, s.Supplier_Name,
         CASE
           WHEN c.Customer_ID IS NULL THEN 'unknown Customer_ID'
           WHEN p.Product_ID IS NULL THEN 'unknown Product_ID'
           WHEN t.Order_ID IS NULL THEN 'Order_ID is NULL'
           WHEN t.Date IS NULL THEN 'Date is NULL'
           WHEN t.Customer_ID IS NULL THEN 'Customer_ID is NULL'
           WHEN t.Product_ID IS NULL THEN 'Product_ID is NULL'
           WHEN length(c.Gender) > 1 THEN 'Gender longer than 1'
           WHEN length(c.Age) > 20 THEN 'Age longer than 20'
           WHEN length(c.City_Category) > 1 THEN 'City_Category longer than 1'
           WHEN length(CAST(c.Stay_In_Current_City_Years AS VARCHAR)) > 10
             THEN 'Stay_In_Current_City_Years longer than 10'
           WHEN length(CAST(t.Product_ID AS VARCHAR)) > 255 THEN 'Product_ID longer than 255'
           WHEN length(p.Product_Category) > 255 THEN 'Product_Category longer than 255'
           WHEN length(p.Store_Name) > 255 THEN 'Store_Name longer than 255'
           WHEN length(s.Supplier_Name) > 255 THEN 'Supplier_Name longer than 255'
         END AS Reject_Reason
  FROM txn t
  LEFT JOIN cust c ON t.Customer_ID = c.Customer_ID
  LEFT JOIN prod p ON t.Product_ID = p.Product_ID
  LEFT JOIN supp s ON t.Supplier_ID = s.Supplier_ID
),
staged AS (
  SELECT * EXCLUDE (Reject_Reason) FROM enriched
  WHERE Reject_Reason IS NULL AND ({staged_filter})
),
quarantine AS (SELECT * FROM enriched WHERE Reject_Reason IS NOT NULL)"""


def _first_per_key(name: str, source: str, keys: list[str], payload: list[str],
                   required: list[str] | None = None) -> str:
    part = ", ".join(keys)
    cols = ", ".join(keys + [c for c in payload if c not in keys])
    not_null = " AND ".join(f"{k} IS NOT NULL" for k in (required or keys))
    return f"""
{name} AS (
  SELECT {cols} FROM (
    SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {_first_order(payload)}) AS rn
    FROM {source} WHERE {not_null}
  ) WHERE rn = 1
)"""


CUSTOMER_PAYLOAD = ["Gender", "Age", "Occupation", "City_Category",
                    "Stay_In_Current_City_Years", "Marital_Status"]
PRODUCT_PAYLOAD = ["Product_Category", "Price", "Store_ID", "Supplier_ID"]
STORE_PAYLOAD = ["Store_Name", "City_Category"]
SUPPLIER_PAYLOAD = ["Supplier_Name"]
FACT_PAYLOAD = ["Customer_ID", "Store_ID", "Time_ID", "Quantity", "Revenue", "Year"]


def _star(source: str = "staged", prefix: str = "") -> str:
    """CTEs dim_* and fact built from ``source``."""
    p = prefix
    return ",".join([
        _first_per_key(f"{p}dim_customer", source, ["Customer_ID"], CUSTOMER_PAYLOAD),
        _first_per_key(f"{p}dim_product", source, ["Product_ID"], PRODUCT_PAYLOAD),
        _first_per_key(f"{p}dim_store", source, ["Store_ID"], STORE_PAYLOAD),
        _first_per_key(f"{p}dim_supplier", source, ["Supplier_ID"], SUPPLIER_PAYLOAD),
        f"""
{p}dim_time AS (
  SELECT {_time_key('d')} AS Time_ID, d AS Date,
         CAST(day(d) AS INTEGER) AS Day, CAST(month(d) AS INTEGER) AS Month,
         CAST(quarter(d) AS INTEGER) AS Quarter, CAST(year(d) AS INTEGER) AS Year,
         dayname(d) AS Weekday_Name,
         CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS Is_Weekend
  FROM (SELECT DISTINCT CAST(Date AS DATE) AS d FROM {source} WHERE Date IS NOT NULL)
)""",
        f"""
{p}fact_src AS (
  SELECT *, {_time_key('CAST(Date AS DATE)')} AS Time_ID,
         CAST(year(Date) AS INTEGER) AS Year
  FROM (SELECT * EXCLUDE (Revenue), CAST(Revenue AS DECIMAL(12,2)) AS Revenue FROM {source})
)""",
        _first_per_key(f"{p}fact", f"{p}fact_src", FACT_KEY, FACT_PAYLOAD, FACT_KEY_REQUIRED),
    ])


def with_star(body: str) -> str:
    return f"WITH {_ctes()},{_star()}\n{body}"


MONEY = "CAST(SUM(f.Revenue) AS DOUBLE)"


def _pct(cur: str, prev: str) -> str:
    return (f"CAST(round(CAST((CAST({cur} AS DOUBLE) - CAST({prev} AS DOUBLE)) "
            f"/ NULLIF(CAST({prev} AS DOUBLE), 0) * 100 AS DECIMAL(38,10)), 2) AS DOUBLE)")


DAYTYPE = "CASE WHEN t.Is_Weekend = 1 THEN 'Weekend' ELSE 'Weekday' END"
SEASON = ("CASE WHEN t.Month IN (12, 1, 2) THEN 'Winter' WHEN t.Month IN (3, 4, 5) THEN 'Spring' "
          "WHEN t.Month IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END")
HALF = "CASE WHEN t.Month BETWEEN 1 AND 6 THEN 'H1' ELSE 'H2' END"
FP = "fact f JOIN dim_product p ON f.Product_ID = p.Product_ID"
FPT = FP + " JOIN dim_time t ON f.Time_ID = t.Time_ID"
FC = "fact f JOIN dim_customer c ON f.Customer_ID = c.Customer_ID"
FCT = FC + " JOIN dim_time t ON f.Time_ID = t.Time_ID"
FCP = FC + " JOIN dim_product p ON f.Product_ID = p.Product_ID"
FST = "fact f JOIN dim_store s ON f.Store_ID = s.Store_ID JOIN dim_time t ON f.Time_ID = t.Time_ID"
FSS = ("fact f JOIN dim_store s ON f.Store_ID = s.Store_ID "
       "JOIN dim_supplier sp ON f.Supplier_ID = sp.Supplier_ID")


OLAP = {
    "q01_revenue_daytype_top5": f"""
SELECT p.Product_Category, t.Month, {DAYTYPE} AS DayType, {MONEY} AS Total_Revenue
FROM {FPT} GROUP BY 1, 2, 3
ORDER BY Month, Total_Revenue DESC, Product_Category, DayType LIMIT 5""",
    "q01_top_n_per_month": f"""
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY Month
           ORDER BY Total_Revenue DESC, Product_Category, DayType) AS INTEGER) AS Rank
  FROM (SELECT p.Product_Category, t.Month, {DAYTYPE} AS DayType, {MONEY} AS Total_Revenue
        FROM {FPT} GROUP BY 1, 2, 3)
) WHERE Rank <= 5""",
    "q02_monthly_growth": f"""
SELECT Product_Category, Month, CAST(rev AS DOUBLE) AS Total_Revenue,
       CAST(prev AS DOUBLE) AS Prev_Month_Revenue, {_pct('rev', 'prev')} AS Growth_Percentage
FROM (SELECT *, lag(rev) OVER (PARTITION BY Product_Category ORDER BY Month) AS prev
      FROM (SELECT p.Product_Category, t.Month, SUM(f.Revenue) AS rev FROM {FPT} GROUP BY 1, 2))""",
    "q02_year_month_growth": f"""
SELECT Product_Category, Year, Month, CAST(rev AS DOUBLE) AS Total_Revenue,
       CAST(prev AS DOUBLE) AS Prev_Month_Revenue, {_pct('rev', 'prev')} AS Growth_Percentage
FROM (SELECT *, lag(rev) OVER (PARTITION BY Product_Category ORDER BY Year, Month) AS prev
      FROM (SELECT p.Product_Category, t.Year, t.Month, SUM(f.Revenue) AS rev
            FROM {FPT} GROUP BY 1, 2, 3))""",
    "q03_occupation_category": f"""
SELECT c.Occupation, p.Product_Category, {MONEY} AS Total_Sales
FROM {FCP} GROUP BY 1, 2 ORDER BY Total_Sales DESC""",
    # per order, a pair is bought as often as the product of its line counts
    "q04_product_affinity_top5": """
SELECT a.Product_ID AS Product_A, b.Product_ID AS Product_B,
       CAST(SUM(a.n * b.n) AS BIGINT) AS Times_Bought_Together
FROM (SELECT Order_ID, Product_ID, COUNT(*) AS n FROM fact GROUP BY ALL) a
JOIN (SELECT Order_ID, Product_ID, COUNT(*) AS n FROM fact GROUP BY ALL) b
  ON b.Order_ID = a.Order_ID AND b.Product_ID IS DISTINCT FROM a.Product_ID
GROUP BY ALL ORDER BY 3 DESC, 1, 2 LIMIT 5""",
    "q05_season_category": f"""
SELECT p.Product_Category, {SEASON} AS Season, {MONEY} AS Total_Sales
FROM {FPT} GROUP BY 1, 2 ORDER BY Product_Category, Total_Sales DESC""",
    "q06_demographics_city": f"""
SELECT c.Gender, c.Age, c.City_Category, {MONEY} AS Total_Purchase
FROM {FC} GROUP BY 1, 2, 3 ORDER BY Total_Purchase DESC""",
    "q07_gender_age_quarter": f"""
SELECT c.Gender, c.Age, t.Quarter, {MONEY} AS Total_Revenue
FROM {FCT} GROUP BY 1, 2, 3 ORDER BY Quarter, Total_Revenue DESC""",
    "q08_avg_by_stay_gender": f"""
SELECT c.Gender, c.Stay_In_Current_City_Years,
       CAST(SUM(f.Revenue) AS DOUBLE) / COUNT(f.Revenue) AS Avg_Purchase
FROM {FC} GROUP BY 1, 2 ORDER BY Avg_Purchase DESC""",
    "q09_age_daytype": f"""
SELECT c.Age, {DAYTYPE} AS DayType, {MONEY} AS Total_Sales
FROM {FCT} GROUP BY 1, 2 ORDER BY Total_Sales DESC""",
    "q10_category_occupation_top5": f"""
SELECT p.Product_Category, c.Occupation, {MONEY} AS Revenue
FROM {FCP} GROUP BY 1, 2 ORDER BY Product_Category, Revenue DESC, Occupation LIMIT 5""",
    "q10_top_n_per_category": f"""
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY Product_Category
           ORDER BY Revenue DESC, Occupation) AS INTEGER) AS Rank
  FROM (SELECT p.Product_Category, c.Occupation, {MONEY} AS Revenue FROM {FCP} GROUP BY 1, 2)
) WHERE Rank <= 5""",
    "q11_store_category_top5": f"""
SELECT s.Store_Name, p.Product_Category, {MONEY} AS Total_Revenue
FROM {FP} JOIN dim_store s ON f.Store_ID = s.Store_ID
GROUP BY 1, 2 ORDER BY Total_Revenue DESC, Store_Name, Product_Category LIMIT 5""",
    "q12_store_supplier_category": f"""
SELECT s.Store_Name, sp.Supplier_Name, p.Product_Category, {MONEY} AS Total_Sales
FROM {FSS} JOIN dim_product p ON f.Product_ID = p.Product_ID
GROUP BY 1, 2, 3 ORDER BY Store_Name, Total_Sales DESC""",
    "q13_city_marital_month": f"""
SELECT c.City_Category, c.Marital_Status, t.Month, {MONEY} AS Total_Revenue
FROM {FCT} GROUP BY 1, 2, 3 ORDER BY Month, Total_Revenue DESC""",
    "q14_store_quarter_year": f"""
SELECT s.Store_Name, t.Quarter, {MONEY} AS Total_Revenue
FROM {FST} WHERE t.Year = 1998 GROUP BY 1, 2 ORDER BY Store_Name, Quarter""",
    "q14_store_quarter_growth": f"""
SELECT Store_Name, Year, Quarter, CAST(rev AS DOUBLE) AS Total_Revenue,
       CAST(prev AS DOUBLE) AS Prev_Quarter_Revenue, {_pct('rev', 'prev')} AS Growth_Percentage
FROM (SELECT *, lag(rev) OVER (PARTITION BY Store_Name ORDER BY Year, Quarter) AS prev
      FROM (SELECT s.Store_Name, t.Year, t.Quarter, SUM(f.Revenue) AS rev
            FROM {FST} GROUP BY 1, 2, 3))""",
    "q15_store_supplier_volatility": f"""
SELECT Store_Name, Supplier_Name, Month, CAST(rev AS DOUBLE) AS Monthly_Revenue,
       {_pct('rev', 'prev')} AS Revenue_Volatility
FROM (SELECT *, lag(rev) OVER (PARTITION BY Store_Name, Supplier_Name ORDER BY Month) AS prev
      FROM (SELECT s.Store_Name, sp.Supplier_Name, t.Month, SUM(f.Revenue) AS rev
            FROM {FSS} JOIN dim_time t ON f.Time_ID = t.Time_ID GROUP BY 1, 2, 3))
ORDER BY Revenue_Volatility DESC NULLS LAST""",
    "q16_rollup_year_quarter_category": f"""
SELECT t.Year, t.Quarter, p.Product_Category, {MONEY} AS Total_Revenue,
       CAST(GROUPING(t.Year, t.Quarter, p.Product_Category) AS INTEGER) AS Grouping_ID
FROM {FPT} GROUP BY ROLLUP (t.Year, t.Quarter, p.Product_Category)""",
    "q17_rollup_store_supplier_category_year": f"""
SELECT s.Store_Name, sp.Supplier_Name, p.Product_Category, t.Year, {MONEY} AS Total_Revenue,
       CAST(GROUPING(s.Store_Name, sp.Supplier_Name, p.Product_Category, t.Year) AS INTEGER)
         AS Grouping_ID
FROM {FSS} JOIN dim_product p ON f.Product_ID = p.Product_ID
JOIN dim_time t ON f.Time_ID = t.Time_ID
GROUP BY ROLLUP (s.Store_Name, sp.Supplier_Name, p.Product_Category, t.Year)""",
    "q18_half_year": f"""
SELECT p.Product_Category, {HALF} AS Half_Year, {MONEY} AS Total_Revenue,
       CAST(SUM(f.Quantity) AS BIGINT) AS Total_Quantity
FROM {FPT} GROUP BY 1, 2 ORDER BY Product_Category, Half_Year""",
    "q19_revenue_spikes": f"""
SELECT Product_Category, Date, CAST(day_sales AS DOUBLE) AS Daily_Sales,
       CAST(cat_sum AS DOUBLE) / cat_days AS Avg_Sales
FROM (SELECT *, SUM(day_sales) OVER (PARTITION BY Product_Category) AS cat_sum,
             COUNT(day_sales) OVER (PARTITION BY Product_Category) AS cat_days
      FROM (SELECT p.Product_Category, t.Date, SUM(f.Revenue) AS day_sales
            FROM {FPT} GROUP BY 1, 2))
WHERE day_sales * cat_days > cat_sum * 2
ORDER BY Product_Category, Daily_Sales DESC""",
    "q20_store_quarterly_view": f"""
SELECT s.Store_Name, t.Quarter, {MONEY} AS Total_Sales
FROM {FST} GROUP BY 1, 2 ORDER BY Store_Name, Quarter""",
}


def oracle_queries() -> dict[str, str]:
    out = {name: with_star(body) for name, body in OLAP.items()}
    return out


def _fk_reason() -> str:
    checks = [("Customer_ID", "dim_customer", "rc"), ("Product_ID", "dim_product", "rp"),
              ("Store_ID", "dim_store", "rs"), ("Supplier_ID", "dim_supplier", "rsp"),
              ("Time_ID", "dim_time", "rt")]
    whens = " ".join(
        f"WHEN f.{col} IS NOT NULL AND {a}.{col} IS NULL THEN 'no {dim} row for {col}'"
        for col, dim, a in checks)
    joins = " ".join(f"LEFT JOIN r_{dim} {a} ON f.{col} = {a}.{col}" for col, dim, a in checks)
    return f"CASE {whens} END", joins


def _with_recent(body: str) -> str:
    recent = (f"recent AS (SELECT * FROM staged WHERE Date >= "
              f"TIMESTAMP '{INCREMENTAL_CUTOFF} 00:00:00')")
    return f"WITH {_ctes()},{_star()},\n{recent},{_star('recent', 'r_')}\n{body}"


def _backfill(dim: str, key: str) -> str:
    return _with_recent(f"""
SELECT * FROM r_{dim}
UNION ALL
SELECT * FROM {dim} WHERE {key} NOT IN (SELECT {key} FROM r_{dim})""")


_reason, _joins = _fk_reason()

ETL = {
    "etl_staging": with_star("SELECT * FROM staged"),
    "etl_quarantine": with_star("SELECT * FROM quarantine"),
    "etl_load_report": with_star("""
SELECT 'dim_customer' AS table_name, COUNT(*) AS rows_loaded FROM dim_customer
UNION ALL SELECT 'dim_product', COUNT(*) FROM dim_product
UNION ALL SELECT 'dim_store', COUNT(*) FROM dim_store
UNION ALL SELECT 'dim_supplier', COUNT(*) FROM dim_supplier
UNION ALL SELECT 'dim_time', COUNT(*) FROM dim_time
UNION ALL SELECT 'fact_sales', COUNT(*) FROM fact"""),
    "load_dim_customer": with_star("SELECT * FROM dim_customer"),
    "load_dim_product": with_star("SELECT * FROM dim_product"),
    "load_dim_store": with_star("SELECT * FROM dim_store"),
    "load_dim_supplier": with_star("SELECT * FROM dim_supplier"),
    "load_dim_time": with_star("SELECT * FROM dim_time"),
    "load_fact_sales": with_star("SELECT * FROM fact"),
    "load_backfill_dim_store": _backfill("dim_store", "Store_ID"),
    "load_backfill_dim_product": _backfill("dim_product", "Product_ID"),
    "load_backfill_dim_customer": _backfill("dim_customer", "Customer_ID"),
    "load_fk_check_recent_dims": _with_recent(f"""
SELECT * FROM (SELECT f.*, {_reason} AS Reject_Reason FROM fact f {_joins})
WHERE Reject_Reason IS NOT NULL"""),
    "stream_fact_sales": with_star("SELECT * FROM fact"),
    "stream_dim_store": with_star("SELECT * FROM dim_store"),
    # what is sent twice reaches the load once
    "stream_deduplicated_rows": with_star("""
SELECT DISTINCT Order_ID, Line_Number, Product_ID, Supplier_ID, Customer_ID, Quantity, Date,
       CAST(1 AS BIGINT) AS times_loaded FROM staged"""),
    "stream_progress_totals": with_star("""
SELECT COUNT(*) AS rows_read, CAST(0 AS BIGINT) AS files_left, TRUE AS several_micro_batches FROM txn"""),
    "stream_mixed_headers_fact": with_star("SELECT * FROM fact"),
    "csv_mixed_headers_fact": with_star("SELECT * FROM fact"),
    "stream_hourly_events": """
SELECT date_trunc('hour', ts) AS hour, event_type, COUNT(*) AS events,
       CAST(SUM(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS value
FROM events WHERE ts IS NOT NULL GROUP BY ALL""",
    "view_store_quarterly_after_replay": with_star(OLAP["q20_store_quarterly_view"]),
    "load_killed_before_fact": _with_recent("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS rows_seen FROM r_{'fact' if t == 'fact_sales' else t}"
        for t in ["dim_customer", "dim_product", "dim_store", "dim_supplier", "dim_time", "fact_sales"])),
    "load_redriven_fact": with_star("SELECT * FROM fact"),
    "etl_quarantine_redriven": with_star("SELECT * FROM quarantine"),
    "etl_constraints": with_star("""
, told AS (
  SELECT *, CASE WHEN Order_ID % 11 = 0 THEN 'unknown Customer_ID' WHEN Order_ID % 13 = 0 THEN 'Date is NULL'
    WHEN Product_ID % 17 = 0 THEN 'Product_Category longer than 255' END AS what
  FROM staged),
good AS (SELECT DISTINCT Order_ID, Line_Number, Product_ID, Supplier_ID, Store_ID FROM told WHERE what IS NULL)
SELECT 'rejects' AS batch, 'unparsable Quantity' AS what, COUNT(*) AS n FROM txn WHERE Order_ID % 5 = 0
UNION ALL SELECT 'rejects', 'loads of nothing', 1
UNION ALL SELECT 'sales', what, COUNT(*) FROM told WHERE what IS NOT NULL GROUP BY what
UNION ALL SELECT 'sales', 'stores', COUNT(DISTINCT Store_ID) FROM good WHERE Product_ID % 3 <> 0
UNION ALL SELECT 'sales', CASE WHEN Product_ID % 3 = 0 THEN 'sales without a store' ELSE 'sales of a store' END, COUNT(*)
FROM good GROUP BY 2"""),
    "stream_redelivered_fact": with_star("SELECT * FROM fact"),
    # the history adds what the recent load lacks; both give a key the same row
    "load_backfill_fact_sales": with_star("SELECT * FROM fact"),
    # masters without customers divisible by 7 and products divisible by 11;
    # the second listing of a product must not count
    "load_partial_masters_fact": with_star(
        "SELECT * FROM fact WHERE Customer_ID % 7 <> 0 AND Product_ID % 11 <> 0"),
    "etl_quarantine_partial_masters": with_star("""
SELECT Order_ID, Line_Number, Product_ID, Customer_ID, Quantity,
       CASE WHEN Customer_ID % 7 = 0 THEN 'unknown Customer_ID' ELSE 'unknown Product_ID' END AS Reject_Reason
FROM txn WHERE Customer_ID % 7 = 0 OR Product_ID % 11 = 0"""),
    # Delivered CSV files: product ids are text
    "csv_batch_fact_sales": with_star("""
SELECT Order_ID, Line_Number, Customer_ID, CAST(Product_ID AS VARCHAR) AS Product_ID, Store_ID,
       Supplier_ID, Time_ID, Quantity, Revenue, Year FROM fact"""),
}


def all_oracle_queries() -> dict[str, str]:
    out = oracle_queries()
    out.update(ETL)
    return out
