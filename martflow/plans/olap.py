"""The twenty analytical queries over the star schema (Q1-Q20) and the
variants their titles ask for.

Every query is a star aggregate (``plans/star.py``): the fact is joined to
the dimensions it needs on their keys - broadcast when the dimension's exact
size is under the bound, otherwise after pre-aggregating the fact on that
dimension's key - aggregated with a partial + final aggregate, and, where
the question asks for it, windowed, rolled up or limited.  Rollups run on
the pre-aggregated rows, so the rollup's row expansion never touches the
fact.
Sums are exact DECIMAL aggregates, reported as DOUBLE.  Every LIMIT has a
unique tie-breaker so the answer is deterministic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.functions.calendar import day_type, half_year, season
from martflow.functions.measures import pct_change
from martflow.operators.affinity import top_pairs
from martflow.plans.star import Derived, star_aggregate
from martflow.plans.views import store_quarterly_view
from martflow.plans.warehouse import Warehouse
from martflow.session import dealt

DAY_TYPE = {"DayType": Derived(["Is_Weekend"], lambda: day_type(F.col("Is_Weekend")))}
SEASON = {"Season": Derived(["Month"], lambda: season(F.col("Month")))}
HALF_YEAR = {"Half_Year": Derived(["Month"], lambda: half_year(F.col("Month")))}


def _money(c: Column) -> Column:
    return c.cast("double")


def revenue_by(wh: Warehouse, dims: list[str], group_by: list[str], name: str = "_rev",
               **kwargs) -> DataFrame:
    """Exact DECIMAL revenue per group over the star join."""
    return star_aggregate(wh, dims, group_by, sums={name: "Revenue"}, **kwargs)


def total_by(wh: Warehouse, dims: list[str], group_by: list[str], name: str,
             **kwargs) -> DataFrame:
    """Revenue per group, reported as DOUBLE under ``name``."""
    agg = revenue_by(wh, dims, group_by, "_rev", **kwargs)
    return agg.select(*group_by, _money(F.col("_rev")).alias(name))


# ----------------------------------------------------------------- section 1
def q1(wh: Warehouse) -> DataFrame:
    """Revenue by category x month x day type; the first five by month,
    then revenue (highest first)."""
    agg = total_by(wh, ["product", "time"], ["Product_Category", "Month", "DayType"],
                   "Total_Revenue", derived=DAY_TYPE)
    return agg.orderBy(F.col("Month").asc(), F.col("Total_Revenue").desc(),
                       "Product_Category", "DayType").limit(5)


def q1_top_n_per_month(wh: Warehouse, n: int = 5) -> DataFrame:
    """Top ``n`` category x day-type cells inside every month."""
    agg = total_by(wh, ["product", "time"], ["Product_Category", "Month", "DayType"],
                   "Total_Revenue", derived=DAY_TYPE)
    w = Window.partitionBy("Month").orderBy(F.col("Total_Revenue").desc(),
                                            "Product_Category", "DayType")
    return agg.withColumn("Rank", F.row_number().over(w)).filter(F.col("Rank") <= n)


def q2(wh: Warehouse) -> DataFrame:
    """Monthly revenue per category with the previous month and growth %."""
    agg = revenue_by(wh, ["product", "time"], ["Product_Category", "Month"])
    w = Window.partitionBy("Product_Category").orderBy("Month")
    prev = F.lag("_rev").over(w)
    return agg.select(
        "Product_Category", "Month",
        _money(F.col("_rev")).alias("Total_Revenue"),
        _money(prev).alias("Prev_Month_Revenue"),
        pct_change(F.col("_rev"), prev).alias("Growth_Percentage"),
    ).orderBy("Product_Category", "Month")


def q2_year_month(wh: Warehouse) -> DataFrame:
    """Q2 with calendar months (year + month) instead of month numbers."""
    agg = revenue_by(wh, ["product", "time"], ["Product_Category", "Year", "Month"])
    w = Window.partitionBy("Product_Category").orderBy("Year", "Month")
    prev = F.lag("_rev").over(w)
    return agg.select(
        "Product_Category", "Year", "Month",
        _money(F.col("_rev")).alias("Total_Revenue"),
        _money(prev).alias("Prev_Month_Revenue"),
        pct_change(F.col("_rev"), prev).alias("Growth_Percentage"),
    ).orderBy("Product_Category", "Year", "Month")


def q3(wh: Warehouse) -> DataFrame:
    """Revenue by occupation x product category."""
    return (total_by(wh, ["customer", "product"], ["Occupation", "Product_Category"],
                     "Total_Sales").orderBy(F.col("Total_Sales").desc(), "Occupation", "Product_Category"))


def q4(wh: Warehouse, n: int = 5) -> DataFrame:
    """The ``n`` product pairs most often bought in the same order."""
    return top_pairs(wh.fact.select("Order_ID", "Product_ID"), n, rows=wh.row_count("fact_sales"))


def q5(wh: Warehouse) -> DataFrame:
    """Revenue by category x season."""
    return (total_by(wh, ["product", "time"], ["Product_Category", "Season"], "Total_Sales",
                     derived=SEASON)
            .orderBy("Product_Category", F.col("Total_Sales").desc(), "Season"))


# ----------------------------------------------------------------- section 2
def q6(wh: Warehouse) -> DataFrame:
    """Revenue by gender x age x city category."""
    return (total_by(wh, ["customer"], ["Gender", "Age", "City_Category"], "Total_Purchase")
            .orderBy(F.col("Total_Purchase").desc(), "Gender", "Age", "City_Category"))


def q7(wh: Warehouse) -> DataFrame:
    """Revenue by gender x age x quarter."""
    return (total_by(wh, ["customer", "time"], ["Gender", "Age", "Quarter"], "Total_Revenue")
            .orderBy("Quarter", F.col("Total_Revenue").desc(), "Gender", "Age"))


def q8(wh: Warehouse) -> DataFrame:
    """Average fact revenue by gender x years in the city."""
    keys = ["Gender", "Stay_In_Current_City_Years"]
    agg = star_aggregate(wh, ["customer"], keys, sums={"_s": "Revenue"},
                         counts={"_n": "Revenue"})
    out = agg.select(*keys, (F.col("_s").cast("double") / F.col("_n")).alias("Avg_Purchase"))
    return out.orderBy(F.col("Avg_Purchase").desc(), *keys)


def q9(wh: Warehouse) -> DataFrame:
    """Revenue by age band x day type."""
    return (total_by(wh, ["customer", "time"], ["Age", "DayType"], "Total_Sales",
                     derived=DAY_TYPE)
            .orderBy(F.col("Total_Sales").desc(), "Age", "DayType"))


def _category_occupation(wh: Warehouse) -> DataFrame:
    return total_by(wh, ["customer", "product"], ["Product_Category", "Occupation"], "Revenue")


def q10(wh: Warehouse, n: int = 5) -> DataFrame:
    """Revenue by category x occupation; the first five rows by category,
    then revenue."""
    return _category_occupation(wh).orderBy(
        "Product_Category", F.col("Revenue").desc(), "Occupation").limit(n)


def q10_top_n_per_category(wh: Warehouse, n: int = 5) -> DataFrame:
    """Top ``n`` occupations inside every product category."""
    w = Window.partitionBy("Product_Category").orderBy(F.col("Revenue").desc(), "Occupation")
    return (_category_occupation(wh).withColumn("Rank", F.row_number().over(w))
            .filter(F.col("Rank") <= n))


# ----------------------------------------------------------------- section 3
def q11(wh: Warehouse, n: int = 5) -> DataFrame:
    """Top five store x category cells by revenue."""
    agg = total_by(wh, ["product", "store"], ["Store_Name", "Product_Category"],
                   "Total_Revenue")
    return agg.orderBy(F.col("Total_Revenue").desc(), "Store_Name", "Product_Category").limit(n)


def q12(wh: Warehouse) -> DataFrame:
    """Revenue by store x supplier x category."""
    return (total_by(wh, ["store", "supplier", "product"],
                     ["Store_Name", "Supplier_Name", "Product_Category"], "Total_Sales")
            .orderBy("Store_Name", F.col("Total_Sales").desc(), "Supplier_Name", "Product_Category"))


def q13(wh: Warehouse) -> DataFrame:
    """Revenue by city category x marital status x month."""
    return (total_by(wh, ["customer", "time"], ["City_Category", "Marital_Status", "Month"],
                     "Total_Revenue")
            .orderBy("Month", F.col("Total_Revenue").desc(), "City_Category", "Marital_Status"))


def q14(wh: Warehouse, year: int = 1998) -> DataFrame:
    """Quarterly store revenue in one year.

    The fact is partitioned by year, and a fact row's year is the year of
    its date, so the filter is also applied to the fact: the scan then
    reads one year's partition instead of all of them."""
    fact = wh.fact.filter(F.col("Year") == year)
    return (total_by(wh, ["store", "time"], ["Store_Name", "Quarter"], "Total_Revenue",
                     fact=fact, dim_filters={"time": F.col("Year") == year})
            .orderBy("Store_Name", "Quarter"))


def q14_growth(wh: Warehouse) -> DataFrame:
    """Quarter-over-quarter revenue growth per store (what Q14's title asks)."""
    agg = revenue_by(wh, ["store", "time"], ["Store_Name", "Year", "Quarter"])
    w = Window.partitionBy("Store_Name").orderBy("Year", "Quarter")
    prev = F.lag("_rev").over(w)
    return agg.select("Store_Name", "Year", "Quarter",
                      _money(F.col("_rev")).alias("Total_Revenue"),
                      _money(prev).alias("Prev_Quarter_Revenue"),
                      pct_change(F.col("_rev"), prev).alias("Growth_Percentage"))


def q15(wh: Warehouse) -> DataFrame:
    """Monthly revenue and month-to-month change per store x supplier."""
    agg = revenue_by(wh, ["store", "supplier", "time"], ["Store_Name", "Supplier_Name", "Month"])
    w = Window.partitionBy("Store_Name", "Supplier_Name").orderBy("Month")
    out = agg.select("Store_Name", "Supplier_Name", "Month",
                     _money(F.col("_rev")).alias("Monthly_Revenue"),
                     pct_change(F.col("_rev"), F.lag("_rev").over(w)).alias("Revenue_Volatility"))
    return out.orderBy(F.col("Revenue_Volatility").desc_nulls_last(), "Store_Name", "Supplier_Name", "Month")


# ----------------------------------------------------------------- section 4
def q16(wh: Warehouse) -> DataFrame:
    """ROLLUP (year, quarter, category); Grouping_ID tells a subtotal row
    from a row whose key is NULL."""
    keys = ["Year", "Quarter", "Product_Category"]
    base = revenue_by(wh, ["product", "time"], keys)
    return base.rollup(*keys).agg(_money(F.sum("_rev")).alias("Total_Revenue"),
                                  F.grouping_id().cast("int").alias("Grouping_ID"))


def q17(wh: Warehouse) -> DataFrame:
    """ROLLUP (store, supplier, category, year).

    The cells are nearly as many as the sales, and so are those of all years: the
    first two levels are taken one from the other, dealt out so many rows to a
    task, and only the rows of the second are expanded for the levels above."""
    keys = ["Store_Name", "Supplier_Name", "Product_Category", "Year"]
    base = revenue_by(wh, ["store", "supplier", "product", "time"], keys)
    years = dealt(base, wh.row_count("fact_sales") or 0, *keys[:3]).groupBy(*keys[:3]).agg(F.sum("_rev").alias("_rev"))
    above = years.rollup(*keys[:2]).agg(F.sum("_rev").alias("_rev"), F.grouping_id().cast("int").alias("_id"))
    none = [F.lit(None).cast(base.schema[k].dataType).alias(k) for k in keys]
    levels = [base.select(*keys, "_rev", F.lit(0).alias("Grouping_ID")),
              years.select(*keys[:3], none[3], "_rev", F.lit(1).alias("Grouping_ID")),
              above.select(*keys[:2], *none[2:], "_rev", (F.col("_id") * 4 + 3).alias("Grouping_ID"))]
    return reduce(DataFrame.unionByName, levels).select(*keys, _money(F.col("_rev")).alias("Total_Revenue"),
                                                        "Grouping_ID")


def q18(wh: Warehouse) -> DataFrame:
    """Revenue and units by category x half-year."""
    keys = ["Product_Category", "Half_Year"]
    agg = star_aggregate(wh, ["product", "time"], keys,
                         sums={"_rev": "Revenue", "_qty": "Quantity"}, derived=HALF_YEAR)
    return (agg.select(*keys, _money(F.col("_rev")).alias("Total_Revenue"),
                       F.col("_qty").cast("bigint").alias("Total_Quantity"))
            .orderBy("Product_Category", "Half_Year"))


def q19(wh: Warehouse) -> DataFrame:
    """Days whose category revenue exceeds twice the category's daily mean.

    ``x > 2 * avg`` is evaluated exactly as ``x * days > 2 * sum`` on the
    DECIMAL sums; the mean is reported as DOUBLE."""
    daily = revenue_by(wh, ["product", "time"], ["Product_Category", "Date"], "_day")
    w = Window.partitionBy("Product_Category")
    df = daily.withColumn("_sum", F.sum("_day").over(w)).withColumn("_n", F.count("_day").over(w))
    spikes = df.filter(F.col("_day") * F.col("_n") > F.col("_sum") * 2)
    return spikes.select(
        "Product_Category", "Date",
        _money(F.col("_day")).alias("Daily_Sales"),
        (F.col("_sum").cast("double") / F.col("_n")).alias("Avg_Sales"),
    ).orderBy("Product_Category", F.col("Daily_Sales").desc(), "Date")


def store_quarterly_sales(wh: Warehouse) -> DataFrame:
    """What the STORE_QUARTERLY_SALES view shows, computed from the fact."""
    return total_by(wh, ["store", "time"], ["Store_Name", "Quarter"], "Total_Sales")


def q20(wh: Warehouse) -> DataFrame:
    """Create or replace the STORE_QUARTERLY_SALES view and read it back: the
    kept summary, not the fact."""
    return store_quarterly_view(wh).orderBy("Store_Name", "Quarter")


QUERIES = {
    "q01_revenue_daytype_top5": q1,
    "q01_top_n_per_month": q1_top_n_per_month,
    "q02_monthly_growth": q2,
    "q02_year_month_growth": q2_year_month,
    "q03_occupation_category": q3,
    "q04_product_affinity_top5": q4,
    "q05_season_category": q5,
    "q06_demographics_city": q6,
    "q07_gender_age_quarter": q7,
    "q08_avg_by_stay_gender": q8,
    "q09_age_daytype": q9,
    "q10_category_occupation_top5": q10,
    "q10_top_n_per_category": q10_top_n_per_category,
    "q11_store_category_top5": q11,
    "q12_store_supplier_category": q12,
    "q13_city_marital_month": q13,
    "q14_store_quarter_year": q14,
    "q14_store_quarter_growth": q14_growth,
    "q15_store_supplier_volatility": q15,
    "q16_rollup_year_quarter_category": q16,
    "q17_rollup_store_supplier_category_year": q17,
    "q18_half_year": q18,
    "q19_revenue_spikes": q19,
    "q20_store_quarterly_view": q20,
}
