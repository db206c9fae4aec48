"""Every registered query against its DuckDB oracle on the smallest data set."""

import os

import pytest

from oracle_check import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_all_registered_queries_match_oracle(spark):
    from martflow.plans import etl_queries, olap
    results = compare(spark, SF, [*olap.QUERIES, *etl_queries.QUERIES], verbose=False)
    bad = {k: v for k, v in results.items() if v is False}
    assert not bad
    import __spark_entry__ as e
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_entry_and_rollup_total(spark):
    import __spark_entry__ as e
    from martflow.plans import olap
    from martflow.plans.warehouse import open_warehouse
    assert e.entry(spark).count() > 0
    wh = open_warehouse(spark, SF)
    grand = [r for r in olap.q16(wh).collect() if r.Grouping_ID == 7]
    plain = wh.fact.agg({"Revenue": "sum"}).first()[0]
    assert len(grand) == 1 and abs(grand[0].Total_Revenue - float(plain)) < 1e-6


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_star_table_contracts(spark):
    from martflow.plans.warehouse import open_warehouse
    wh = open_warehouse(spark, SF)
    fact = dict(wh.fact.dtypes)
    assert fact["Revenue"] == "decimal(12,2)" and fact["Quantity"] == "int"
    assert fact["Time_ID"] == "int" and fact["Year"] == "int"
    assert dict(wh.product.dtypes)["Price"] == "decimal(10,2)"
    assert dict(wh.staged().dtypes)["Revenue"] == "decimal(10,2)"
    t = dict(wh.time.dtypes)
    assert t["Date"] == "date" and t["Weekday_Name"] == "string" and t["Is_Weekend"] == "int"
    c = dict(wh.customer.dtypes)
    assert c["Stay_In_Current_City_Years"] == "int" and c["Occupation"] == "int"
    # keys are unique in every dimension and in the fact
    for name, key in [("dim_customer", ["Customer_ID"]), ("dim_product", ["Product_ID"]),
                      ("dim_store", ["Store_ID"]), ("dim_supplier", ["Supplier_ID"]),
                      ("dim_time", ["Date"]),
                      ("fact_sales", ["Order_ID", "Line_Number", "Product_ID", "Supplier_ID"])]:
        df = wh.table(name)
        assert df.count() == df.select(*key).distinct().count(), name
