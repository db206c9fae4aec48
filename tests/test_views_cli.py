"""SQL over the star-schema views and the command line."""

import os
from collections import Counter

import pytest

from conftest import CUSTOMER_HEADER, PRODUCT_HEADER, TXN_HEADER, write_csv
from martflow.__main__ import main
from martflow.plans.views import register_views
from martflow.plans.warehouse import Warehouse, open_warehouse

SF = "/root/testdata/sf0.001"

# Questions of our own over the views, answered independently from the tables.
WEEKDAY_UNITS = """
SELECT s.Supplier_Name AS maker, d.Weekday_Name AS day, sum(f.Quantity) AS units
FROM FactSales f JOIN DimTime d USING (Time_ID) JOIN DimSupplier s ON s.Supplier_ID = f.Supplier_ID
GROUP BY ALL
"""

STORE_HALVES = """
SELECT f.Store_ID AS store, CASE WHEN d.Month < 7 THEN 1 ELSE 2 END AS half, count(*) AS lines
FROM FactSales f, DimTime d WHERE d.Time_ID = f.Time_ID
GROUP BY f.Store_ID, half WITH ROLLUP
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_sql_over_views_matches_dataframe_queries(spark):
    wh = open_warehouse(spark, SF)
    views = register_views(wh)
    assert {"FactSales", "DimCustomer", "DimProduct", "DimStore", "DimSupplier",
            "DimTime", "StagingSales"} <= set(views)
    fact, time = wh.fact.toPandas(), wh.time.toPandas()
    maker = dict(map(tuple, wh.supplier.select("Supplier_ID", "Supplier_Name").collect()))
    day, month = dict(zip(time.Time_ID, time.Weekday_Name)), dict(zip(time.Time_ID, time.Month))
    units, halves = Counter(), Counter()
    for r in fact.itertuples():
        units[maker[r.Supplier_ID], day[r.Time_ID]] += r.Quantity
        half = 1 if month[r.Time_ID] < 7 else 2
        for cell in ((r.Store_ID, half), (r.Store_ID, None), (None, None)):
            halves[cell] += 1
    assert {(r.maker, r.day): r.units for r in spark.sql(WEEKDAY_UNITS).collect()} == units
    assert {(r.store, r.half): r.lines for r in spark.sql(STORE_HALVES).collect()} == halves


def test_cli_load_query_sql(spark, scratch, capsys):
    c = write_csv(f"{scratch}/c.csv", CUSTOMER_HEADER, ["0,1,F,0-17,10,A,2,0"])
    p = write_csv(f"{scratch}/p.csv", PRODUCT_HEADER, ["0,P1,Toys,2.50,1,7,Shop,Maker"])
    drop = f"{scratch}/drop"
    write_csv(f"{drop}/t1.csv", TXN_HEADER, ["0,10,1,P1,2,2021-01-02"])
    whp = f"{scratch}/wh"
    assert main(["load", "--customers", c, "--products", p, "--transactions", drop,
                 "--warehouse", whp, "--stream"], spark=spark) == 0
    assert Warehouse(spark, whp).fact.count() == 1
    assert main(["query", "q05_season_category", "--warehouse", whp], spark=spark) == 0
    assert main(["sql", "SELECT COUNT(*) AS n FROM FactSales", "--warehouse", whp],
                spark=spark) == 0
    out = capsys.readouterr().out
    assert "Winter" in out and "micro_batches" in out
