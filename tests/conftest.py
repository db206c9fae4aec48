from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from martflow.session import build_session
    s = build_session(master="local[8]", shuffle_partitions=8, app_name="martflow-tests")
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def views_dropped(request):
    """Temporary views of a test do not outlast it in the common session."""
    spark = request.getfixturevalue("spark") if "spark" in request.fixturenames else None
    yield
    if spark is not None:
        for view in spark.sql("SHOW VIEWS").where("isTemporary").collect():
            spark.catalog.dropTempView(view.viewName)


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="martflow-test-")


def write_csv(path: str, header: str, rows: list[str]) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(header + "\n")
        for r in rows:
            fh.write(r + "\n")
    return path


CUSTOMER_HEADER = ",Customer_ID,Gender,Age,Occupation,City_Category,Stay_In_Current_City_Years,Marital_Status"
PRODUCT_HEADER = ",Product_ID,Product_Category,price$,storeID,supplierID,storeName,supplierName"
TXN_HEADER = ",orderID,Customer_ID,Product_ID,quantity,date"
