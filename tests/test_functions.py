import datetime as dt

from pyspark.sql import functions as F

from martflow.functions import calendar as C
from martflow.functions.measures import pct_change, revenue


def test_calendar_attributes(spark):
    df = spark.createDataFrame(
        [(dt.date(2020, 12, 26),), (dt.date(2020, 12, 27),), (dt.date(2020, 12, 28),)], "d date")
    rows = df.select("d", C.time_key(F.col("d")).alias("k"), *C.calendar_columns(F.col("d"))) \
        .orderBy("d").collect()
    assert [r.Weekday_Name for r in rows] == ["Saturday", "Sunday", "Monday"]
    assert [r.Is_Weekend for r in rows] == [1, 1, 0]
    assert [r.k for r in rows] == [20201226, 20201227, 20201228]
    assert rows[0].Quarter == 4 and rows[0].Month == 12 and rows[0].Day == 26


def test_labels(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    out = {r.m: (r.s, r.h) for r in df.select(
        "m", C.season(F.col("m")).alias("s"), C.half_year(F.col("m")).alias("h")).collect()}
    assert out[12] == ("Winter", "H2") and out[1] == ("Winter", "H1")
    assert out[3][0] == "Spring" and out[6] == ("Summer", "H1") and out[7] == ("Summer", "H2")
    assert out[9][0] == "Fall" and out[11][0] == "Fall"
    flag = spark.createDataFrame([(1,), (0,)], "w int").select(C.day_type(F.col("w")).alias("t"))
    assert [r.t for r in flag.collect()] == ["Weekend", "Weekday"]


def test_revenue_rounds_half_up_from_unrounded_price(spark):
    df = spark.sql("SELECT CAST(3 AS INT) q, CAST('25.835' AS DECIMAL(18,6)) p")
    r = df.select(revenue(F.col("q"), F.col("p"), 10).alias("rev"),
                  F.col("p").cast("decimal(10,2)").alias("price")).first()
    assert str(r.rev) == "77.51"
    assert str(r.price) == "25.84"


def test_pct_change_null_and_zero(spark):
    df = spark.sql("SELECT * FROM VALUES (110.0, 100.0), (5.0, 0.0), (5.0, NULL), "
                   "(1.0, 3.0) AS t(c, p)")
    out = [r.g for r in df.select(pct_change(F.col("c"), F.col("p")).alias("g")).collect()]
    assert out == [10.0, None, None, -66.67]
