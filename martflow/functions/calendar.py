"""Calendar attributes of the time dimension and the labels the queries
group by (P10-P16, K1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Season of each month number and half-year boundary.
WINTER_MONTHS = (12, 1, 2)
SPRING_MONTHS = (3, 4, 5)
SUMMER_MONTHS = (6, 7, 8)
FIRST_HALF_MONTHS = (1, 6)  # inclusive range -> 'H1', otherwise 'H2'
# dayofweek(): 1 = Sunday ... 7 = Saturday
WEEKEND_DAYS = (1, 7)


def time_key(date: Column) -> Column:
    """Deterministic surrogate key of a calendar day: yyyymmdd as INT."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def weekday_name(date: Column) -> Column:
    """Full English weekday name ('Saturday')."""
    return F.date_format(date, "EEEE")


def is_weekend(date: Column) -> Column:
    return F.when(F.dayofweek(date).isin(*WEEKEND_DAYS), F.lit(1)).otherwise(F.lit(0))


def calendar_columns(date: Column) -> list[Column]:
    """Day, Month, Quarter, Year, Weekday_Name, Is_Weekend of a DATE column."""
    return [
        F.dayofmonth(date).alias("Day"),
        F.month(date).alias("Month"),
        F.quarter(date).alias("Quarter"),
        F.year(date).alias("Year"),
        weekday_name(date).alias("Weekday_Name"),
        is_weekend(date).alias("Is_Weekend"),
    ]


def day_type(weekend_flag: Column) -> Column:
    return F.when(weekend_flag == 1, F.lit("Weekend")).otherwise(F.lit("Weekday"))


def season(month: Column) -> Column:
    return (
        F.when(month.isin(*WINTER_MONTHS), F.lit("Winter"))
        .when(month.isin(*SPRING_MONTHS), F.lit("Spring"))
        .when(month.isin(*SUMMER_MONTHS), F.lit("Summer"))
        .otherwise(F.lit("Fall"))
    )


def half_year(month: Column) -> Column:
    lo, hi = FIRST_HALF_MONTHS
    return F.when(month.between(lo, hi), F.lit("H1")).otherwise(F.lit("H2"))
