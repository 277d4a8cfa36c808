"""Calendar rows and their attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_spine(dated: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last date in ``column``; nothing for an empty table.

    The rows are bounded by the calendar, whatever the size of the table.
    """
    ends = dated.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    return ends.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("Date"))


def date_attributes(days: DataFrame) -> DataFrame:
    """The calendar dimension of a table of days; the day itself is the key."""
    day = F.col("Date")
    return days.select(
        day.alias("DateKey"),
        day,
        F.year(day).alias("Year"),
        F.month(day).alias("Month"),
        F.dayofmonth(day).alias("DayOfMonth"),
        F.dayofweek(day).alias("DayOfWeek"),
        F.weekofyear(day).alias("WeekOfYear"),
        F.quarter(day).alias("Quarter"),
        F.format_string("%d-Q%d", F.year(day), F.quarter(day)).alias("QuarterYear"),
        F.dayname(day).alias("DayName"),
        F.monthname(day).alias("MonthName"),
        F.dayofweek(day).isin(1, 7).alias("IsWeekend"),
    )
