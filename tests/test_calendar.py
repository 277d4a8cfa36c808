from __future__ import annotations

import datetime as dt

from martloom.functions.calendar import date_attributes, date_spine

DAY = dt.date


def spine(spark, *days):
    return date_spine(spark.createDataFrame([(d,) for d in days], "sold date"), "sold")


def test_every_day_between_first_and_last(spark):
    days = [r.Date for r in spine(spark, DAY(2024, 2, 27), None, DAY(2024, 3, 2), DAY(2024, 2, 28)).collect()]
    assert sorted(days) == [DAY(2024, 2, 27) + dt.timedelta(n) for n in range(5)]


def test_more_than_a_hundred_days_one_day_and_none(spark):
    assert spine(spark, DAY(1995, 1, 2), DAY(2001, 11, 4)).count() == 2499
    assert spine(spark, DAY(2024, 1, 1)).count() == 1
    assert spine(spark).count() == 0
    assert spine(spark, None).count() == 0


def test_attributes(spark):
    days = date_attributes(spine(spark, DAY(2023, 12, 31), DAY(2024, 1, 1)))
    sunday, monday = sorted(map(tuple, days.collect()))
    assert sunday == (
        DAY(2023, 12, 31), DAY(2023, 12, 31), 2023, 12, 31, 1, 52, 4, "2023-Q4", "Sun", "Dec", True,
    )
    assert monday == (
        DAY(2024, 1, 1), DAY(2024, 1, 1), 2024, 1, 1, 2, 1, 1, "2024-Q1", "Mon", "Jan", False,
    )


def test_saturday_is_weekend(spark):
    row = date_attributes(spine(spark, DAY(2024, 1, 6))).first()
    assert (row.DayOfWeek, row.DayName, row.IsWeekend) == (7, "Sat", True)
