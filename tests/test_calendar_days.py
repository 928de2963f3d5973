"""Days of the calendar: labelled once per month, those of gaps made of keys and zeros where measures are many."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tradeloom.functions.columns import date_key, day_name
from tradeloom.plans import cubes


def test_labels_follow_the_days(spark):
    spans = [(1, dt.date(1999, 12, 30), dt.date(2000, 3, 2)), (2, dt.date(2000, 2, 29), dt.date(2000, 2, 29)), (3, dt.date(1900, 2, 27), dt.date(1900, 3, 31))]
    got = cubes._exploded(spark.createDataFrame(spans, "nr int, __from date, __to date"))
    want = {(n, a + dt.timedelta(i)) for n, a, b in spans for i in range((b - a).days + 1)}
    assert sorted((r.nr, r.calendar_day) for r in got.collect()) == sorted(want)
    assert got.filter((F.col("date_key") != date_key(F.col("calendar_day"))) | (F.col("day_name") != day_name(F.col("calendar_day")))).isEmpty()


@pytest.mark.parametrize("name", ["daily_summary", "daily_long", "daily_short"])
def test_days_are_not_labelled_one_by_one(spark, name):
    plan = entry.queries()[name](spark, entry.SMOKE_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in plan and "year(calendar_day" not in plan


@pytest.mark.parametrize("name", ["joined_cube", "joined_summaries"])
def test_days_of_gaps_come_from_stored_rows(spark, name):
    days = entry.queries()[name](spark, entry.SMOKE_DIR)
    assert all("/calendar-rows-" in f for f in days.inputFiles())
