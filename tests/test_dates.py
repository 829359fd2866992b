import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import DateRange, date_spine, month_ends
from tidemark.operators.asof import spine


@pytest.mark.parametrize("period, count, first", [("daily", 63, "2021-12-01"), ("monthly", 3, "2021-12-01"), ("yearly", 1, "2022-01-01")])
def test_spine_sizes(spark, period, count, first):
    dates = DateRange("2021-12-01", "2022-02-01", period)
    days = [r.dtRef for r in date_spine(spark, dates).orderBy("dtRef").collect()]
    assert len(days) == count and days[0].isoformat() == first
    assert dates.labels() == [d.isoformat() for d in days]


def test_monthly_range_with_odd_ends(spark):
    dates = DateRange("2021-11-15", "2022-03-20", "monthly")
    assert dates.labels() == ["2021-12-01", "2022-01-01", "2022-02-01", "2022-03-01"]


def test_bad_ranges():
    with pytest.raises(ValueError):
        DateRange("2021-12-01", "2022-02-01", "hourly")
    with pytest.raises(ValueError):
        DateRange("2021-12-02", "2021-12-20", "monthly")


def test_month_ends_and_spine(spark):
    ids = spark.createDataFrame([(1,), (2,)], "id long")
    got = spine(ids, month_ends("2021-12-01", "2022-12-01"))
    times = sorted({r.event_timestamp for r in got.collect()})
    assert got.count() == 24
    assert (times[0], times[-1]) == (dt.datetime(2021, 12, 31), dt.datetime(2022, 11, 30))


@pytest.mark.parametrize("period", ["daily", "monthly", "yearly"])
@pytest.mark.parametrize("months", [None, 1, 12, 60])
def test_run_of_dates_matches_definition(spark, period, months):
    """first_after/last_within against the plain conditions, day by day, over leap years."""
    dates = DateRange("2019-12-31", "2025-03-02", period)
    days = spark.sql("SELECT explode(sequence(date '2014-11-28', date '2025-03-05', interval 1 day)) AS day")
    if months == 60:
        days = days.where("day < '2016-04-01' OR day > '2024-01-15'")
    run = days.withColumn("f", dates.first_after(F.col("day"))).withColumn("t", dates.last_within(F.col("day"), months))
    got = run.where("f <= t").withColumn("d", F.explode(dates.between(F.col("f"), F.col("t")))).select("day", "d")
    want = days.join(date_spine(spark, dates, "d"), F.col("d") > F.col("day"))
    if months is not None:
        want = want.where(F.add_months("d", -months) <= F.col("day"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
