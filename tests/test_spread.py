"""Sums over reference dates against plain enumeration."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import DateRange
from tidemark.operators.features import ALL_HISTORY, block_of, run_marks, spread_runs

MERGES = {"_items": "sum", "_first": "min", "_last": "max", "_s0": "sum"}


def _months_before(day, months):
    number = day.year * 12 + day.month - 1 - months
    year, month = divmod(number, 12)
    for last in (31, 30, 29, 28):
        try:
            return dt.date(year, month + 1, min(day.day, last))
        except ValueError:
            continue


def _runs(spark, rows, dates, windows):
    items = spark.createDataFrame(rows, "entity long, day date, value double")
    runs = [
        F.struct(
            F.lit(m or ALL_HISTORY).alias("months"),
            block_of(F.col("day"), F.lit(m or ALL_HISTORY)).alias("block"),
            dates.first_after(F.col("day")).alias("from"),
            dates.last_within(F.col("day"), m).alias("to"),
        )
        for m in windows
    ]
    each = items.withColumn("_r", F.explode(F.array(*runs))).select("entity", "_r.*", "day", "value").where("`from` <= `to`")
    return each.groupBy("entity", "months", "block", "from", "to").agg(
        F.count("*").alias("_items"), F.min("day").alias("_first"), F.max("day").alias("_last"), F.sum("value").alias("_s0")
    )


def _plain(rows, dates, windows):
    out = {}
    for label in dates.labels():
        date = dt.date.fromisoformat(label)
        for months in windows:
            low = _months_before(date, months) if months else dt.date.min
            for entity, day, value in rows:
                if low <= day < date:
                    n, first, last, s = out.get((entity, months or 0, date), (0, day, day, 0.0))
                    out[entity, months or 0, date] = n + 1, min(first, day), max(last, day), s + (value or 0.0)
    return out


@pytest.mark.parametrize("period", ["daily", "monthly", "yearly"])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_enumeration(spark, period, seed):
    rng = random.Random(seed)
    dates = DateRange("2019-11-17", {"daily": "2020-04-02", "monthly": "2022-04-02", "yearly": "2027-01-01"}[period], period)
    days = [dt.date(2018, 1, 1) + dt.timedelta(days=rng.randrange(365 * (3 if period == "daily" else 9))) for _ in range(250)]
    days += [dt.date(2020, 2, 29), dt.date(2020, 1, 31), dt.date(2019, 2, 28), dt.date(2020, 1, 1), dt.date(2019, 12, 31)]
    rows = [(rng.choice([1, 2, None]), day, rng.choice([None, 0.1, 2.7])) for day in days]
    windows = [None, 1, 5, 12, 60]
    got = {}
    for r in spread_runs(_runs(spark, rows, dates, windows), "entity", MERGES, dates).collect():
        assert (r.entity, r.months, r._date) not in got
        got[r.entity, r.months, r._date] = (r._items, r._first, r._last, r._s0)
    want = _plain(rows, dates, windows)
    assert got.keys() == want.keys()
    for key, (n, first, last, s) in want.items():
        assert got[key][:3] == (n, first, last) and abs((got[key][3] or 0) - s) < 1e-9


def test_rows_made_are_linear_in_the_dates(spark):
    """Ten years of daily dates, an item a day: the old way spread a million rows for one entity and window."""
    dates = DateRange("2010-01-01", "2019-12-29")
    count = len(dates.labels())
    assert count == 3650
    rows = [(1, dt.date(2009, 1, 1) + dt.timedelta(days=i), 0.1) for i in range(count + 365)]
    runs = _runs(spark, rows, dates, [12]).cache()
    marks = run_marks(runs, dates).count()
    assert marks <= 3 * runs.count() <= 3 * (count + 366)
    spread = spread_runs(runs, "entity", MERGES, dates)
    got = spread.select("_date", "_items", "_s0").orderBy("_date").collect()
    assert len(got) == count and {r._items for r in got} <= {365, 366}
    # Fractions do not drift: no sum is the difference of two larger ones.
    assert max(abs(r._s0 - r._items / 10) for r in got) < 1e-11
    runs.unpersist()


def test_empty(spark):
    dates = DateRange("2020-01-01", "2020-02-01")
    none = _runs(spark, [(1, dt.date(2021, 1, 1), 1.0)], dates, [None, 12])
    assert spread_runs(none, "entity", MERGES, dates).collect() == []
