"""Reference dates: ranges, spines and the dates at which a release counts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_STEP = {"daily": "interval 1 day", "monthly": "interval 1 month", "yearly": "interval 1 year"}
_TRUNC = {"monthly": "month", "yearly": "year"}


@dataclass(frozen=True)
class DateRange:
    """Dates from ``start`` to ``stop``, both included.

    ``monthly`` keeps the first of each month, ``yearly`` each 1 January.
    """

    start: str
    stop: str
    period: str = "daily"

    def __post_init__(self) -> None:
        if self.period not in _STEP:
            raise ValueError(f"period must be one of {sorted(_STEP)}, not {self.period!r}")
        if self.first > self.last:
            raise ValueError(f"no {self.period} date between {self.start} and {self.stop}")

    @property
    def first(self) -> dt.date:
        day = dt.date.fromisoformat(self.start)
        if self.period == "monthly" and day.day > 1:
            return dt.date(day.year + day.month // 12, day.month % 12 + 1, 1)
        if self.period == "yearly" and (day.month, day.day) != (1, 1):
            return dt.date(day.year + 1, 1, 1)
        return day

    @property
    def last(self) -> dt.date:
        day = dt.date.fromisoformat(self.stop)
        if self.period == "monthly":
            return day.replace(day=1)
        if self.period == "yearly":
            return day.replace(month=1, day=1)
        return day

    def labels(self) -> list[str]:
        """The dates as ISO text, for naming partitions."""
        out, day = [], self.first
        while day <= self.last:
            out.append(day.isoformat())
            if self.period == "daily":
                day += dt.timedelta(days=1)
            elif self.period == "monthly":
                day = dt.date(day.year + day.month // 12, day.month % 12 + 1, 1)
            else:
                day = dt.date(day.year + 1, 1, 1)
        return out

    def between(self, low: Column, high: Column) -> Column:
        """Array of this range's dates from ``low`` to ``high``; both must be on the grid."""
        return F.sequence(low, high, F.expr(_STEP[self.period]))

    def array(self) -> Column:
        return self.between(F.lit(self.first), F.lit(self.last))

    def first_after(self, day: Column) -> Column:
        """First date of the range strictly after ``day``."""
        if self.period == "daily":
            following = F.date_add(day, 1)
        elif self.period == "monthly":
            following = F.date_add(F.last_day(day), 1)
        else:
            following = F.trunc(F.add_months(day, 12), "year").cast("date")
        return F.greatest(following, F.lit(self.first))

    def last_within(self, day: Column, months: int | None) -> Column:
        """Last date ``d`` of the range with ``add_months(d, -months) <= day``.

        ``add_months`` clips to the month end, so several dates can share one
        lower bound: for a ``day`` that ends its month all of them still count.
        """
        if months is None:
            return F.lit(self.last)
        moved = F.add_months(day, months)
        reach = F.when(day == F.last_day(day), F.last_day(moved)).otherwise(moved)
        if self.period != "daily":
            reach = F.trunc(reach, _TRUNC[self.period]).cast("date")
        return F.least(reach, F.lit(self.last))


def date_spine(spark: SparkSession, dates: DateRange, name: str = "dtRef") -> DataFrame:
    """One row per date of the range."""
    return spark.range(1).select(F.explode(dates.array()).alias(name))


def month_ends(start: str, stop: str) -> Column:
    """Array of the month-end dates from ``start`` to ``stop``, both included."""
    low, high = F.lit(dt.date.fromisoformat(start)), F.lit(dt.date.fromisoformat(stop))
    firsts = F.sequence(F.trunc(low, "month").cast("date"), high, F.expr("interval 1 month"))
    return F.filter(F.transform(firsts, F.last_day), lambda day: (day >= low) & (day <= high))
