"""Date bounds of a run, worked out once from the run date.

The bounds are plain ``datetime.date`` values, so every filter built on them carries a literal that
prunes partitions and reaches the Parquet scan. Nothing here reads the wall clock.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFER_LIFETIME_DAYS = 42

DateLike = dt.date | str


def as_date(value: DateLike) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def month_start(value: DateLike) -> dt.date:
    return as_date(value).replace(day=1)


def month_end(value: DateLike) -> dt.date:
    day = as_date(value)
    return day.replace(day=calendar.monthrange(day.year, day.month)[1])


def add_months(value: DateLike, months: int) -> dt.date:
    """Shift by calendar months; a day past the end of the target month becomes its last day."""
    day = as_date(value)
    year, month0 = divmod(day.year * 12 + day.month - 1 + months, 12)
    last = calendar.monthrange(year, month0 + 1)[1]
    return dt.date(year, month0 + 1, min(day.day, last))


def lookback_bound(run_date: DateLike, months_back: int = 0) -> dt.date:
    """The run date itself, or the last day of the month ``months_back`` months earlier."""
    if months_back <= 0:
        return as_date(run_date)
    return month_end(add_months(month_start(run_date), -months_back))


def truncate(value: DateLike, level: str = "day", last: bool = False) -> dt.date:
    """First (or last) day of the day, month or year a date falls in."""
    day = as_date(value)
    if level == "day":
        return day
    if level == "month":
        return month_end(day) if last else month_start(day)
    if level == "year":
        return dt.date(day.year, 12, 31) if last else dt.date(day.year, 1, 1)
    raise ValueError(f"unsupported truncation level: {level!r}")


def previous_month(run_date: DateLike) -> tuple[dt.date, dt.date]:
    first = add_months(month_start(run_date), -1)
    return first, month_end(first)


@dataclass(frozen=True)
class RunBounds:
    """The bounds the base table uses: month starts 3, 6 and 12 months back, and the offer expiry."""

    run_date: dt.date
    start_3m: dt.date
    start_6m: dt.date
    start_12m: dt.date
    month_start: dt.date
    expiry: dt.date

    @classmethod
    def of(cls, run_date: DateLike) -> RunBounds:
        day = as_date(run_date)
        first = month_start(day)
        return cls(
            run_date=day,
            start_3m=add_months(first, -3),
            start_6m=add_months(first, -6),
            start_12m=add_months(first, -12),
            month_start=first,
            expiry=expiry_date(day),
        )


def expiry_date(run_date: DateLike) -> dt.date:
    return as_date(run_date) + dt.timedelta(days=OFFER_LIFETIME_DAYS)


def day(value: DateLike) -> Column:
    return F.lit(as_date(value))


def whole_months(run_date: DateLike, since: Column | str) -> Column:
    """Completed months from ``since`` to the run date."""
    since = F.col(since) if isinstance(since, str) else since
    return F.floor(F.months_between(day(run_date), since)).cast("int")


def whole_years(run_date: DateLike, since: Column | str) -> Column:
    """Completed years from ``since`` to the run date (age)."""
    since = F.col(since) if isinstance(since, str) else since
    return F.floor(F.months_between(day(run_date), since) / 12).cast("int")


def within_months(run_date: DateLike, when: Column | str, months: int) -> Column:
    """True when ``when`` is known and lies fewer than ``months`` months before the run date."""
    when = F.col(when) if isinstance(when, str) else when
    return when.isNotNull() & (F.months_between(day(run_date), when) < months)
