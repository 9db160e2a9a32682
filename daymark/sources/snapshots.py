"""Reads of dated snapshot tables as of a run date.

A snapshot table keeps every past state under a date column. Each function takes the table as a
DataFrame and returns the rows one read mode selects. Where the date has to be looked up first, that
is one tiny aggregate whose single value becomes a literal filter, so partitions are pruned and the
filter reaches the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.functions.bounds import (
    DateLike,
    add_months,
    as_date,
    day,
    lookback_bound,
    month_end,
    month_start,
    previous_month,
    truncate,
)

SNAPSHOT_COLUMN = "actual_date"
# Fixed value: the date looked for when no snapshot qualifies.
NO_SNAPSHOT = dt.date(2000, 1, 1)


def _single_date(df: DataFrame, value: Column) -> dt.date:
    found = df.agg(value.cast("date").alias("d")).first()["d"]
    return NO_SNAPSHOT if found is None else found


def full(df: DataFrame) -> DataFrame:
    return df


def latest_date(df: DataFrame, run_date: DateLike, column: str = SNAPSHOT_COLUMN, months_back: int = 0) -> dt.date:
    bound = lookback_bound(run_date, months_back)
    return _single_date(df.where(F.col(column) <= day(bound)), F.max(column))


def last(df: DataFrame, run_date: DateLike, column: str = SNAPSHOT_COLUMN, months_back: int = 0) -> DataFrame:
    """Latest snapshot not after the run date, or not after the end of the month ``months_back`` ago."""
    return exact(df, latest_date(df, run_date, column, months_back), column)


def first_in_month(
    df: DataFrame, run_date: DateLike, column: str = SNAPSHOT_COLUMN, months_back: int = 0
) -> DataFrame:
    """Earliest snapshot inside the calendar month of the bound."""
    bound = lookback_bound(run_date, months_back)
    in_month = df.where(F.col(column).between(day(month_start(bound)), day(month_end(bound))))
    return exact(df, _single_date(in_month, F.min(column)), column)


def exact(df: DataFrame, run_date: DateLike, column: str = SNAPSHOT_COLUMN) -> DataFrame:
    return df.where(F.col(column) == day(run_date))


def until(df: DataFrame, run_date: DateLike, column: str = SNAPSHOT_COLUMN, inclusive: bool = True) -> DataFrame:
    bound = day(run_date)
    return df.where(F.col(column) <= bound if inclusive else F.col(column) < bound)


def month_period(
    df: DataFrame,
    run_date: DateLike,
    months_back: int,
    column: str = SNAPSHOT_COLUMN,
    include_current_month: bool = True,
) -> DataFrame:
    """Trailing months up to the run date, or the whole calendar months before the run's month."""
    value, first = F.col(column), month_start(run_date)
    if not include_current_month:
        if months_back == 0:
            raise ValueError("no dates to read: zero months back without the current month")
        return df.where((value >= day(add_months(first, -months_back))) & (value < day(first)))
    lower = value >= day(first) if months_back == 0 else value > day(add_months(run_date, -months_back))
    return df.where(lower & (value <= day(run_date)))


def day_period(df: DataFrame, run_date: DateLike, days_back: int, column: str = SNAPSHOT_COLUMN) -> DataFrame:
    after = as_date(run_date) - dt.timedelta(days=days_back)
    return df.where((F.col(column) > day(after)) & (F.col(column) <= day(run_date)))


def date_range(
    df: DataFrame, start: DateLike, end: DateLike, column: str = SNAPSHOT_COLUMN, level: str = "day"
) -> DataFrame:
    """Closed range, widened to whole months or years when ``level`` says so."""
    return df.where(F.col(column).between(day(truncate(start, level)), day(truncate(end, level, last=True))))


def valid_at(df: DataFrame, run_date: DateLike, start_column: str, end_column: str) -> DataFrame:
    """Rows whose half-open validity interval holds the run date."""
    return df.where((F.col(start_column) <= day(run_date)) & (day(run_date) < F.col(end_column)))


def business_day(
    calendar: DataFrame,
    run_date: DateLike,
    months_back: int = 1,
    nth: int | str = "end",
    date_column: str = "cdate_date",
    flag_column: str = "pflag",
) -> dt.date:
    """The n-th, 'half' or 'end' business day of a month, from a calendar of business days.

    A month has at most 31 calendar days, so the ordered dates of one month are a bounded array.
    """
    month = add_months(month_start(run_date), -months_back)
    in_month = calendar.where(F.col(date_column).between(day(month), day(month_end(month))))
    if isinstance(nth, int):
        dates = F.sort_array(F.collect_set(date_column))
        position = F.least(F.greatest(F.lit(nth), F.lit(1)), F.size(dates))
        found = in_month.agg(F.try_element_at(dates, F.nullif(position, F.lit(0))).alias("d")).first()["d"]
    elif nth in ("end", "half"):
        wanted = "M" if nth == "end" else "H"
        found = in_month.where(F.col(flag_column) == wanted).agg(F.min(date_column).alias("d")).first()["d"]
    else:
        raise ValueError(f"unsupported business day: {nth!r}")
    if found is None:
        raise LookupError(f"calendar has no such business day in {month:%Y-%m}")
    return as_date(found)


def on_business_day(
    df: DataFrame,
    calendar: DataFrame,
    run_date: DateLike,
    months_back: int = 1,
    nth: int | str = "end",
    column: str = SNAPSHOT_COLUMN,
    **calendar_columns: str,
) -> DataFrame:
    return exact(df, business_day(calendar, run_date, months_back, nth, **calendar_columns), column)


def previous_month_end(df: DataFrame, run_date: DateLike, column: str = SNAPSHOT_COLUMN) -> DataFrame:
    """The last snapshot taken inside the previous calendar month; empty when there is none."""
    first, final = previous_month(run_date)
    in_month = df.where(F.col(column).between(day(first), day(final)))
    found = in_month.agg(F.max(column).cast("date").alias("d")).first()["d"]
    return df.where(F.lit(False)) if found is None else exact(df, found, column)


def previous_month_end_of_table(spark: SparkSession, table: str, run_date: DateLike, column: str | None = None) -> DataFrame:
    """``previous_month_end`` of a partitioned catalog table, the date taken from partition names: nothing is scanned for it."""
    name = column or snapshot_column(spark, table)
    first, final = previous_month(run_date)
    found = [d for d in partition_dates(spark, table, name) if as_date(first) <= d <= as_date(final)]
    return spark.table(table).where(F.lit(False)) if not found else exact(spark.table(table), max(found), name)


def partition_dates(spark: SparkSession, table: str, column: str) -> list[dt.date]:
    """The snapshot dates of a partitioned catalog table, from the names of its partitions; names that are no date are passed over."""
    quoted = ".".join(f"`{part.strip('`')}`" for part in table.split("."))
    names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {quoted}").collect()]
    found = []
    for name in names:
        value = dict(part.split("=", 1) for part in name.split("/"))[column]
        try:
            found.append(dt.date.fromisoformat(value[:10]))
        except ValueError:
            continue
    return sorted(found)


def where_all(df: DataFrame, *conditions: Column | str) -> DataFrame:
    for condition in conditions:
        df = df.where(condition)
    return df


def snapshot_column(spark: SparkSession, table: str) -> str:
    """The date column of a catalog table: its one partition column."""
    names = [column.name for column in spark.catalog.listColumns(table) if column.isPartition]
    if len(names) != 1:
        raise ValueError(f"{table} needs exactly one partition column, found {names}")
    return names[0]


def latest_partition(
    spark: SparkSession, table: str, run_date: DateLike, column: str | None = None, months_back: int = 0
) -> dt.date:
    """Latest snapshot date of a partitioned catalog table, from partition names alone (no data read)."""
    name = column or snapshot_column(spark, table)
    quoted = ".".join(f"`{part.strip('`')}`" for part in table.split("."))
    dates = spark.sql(f"SHOW PARTITIONS {quoted}").select(
        F.regexp_extract("partition", rf"(?:^|/){name}=([^/]*)", 1).try_cast(T.DateType()).alias(name)
    )
    return latest_date(dates, run_date, name, months_back)


def last_of_table(
    spark: SparkSession, table: str, run_date: DateLike, column: str | None = None, months_back: int = 0
) -> DataFrame:
    """``last`` for a partitioned catalog table without scanning it for the date."""
    name = column or snapshot_column(spark, table)
    return exact(spark.table(table), latest_partition(spark, table, run_date, name, months_back), name)
