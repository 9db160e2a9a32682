"""Reads of versioned (SCD2) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.bounds import DateLike, day, month_start
from daymark.operators.dedup import first_per_key

OPEN_END = "9999-12-31"
START, END, CURRENT = "row_eff_start_date", "row_eff_end_date", "current_row_flag"
#: Derived column of tables that are partitioned by the month in which a version begins.
START_MONTH = "row_eff_start_month"


def is_current() -> Column:
    return F.col(CURRENT) == "Y"


def is_live() -> Column:
    """Current and not a tombstone (a tombstone is a current row without an end)."""
    return is_current() & F.col(END).isNotNull()


def current(df: DataFrame) -> DataFrame:
    return df.where(is_current())


def live(df: DataFrame) -> DataFrame:
    return df.where(is_live())


def with_start_month(df: DataFrame) -> DataFrame:
    """Rows with the first day of the month in which their version begins."""
    return df.withColumn(START_MONTH, F.trunc(START, "month"))


def valid_in_months(df: DataFrame, run_date: DateLike) -> DataFrame:
    """Versions whose half-open interval holds the run date, from a table partitioned by ``START_MONTH``: months after the run's are never listed.

    For the latest state of a table ``live`` needs the current partitions only.
    """
    return df.where((F.col(START_MONTH) <= day(month_start(run_date))) & (F.col(START) <= day(run_date)) & (day(run_date) < F.col(END)))


def began_between(df: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Versions that began from ``start`` to ``end``, both included: only the partitions of these months are read."""
    months = F.col(START_MONTH).between(day(month_start(start)), day(month_start(end)))
    return df.where(months & F.col(START).between(day(start), day(end)))


def versions_as_of(
    df: DataFrame,
    keys: Sequence[str],
    run_date: DateLike,
    column: str = "actual_date",
    deleted: Column | None = None,
    keep_deleted: bool = False,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Latest row per key up to the run date, for tables that only ever append versions.

    ``deleted`` marks rows that record a deletion; unless ``keep_deleted`` is set, a key whose latest
    row is one of those is left out.
    """
    order = [F.col(column).desc(), *[F.col(name) for name in tie_break]]
    latest = first_per_key(df.where(F.col(column) <= day(run_date)), keys, order)
    if deleted is None or keep_deleted:
        return latest
    return latest.where(~F.coalesce(deleted, F.lit(False)))
