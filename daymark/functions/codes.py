"""Offer codes: product(2) kind(3) month(2) year(2) 'B' sequence(7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.bounds import DateLike, as_date
from daymark.functions.cleaning import col

#: Digits of the sequence unless another width is passed; a month holds one code fewer than ten to that power.
SEQUENCE_DIGITS = 7


def period(run_date: DateLike) -> str:
    return as_date(run_date).strftime("%m%y")


def build_code(product: str, kind: str, run_date: DateLike, sequence: Column | str, digits: int = SEQUENCE_DIGITS) -> Column:
    """Padding would silently cut a longer number, so running past the last code is an error; take more digits then."""
    number, last = col(sequence), 10**digits - 1
    suffix = F.lpad(number.cast("string"), digits, "0")
    checked = F.when(
        number > last, F.raise_error(F.lit(f"offer sequence of {product}{kind} is past {last}"))
    ).otherwise(suffix)
    return F.concat(F.lit(f"{product}{kind}{period(run_date)}B"), checked)


def code_sequence(code: Column | str, digits: int = SEQUENCE_DIGITS) -> Column:
    return F.substring(col(code), -digits, digits).try_cast("int" if digits < 10 else "long")


def code_month(code: Column | str) -> Column:
    return F.substring(col(code), 6, 2).try_cast("int")


def code_year(code: Column | str) -> Column:
    """Two-digit year."""
    return F.substring(col(code), 8, 2).try_cast("int")


def in_period(code: Column | str, run_date: DateLike) -> Column:
    day = as_date(run_date)
    return (code_month(code) == day.month) & (code_year(code) == day.year % 100)


def last_sequence(offers: DataFrame, run_date: DateLike, code: str = "offer_code", digits: int = SEQUENCE_DIGITS) -> Column:
    """Highest sequence among the offers coded in the run's month, 0 when there is none.

    A scalar subquery column: it is evaluated once, inside the query that uses it.
    """
    return (
        offers.where(in_period(code, run_date))
        .agg(F.coalesce(F.max(code_sequence(code, digits)), F.lit(0)).alias("last_sequence"))
        .scalar()
    )
