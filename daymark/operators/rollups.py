"""Child rows rolled up to one row per key.

Everything here is a plain ``groupBy().agg()`` over max, sum and avg, which Spark combines inside the
map tasks: a key with very many rows reaches the shuffle as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def any_flag(condition: Column) -> Column:
    """1 when the condition holds on any row of the group, else 0."""
    return F.max(F.when(condition, 1).otherwise(0))


def any_flags(df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[any_flag(condition).alias(name) for name, condition in conditions.items()])


def roll_up_flags(df: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Any-flag of 0/1 flags; a flag missing after a left join counts as 0."""
    return any_flags(df, keys, {name: F.col(name) > 0 for name in flags})


def max_where(value: Column | str, condition: Column) -> Column:
    """Largest value among the rows where the condition holds; NULL when there is none."""
    value = F.col(value) if isinstance(value, str) else value
    return F.max(F.when(condition, value))


def sum_where(value: Column | str, condition: Column) -> Column:
    """Sum over the rows where the condition holds; NULL when there is none."""
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(condition, value))


def count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def first_present(*candidates: Column) -> Column:
    """Priority pick: the first candidate that is not NULL."""
    return F.coalesce(*candidates)


def pivot_max(
    df: DataFrame, keys: Sequence[str], value: Column | str, picks: Mapping[str, Column]
) -> DataFrame:
    """One column per pick, holding the largest value among the rows the pick's condition selects."""
    return df.groupBy(*keys).agg(*[max_where(value, condition).alias(name) for name, condition in picks.items()])


def average_between(
    df: DataFrame, keys: Sequence[str], value: str, when: str, start: Column, end: Column, name: str
) -> DataFrame:
    return df.where(F.col(when).between(start, end)).groupBy(*keys).agg(F.avg(value).alias(name))
