"""One row per key, with a stated order so that reruns keep the same row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW = "__row"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key in the given order.

    Spark cuts a ``row_number = 1`` filter down inside every map task before the shuffle, so a key
    that holds a large share of the rows sends one row per task, not all of them.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(ROW, F.row_number().over(window)).where(F.col(ROW) == 1).drop(ROW)


def gaps(df: DataFrame, names: Sequence[str]) -> Column:
    """How many of the columns hold nothing: NULL, or blank text."""
    types = dict(df.dtypes)
    empty = [F.trim(F.col(f"`{n}`")) == "" if types[n] == "string" else F.lit(False) for n in names]
    counted = [F.when(F.col(f"`{n}`").isNull() | blank, 1).otherwise(0) for n, blank in zip(names, empty, strict=True)]
    return sum(counted, F.lit(0))


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key where the source states no order: the one with the fewest gaps, then the smallest over all other columns."""
    names = [name for name in df.columns if name not in set(keys)]
    others = [gaps(df, names), *[F.col(f"`{name}`").asc_nulls_last() for name in names]]
    return first_per_key(df, keys, others if names else [F.col(keys[0])])


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "copies") -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)
