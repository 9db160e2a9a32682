"""Comparison of two versions of a table as multisets of rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEFT_ONLY, RIGHT_ONLY = "left_only", "right_only"
BALANCE = "__balance"
BLOCK = 1000


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that occur more often on one side, with the side and the surplus.

    Both tables go through one grouped sum of +1 and -1, that is one shuffle with map-side partial
    sums. Rows only on the left show up just like rows only on the right.
    """
    columns = left.columns
    signed = left.withColumn(BALANCE, F.lit(1).cast("long")).unionByName(
        right.select(*columns).withColumn(BALANCE, F.lit(-1).cast("long"))
    )
    surplus = signed.groupBy(*columns).agg(F.sum(BALANCE).alias(BALANCE)).where(F.col(BALANCE) != 0)
    return surplus.select(
        *columns,
        F.when(F.col(BALANCE) > 0, LEFT_ONLY).otherwise(RIGHT_ONLY).alias("side"),
        F.abs(BALANCE).alias("copies"),
    )


def difference_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """The differing rows themselves, each as many times as it is in surplus.

    A row with very many surplus copies is first split into blocks, which are spread over the tasks, so
    that no task has to produce them all.
    """
    found = difference(left, right)
    block, size = F.col("__block"), F.lit(BLOCK).cast("long")
    blocks = found.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / size))))
    spread = blocks.repartition(*[F.col(f"`{name}`") for name in left.columns], block)
    in_block = F.least(size, F.col("copies") - block * size).cast("int")
    return spread.select(*left.columns, F.explode(F.array_repeat(F.lit(0), in_block)).alias("__copy")).drop("__copy")


def difference_count(left: DataFrame, right: DataFrame) -> int:
    return difference(left, right).agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first()["n"]


def is_equal(left: DataFrame, right: DataFrame) -> bool:
    return difference(left, right).isEmpty()


#: Groups of rows when there are no partitions to go by.
GROUPS = 256
GROUP = "__group"


def digests(df: DataFrame, by: Sequence[str] = (), groups: int = GROUPS) -> DataFrame:
    """A digest of the multiset of rows in each partition (``by``), or in each of ``groups`` groups that a hash deals rows to.

    It is the number of rows and the sums of two 64-bit hashes, which don't depend on the order of rows and count copies. The sums are taken in
    the tasks; what is shuffled is one row per task and group.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    first, second = F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)
    keyed = df if by else df.withColumn(GROUP, F.pmod(F.xxhash64(F.lit("group"), *columns), F.lit(groups)))
    total = lambda h: F.sum(h.cast("decimal(20,0)"))
    return keyed.groupBy(*[F.col(f"`{b}`") for b in (by or [GROUP])]).agg(F.count(F.lit(1)).alias("rows"), total(first).alias("first"), total(second).alias("second"))


def differing_groups(left: DataFrame, right: DataFrame, by: Sequence[str] = (), groups: int = GROUPS) -> list[tuple]:
    """Partitions, or groups, whose digests differ. What comes to the driver is bounded by their number."""
    named = list(by) or [GROUP]
    figures = ["rows", "first", "second"]
    a, b = digests(left, by, groups), digests(right, by, groups)
    signed = a.select(*named, *figures, F.lit(1).alias("side")).unionByName(b.select(*named, *figures, F.lit(-1).alias("side")))
    summed = signed.groupBy(*named).agg(*[F.sum(F.col(f).cast("decimal(38,0)") * F.col("side")).alias(f) for f in figures])
    return [tuple(r) for r in summed.where(reduce(or_, [F.col(f) != 0 for f in figures])).select(*named).collect()]


def difference_by_digest(left: DataFrame, right: DataFrame, by: Sequence[str] = (), groups: int = GROUPS) -> DataFrame:
    """``difference``, with rows shuffled only where digests of both sides differ; none are if the tables agree.

    ``by`` names partition columns, so that only differing partitions are read again. Rows of equal content have equal digests; values that
    compare as equal but hash apart (0.0 and -0.0) only cost a comparison.
    """
    types = dict(left.dtypes)
    right = right.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in left.columns])
    found = differing_groups(left, right, by, groups)
    if not found:
        return difference(left.limit(0), right.limit(0))
    if by:
        inside = reduce(or_, [reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.lit(v)) for c, v in zip(by, values, strict=True)]) for values in found])
        return difference(left.where(inside), right.where(inside))
    own = lambda df: df.where(F.pmod(F.xxhash64(F.lit("group"), *[F.col(f"`{c}`") for c in left.columns]), F.lit(groups)).isin([v for (v,) in found]))
    return difference(own(left), own(right))
