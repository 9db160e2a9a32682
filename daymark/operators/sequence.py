"""Dense row numbers over a whole table.

``row_number()`` over an ordering without partitions pulls every row into one task. Here the rows are
range-partitioned and sorted on the full ordering, numbered inside each partition, and shifted by how
many rows lie in the partitions before. The only thing that is ever in one place is one count per
partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.shared import settle

SLOT, PART, BEFORE, TIE = "__slot", "__part", "__before", "__tie"
# monotonically_increasing_id() holds the partition number above this bit
SLOT_BITS = 33


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    start: Column | int = 0,
    name: str = "sequence",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = 1, 2, 3, ... in the given order, continuing after ``start``.

    Rows that tie in ``order`` are ordered by a hash of the whole row, so that reruns give the same
    numbers and a value that very many rows share can still be split over partitions. The ordered frame
    is written as Parquet, because the counts and the numbers must come from one and the same partitioning;
    the counts read its slots only. Without ``partitions`` Spark sizes the ranges.
    """
    total = [*order, TIE]
    tied = df.withColumn(TIE, F.xxhash64(*df.columns))
    ranged = tied.repartitionByRange(partitions, *total) if partitions else tied.repartitionByRange(*total)
    placed = settle(
        ranged.sortWithinPartitions(*total)
        .drop(TIE)
        .withColumn(SLOT, F.monotonically_increasing_id())
    )
    part = F.shiftright(SLOT, SLOT_BITS)
    running = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per partition, so both the window and the broadcast stay tiny
    before = (
        placed.groupBy(part.alias(PART))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(PART, F.coalesce(F.sum("rows").over(running), F.lit(0)).alias(BEFORE))
    )
    first = F.lit(start) if isinstance(start, int) else start
    index = F.col(SLOT) - F.shiftleft(F.col(PART), SLOT_BITS) + 1
    return (
        placed.withColumn(PART, part)
        .join(F.broadcast(before), PART)
        .withColumn(name, (index + F.col(BEFORE) + first).cast("long"))
        .drop(SLOT, PART, BEFORE)
    )


def number_weighted(df: DataFrame, order: Sequence[str], weight: str, start: Column | int = 0, name: str = "first", partitions: int | None = None) -> DataFrame:
    """Add ``name``: the number that the first of ``weight`` rows standing behind each row gets, if all of them are numbered in the given order after ``start``.

    Give it keys and weights only: no other column is needed to number rows that are fanned out later (``number + place - 1``). Rows without weight
    use up no number. Ties as in ``number_rows``.
    """
    total = [*order, TIE]
    tied = df.withColumn(TIE, F.xxhash64(*df.columns))
    ranged = tied.repartitionByRange(partitions, *total) if partitions else tied.repartitionByRange(*total)
    placed = settle(ranged.withColumn(PART, F.spark_partition_id()).sortWithinPartitions(PART, *total))
    running = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    # a row per partition
    before = placed.groupBy(PART).agg(F.sum(weight).alias("rows")).select(PART, F.coalesce(F.sum("rows").over(running), F.lit(0)).alias(BEFORE))
    inside = Window.partitionBy(PART).orderBy(*total).rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn(SLOT, F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    first = F.lit(start) if isinstance(start, int) else start
    return numbered.join(F.broadcast(before), PART).withColumn(name, (F.col(SLOT) + F.col(BEFORE) + first + 1).cast("long")).drop(SLOT, PART, BEFORE, TIE)
