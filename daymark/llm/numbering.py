"""Numbers within groups, without bringing a group together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm.common import kept
from daymark.operators.joins import join_splitting

BUCKET, BEFORE = "__n_bucket", "__n_before"
#: Rows that one window group holds, about.
BUCKET_ROWS = 4000


def number_within(rows: DataFrame, group: str, row_id: str, name: str, total: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``name`` = 0, 1, ... without gaps per ``group``, in the order of a hash of ``row_id`` and then of all columns.

    ``total`` (rows in all) sets into how many buckets of that hash each group is cut. Only one count per
    group and bucket is ever summed up in order; rows are sorted within their bucket.
    """
    buckets = max(1, -(-total // bucket_rows))
    cut = rows.withColumn(BUCKET, F.pmod(F.xxhash64(F.lit("bucket"), row_id), F.lit(buckets)).cast("int"))
    counts = kept(cut.groupBy(group, BUCKET).agg(F.count(F.lit(1)).alias("n")), "bucket-counts")
    before = counts.select(group, BUCKET, (F.sum("n").over(Window.partitionBy(group).orderBy(BUCKET)) - F.col("n")).alias(BEFORE))
    order = [F.xxhash64(F.lit("order"), row_id), F.col(row_id), *[F.col(f"`{c}`") for c in rows.columns if c not in (row_id, group) and not c.startswith("__")]]
    inside = F.row_number().over(Window.partitionBy(group, BUCKET).orderBy(*order))
    joined = join_splitting(cut.withColumn(name, inside), before, [group, BUCKET], "inner")
    return joined.withColumn(name, (F.col(name) - 1 + F.col(BEFORE)).cast("long")).drop(BUCKET, BEFORE)
