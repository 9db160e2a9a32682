"""Source tables as they arrive: several snapshots, closed versions, edge blanks, missing words, repeated rows.

``Arriving`` derives them from the roles, so that what the declared reads make of them can be held against the roles themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.showcase.roles import RUN, TestTables
from daymark.sources.registry import SOURCES, Source

#: Dates of the snapshot that a read of the latest one must find, of an older one, and of one after the run date.
LATEST, OLDER, LATER = "1998-06-12", "1998-05-12", "1998-06-19"
MISSING = "n/a"


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def padded(df: DataFrame) -> DataFrame:
    """Every text between a tab, blanks and a non-breaking space; null and empty ones as a missing word."""
    return df.withColumns({c: F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(f" {MISSING}\t")).otherwise(F.concat(F.lit("\t "), F.col(c), F.lit(" \u00a0"))) for c in _texts(df)})


def stale(df: DataFrame) -> DataFrame:
    """The same keys (first column) with other values."""
    key = df.columns[0]
    other = {c: F.lit("stale") for c in _texts(df) if c != key}
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name != key]
    return df.withColumns({**other, **{c: (F.col(c) + 1).cast(df.schema[c].dataType) for c in numbers}})


def arriving(df: DataFrame, source: Source) -> DataFrame:
    """Rows of a role twice, once padded, in the snapshot or version that the read is for, next to stale rows in others."""
    good = df.unionByName(padded(df))
    stamped = lambda rows, day: rows.withColumn(source.column, F.lit(day).cast("date"))
    if any("current_row_flag" in f for f in source.filters):
        version = lambda rows, flag, end: rows.withColumns({"current_row_flag": F.lit(flag), "row_eff_end_date": F.lit(end).cast("date")})
        return version(good, "Y", "9999-12-31").unionByName(version(stale(df), "N", OLDER)).unionByName(version(stale(df), "Y", None))
    if source.mode in ("last", "exact"):
        right = LATEST if source.mode == "last" else RUN
        return stamped(good, right).unionByName(stamped(stale(df), OLDER)).unionByName(stamped(stale(df), LATER))
    return good  # full reads, and trailing months, which the roles have already


class Arriving:
    """A reader of the tables as they arrive."""

    def __init__(self, tables: TestTables, names: dict[str, str]):
        self.tables, self.names = tables, names

    def __call__(self, table: str) -> DataFrame:
        source, rows = SOURCES[table], self.tables.role(self.names.get(table, table))
        # numbers that the read normalises but no role has
        phones = {c: F.lit("0917-1234567") for c in (*source.mobile, *source.landline) if c not in rows.columns}
        return arriving(rows.withColumns(phones), source)
