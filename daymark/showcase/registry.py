"""Where queries are registered with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.showcase.roles import TestTables, with_roles

Build = Callable[[TestTables], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    build: Build
    sql: str | None

    def __call__(self, spark: SparkSession, directory: str) -> DataFrame:
        return plain(self.build(TestTables(spark, directory)))


ENTRIES: dict[str, Entry] = {}


def query(sql: str | None = None, roles: tuple[str, ...] = ()) -> Callable[[Build], Build]:
    """Register a query under its function's name."""

    def register(build: Build) -> Build:
        name = build.__name__
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        ENTRIES[name] = Entry(name, build, None if sql is None else with_roles(roles, sql))
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates as text, decimals as doubles and truth values as 0/1, so that engines can be compared."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.BooleanType):
            column = column.cast("int")
        columns.append(column.alias(field.name))
    return df.select(*columns)
