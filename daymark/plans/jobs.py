"""One call per produced table: read its sources, build it, write it.

The order of ``JOBS`` is the order the tables depend on each other within one run date. Starting them, passing
parameters and retrying is left to whatever schedules Spark applications.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from daymark.functions.bounds import DateLike
from daymark.operators.quality import check_table
from daymark.plans import base, offers
from daymark.plans.contracts import CONTRACTS, CROSS_SELL_BASE, STAGING_BASE
from daymark.sinks.tables import create_table, write_table, write_with_metrics
from daymark.sources.registry import SOURCES, CatalogReader, Reader, Sources
from daymark.sources.snapshots import last_of_table

JOBS = (STAGING_BASE.name, CROSS_SELL_BASE.name, *offers.BUILDERS)


def build(name: str, tables: Mapping[str, DataFrame], run_date: DateLike, **options: Any) -> DataFrame:
    """The rows of one produced table for a run date."""
    if name == STAGING_BASE.name:
        return base.staging_base(tables, run_date, **options)
    if name == CROSS_SELL_BASE.name:
        return base.cross_sell_base(tables[STAGING_BASE.name])
    return offers.build(name, tables, run_date, **options)


def own_or_source(spark: SparkSession, database: str, source: Reader) -> Reader:
    """Reads produced tables from their database and everything else from ``source``."""

    own = CatalogReader(spark, database)

    def read(name: str) -> DataFrame:
        return own(name) if name in CONTRACTS else source(name)

    if isinstance(source, CatalogReader):
        names = {name: database for name in CONTRACTS}
        elsewhere = source.database
        others = elsewhere if isinstance(elsewhere, Mapping) else {s.table: elsewhere for s in SOURCES.values()}
        return CatalogReader(spark, {**others, **names})
    return read


def run_job(
    spark: SparkSession,
    name: str,
    run_date: DateLike,
    source: Reader,
    database: str,
    root: str,
    metrics: bool = False,
    **options: Any,
) -> dict[str, Any]:
    """Create the table if it is missing, build the run date's rows and replace that partition."""
    contract = CONTRACTS[name]
    table = f"{database}.{name}"
    for other in JOBS:  # earlier offers are read back, so the tables have to be there
        create_table(spark, f"{database}.{other}", CONTRACTS[other], f"{root.rstrip('/')}/{other}")
    rows = build(name, Sources(own_or_source(spark, database, source), run_date), run_date, **options)
    # named, so that a rerun without rows takes back what an earlier one has published
    own = {partition: str(run_date) for partition in contract.partitions} or None
    if metrics:
        return write_with_metrics(rows, table, contract=contract, replacing=own)
    write_table(rows, table, contract, replacing=own)
    return {"table": table}


def check_job(
    spark: SparkSession, name: str, run_date: DateLike, database: str, error_table: str | None = None, last_snapshot: bool = False
) -> DataFrame:
    """Check the run date's rows of a produced table, or with ``last_snapshot`` its latest ones not after that date.

    With ``error_table`` the findings are appended to it.
    """
    contract = CONTRACTS[name]
    table = f"{database}.{name}"
    if last_snapshot:
        rows = last_of_table(spark, table, run_date)
    else:
        rows = spark.table(table)
        for partition in contract.partitions:
            rows = rows.where(rows[partition] == str(run_date))
    errors = check_table(rows, contract, run_date)
    if error_table is not None:
        write_table(errors, error_table, mode="append", clustered=False)
    return errors
