"""Checks of a table against its contract, reported as rows."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.bounds import DateLike, day
from daymark.operators.contract import TableContract
from daymark.operators.dedup import duplicate_keys

KEY_SEPARATOR = "|"


def _key_text(keys: list[str]) -> Column:
    return F.concat_ws(KEY_SEPARATOR, *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def _finding(check: str, column: str, value: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check_name"), F.lit(column).alias("column_name"), value.cast("string").alias("value")
    )


def _row_checks(df: DataFrame, contract: TableContract) -> list[tuple[str, str, Column]]:
    """Check, column and whether a row fails it: keys present, values castable, values in their domain."""
    checks = []
    available = dict(df.dtypes)
    for spec in contract.columns:
        if spec.name not in available:
            continue
        value = F.col(f"`{spec.name}`")
        if spec.is_pkey:
            blank = value.isNull() if available[spec.name] != "string" else F.coalesce(F.trim(value) == "", F.lit(True))
            checks.append(("key_present", spec.name, blank))
        if available[spec.name] != spec.spark_type.simpleString():
            bad = value.isNotNull() & value.try_cast(spec.spark_type).isNull()
            checks.append(("type", spec.name, bad))
        if spec.domain:
            outside = value.isNotNull() & ~value.isin(*spec.domain)
            checks.append(("domain", spec.name, outside))
    return checks


def row_findings(df: DataFrame, contract: TableContract) -> DataFrame:
    """Per-row checks, all in one scan."""
    found = [F.when(fails, _finding(check, column, F.col(f"`{column}`"))) for check, column, fails in _row_checks(df, contract)]
    if not found:
        found = [F.when(F.lit(False), _finding("none", "", F.lit(None)))]
    key = _key_text(contract.keys) if contract.keys else F.lit("")
    # a check that finds nothing is a row of NULLs here
    return df.select(key.alias("row_key"), F.inline(F.array(*found))).where(F.col("check_name").isNotNull())


FAILED = "failed_checks"


def mark_failures(df: DataFrame, contract: TableContract) -> DataFrame:
    """The rows with the array ``failed_checks`` of the per-row checks that each fails, as 'check:column'. A missing column raises."""
    lacking = missing_columns(df, contract)
    if lacking:
        raise ValueError(f"{contract.name} lacks {', '.join(lacking)}")
    failed = [F.when(fails, F.lit(f"{check}:{column}")) for check, column, fails in _row_checks(df, contract)]
    return df.withColumn(FAILED, F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>"))


def failure_counts(df: DataFrame, contract: TableContract) -> dict[str, Column]:
    """An aggregate per per-row check over what ``mark_failures`` returns, so that a write can observe them."""
    names = [f"{check}:{column}" for check, column, _ in _row_checks(df, contract)]
    return {name: F.count_if(F.array_contains(FAILED, name)) for name in names}


def key_findings(df: DataFrame, contract: TableContract) -> DataFrame:
    """Keys that occur more than once."""
    keys = contract.keys
    return duplicate_keys(df, keys).select(
        _key_text(keys).alias("row_key"),
        F.lit("key_unique").alias("check_name"),
        F.lit(KEY_SEPARATOR.join(keys)).alias("column_name"),
        F.col("copies").cast("string").alias("value"),
    )


def missing_columns(df: DataFrame, contract: TableContract) -> list[str]:
    return [name for name in contract.names if name not in df.columns]


def column_findings(df: DataFrame, contract: TableContract) -> DataFrame:
    """Declared columns that the table lacks, one row each."""
    rows = [("", "column_present", name, None) for name in missing_columns(df, contract)]
    return df.sparkSession.createDataFrame(rows, "row_key string, check_name string, column_name string, value string")


def check_table(df: DataFrame, contract: TableContract, run_date: DateLike) -> DataFrame:
    """Error rows of one table, ready to be appended to an error table.

    A missing column is a finding of its own; checks that need a missing key column are left out.
    """
    lacking = set(missing_columns(df, contract))
    keys_there = not lacking.intersection(contract.keys)
    errors = row_findings(df, contract if keys_there else replace(contract, columns=tuple(c for c in contract.columns if c.name not in lacking)))
    if contract.keys and keys_there:
        errors = errors.unionByName(key_findings(df, contract))
    if lacking:
        errors = errors.unionByName(column_findings(df, contract))
    return errors.select(
        F.lit(contract.name).alias("table_name"),
        "check_name",
        "column_name",
        "row_key",
        "value",
        day(run_date).alias("actual_date"),
    )
