"""Cleansing selects described by a spec.

A spec is a dict (or YAML/JSON file) with ``table_name``, optional ``alias`` and ``fields``. A field
has ``name`` and optionally ``transform`` (+ ``transform_args``), ``cast`` and ``alias``; a transform
wins over a cast. A field ``{use_actual_date_as_business_date: true}`` adds the run date.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions import cleaning
from daymark.functions.bounds import DateLike, day
from daymark.operators.contract import load_document

# Names a spec may use, and the column function behind each.
TRANSFORMS: dict[str, Callable[..., Column]] = {
    "sql_str_to_num": cleaning.str_to_num,
    "sql_rtrim_tab_and_space": cleaning.strip_right,
    "sql_ltrim_tab_and_space": cleaning.strip_left,
    "sql_trim_tab_and_space": cleaning.strip_both,
    "sql_int_to_date": cleaning.cyymmdd_to_date,
    "sql_str_to_date": cleaning.us_text_to_date,
    "sql_military_date_int_to_date": cleaning.mmddyyyy_to_date,
    "sql_timestamp_to_date": cleaning.timestamp_text_to_date,
    "sql_empty_string_to_null": cleaning.empty_to_null,
    "sql_safe_addition": cleaning.safe_add,
    "sql_truncate_field": cleaning.truncate_text,
}


def cleansed_column(field: Mapping, run_date: DateLike) -> Column:
    if field.get("use_actual_date_as_business_date"):
        return day(run_date).alias("business_date")
    name = field["name"]
    column = F.col(name)
    if field.get("transform") is not None:
        if field["transform"] not in TRANSFORMS:
            raise ValueError(f"unknown transform {field['transform']!r} for field {name!r}")
        column = TRANSFORMS[field["transform"]](column, **field.get("transform_args", {}))
    elif field.get("cast") is not None:
        column = column.try_cast(field["cast"])
    return column.alias(field.get("alias") or name.split(".")[-1])


def cleanse(spec: Mapping | str | Path, run_date: DateLike, df: DataFrame | None = None, spark=None) -> DataFrame:
    """Run a cleansing spec over its table, or over a frame that stands for it."""
    document = load_document(spec)
    source = spark.table(document["table_name"]) if df is None else df
    if document.get("alias"):
        source = source.alias(document["alias"])
    return source.select(*[cleansed_column(field, run_date) for field in document["fields"]])
