"""Column functions that turn raw source text and packed numbers into typed values.

Every function takes a column (or its name) and returns a column, so a cleansing step stays one
projection inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Texts that mean "no value" in source extracts, compared in upper case.
MISSING_WORDS = ("NAN", "NA", "N/A", "N.A.", "N.A", "NONE")

# Fixed: what counts as blank at the edges of a text.
EDGE_SPACE = " \t\n\x0b\f\r\u00a0"


def col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def str_to_num(
    column: Column | str, cast_type: str, precision: int | None = None, scale: int | None = None
) -> Column:
    """Keep digits, dots and minus signs, then cast; text that is still no number becomes NULL."""
    target = f"decimal({precision},{scale})" if cast_type == "decimal" else cast_type
    return F.regexp_replace(col(column), "[^0-9.-]", "").try_cast(target)


def strip_right(column: Column | str) -> Column:
    return F.regexp_replace(col(column), "[\t ]+$", "")


def strip_left(column: Column | str) -> Column:
    return F.regexp_replace(col(column), "^[\t ]+", "")


def strip_both(column: Column | str) -> Column:
    return F.regexp_replace(col(column), "^[\t ]+|[\t ]+$", "")


def cyymmdd_to_date(column: Column | str) -> Column:
    """Packed CYYMMDD integer (years counted from 1900) to date."""
    return F.try_to_date((col(column) + F.lit(19000000)).cast("string"), "yyyyMMdd")


def us_text_to_date(column: Column | str) -> Column:
    return F.try_to_date(col(column), "MM/dd/yyyy")


def mmddyyyy_to_date(column: Column | str) -> Column:
    """MMddyyyy integer to date; 0 is no date, a missing leading zero is put back."""
    text = col(column).cast("string")
    padded = F.when(F.length(text) < 8, F.concat(F.lit("0"), text)).otherwise(text)
    return F.when(col(column) != 0, F.try_to_date(padded, "MMddyyyy"))


def timestamp_text_to_date(column: Column | str) -> Column:
    return F.try_to_date(F.substring(col(column).cast("string"), 1, 10), "yyyy-MM-dd")


def empty_to_null(column: Column | str) -> Column:
    return F.nullif(col(column), F.lit(""))


def safe_add(left: Column | str, right: Column | str) -> Column:
    """Sum that is NULL only when both sides are."""
    return F.coalesce(col(left) + col(right), col(left), col(right))


def truncate_text(column: Column | str, limit: int) -> Column:
    return F.substring(col(column), 1, limit)


def is_blank(column: Column | str) -> Column:
    """True for NULL, empty or only spaces; never NULL itself."""
    return F.coalesce(F.trim(col(column)) == "", F.lit(True))


def present(column: Column | str, blank_is_missing: bool = True) -> Column:
    """Whether a text value is there. With ``blank_is_missing=False`` only NULL counts as missing."""
    return ~is_blank(column) if blank_is_missing else col(column).isNotNull()


def trim_text(column: Column | str) -> Column:
    """Strip whitespace, non-breaking spaces included, from both edges."""
    return F.btrim(col(column), F.lit(EDGE_SPACE))


def clean_text(column: Column | str) -> Column:
    """Edge-trimmed text; NULL and the missing words become ''."""
    trimmed = trim_text(column)
    return F.when(F.upper(trimmed).isin(*MISSING_WORDS), F.lit("")).otherwise(F.coalesce(trimmed, F.lit("")))


def clean_strings(df: DataFrame, skip: Iterable[str] = (), replace_missing: bool = True) -> DataFrame:
    """Clean every string column except those named in ``skip``, in one projection."""
    skipped = {name.lower() for name in skip}
    clean = clean_text if replace_missing else trim_text
    return df.select(
        *[
            clean(F.col(f"`{field.name}`")).alias(field.name)
            if isinstance(field.dataType, StringType) and field.name.lower() not in skipped
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        ]
    )
