"""Phone number and e-mail checks as single column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.cleaning import col, empty_to_null

# First digit of a metro subscriber number (after area prefix 02).
METRO_FIRST_DIGITS = ("3", "5", "6", "7", "8")

# Provincial area codes.
AREA_CODES = (
    "32", "33", "34", "35", "36", "38",
    "42", "43", "44", "45", "46", "47", "48", "49",
    "52", "53", "54", "55", "56",
    "62", "63", "64", "65", "68",
    "72", "74", "75", "77", "78",
    "82", "83", "84", "85", "86", "87", "88",
)

# Whole e-mail texts that stand for "none".
JUNK_EMAILS = (
    "NONE", "NA", "N.A.", "0", "N/A", "---", "--------", "MA", "NODATA", "NULL",
    "NODATA@YAHOO.COM", "NONE@NONE.COM", "NONE@YAHOO.COM", "NA@YAHOO.COM",
)

# Accepted domain labels (the part between '@' and the first dot).
EMAIL_DOMAINS = (
    "GMAIL", "YAHOO", "YMAIL", "HOTMAIL", "ICLOUD", "ROCKETMAIL", "OUTLOOK", "ANZ", "TASKUS", "BMS",
    "LIVE", "MANULIFE", "IQOR", "SYNCHRONYFINANCIAL", "SPI-GLOBAL", "TRANSCOM", "ACCENTURE", "GLOBE",
    "ALORICA", "CLOUDSTAFF", "QQ", "RESULTS-CX", "TENETHEALTH", "PROTONMAIL",
)


def digits(column: Column | str) -> Column:
    return F.regexp_replace(col(column), r"\D", "")


def normalize_mobile(column: Column | str) -> Column:
    """Country code 63 plus the ten-digit national number, or NULL.

    Accepts the national number (first digit 8 or 9) bare, after one 0, or after 63. A number whose
    last nine digits are all the same is a filler and is dropped.
    """
    national = F.regexp_extract(digits(column), r"^(?:63|0)?(?!\d(\d)\1{8}$)([89]\d{9})$", 2)
    return F.concat(F.lit("63"), empty_to_null(national))


def normalize_landline(
    column: Column | str,
    area_codes: Sequence[str] = AREA_CODES,
    metro_first_digits: Sequence[str] = METRO_FIRST_DIGITS,
    keep_final_form: bool = False,
) -> Column:
    """Metro numbers as 02 plus eight digits, provincial ones as area code plus seven, else NULL.

    A number that already has its final form is not recognised unless ``keep_final_form`` is set;
    that is how existing tables were filled.
    """
    text = digits(column)
    metro_prefix = "(?:632|02|2)?" if keep_final_form else "(?:632|2)?"
    area_prefix = "(?:63|0)?" if keep_final_form else "(?:63|0)"
    metro = F.regexp_extract(text, rf"^{metro_prefix}([{''.join(metro_first_digits)}]\d{{7}})$", 1)
    provincial = F.regexp_extract(text, rf"^{area_prefix}((?:{'|'.join(area_codes)})\d{{7}})$", 1)
    return F.coalesce(F.concat(F.lit("02"), empty_to_null(metro)), empty_to_null(provincial))


def clean_mobile_columns(df: DataFrame, columns: Sequence[str] | str) -> DataFrame:
    names = [columns] if isinstance(columns, str) else columns
    return df.withColumns({name: normalize_mobile(name) for name in names})


def clean_landline_columns(df: DataFrame, columns: Sequence[str] | str, **options) -> DataFrame:
    names = [columns] if isinstance(columns, str) else columns
    return df.withColumns({name: normalize_landline(name, **options) for name in names})


def is_valid_email(
    column: Column | str,
    domains: Sequence[str] = EMAIL_DOMAINS,
    junk: Sequence[str] = JUNK_EMAILS,
    blocked_mailboxes: Sequence[str] = (),
) -> Column:
    """Boolean, never NULL. ``blocked_mailboxes`` are lower-case texts before the '@' to refuse."""
    email = col(column)
    ok = (
        ~F.upper(F.trim(email)).isin(*junk)
        & email.rlike("[A-Za-z]")
        & F.trim(F.upper(F.regexp_extract(email, "@([^.]+)", 1))).isin(*domains)
    )
    if blocked_mailboxes:
        ok = ok & ~F.lower(F.split_part(email, F.lit("@"), F.lit(1))).isin(*blocked_mailboxes)
    return F.coalesce(ok, F.lit(False))


def yes_no(condition: Column) -> Column:
    """'Y' when the condition holds, 'N' when it is false or unknown."""
    return F.when(condition, "Y").otherwise("N")
