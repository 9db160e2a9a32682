"""Labels, tiers, decode tables and small counts used by the offer tables."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from daymark.functions.cleaning import col, present

# Fixed values: (upper bound, bound belongs to the band, label), in order; above the last is 'h.>=500k'.
BALANCE_BANDS = (
    (200000, False, "a.<200k"),
    (250000, True, "b.200k-250k"),
    (300000, True, "c.250k-300k"),
    (350000, True, "d.300k-350k"),
    (400000, True, "e.350k-400k"),
    (450000, True, "f.400k-450k"),
    (500000, False, "g.450k-500k"),
)
TOP_BALANCE_BAND = "h.>=500k"

# Fixed values: (first age, last age, label); the last tier is open.
AGE_TIERS = ((18, 29, "a.18-29"), (30, 39, "b.30-39"), (40, 49, "c.40-49"), (50, None, "d.50 & up"))
UNKNOWN = "UNKNOWN"

# Income label -> yearly income range whose middle stands for the band.
INCOME_BANDS = {
    "(1) Below 305k": (305000, 305000),
    "(2) 305k to 470k": (305000, 470000),
    "(3) 470k to 835k": (470000, 835000),
    "(4) 835k to 1.5M": (835000, 1500000),
    "(5) 1.5M to 5M": (1500000, 5000000),
    "(6) Above 5M": (5000000, 5000000),
}

# Code texts.
GENDERS = {"M": "Male", "F": "Female"}
CIVIL_STATUSES = {"0": "Single", "1": "Married", "2": "Separated", "3": "Widowed"}
EMPLOYMENT_TYPES = {"0": "Employed", "1": "Self-employed", "2": "Unemployed"}


def balance_band(column: Column | str) -> Column:
    value = col(column)
    label = F.when(value.isNull(), UNKNOWN)
    for bound, inclusive, name in BALANCE_BANDS:
        label = label.when(value <= bound if inclusive else value < bound, name)
    return label.otherwise(TOP_BALANCE_BAND)


def age_tier(column: Column | str) -> Column:
    value = col(column)
    label = F.when(value.isNull(), UNKNOWN)
    for first, last, name in AGE_TIERS:
        label = label.when(value >= first if last is None else value.between(first, last), name)
    return label.otherwise(UNKNOWN)


def is_aged(column: Column | str, age: int = 70) -> Column:
    return F.when(col(column) >= age, 1).otherwise(0)


def score_label(column: Column | str, boundary_is_mid: bool = True) -> Column:
    """HIGH from 0.6, MID down to 0.3, LOW below; ``boundary_is_mid`` says where 0.3 itself goes."""
    score = col(column)
    mid = score >= 0.3 if boundary_is_mid else score > 0.3
    return F.when(score >= 0.6, "HIGH").when(mid, "MID").when(score.isNotNull(), "LOW")


def monthly_income(label: Column | str) -> Column:
    """Monthly middle of an income band, decimal(18,2); unknown labels give NULL."""
    value = None
    for name, (low, high) in INCOME_BANDS.items():
        middle = (Decimal(low + high) / 24).quantize(Decimal("0.01"))
        hit = col(label) == name
        value = F.when(hit, F.lit(middle)) if value is None else value.when(hit, F.lit(middle))
    return value.cast("decimal(18,2)")


def decode(column: Column | str, mapping: Mapping[str, str], default: str | None = None) -> Column:
    value = None
    for code, text in mapping.items():
        hit = col(column) == code
        value = F.when(hit, text) if value is None else value.when(hit, text)
    return value if default is None else value.otherwise(default)


def count_present(*columns: Column | str, blank_is_missing: bool = True) -> Column:
    """How many of the text columns hold a value."""
    total = F.lit(0)
    for column in columns:
        total = total + present(column, blank_is_missing).cast("int")
    return total


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or unknown."""
    return F.when(condition, 1).otherwise(0)
