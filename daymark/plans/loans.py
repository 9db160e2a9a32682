"""What a customer's existing loans say about a new offer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.bounds import DateLike, add_months, day, within_months
from daymark.operators.rollups import any_flag, count_where, max_where, sum_where
from daymark.sources.snapshots import previous_month_end

# Product codes.
OTHER_LOANS = ("CTS", "BEL", "BML")
AUTO_CHECKED = ("HL", "PL", *OTHER_LOANS)
RECENT_AUTO = ("AL", "CSL", "SALAD")
CARD_CHECKED = ("AL", "HL", "PL", "CSL", *OTHER_LOANS, "SD")
CARD_SIX_MONTHS = ("CSL", *OTHER_LOANS, "SD")
CARD_FOUR_MONTHS = ("AL", "PL")


def _product(*codes: str) -> Column:
    return F.col("product_code").isin(*codes)


def _is(column: str) -> Column:
    return F.col(column) == 1


def recent_auto_bookings(loans: DataFrame, run_date: DateLike, products: tuple[str, ...] = RECENT_AUTO) -> DataFrame:
    """Customers who booked an auto or salary loan in the last three months."""
    since = day(add_months(run_date, -3))
    booked = previous_month_end(loans, run_date, "reporting_date").where(_is("booked_yesno") & _product(*products))
    return booked.where(F.col("booking_date") >= since).select("bbn").distinct()


def auto_loan_checks(loans: DataFrame, run_date: DateLike) -> DataFrame:
    """Per customer with active loans: their amortization and whether none of them is younger than 3 months."""
    active = previous_month_end(loans, run_date, "reporting_date").where(
        _is("active_yesno") & _product(*AUTO_CHECKED)
    )
    rolled = active.groupBy("bbn").agg(
        max_where("booking_date", _product("HL")).alias("dt_hl"),
        max_where("booking_date", _product("PL")).alias("dt_pl"),
        max_where("booking_date", _product(*OTHER_LOANS)).alias("dt_oth"),
        sum_where(F.coalesce("booked_amortization_amount", F.lit(0)), _is("booked_yesno")).alias("amort_all_loans"),
    )
    young = F.lit(False)
    for column in ("dt_hl", "dt_pl", "dt_oth"):
        young = young | F.coalesce(within_months(run_date, column, 3), F.lit(False))
    return rolled.select("bbn", "amort_all_loans", F.when(young, 0).otherwise(1).alias("loan_criteria_pass"))


def card_loans(loans: DataFrame, run_date: DateLike) -> DataFrame:
    """Per customer with active loans: whether the loans are old enough, and whether one is overdue."""
    active = previous_month_end(loans, run_date, "reporting_date").where(_is("active_yesno") & _product(*CARD_CHECKED))
    rolled = active.groupBy("bbn").agg(
        max_where("booking_date", _product(*CARD_SIX_MONTHS)).alias("dt_six"),
        max_where("booking_date", _product(*CARD_FOUR_MONTHS)).alias("dt_four"),
        any_flag(F.col("days_past_due").try_cast("int") > 0).alias("non_current_flag"),
    )
    young = within_months(run_date, "dt_six", 6) | within_months(run_date, "dt_four", 4)
    return rolled.select("bbn", F.when(young, 0).otherwise(1).alias("loan_criteria_pass"), "non_current_flag")


def card_loan_exclusions(loans: DataFrame, run_date: DateLike, exclude_good: bool = True) -> DataFrame:
    """Customers barred from a card offer by their loans.

    As the tables have always been filled, those are the customers whose loans pass the age test and
    those with no overdue loan. ``exclude_good=False`` bars the opposite ones.
    """
    checks = card_loans(loans, run_date)
    passes = (F.col("loan_criteria_pass") == 1) | (F.col("non_current_flag") == 0)
    fails = (F.col("loan_criteria_pass") == 0) | (F.col("non_current_flag") == 1)
    return checks.where(passes if exclude_good else fails).select("bbn")


def home_loan_rollup(loans: DataFrame, run_date: DateLike) -> DataFrame:
    """Booked active loans per customer: amortization, overdue count, months on book and products."""
    months = F.months_between(day(run_date), F.col("booking_date")).cast("int")
    active = loans.where(_is("active_yesno") & _is("booked_yesno") & F.col("bbn").isNotNull())
    return active.groupBy("bbn").agg(
        F.sum(F.coalesce("booked_amortization_amount", F.lit(0))).alias("amort_all_loans"),
        count_where(F.col("days_past_due").try_cast("int") > 0).alias("non_current_cnt"),
        max_where(months, _product("HL")).alias("hl_mob"),
        max_where(months, _product("PL")).alias("pl_mob"),
        max_where(months, _product("AL")).alias("al_mob"),
        max_where(months, _product(*OTHER_LOANS)).alias("oth_mob"),
        any_flag(_product("HL", "AL", "PL")).alias("has_hl_al_pl"),
        any_flag(_product("CSL")).alias("has_csl"),
        any_flag(_product(*OTHER_LOANS)).alias("has_oth"),
    )
