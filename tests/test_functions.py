import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daymark.functions import bands, bounds, cleaning, codes, contacts, pricing

D = dt.date


def test_bounds():
    assert bounds.add_months("2024-03-31", -1) == D(2024, 2, 29)
    assert bounds.add_months("2024-01-31", 1) == D(2024, 2, 29)
    assert bounds.lookback_bound("2023-01-10") == D(2023, 1, 10)
    assert bounds.lookback_bound("2023-01-10", 1) == D(2022, 12, 31)
    assert bounds.lookback_bound("2023-01-10", 3) == D(2022, 10, 31)
    assert bounds.truncate("2024-02-10", "month", last=True) == D(2024, 2, 29)
    assert bounds.truncate("2024-02-10", "year", last=True) == D(2024, 12, 31)
    assert bounds.previous_month("2024-03-05") == (D(2024, 2, 1), D(2024, 2, 29))
    with pytest.raises(ValueError):
        bounds.truncate("2024-02-10", "week")
    b = bounds.RunBounds.of("2026-01-15")
    assert (b.start_3m, b.start_6m, b.start_12m) == (D(2025, 10, 1), D(2025, 7, 1), D(2025, 1, 1))
    assert (b.month_start, b.expiry) == (D(2026, 1, 1), D(2026, 2, 26))


def test_bounds_agree_with_spark(spark):
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(0, 420, 7)] + [D(2024, 2, 29), D(2023, 12, 31)]
    rows = spark.createDataFrame([(d,) for d in days], "d date")
    for n in (-12, -3, -1, 0, 1, 13):
        got = rows.select("d", F.add_months("d", n).alias("m"), F.last_day("d").alias("l"), F.trunc("d", "month").alias("f"))
        for row in got.collect():
            assert row["m"] == bounds.add_months(row["d"], n)
            assert row["l"] == bounds.month_end(row["d"])
            assert row["f"] == bounds.month_start(row["d"])


@pytest.mark.parametrize(
    ("text", "mobile"),
    [
        ("0917-123-4567", "639171234567"),
        ("9171234567", "639171234567"),
        ("639171234567", "639171234567"),
        ("+63 (917) 123 4567", "639171234567"),
        ("0999999999", None),
        ("99999999999", None),
        ("9999999999", None),
        ("9111111111", None),
        ("12345", None),
        ("", None),
        (None, None),
        ("0717-123-4567", None),
    ],
)
def test_mobile(one, text, mobile):
    assert one([text], contacts.normalize_mobile("x")) == [mobile]


@pytest.mark.parametrize(
    ("text", "landline", "kept"),
    [
        ("81234567", "0281234567", "0281234567"),
        ("281234567", "0281234567", "0281234567"),
        ("0321234567", "321234567", "321234567"),
        ("63281234567", "0281234567", "0281234567"),
        ("63321234567", "321234567", "321234567"),
        ("0281234567", None, "0281234567"),
        ("321234567", None, "321234567"),
        ("41234567", None, None),
        ("0311234567", None, None),
        (None, None, None),
    ],
)
def test_landline(one, text, landline, kept):
    assert one([text], contacts.normalize_landline("x")) == [landline]
    assert one([text], contacts.normalize_landline("x", keep_final_form=True)) == [kept]


def test_email(one):
    texts = ["a@gmail.com", "A@Yahoo.com.ph", "a@example.com", "none@yahoo.com", " ", None, "gmail.com", "1@2.3", "bad@gmail.com"]
    valid = contacts.is_valid_email("x", blocked_mailboxes=["bad"])
    assert one(texts, contacts.yes_no(valid)) == ["Y", "Y", "N", "N", "N", "N", "N", "N", "N"]


def test_text_cleaning(one):
    assert one([" n/a ", None, " x\t", "None", " a  b "], cleaning.clean_text("x")) == ["", "", "x", "", "a  b"]
    assert one([None, " n/a "], cleaning.trim_text("x")) == [None, "n/a"]
    assert one(["", " ", None, "a"], cleaning.empty_to_null("x")) == [None, " ", None, "a"]
    assert one([None, "", "  ", "a"], cleaning.is_blank("x")) == [True, True, True, False]
    assert one(["\t a \t"], cleaning.strip_left("x")) == ["a \t"]
    assert one(["\t a \t"], cleaning.strip_right("x")) == ["\t a"]


def test_numbers_and_dates(one):
    amounts = one(["PHP 1,234.50", "-7", "x", "1-2"], cleaning.str_to_num("x", "decimal", 18, 2))
    assert amounts == [Decimal("1234.50"), Decimal("-7.00"), None, None]
    assert one([1240131, 991231, 1241399], cleaning.cyymmdd_to_date("x"), "int") == [D(2024, 1, 31), D(1999, 12, 31), None]
    got = one([0, 1312024, 12312024, 99999999, None], cleaning.mmddyyyy_to_date("x"), "int")
    assert got == [None, D(2024, 1, 31), D(2024, 12, 31), None, None]
    assert one(["01/31/2024", "31/01/2024"], cleaning.us_text_to_date("x")) == [D(2024, 1, 31), None]
    assert one(["2024-01-31 10:00:00", "no"], cleaning.timestamp_text_to_date("x")) == [D(2024, 1, 31), None]


def test_safe_add(spark):
    rows = spark.createDataFrame([(None, None), (None, 2), (1, None), (1, 2)], "a int, b int")
    assert [r[0] for r in rows.select(cleaning.safe_add("a", "b")).collect()] == [None, 2, 1, 3]


def test_score_boundary(one):
    scores = [0.6, 0.59, 0.3, 0.29, None]
    assert one(scores, bands.score_label("x"), "double") == ["HIGH", "MID", "MID", "LOW", None]
    assert one(scores, bands.score_label("x", boundary_is_mid=False), "double") == ["HIGH", "MID", "LOW", "LOW", None]


def test_bands(one):
    values = [199999, 200000, 250000, 250001, 450001, 499999, 500000, None]
    assert one(values, bands.balance_band("x"), "int") == [
        "a.<200k", "b.200k-250k", "b.200k-250k", "c.250k-300k", "g.450k-500k", "g.450k-500k", "h.>=500k", "UNKNOWN",
    ]
    assert one([17, 18, 29, 30, 50, None], bands.age_tier("x"), "int") == [
        "UNKNOWN", "a.18-29", "a.18-29", "b.30-39", "d.50 & up", "UNKNOWN",
    ]
    assert one(["(1) Below 305k", "(6) Above 5M", "?"], bands.monthly_income("x")) == [
        Decimal("25416.67"), Decimal("416666.67"), None,
    ]


def test_offer_codes(spark, one):
    run = "2026-01-15"
    assert one([12], codes.build_code("AL", "PTB", run, "x"), "int") == ["ALPTB0126B0000012"]
    assert one(["ALPTB0126B0000012", "odd"], codes.code_sequence("x")) == [12, None]
    with pytest.raises(Exception, match="past"):
        one([10_000_000], codes.build_code("AL", "PTB", run, "x"), "int")
    offers = spark.createDataFrame([("ALPTB0126B0000012",), ("ALPTB1225B0000099",)], "offer_code string")
    last = spark.range(1).select(codes.last_sequence(offers, run).alias("n"))
    assert last.first()["n"] == 12
    empty = spark.range(1).select(codes.last_sequence(offers.limit(0), run).alias("n"))
    assert empty.first()["n"] == 0


def test_card_prices(spark):
    rows = spark.createDataFrame([(1, 34999.0, 0.0), (1, 35400.0, 0.0), (0, 0.0, 500000.0), (1, 2e6, 0.0), (None, 1e6, 1e6)], "p int, s double, b double")
    priced = rows.select(pricing.card_limit(pricing.card_raw_limit("p", "s", "b")).alias("limit"))
    got = priced.select("limit", pricing.card_type("limit").alias("type")).collect()
    assert [tuple(r) for r in got] == [
        (None, None), (35000, "MasterCard Gold"), (200000, "MasterCard Platinum"), (1000000, "MasterCard World"), (None, None),
    ]


def test_home_price_uses_seven_decimals_of_the_monthly_rate(spark):
    rate = spark.sql("SELECT 0.068 / 12.0 AS r").first()["r"]
    assert rate == pricing.HOME_MONTHLY_RATE
    row = spark.sql("SELECT CAST(500000 AS DECIMAL(18,2)) AS b, CAST(100000 AS DECIMAL(18,2)) AS i, CAST(NULL AS DECIMAL(18,2)) AS a, 40 AS age")
    priced = row.select(pricing.home_capacity("b", "i", "a").alias("c"), pricing.home_term_years("age").alias("y"))
    amount = priced.select("c", "y", pricing.home_loan_amount("c", "y").cast("string").alias("amount")).first()
    assert (amount["c"], amount["y"]) == (75000.0, 25)
    monthly = 0.0056667
    assert amount["amount"] == f"{int(75000 * (1 - (1 + monthly) ** -300) / monthly // 1000 * 1000)}.0"
