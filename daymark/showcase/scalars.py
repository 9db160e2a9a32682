"""Column functions: cleaning, contacts, dates, bands, prices, codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymark.functions import bands, cleaning, codes, contacts, pricing
from daymark.functions import bounds as B
from daymark.operators.cleanse import cleanse
from daymark.operators.joins import fan_out
from daymark.operators.rollups import first_present
from daymark.showcase import fixed
from daymark.showcase.registry import query
from daymark.showcase.roles import RUN

MISSING = "('NAN', 'NA', 'N/A', 'N.A.', 'N.A', 'NONE')"
EDGES = "regexp_replace({}, '^[\\x{{00A0}}\\s]+|[\\x{{00A0}}\\s]+$', '', 'g')"

RAW_TEXT = """
    SELECT o_orderkey AS id,
           CASE o_orderpriority WHEN '1-URGENT' THEN '  n/a ' WHEN '2-HIGH' THEN NULL
                WHEN '3-MEDIUM' THEN chr(160) || ' ' || o_orderstatus || chr(9) WHEN '4-NOT SPECIFIED' THEN 'None'
                ELSE ' ' || o_orderpriority || ' x ' END AS note,
           ' ' || o_orderstatus AS kept
    FROM {orders}"""
RAW_TEXT_SQL = RAW_TEXT.replace("{orders}", "orders")


@query(
    f"""SELECT id, CASE WHEN trimmed IS NULL OR upper(trimmed) IN {MISSING} THEN '' ELSE trimmed END AS note, kept
        FROM (SELECT id, {EDGES.format("note")} AS trimmed, kept FROM ({RAW_TEXT_SQL}))"""
)
def clean_strings(t):
    return cleaning.clean_strings(t.sql(RAW_TEXT), skip=["KEPT"])


@query(f"SELECT id, {EDGES.format('note')} AS note, {EDGES.format('kept')} AS kept FROM ({RAW_TEXT_SQL})")
def trim_strings(t):
    return cleaning.clean_strings(t.sql(RAW_TEXT), replace_missing=False)


@query(f"SELECT doc_id, {EDGES.format('text')} AS text, lang FROM documents")
def trim_documents(t):
    """Edge trimming over whole document texts."""
    return t.documents.select("doc_id", cleaning.trim_text("text").alias("text"), "lang")


# numbers in text, text without a number, a number too large for its type, and nothing at all
NUMBERS = """
    SELECT o_orderkey, 'PHP ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) || ' only' AS price,
           CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN 'no ' || CAST(o_custkey AS STRING) || ' of ' ELSE o_orderpriority END AS number,
           CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN '-' || CAST(o_custkey AS STRING) ELSE '99999999999' END AS signed
    FROM {orders}"""


@query(
    f"""SELECT o_orderkey, CAST(TRY_CAST(regexp_replace(price, '[^0-9.-]', '', 'g') AS DECIMAL(18,2)) AS DOUBLE) AS amount,
              TRY_CAST(nullif(regexp_replace(number, '[^0-9.-]', '', 'g'), '') AS INTEGER) AS rank,
              TRY_CAST(nullif(regexp_replace(signed, '[^0-9.-]', '', 'g'), '') AS INTEGER) AS nothing
       FROM ({NUMBERS.replace("{orders}", "orders")})"""
)
def str_to_num(t):
    rows = t.sql(NUMBERS)
    return rows.select(
        "o_orderkey",
        cleaning.str_to_num("price", "decimal", 18, 2).alias("amount"),
        cleaning.str_to_num("number", "int").alias("rank"),
        cleaning.str_to_num("signed", "int").alias("nothing"),
    )


@query(
    """SELECT o_orderkey, regexp_replace(raw, '[ \t]+$', '') AS right_cut, regexp_replace(raw, '^[ \t]+', '') AS left_cut,
              regexp_replace(raw, '^[ \t]+|[ \t]+$', '', 'g') AS both_cut
       FROM (SELECT o_orderkey, chr(9) || ' ' || o_orderpriority || ' ' || chr(9) AS raw FROM orders)"""
)
def trim_tabs(t):
    raw = F.concat(F.lit("\t "), "o_orderpriority", F.lit(" \t"))
    return t.orders.select(
        "o_orderkey",
        cleaning.strip_right(raw).alias("right_cut"),
        cleaning.strip_left(raw).alias("left_cut"),
        cleaning.strip_both(raw).alias("both_cut"),
    )


@query(
    """SELECT o_orderkey, d AS packed, d AS us_text, d AS military, d AS stamp
       FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders)"""
)
def packed_dates(t):
    """Every packed form of a date comes back as that date."""
    when = F.col("o_orderdate").cast("date")
    number = F.year(when) * 10000 + F.month(when) * 100 + F.dayofmonth(when)
    military = F.month(when) * 1000000 + F.dayofmonth(when) * 10000 + F.year(when)
    return t.orders.select(
        "o_orderkey",
        cleaning.cyymmdd_to_date(number - 19000000).alias("packed"),
        cleaning.us_text_to_date(F.date_format(when, "MM/dd/yyyy")).alias("us_text"),
        cleaning.mmddyyyy_to_date(military).alias("military"),
        cleaning.timestamp_text_to_date(F.col("o_orderdate").cast("string")).alias("stamp"),
    )


@query(
    """SELECT c_custkey, CASE WHEN a IS NULL AND b IS NULL THEN NULL ELSE coalesce(a, 0) + coalesce(b, 0) END AS total,
              substr(c_name, 1, 12) AS short_name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS segment
       FROM (SELECT *, CASE WHEN c_acctbal > 0 THEN c_custkey END AS a, CASE WHEN c_nationkey > 9 THEN c_nationkey END AS b
             FROM customer)"""
)
def safe_add_truncate_blank(t):
    a = F.when(F.col("c_acctbal") > 0, F.col("c_custkey"))
    b = F.when(F.col("c_nationkey") > 9, F.col("c_nationkey"))
    emptied = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    return t.customer.select(
        "c_custkey",
        cleaning.safe_add(a, b).alias("total"),
        cleaning.truncate_text("c_name", 12).alias("short_name"),
        cleaning.empty_to_null(emptied).alias("segment"),
    )


SPEC = {
    "table_name": "orders",
    "alias": "o",
    "fields": [
        {"name": "o_orderkey"},
        {
            "name": "o.o_note",
            "transform": "sql_str_to_num",
            "transform_args": {"cast_type": "int"},
            "alias": "rank",
        },
        {"name": "o_totalprice", "cast": "decimal(18,2)", "alias": "amount"},
        {"name": "o_orderstatus", "transform": "sql_truncate_field", "transform_args": {"limit": 1}, "cast": "int"},
        {"use_actual_date_as_business_date": True},
    ],
}


@query(
    f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey::INTEGER END AS rank,
              CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, o_orderstatus, '{RUN}' AS business_date
       FROM orders"""
)
def cleanse_spec(t):
    customer = F.concat(F.lit("no "), F.col("o_custkey").cast("string"))
    note = F.when(F.col("o_orderstatus") == "F", customer).when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))
    return cleanse(SPEC, RUN, t.orders.withColumn("o_note", note))


PHONES = """
    SELECT o_orderkey,
           CASE o_orderpriority WHEN '1-URGENT' THEN '0917-' || lpad(CAST(o_orderkey AS STRING), 7, '0')
                WHEN '2-HIGH' THEN '+63 (8' || lpad(CAST(o_custkey AS STRING), 2, '1') || ') '
                     || lpad(CAST(o_orderkey AS STRING), 7, '5')
                WHEN '3-MEDIUM' THEN '9' || lpad(CAST(o_custkey AS STRING), 9, '9')
                WHEN '4-NOT SPECIFIED' THEN '8' || lpad('', 9, substring(CAST(o_custkey AS STRING), 1, 1))
                ELSE CAST(o_totalprice AS STRING) END AS phone
    FROM {orders}"""
# lengths 8 to 11 in every accepted and several refused forms
LANDLINES = """
    SELECT o_orderkey,
           CASE o_orderpriority WHEN '1-URGENT' THEN CAST(20000000 + o_orderkey * 4001 AS STRING)
                WHEN '2-HIGH' THEN '(2) ' || CAST(30000000 + o_orderkey * 3001 AS STRING)
                WHEN '3-MEDIUM' THEN '0' || CAST(320000000 + o_orderkey * 37003 AS STRING)
                WHEN '4-NOT SPECIFIED' THEN '+63-' || CAST(200000000 + o_orderkey * 45001 AS STRING)
                ELSE CAST(o_totalprice AS STRING) || o_orderstatus END AS phone
    FROM {orders}"""


@query(
    f"""WITH phones AS ({PHONES.replace("{orders}", "orders")}),
        digits AS (SELECT o_orderkey, regexp_replace(phone, '[^0-9]', '', 'g') AS d FROM phones),
        kept AS (SELECT o_orderkey, CASE WHEN length(d) BETWEEN 10 AND 12 AND NOT regexp_matches(d,
            '(0{{9,}}|1{{9,}}|2{{9,}}|3{{9,}}|4{{9,}}|5{{9,}}|6{{9,}}|7{{9,}}|8{{9,}}|9{{9,}})$') THEN d END AS d FROM digits)
        SELECT o_orderkey, CASE WHEN length(d) = 10 AND substr(d, 1, 1) IN ('8', '9') THEN '63' || d
                    WHEN length(d) = 11 AND substr(d, 1, 2) IN ('08', '09') THEN '63' || substr(d, 2)
                    WHEN length(d) = 12 AND substr(d, 1, 3) IN ('638', '639') THEN d END AS mobile
        FROM kept"""
)
def mobile_norm(t):
    return t.sql(PHONES).select("o_orderkey", contacts.normalize_mobile("phone").alias("mobile"))


AREAS = ", ".join(f"'{code}'" for code in fixed.AREA_CODES)


@query(
    f"""WITH phones AS ({LANDLINES.replace("{orders}", "orders")}),
        digits AS (SELECT o_orderkey, regexp_replace(phone, '[^0-9]', '', 'g') AS d FROM phones),
        formed AS (SELECT o_orderkey, CASE WHEN length(d) = 8 THEN '02' || d
            WHEN length(d) = 9 AND substr(d, 1, 1) = '2' THEN '0' || d
            WHEN length(d) = 10 AND substr(d, 1, 1) = '0' AND substr(d, 2, 1) <> '2' THEN substr(d, 2)
            WHEN length(d) = 11 AND substr(d, 1, 3) = '632' THEN '0' || substr(d, 3)
            WHEN length(d) = 11 AND substr(d, 1, 2) = '63' THEN substr(d, 3) END AS d FROM digits)
        SELECT o_orderkey, CASE WHEN length(d) = 10 AND substr(d, 1, 3) IN ('023', '025', '026', '027', '028') THEN d
                    WHEN length(d) = 9 AND substr(d, 1, 2) IN ({AREAS}) THEN d END AS landline
        FROM formed"""
)
def landline_norm(t):
    return t.sql(LANDLINES).select("o_orderkey", contacts.normalize_landline("phone").alias("landline"))


JUNK = ", ".join(f"'{word}'" for word in fixed.JUNK_EMAILS)
DOMAINS = ", ".join(f"'{word}'" for word in fixed.EMAIL_DOMAINS)
EMAIL_SQL = f"""CASE WHEN {{0}} IS NULL OR trim({{0}}) = '' THEN 'N' WHEN upper(trim({{0}})) IN ({JUNK}) THEN 'N'
    WHEN {{0}} NOT LIKE '%@%' THEN 'N' WHEN NOT regexp_matches({{0}}, '[A-Za-z]') THEN 'N'
    WHEN lower(split_part({{0}}, '@', 1)) IN ('blocked+test') THEN 'N'
    WHEN trim(upper(regexp_extract({{0}}, '@([^.]+)', 1))) IN ({DOMAINS}) THEN 'Y' ELSE 'N' END"""
EMAILS = """
    SELECT o_orderkey,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'c' || CAST(o_custkey AS STRING) || '@' ||
                     CASE o_orderstatus WHEN 'F' THEN 'Gmail.com' WHEN 'O' THEN 'example.com' ELSE 'yahoo.com.ph' END
                WHEN '2-HIGH' THEN CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN '  ' ELSE ' none@yahoo.com' END
                WHEN '3-MEDIUM' THEN CAST(o_custkey AS STRING) || '@' || CAST(o_orderkey AS STRING) || '.1'
                WHEN '4-NOT SPECIFIED' THEN 'Blocked+Test@gmail.com' ELSE 'no at sign' END AS email
    FROM {orders}"""


@query(f"SELECT o_orderkey, email, {EMAIL_SQL.format('email')} AS is_valid FROM ({EMAILS.replace('{orders}', 'orders')})")
def email_valid(t):
    valid = contacts.is_valid_email("email", blocked_mailboxes=["blocked+test"])
    return t.sql(EMAILS).withColumn("is_valid", contacts.yes_no(valid))


@query(
    f"""SELECT doc_id, word, {EMAIL_SQL.format("word")} AS is_valid
        FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) WHERE word LIKE '%@%'"""
)
def email_valid_documents(t):
    """Addresses found anywhere in the document texts."""
    words = t.documents.select("doc_id", F.explode(F.split("text", " ")).alias("word"))
    valid = contacts.is_valid_email("word", blocked_mailboxes=["blocked+test"])
    return words.where(F.col("word").contains("@")).withColumn("is_valid", contacts.yes_no(valid))


# months between the run date and a date: whole months on equal days or two month ends, else 31-day fractions
MONTHS = f"""(CASE WHEN day(DATE '{RUN}') = day({{0}}) OR (DATE '{RUN}' = last_day(DATE '{RUN}') AND {{0}} = last_day({{0}}))
    THEN 12 * (year(DATE '{RUN}') - year({{0}})) + month(DATE '{RUN}') - month({{0}})
    ELSE round(12 * (year(DATE '{RUN}') - year({{0}})) + month(DATE '{RUN}') - month({{0}})
         + (day(DATE '{RUN}') - day({{0}})) / 31.0, 8) END)"""
ORDER_MONTHS = MONTHS.format("CAST(o_orderdate AS DATE)")


@query(
    f"""SELECT o_orderkey, CAST(floor({ORDER_MONTHS}) AS INTEGER) AS months, CAST(floor({ORDER_MONTHS} / 12) AS INTEGER) AS years
        FROM orders"""
)
def age_months(t):
    when = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey", B.whole_months(RUN, when).alias("months"), B.whole_years(RUN, when).alias("years")
    )


@query(
    f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 WHEN {ORDER_MONTHS} < 3 THEN 1 ELSE 0 END AS under_3,
              CASE WHEN {ORDER_MONTHS} < 6 THEN 1 ELSE 0 END AS under_6 FROM orders"""
)
def recency_flags(t):
    when = F.col("o_orderdate").cast("date")
    known = F.when(F.col("o_orderstatus") != "F", when)
    return t.orders.select(
        "o_orderkey",
        bands.flag(B.within_months(RUN, known, 3)).alias("under_3"),
        bands.flag(B.within_months(RUN, when, 6)).alias("under_6"),
    )


@query(
    f"""SELECT o_orderkey, CASE WHEN d BETWEEN DATE '1998-03-01' AND DATE '1998-06-01' THEN 1 ELSE 0 END AS in_3m,
              CASE WHEN d BETWEEN DATE '1997-12-01' AND DATE '1998-06-01' THEN 1 ELSE 0 END AS in_6m,
              CASE WHEN d BETWEEN DATE '1997-06-01' AND DATE '1998-06-01' THEN 1 ELSE 0 END AS in_12m,
              CAST(CAST(DATE '{RUN}' + 42 AS DATE) AS VARCHAR) AS expiry_date
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"""
)
def run_bounds(t):
    b = B.RunBounds.of(RUN)
    when = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        bands.flag(when.between(B.day(b.start_3m), B.day(b.month_start))).alias("in_3m"),
        bands.flag(when.between(B.day(b.start_6m), B.day(b.month_start))).alias("in_6m"),
        bands.flag(when.between(B.day(b.start_12m), B.day(b.month_start))).alias("in_12m"),
        B.day(b.expiry).alias("expiry_date"),
    )


@query(
    """SELECT o_orderkey,
        CASE WHEN v < 200000 THEN 'a.<200k' WHEN v <= 250000 THEN 'b.200k-250k' WHEN v <= 300000 THEN 'c.250k-300k'
             WHEN v <= 350000 THEN 'd.300k-350k' WHEN v <= 400000 THEN 'e.350k-400k' WHEN v <= 450000 THEN 'f.400k-450k'
             WHEN v < 500000 THEN 'g.450k-500k' WHEN v >= 500000 THEN 'h.>=500k' ELSE 'UNKNOWN' END AS band,
        CASE WHEN age BETWEEN 18 AND 29 THEN 'a.18-29' WHEN age BETWEEN 30 AND 39 THEN 'b.30-39'
             WHEN age BETWEEN 40 AND 49 THEN 'c.40-49' WHEN age >= 50 THEN 'd.50 & up' ELSE 'UNKNOWN' END AS tier,
        CASE WHEN age >= 70 THEN 1 ELSE 0 END AS aged
       FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN round(o_totalprice * 1.2, -4) END AS v,
                    CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(floor(o_totalprice / 5000) AS INTEGER) END AS age FROM orders)"""
)
def buckets(t):
    value = F.when(F.col("o_orderstatus") != "F", F.round(F.col("o_totalprice") * 1.2, -4))
    age = F.when(F.col("o_orderpriority") != "5-LOW", F.floor(F.col("o_totalprice") / 5000).cast("int"))
    return t.orders.select(
        "o_orderkey",
        bands.balance_band(value).alias("band"),
        bands.age_tier(age).alias("tier"),
        bands.is_aged(age).alias("aged"),
    )


@query(
    """SELECT c_custkey,
        CASE WHEN s >= 0.6 THEN 'HIGH' WHEN s BETWEEN 0.3 AND 0.6 THEN 'MID' WHEN s <= 0.3 THEN 'LOW' END AS auto_label,
        CASE WHEN s >= 0.6 THEN 'HIGH' WHEN s > 0.3 THEN 'MID' WHEN s <= 0.3 THEN 'LOW' END AS home_label
       FROM (SELECT c_custkey, CASE WHEN c_nationkey < 20 THEN CAST(round(c_acctbal / 10000, 1) AS DOUBLE) END AS s FROM customer)"""
)
def score_labels(t):
    score = F.when(F.col("c_nationkey") < 20, F.round(F.col("c_acctbal") / 10000, 1))
    return t.customer.select(
        "c_custkey",
        bands.score_label(score).alias("auto_label"),
        bands.score_label(score, boundary_is_mid=False).alias("home_label"),
    )


@query(
    """SELECT bbn, CASE label WHEN '(1) Below 305k' THEN 25416.67 WHEN '(2) 305k to 470k' THEN 32291.67
              WHEN '(3) 470k to 835k' THEN 54375.00 WHEN '(4) 835k to 1.5M' THEN 97291.67
              WHEN '(5) 1.5M to 5M' THEN 270833.33 WHEN '(6) Above 5M' THEN 416666.67 END::DOUBLE AS income
       FROM incomeestimatorv2""",
    roles=("incomeestimatorv2",),
)
def income_midpoint(t):
    return t.role("incomeestimatorv2").select("bbn", bands.monthly_income("label").alias("income"))


@query(
    """SELECT bbn, CASE gender_code WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' END AS gender,
              CASE gender_code WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' ELSE '' END AS gender_or_blank,
              CASE civil_status_code WHEN '0' THEN 'Single' WHEN '1' THEN 'Married' WHEN '2' THEN 'Separated'
                   WHEN '3' THEN 'Widowed' END AS civil_status,
              CASE employment_type_code WHEN '0' THEN 'Employed' WHEN '1' THEN 'Self-employed' WHEN '2' THEN 'Unemployed' END
                   AS employment
       FROM dim_cust_indiv""",
    roles=("dim_cust_indiv",),
)
def decode_maps(t):
    return t.role("dim_cust_indiv").select(
        "bbn",
        bands.decode("gender_code", bands.GENDERS).alias("gender"),
        bands.decode("gender_code", bands.GENDERS, "").alias("gender_or_blank"),
        bands.decode("civil_status_code", bands.CIVIL_STATUSES).alias("civil_status"),
        bands.decode("employment_type_code", bands.EMPLOYMENT_TYPES).alias("employment"),
    )


@query(
    f"""SELECT id, CAST(coalesce(trim(note) <> '', FALSE) AS INTEGER) + CAST(trim(kept) <> '' AS INTEGER) AS known,
              CAST(note IS NOT NULL AS INTEGER) + 1 AS not_null FROM ({RAW_TEXT_SQL})"""
)
def completeness(t):
    return t.sql(RAW_TEXT).select(
        "id",
        bands.count_present("note", "kept").alias("known"),
        bands.count_present("note", "kept", blank_is_missing=False).alias("not_null"),
    )


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN CAST(c_custkey AS VARCHAR) WHEN c_acctbal > 0 THEN c_mktsegment
              ELSE 'none' END AS pick,
              CASE WHEN upper(trim(' ' || lower(c_mktsegment))) IN ('BUILDING', 'MACHINERY') THEN 1 ELSE 0 END AS in_category
       FROM customer"""
)
def first_present_and_category(t):
    rich = F.when(F.col("c_acctbal") > 5000, F.col("c_custkey").cast("string"))
    solvent = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))
    category = F.trim(F.upper(F.concat(F.lit(" "), F.lower("c_mktsegment"))))
    return t.customer.select(
        "c_custkey",
        first_present(rich, solvent, F.lit("none")).alias("pick"),
        bands.flag(category.isin("BUILDING", "MACHINERY")).alias("in_category"),
    )


CUSTOMER_MONEY = """
    SELECT o_custkey AS custkey, CAST(max(o_totalprice) AS DECIMAL(18,2)) AS balance,
           CAST(min(floor(o_totalprice / 50)) AS DECIMAL(18,2)) AS amort, CAST(count(*) * 3 + 20 AS INT) AS age,
           CAST(min(o_totalprice) AS DECIMAL(18,2)) AS income,
           CASE WHEN count(*) > 10 THEN 1 WHEN count(*) > 3 THEN 0 END AS payroll
    FROM {orders} GROUP BY o_custkey"""
MONEY_SQL = CUSTOMER_MONEY.replace("{orders}", "orders")
RATES = fixed.AUTO_RATES


def _money(t):
    return t.sql(CUSTOMER_MONEY)


@query(
    f"""SELECT custkey, al_ratecode, term, CAST(least(5000000, round((balance * 4 * 0.4 * 0.75 * 0.4 - amort) * term
                    / (1 + rate_factor) / 1000) * 1000) AS INTEGER) AS amount
        FROM ({MONEY_SQL}) CROSS JOIN (VALUES {RATES}) AS rates(al_ratecode, term, rate_factor)"""
)
def price_auto(t):
    offers = fan_out(_money(t), [{"al_ratecode": c, "term": n, "rate_factor": f} for c, n, f in pricing.AUTO_RATES])
    amount = pricing.auto_loan_amount((F.col("balance") * 4).cast("decimal(18,2)"), "amort", "term", "rate_factor")
    return offers.select("custkey", "al_ratecode", "term", amount.alias("amount"))


@query(
    f"""SELECT custkey, CAST(card_limit AS INTEGER) AS card_limit,
              CASE WHEN card_limit < 150000 THEN 'MasterCard Gold' WHEN card_limit < 1000000 THEN 'MasterCard Platinum'
                   WHEN card_limit >= 1000000 THEN 'MasterCard World' END AS card_type
        FROM (SELECT custkey, CASE WHEN raw >= 35000 THEN least(1000000, round(raw / 1000) * 1000) END AS card_limit
              FROM (SELECT custkey, CASE payroll WHEN 1 THEN CAST(income * 9 AS DOUBLE) WHEN 0 THEN 0.4 * CAST(balance AS DOUBLE) END
                    AS raw FROM ({MONEY_SQL})))"""
)
def price_card(t):
    raw = pricing.card_raw_limit("payroll", F.col("income") * 9, "balance")
    priced = _money(t).withColumn("card_limit", pricing.card_limit(raw))
    return priced.select("custkey", "card_limit", pricing.card_type("card_limit").alias("card_type"))


@query(
    f"""SELECT custkey, round(capacity, 6) AS capacity, years, CAST(least(20000000, floor(capacity * (1 - pow(1.0056667, -12 * years))
                   / 0.0056667::DOUBLE / 1000) * 1000) AS DOUBLE) AS amount
        FROM (SELECT custkey, greatest(CAST(0.4 * balance AS DOUBLE), CAST(income AS DOUBLE)) * 0.75::DOUBLE * 0.5::DOUBLE
                     - CAST(amort AS DOUBLE) AS capacity, least(25, 65 - age) AS years FROM ({MONEY_SQL}))"""
)
def price_home(t):
    priced = _money(t).select(
        "custkey",
        pricing.home_capacity("balance", "income", "amort").alias("capacity"),
        pricing.home_term_years("age").alias("years"),
    )
    return priced.select(
        "custkey",
        F.round("capacity", 6).alias("capacity"),
        "years",
        pricing.home_loan_amount("capacity", "years").alias("amount"),
    )


@query("SELECT c_custkey, 'ALPTB0698B' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS code FROM customer")
def offer_code_build(t):
    return t.customer.select("c_custkey", codes.build_code("AL", "PTB", RUN, "c_custkey").alias("code"))


@query(
    "SELECT c_custkey, 'ALPTB0698B' || lpad(CAST(c_custkey * 50000 AS VARCHAR), 9, '0') AS code, c_custkey * 50000 AS number FROM customer WHERE c_custkey * 50000 < 1000000000"
)
def offer_code_nine_digits(t):
    """A wider sequence, for months with more than 9,999,999 codes: nine digits, and eighteen for numbers past them.

    The SQL text leaves out customers past nine digits; this has every customer.
    """
    wide = t.customer.withColumn("n", F.col("c_custkey") * 50000)
    fits = F.col("n") < 1000000000
    coded = wide.select(
        "c_custkey",
        "n",
        F.when(fits, codes.build_code("AL", "PTB", RUN, "n", digits=9)).otherwise(codes.build_code("AL", "PTB", RUN, "n", digits=18)).alias("code"),
    )
    number = F.when(fits, codes.code_sequence("code", digits=9).cast("long")).otherwise(codes.code_sequence("code", digits=18))
    return coded.select("c_custkey", "code", number.alias("number"))


@query(
    """SELECT bbn, offer_code, CAST(right(offer_code, 7) AS INTEGER) AS number, CAST(substr(offer_code, 6, 2) AS INTEGER) AS month,
              CAST(substr(offer_code, 8, 2) AS INTEGER) AS year,
              CASE WHEN substr(offer_code, 6, 4) = '0698' THEN 1 ELSE 0 END AS in_run_month
       FROM prior_offers""",
    roles=("prior_offers",),
)
def offer_code_parse(t):
    return t.role("prior_offers").select(
        "bbn",
        "offer_code",
        codes.code_sequence("offer_code").alias("number"),
        codes.code_month("offer_code").alias("month"),
        codes.code_year("offer_code").alias("year"),
        codes.in_period("offer_code", RUN).alias("in_run_month"),
    )
