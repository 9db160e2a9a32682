"""The base table and the offer tables, with everything they are made of."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.operators.contract import TableContract
from daymark.operators.joins import active_offers, exclude_active
from daymark.plans import base as B
from daymark.plans import contracts, loans, offers
from daymark.showcase import fixed
from daymark.showcase.registry import query
from daymark.showcase.roles import EVENT_RUN, RUN, TestTables
from daymark.showcase.scalars import EMAIL_SQL, MONTHS
from daymark.showcase.untidy import Arriving
from daymark.shared import settle
from daymark.sources.registry import SOURCES, Sources, load_together

# --- inputs --------------------------------------------------------------------------------------------

CUSTOMER_ROLES = (
    "dim_cust_indiv_pii", "ptbcasatocc", "dosri_distinct", "dim_cust_class", "branch_listing", "depo_segmentation_v2",
    "enfis_bbn", "ref_risk_industry", "df_pm_eq", "auto_applications", "pm_application", "pl_active_accounts",
    "pl_active_accounts_woff", "salad_accounts", "df_abt_customer", "card_applications", "incomeestimatorv2",
    "dim_cust_indiv", "dim_cust_contact", "dim_cust_contact_pii", "dim_cust_address", "dim_cust_address_pii",
    "dim_cust_id_proof", "dim_cust_id_proof_pii", "cust_info", "dim_cust_indiv_employment",
)
BASE_ROLES = ("df_customer_account", "df_adb", "df_cards_accounts", "winnow_b_score_cc", "scpf", *CUSTOMER_ROLES)
ROLE_NAMES = {
    "staging_pm_al_non_grid_application_data": "auto_applications",
    "credit_card_processing_tu": "card_applications",
}


class MartTables:
    """The plan's tables, each derived from the test tables when it is asked for."""

    def __init__(self, tables: TestTables):
        self.tables = tables

    def __getitem__(self, name: str):
        if name.endswith("_offers_for_month"):
            product, kind = name.split("_")[3], name.split("_")[6]
            code = f"{product}{kind}".upper()
            return self.tables.role("prior_offers").where(F.col("offer_code").startswith(code))
        return self.tables.role(ROLE_NAMES.get(name, name))


STORED: dict[tuple[str, str], DataFrame] = {}


def stored_base(tables: TestTables) -> DataFrame:
    """The base table as its own job leaves it: built and written once per application and directory."""
    key = (tables.spark.sparkContext.applicationId, tables.directory)
    if key not in STORED:
        STORED[key] = settle(B.staging_base(MartTables(tables), RUN))
    return STORED[key]


class OfferTables(MartTables):
    """For the offer jobs: the stored base table, and loans with a history."""

    def __init__(self, tables: TestTables):
        super().__init__(tables)
        self.base = stored_base(tables)

    def __getitem__(self, name: str):
        if name == "staging_cross_sell_base":
            return self.base
        if name in ("df_pm_eq", "df_pm_eq_latest"):
            return self.tables.role("df_pm_history")
        return super().__getitem__(name)


# --- oracle text ---------------------------------------------------------------------------------------

ACCOUNT = """account AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY bbnumber, accountnumber ORDER BY credit_card_tag DESC,
                   account_basic_number NULLS FIRST, internal_accountnumber NULLS FIRST, deposit_account_number NULLS FIRST,
                   credit_card_card_no NULLS FIRST, deposit_months_on_books NULLS FIRST,
                   credit_card_months_on_books NULLS FIRST, low_cost_deposit_mtd_adb NULLS FIRST,
                   high_cost_deposit_mtd_adb NULLS FIRST, low_cost_deposit_ob NULLS FIRST,
                   high_cost_deposit_ob NULLS FIRST) AS rn,
               max(CASE WHEN dnc_tag > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY bbnumber, accountnumber) AS dnc
        FROM df_customer_account) WHERE rn = 1)"""
HELD = """held AS (
    SELECT p.bbn, max(CAST(p.product_code = 'AL' AS INTEGER)) AS al, max(CAST(p.product_code = 'HL' AS INTEGER)) AS hl,
           max(CAST(p.product_code = 'CEL' AS INTEGER)) AS csl,
           max(CAST(p.product_code = 'CTS' AND p.mutated_pn_number LIKE '%@BR5LBGSOP%' AS INTEGER)) AS bml,
           max(CASE WHEN a.product_cd = 'AL' AND a.app_create_date BETWEEN DATE '1997-12-01' AND DATE '1998-06-01'
                    THEN 1 ELSE 0 END) AS al6,
           max(CASE WHEN a.product_cd = 'AL' AND a.app_create_date BETWEEN DATE '1997-06-01' AND DATE '1998-06-01'
                    THEN 1 ELSE 0 END) AS al12,
           max(CASE WHEN h.product_code = 'HL' AND h.app_create_date BETWEEN DATE '1997-06-01' AND DATE '1998-06-01'
                    THEN 1 ELSE 0 END) AS hl_app
    FROM df_pm_eq p LEFT JOIN auto_applications a ON p.app_number = a.app_number
    LEFT JOIN pm_application h ON p.app_number = h.app_number
    WHERE p.reporting_date = (SELECT max(reporting_date) FROM df_pm_eq
                              WHERE reporting_date BETWEEN DATE '1998-05-01' AND DATE '1998-05-31')
    GROUP BY 1)"""
MOBILE = "regexp_extract(regexp_replace({0}, '[^0-9]', '', 'g'), '^(?:63|0)?([89][0-9]{{9}})$', 1)"
CONTACT = f"""detail AS (
    SELECT cust_contact_pii_key AS k, contact_details_text AS txt,
           CASE WHEN nat <> '' AND NOT regexp_matches(nat, '^.(0{{9}}|1{{9}}|2{{9}}|3{{9}}|4{{9}}|5{{9}}|6{{9}}|7{{9}}|8{{9}}|9{{9}})$')
                THEN '63' || nat END AS mob,
           CASE WHEN metro <> '' THEN '02' || metro WHEN prov <> '' AND length(prov) = 9 THEN prov END AS land
    FROM (SELECT *, {MOBILE.format("contact_details_text")} AS nat,
                 regexp_extract(regexp_replace(contact_details_text, '[^0-9]', '', 'g'), '^(?:632|2)?([35678][0-9]{{7}})$', 1) AS metro,
                 regexp_extract(regexp_replace(contact_details_text, '[^0-9]', '', 'g'),
                     '^(?:63|0)((?:3[234568]|4[2-9]|5[23456]|6[23458]|7[24578]|8[2-8])[0-9]{{7}})$', 1) AS prov
          FROM dim_cust_contact_pii)),
contact AS (
    SELECT bbn, max(txt) FILTER (WHERE kind = 'Present' AND cat = 'Email Address') AS present_email,
           coalesce(max(mob) FILTER (WHERE kind = 'Present' AND cat = 'Mobile Number 1'),
                    max(mob) FILTER (WHERE kind = 'Permanent' AND cat = 'Mobile Number 1')) AS priority_mobile_no1,
           coalesce(max(mob) FILTER (WHERE kind = 'Present' AND cat = 'Mobile Number 2'),
                    max(mob) FILTER (WHERE kind = 'Permanent' AND cat = 'Mobile Number 2')) AS priority_mobile_no2,
           coalesce(max(mob) FILTER (WHERE kind = 'Present' AND cat = 'Mobile Number 1'),
                    max(mob) FILTER (WHERE kind = 'Present' AND cat = 'Mobile Number 2'),
                    max(mob) FILTER (WHERE kind = 'Present' AND cat = 'Mobile Number 3'),
                    max(mob) FILTER (WHERE kind = 'Permanent' AND cat = 'Mobile Number 1'),
                    max(mob) FILTER (WHERE kind = 'Permanent' AND cat = 'Mobile Number 2'),
                    max(mob) FILTER (WHERE kind = 'Permanent' AND cat = 'Mobile Number 3')) AS priority_mobile_no,
           coalesce(max(land) FILTER (WHERE kind = 'Present' AND cat = 'Landline Number 1'),
                    max(land) FILTER (WHERE kind = 'Permanent' AND cat = 'Landline Number 1')) AS priority_home_landline1,
           max(land) FILTER (WHERE kind = 'Office' AND cat = 'Landline Number 1') AS office_landline1
    FROM (SELECT bbn, cust_contact_key, contact_type_desc AS kind, contact_category_desc AS cat FROM dim_cust_contact)
    LEFT JOIN detail ON cust_contact_key = k GROUP BY 1)"""
ADDRESS = """address AS (
    SELECT bbn, max(zip_code) FILTER (WHERE kind = 'Present') AS present_zip_code,
           max(whole) FILTER (WHERE kind = 'Present') AS present_address,
           max(whole) FILTER (WHERE kind = 'Permanent') AS permanent_address,
           max(whole) FILTER (WHERE kind = 'Office') AS office_address
    FROM (SELECT bbn, zip_code, address_type_desc AS kind,
                 concat_ws(' ', address_line_1_text, address_line_2_text, address_line_3_text) AS whole
          FROM dim_cust_address a LEFT JOIN dim_cust_address_pii d ON a.cust_address_key = d.cust_address_key)
    GROUP BY 1)"""
PROOF = """proof AS (
    SELECT bbn, max(id_type_code) FILTER (WHERE id_category_desc = 'Primary') AS primary_id_type,
           max(id_num_value) FILTER (WHERE id_category_desc = 'Primary') AS primary_id_number
    FROM dim_cust_id_proof p LEFT JOIN dim_cust_id_proof_pii d ON p.cust_id_proof_key = d.cust_id_proof_key GROUP BY 1)"""
CARD = """card AS (
    SELECT card_number, max(b_score_cust) AS score,
           max(CASE WHEN card_generalstatus_code = 'CANC' AND card_generalstatus_updatedate >= TIMESTAMP '1997-06-01'
                    THEN 1 ELSE 0 END) AS cancelled
    FROM df_cards_accounts LEFT JOIN winnow_b_score_cc ON CAST(customer_serno AS VARCHAR) = custserno GROUP BY 1)"""
BALANCE = """balance AS (
    SELECT account_number, avg(outstanding_balance_amt) AS amount FROM df_adb
    WHERE actual_date BETWEEN DATE '1998-03-01' AND DATE '1998-06-01' GROUP BY 1)"""
BRANCH = """branch AS (
    SELECT bbn, acct_origin_branch_code AS branch_code, acct_origin_branch_name AS branch_name, area AS branch_area_code,
           region AS branch_region_name, branchmnemonic AS branch_mnemonic, client_segment_name, cust_category_desc
    FROM dim_cust_class LEFT JOIN branch_listing b ON trim(acct_origin_branch_code) = trim(b.branch_code))"""
CARD_APPLICATION = """card_application AS (
    SELECT bbn, max(CASE WHEN app_create_date BETWEEN DATE '1997-12-01' AND DATE '1998-06-01' THEN 1 ELSE 0 END) AS applied
    FROM card_applications GROUP BY 1)"""
INCOME = """CASE label WHEN '(1) Below 305k' THEN 25416.67 WHEN '(2) 305k to 470k' THEN 32291.67
    WHEN '(3) 470k to 835k' THEN 54375.00 WHEN '(4) 835k to 1.5M' THEN 97291.67 WHEN '(5) 1.5M to 5M' THEN 270833.33
    WHEN '(6) Above 5M' THEN 416666.67 END"""

# how each base column is worked out; alone-standing names are columns of one of the joined inputs
BASE_SQL = {
    "bbn": "a.bbnumber", "acct_basic_num": "a.account_basic_number", "external_acct_num": "a.accountnumber",
    "internal_acct_num": "a.internal_accountnumber", "depo_acct_num": "a.deposit_account_number",
    "credit_card_physical_num": "a.credit_card_card_no", "age": f"CAST(floor({MONTHS.format('birthdate')} / 12) AS INTEGER)",
    "is_with_credit_card_flag": "coalesce(credit_card_tag, 0)", "is_with_al_flag": "coalesce(held.al, 0)",
    "is_with_hl_flag": "coalesce(held.hl, 0)", "is_with_csl_flag": "coalesce(held.csl, 0)",
    "is_with_bml_flag": "coalesce(held.bml, 0)", "is_with_cc_application_flag": "coalesce(applied, 0)",
    "is_with_al_application_6m_flag": "coalesce(al6, 0)", "is_with_al_application_12m_flag": "coalesce(al12, 0)",
    "is_with_hl_application_flag": "coalesce(hl_app, 0)", "depo_mob_count": "coalesce(deposit_months_on_books, 0)",
    "cc_mob_count": "coalesce(credit_card_months_on_books, 0)",
    "deposit_mtd_adb": "coalesce(low_cost_deposit_mtd_adb, high_cost_deposit_mtd_adb)",
    "deposit_ob": "coalesce(low_cost_deposit_ob, high_cost_deposit_ob)",
    "adb_3m_avg": "CAST(coalesce(amount, 0) AS DECIMAL(18,2))",
    "payr_sal_6m_avg": "coalesce(payroll_salary_cr_avg_6m, 0)",
    "total_relationship_balance_value": "coalesce(trb_amt_m0, 0)", "b_score_cc_value": "coalesce(score, 0)::DOUBLE",
    "is_card_canc_12m_flag": "coalesce(cancelled, 0)", "is_dnc_flag": "coalesce(dnc, 0)",
    "is_non_indiv_flag": "CASE WHEN trim(upper(cust_category_desc)) IN ('PARTNERSHIP', 'CORPORATION') THEN 1 ELSE 0 END",
    "is_no_segment_flag": "CASE WHEN new_segment IS NULL THEN 1 ELSE 0 END",
    "is_payroll_acct_flag": "CASE WHEN scai97 = 'Y' THEN 1 ELSE 0 END",
    "is_acct_payroll_like_flag": "CASE WHEN scaig3 = 'Y' THEN 1 ELSE 0 END", "gmi_value": INCOME,
    "cust_mob_count": f"CAST(floor({MONTHS.format('CAST(cust_create_date_ts AS DATE)')}) AS INTEGER)",
    "earliest_acct_open_date": "CAST(cust_create_date_ts AS DATE)",
    "is_mobile_valid_flag": "CASE WHEN coalesce(priority_mobile_no, '') = '' THEN 0 ELSE 1 END",
    "is_email_valid_flag": "CASE WHEN trim(coalesce(present_email, '')) = '' THEN 0 ELSE 1 END",
    "expiry_date": f"CAST(DATE '{RUN}' + 42 AS DATE)", "actual_date": f"DATE '{RUN}'",
}
LISTS = {
    "is_with_pl_flag": ("pl_active_accounts", "bbn"),
    "is_with_pl_acct_woff_flag": ("pl_active_accounts_woff", "bbn"),
    "is_with_salad_flag": ("salad_accounts", "bbn"),
    "is_with_cc_propensity_flag": ("ptbcasatocc", "bbn"),
    "is_dosri_flag": ("dosri_distinct", "bbn_winner"),
    "is_enfis_flag": ("enfis_bbn", "bbn"),
    "is_risk_industry_flag": ("ref_risk_industry", "bbn"),
}


def _base_column(name: str) -> str:
    if name in LISTS:
        table, key = LISTS[name]
        return f"CASE WHEN a.bbnumber IN (SELECT {key} FROM {table}) THEN 1 ELSE 0 END AS {name}"
    return f"{BASE_SQL[name]} AS {name}" if name in BASE_SQL else name


BASE_FROM = """FROM account a LEFT JOIN dim_cust_indiv_pii pii ON a.bbnumber = pii.bbn
    LEFT JOIN branch ON a.bbnumber = branch.bbn LEFT JOIN depo_segmentation_v2 seg ON a.bbnumber = seg.bbnumber
    LEFT JOIN held ON a.bbnumber = held.bbn LEFT JOIN df_abt_customer abt ON a.bbnumber = abt.bbnumber
    LEFT JOIN scpf ON a.internal_accountnumber = trim(scab) || trim(scan) || trim(scas)
    LEFT JOIN card ON a.credit_card_card_no = card.card_number
    LEFT JOIN balance ON a.accountnumber = balance.account_number
    LEFT JOIN card_application ON a.bbnumber = card_application.bbn
    LEFT JOIN incomeestimatorv2 inc ON a.bbnumber = inc.bbn LEFT JOIN dim_cust_indiv ind ON a.bbnumber = ind.bbn
    LEFT JOIN contact ON a.bbnumber = contact.bbn LEFT JOIN address ON a.bbnumber = address.bbn
    LEFT JOIN proof ON a.bbnumber = proof.bbn LEFT JOIN cust_info ci ON a.bbnumber = ci.bbnumber
    LEFT JOIN dim_cust_indiv_employment emp ON a.bbnumber = emp.bbn"""
BASE_CTES = ",\n".join(
    [
        ACCOUNT, HELD, CONTACT, ADDRESS, PROOF, CARD, BALANCE, BRANCH, CARD_APPLICATION,
        f"base AS MATERIALIZED (SELECT {', '.join(map(_base_column, contracts.STAGING_BASE.names))} {BASE_FROM})",
    ]
)


def _shown(contract: TableContract, expressions: Mapping[str, str] | None = None) -> str:
    """Select list of a declared table, in the plain types queries are compared in."""
    expressions = expressions if expressions is not None else {name: name for name in contract.names}
    shown = []
    for column in contract.columns:
        expression = expressions.get(column.name, "NULL")
        kind = column.data_type
        target = "DOUBLE" if kind.startswith(("decimal", "double")) else "INTEGER" if kind == "int" else "VARCHAR"
        shown.append(f"CAST({expression} AS {target}) AS {column.name}")
    return ", ".join(shown)


# --- parts of the base table ----------------------------------------------------------------------------


@query(
    f"""WITH {ACCOUNT} SELECT bbnumber, accountnumber, account_basic_number, credit_card_tag, deposit_months_on_books,
            CAST(low_cost_deposit_ob AS DOUBLE) AS low_cost_deposit_ob, dnc AS dnc_tag FROM account""",
    roles=("df_customer_account",),
)
def account_rows(t):
    return B.accounts(t.role("df_customer_account")).select(
        "bbnumber", "accountnumber", "account_basic_number", "credit_card_tag", "deposit_months_on_books",
        "low_cost_deposit_ob", "dnc_tag",
    )


@query(
    f"""WITH {HELD} SELECT bbn, al AS is_with_al_flag, hl AS is_with_hl_flag, csl AS is_with_csl_flag, bml AS is_with_bml_flag,
            al6 AS is_with_al_application_6m_flag, al12 AS is_with_al_application_12m_flag,
            hl_app AS is_with_hl_application_flag FROM held""",
    roles=("df_pm_eq", "auto_applications", "pm_application"),
)
def product_flags(t):
    return B.product_flags(t.role("df_pm_eq"), t.role("auto_applications"), t.role("pm_application"), RUN)


@query(
    f"WITH {CARD} SELECT card_number, score AS b_score_cust, cancelled AS is_card_canc_12m_flag FROM card",
    roles=("df_cards_accounts", "winnow_b_score_cc"),
)
def card_profile(t):
    return B.card_profile(t.role("df_cards_accounts"), t.role("winnow_b_score_cc"), RUN)


@query(f"WITH {CONTACT} SELECT * FROM contact", roles=("dim_cust_contact", "dim_cust_contact_pii"))
def contact_summary(t):
    return B.contact_summary(t.role("dim_cust_contact"), t.role("dim_cust_contact_pii"))


@query(f"WITH {ADDRESS} SELECT * FROM address", roles=("dim_cust_address", "dim_cust_address_pii"))
def address_summary(t):
    return B.address_summary(t.role("dim_cust_address"), t.role("dim_cust_address_pii"))


@query(f"WITH {PROOF} SELECT * FROM proof", roles=("dim_cust_id_proof", "dim_cust_id_proof_pii"))
def id_summary(t):
    return B.id_summary(t.role("dim_cust_id_proof"), t.role("dim_cust_id_proof_pii"))


@query(f"WITH {BRANCH} SELECT * FROM branch", roles=("dim_cust_class", "branch_listing"))
def branch_summary(t):
    return B.branch_summary(t.role("dim_cust_class"), t.role("branch_listing"))


@query(f"WITH {BASE_CTES} SELECT {_shown(contracts.STAGING_BASE)} FROM base", roles=BASE_ROLES)
def base_wide(t):
    return B.staging_base(MartTables(t), RUN)


@query(f"WITH {BASE_CTES} SELECT {_shown(contracts.CROSS_SELL_BASE)} FROM base", roles=BASE_ROLES)
def base_published(t):
    return B.cross_sell_base(B.staging_base(MartTables(t), RUN))


# the declared reads clean text: edge blanks go, NULL and missing words become empty
READ_CTES = """tidy_class AS (
    SELECT * REPLACE (trim(acct_origin_branch_code) AS acct_origin_branch_code, trim(client_segment_name) AS client_segment_name,
                      trim(cust_category_desc) AS cust_category_desc) FROM dim_cust_class),
tidy_address_pii AS (
    SELECT * REPLACE (coalesce(address_line_2_text, '') AS address_line_2_text) FROM dim_cust_address_pii),
tidy_contact_pii AS (
    SELECT * REPLACE (CASE WHEN lower(contact_details_text) = 'none' THEN '' ELSE contact_details_text END AS contact_details_text)
    FROM dim_cust_contact_pii),
"""
READ_SQL = BASE_CTES
for _name in ("class", "address_pii", "contact_pii"):
    READ_SQL = re.sub(rf"\bdim_cust_{_name}\b", f"tidy_{_name}", READ_SQL)


@query(f"WITH {READ_CTES}{READ_SQL} SELECT {_shown(contracts.STAGING_BASE)} FROM base", roles=BASE_ROLES)
def base_from_sources(t):
    """The base table through its declared reads, over tables with other snapshots, closed versions, untidy text and two rows a customer."""
    return B.staging_base(Sources(Arriving(t, ROLE_NAMES), RUN), RUN)


CONTACT_READS = ("dim_cust_contact", "dim_cust_contact_email", "dim_cust_contact_mobile", "dim_cust_contact_landline")


@query(
    """SELECT read, bbn, cust_contact_key, contact_type_desc, contact_category_desc
       FROM dim_cust_contact, (VALUES ('dim_cust_contact', ''), ('dim_cust_contact_email', 'Email'),
            ('dim_cust_contact_mobile', 'Mobile Number'), ('dim_cust_contact_landline', 'Landline')) AS reads(read, kind),
            (VALUES (1), (2)) AS copies(copy)
       WHERE starts_with(contact_category_desc, kind)""",
    roles=("dim_cust_contact",),
)
def reads_together(t):
    """Four declared reads of one table in one scan."""
    rows = load_together({name: SOURCES[name] for name in CONTACT_READS}, Arriving(t, ROLE_NAMES), RUN)
    return rows.select(F.explode("reads").alias("read"), "bbn", "cust_contact_key", "contact_type_desc", "contact_category_desc")


# --- parts of the offers --------------------------------------------------------------------------------


@query(
    f"""SELECT bbn, offer_code, CAST(expiry_date AS VARCHAR) AS expiry_date FROM prior_offers
        WHERE expiry_date > DATE '{RUN}' AND actual_date <= DATE '{RUN}'""",
    roles=("prior_offers",),
)
def unexpired_offers(t):
    return active_offers(t.role("prior_offers"), RUN, include_run_date=True).select("bbn", "offer_code", "expiry_date")


@query(
    f"""SELECT c_custkey FROM customer WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT bbn FROM prior_offers
            WHERE offer_code LIKE 'CCPTB%' AND expiry_date > DATE '{RUN}' AND actual_date <= DATE '{RUN}')""",
    roles=("prior_offers",),
)
def exclude_active_offers(t):
    customers = t.customer.select("c_custkey", F.col("c_custkey").cast("string").alias("bbn"))
    held = MartTables(t)[offers.offers_name("CC", "PTB")]
    return exclude_active(customers, held, RUN, include_run_date=True).select("c_custkey")


BOOKED = MONTHS.format("booking_date")
AUTO_CHECK = f"""auto_check AS (
    SELECT bbn, sum(CASE WHEN booked_yesno = 1 THEN coalesce(booked_amortization_amount, 0) END) AS amort_all_loans,
           CASE WHEN min({BOOKED}) FILTER (WHERE product_code = 'HL') < 3 OR min({BOOKED}) FILTER (WHERE product_code = 'PL') < 3
                  OR min({BOOKED}) FILTER (WHERE product_code IN ('CTS', 'BEL', 'BML')) < 3 THEN 0 ELSE 1 END AS passed
    FROM df_pm_history WHERE reporting_date = DATE '1998-05-31' AND active_yesno = 1
      AND product_code IN ('HL', 'PL', 'CTS', 'BEL', 'BML') GROUP BY 1)"""
CARD_CHECK = f"""card_check AS (
    SELECT bbn, CASE WHEN min({BOOKED}) FILTER (WHERE product_code IN ('CSL', 'CTS', 'BEL', 'BML', 'SD')) < 6
                       OR min({BOOKED}) FILTER (WHERE product_code IN ('AL', 'PL')) < 4 THEN 0 ELSE 1 END AS passed,
           max(CASE WHEN TRY_CAST(days_past_due AS INTEGER) > 0 THEN 1 ELSE 0 END) AS overdue
    FROM df_pm_history WHERE reporting_date = DATE '1998-05-31' AND active_yesno = 1
      AND product_code IN ('AL', 'HL', 'PL', 'CSL', 'CTS', 'BEL', 'BML', 'SD') GROUP BY 1)"""
HOME_LOANS = f"""home_loans AS (
    SELECT bbn, sum(coalesce(booked_amortization_amount, 0)) AS amort_all_loans,
           sum(CASE WHEN TRY_CAST(days_past_due AS INTEGER) > 0 THEN 1 ELSE 0 END) AS non_current_cnt,
           max(CAST(trunc({BOOKED}) AS INTEGER)) FILTER (WHERE product_code = 'HL') AS hl_mob,
           max(CAST(trunc({BOOKED}) AS INTEGER)) FILTER (WHERE product_code = 'PL') AS pl_mob,
           max(CAST(trunc({BOOKED}) AS INTEGER)) FILTER (WHERE product_code = 'AL') AS al_mob,
           max(CAST(trunc({BOOKED}) AS INTEGER)) FILTER (WHERE product_code IN ('CTS', 'BEL', 'BML')) AS oth_mob,
           max(CAST(product_code IN ('HL', 'AL', 'PL') AS INTEGER)) AS has_hl_al_pl,
           max(CAST(product_code = 'CSL' AS INTEGER)) AS has_csl,
           max(CAST(product_code IN ('CTS', 'BEL', 'BML') AS INTEGER)) AS has_oth
    FROM df_pm_history WHERE active_yesno = 1 AND booked_yesno = 1 GROUP BY 1)"""
RECENT_AUTO = """SELECT DISTINCT bbn FROM df_pm_history WHERE reporting_date = DATE '1998-05-31' AND booked_yesno = 1
    AND product_code IN ('AL', 'CSL', 'SALAD') AND booking_date >= DATE '1998-03-15'"""


@query(
    f"""WITH {AUTO_CHECK} SELECT bbn, CAST(amort_all_loans AS DOUBLE) AS amort_all_loans, passed AS loan_criteria_pass
        FROM auto_check""",
    roles=("df_pm_history",),
)
def auto_loan_checks(t):
    return loans.auto_loan_checks(t.role("df_pm_history"), RUN)


@query(RECENT_AUTO, roles=("df_pm_history",))
def recent_auto_bookings(t):
    return loans.recent_auto_bookings(t.role("df_pm_history"), RUN)


@query(
    f"WITH {CARD_CHECK} SELECT bbn, passed AS loan_criteria_pass, overdue AS non_current_flag FROM card_check",
    roles=("df_pm_history",),
)
def card_loan_checks(t):
    return loans.card_loans(t.role("df_pm_history"), RUN)


@query(
    f"WITH {CARD_CHECK} SELECT bbn, 'good' AS barred FROM card_check WHERE passed = 1 OR overdue = 0 "
    "UNION ALL SELECT bbn, 'bad' FROM card_check WHERE passed = 0 OR overdue = 1",
    roles=("df_pm_history",),
)
def card_loan_exclusions(t):
    """Both readings of the exclusion: as tables were filled, and the opposite."""
    history = t.role("df_pm_history")
    good = loans.card_loan_exclusions(history, RUN).withColumn("barred", F.lit("good"))
    bad = loans.card_loan_exclusions(history, RUN, exclude_good=False).withColumn("barred", F.lit("bad"))
    return good.unionByName(bad)


@query(
    f"WITH {HOME_LOANS} SELECT * REPLACE (CAST(amort_all_loans AS DOUBLE) AS amort_all_loans) FROM home_loans",
    roles=("df_pm_history",),
)
def loan_rollup(t):
    return loans.home_loan_rollup(t.role("df_pm_history"), RUN)


CONTACT_ROLES = ("activity", "lookupmaster", "act_ex1", "lea_ex1")


def _contacted_sql(run_date: str, products: str = "", activity: str = "activity", known: str = "length(trim(lead.lea_ex1_38)) > 0") -> str:
    return f"""contacted AS (
    SELECT bbn, CAST(bool_or(coalesce(reached, FALSE)) AS INTEGER) AS is_contacted FROM (
        SELECT lead.lea_ex1_38 AS bbn, event.statusid IN (
                SELECT lookupid FROM lookupmaster
                WHERE name IN ('For Call Back', 'Interested', 'Not Interested') AND (groupkey, ownerid) = (16, 608))
            AND CASE WHEN upper(event.relatedtotypename) = 'LEAD' THEN TRUE
                WHEN event.layoutid = 200198 OR upper(event.relatedtotypename) = 'OFFER' THEN EXISTS (
                    SELECT 1 FROM act_ex1 WHERE act_ex1_id = event.activityid::VARCHAR AND act_ex1_2 = 'Contacted')
                ELSE FALSE END AS reached
        FROM lea_ex1 lead, {activity} event
        WHERE lead.lea_ex1_id = event.relatedtoid AND {known} AND event.ownerid = 608 {products}
          AND event.createdon >= CAST(DATE '{run_date}' - INTERVAL 3 MONTH AS DATE) AND event.createdon <= DATE '{run_date}')
    GROUP BY bbn)"""


@query(f"WITH {_contacted_sql(EVENT_RUN)} SELECT * FROM contacted", roles=CONTACT_ROLES)
def contacted_flag(t):
    return offers.contacted_customers(*[t.role(name) for name in CONTACT_ROLES], EVENT_RUN)


@query(f"WITH {_contacted_sql(EVENT_RUN, known='lead.lea_ex1_38 IS NOT NULL')} SELECT * FROM contacted", roles=CONTACT_ROLES)
def contacted_keeping_blank(t):
    """Leads with an empty customer number count as one more customer."""
    return offers.contacted_customers(*[t.role(name) for name in CONTACT_ROLES], EVENT_RUN, keep_blank=True)


CARD_PRODUCTS = """AND relatedtoid IN (SELECT leadid FROM leads WHERE productid IN (SELECT productid FROM products
    WHERE (upper(name) LIKE '%CREDIT CARD%' OR upper(name) LIKE '%MASTERCARD%' OR upper(name) LIKE '%MC%')
      AND upper(name) NOT LIKE '%DIMA%' AND upper(name) NOT LIKE '%TIME LOAN%' AND upper(name) NOT LIKE '%CASHLINK%'))"""


@query(
    f"WITH {_contacted_sql(EVENT_RUN, CARD_PRODUCTS)} SELECT * FROM contacted",
    roles=(*CONTACT_ROLES, "leads", "products"),
)
def contacted_for_card_products(t):
    inputs = [t.role(name) for name in CONTACT_ROLES]
    return offers.contacted_customers(*inputs, EVENT_RUN, leads=t.role("leads"), products=t.role("products"))


# --- the offer tables -------------------------------------------------------------------------------------


def _held(code: str, inclusive: bool) -> str:
    sign = "<=" if inclusive else "<"
    return f"""SELECT bbn FROM prior_offers WHERE offer_code LIKE '{code}%' AND expiry_date > DATE '{RUN}'
        AND actual_date {sign} DATE '{RUN}'"""


def _code(code: str, order: str) -> str:
    return f"""'{code}0698B' || lpad(CAST(row_number() OVER (ORDER BY {order}) + (SELECT coalesce(max(CAST(right(offer_code, 7) AS INTEGER)), 0)
        FROM prior_offers WHERE offer_code LIKE '{code}0698%' AND expiry_date > DATE '{RUN}' AND actual_date < DATE '{RUN}')
        AS VARCHAR), 7, '0')"""


def _first_account(condition: str, extra: str = "") -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT base.*, row_number() OVER (PARTITION BY bbn ORDER BY external_acct_num) AS rn
        FROM base WHERE {condition} {extra}) WHERE rn = 1"""


BAND = """CASE WHEN total_relationship_balance_value < 200000 THEN 'a.<200k'
    WHEN total_relationship_balance_value <= 250000 THEN 'b.200k-250k' WHEN total_relationship_balance_value <= 300000 THEN 'c.250k-300k'
    WHEN total_relationship_balance_value <= 350000 THEN 'd.300k-350k' WHEN total_relationship_balance_value <= 400000 THEN 'e.350k-400k'
    WHEN total_relationship_balance_value <= 450000 THEN 'f.400k-450k' WHEN total_relationship_balance_value < 500000 THEN 'g.450k-500k'
    ELSE 'h.>=500k' END"""
TIER = """CASE WHEN age BETWEEN 18 AND 29 THEN 'a.18-29' WHEN age BETWEEN 30 AND 39 THEN 'b.30-39'
    WHEN age BETWEEN 40 AND 49 THEN 'c.40-49' WHEN age >= 50 THEN 'd.50 & up' ELSE 'UNKNOWN' END"""
KNOWN_COUNT = "CAST(birthdate IS NOT NULL AS INTEGER) + " + " + ".join(
    f"CAST(coalesce(trim({c}), '') <> '' AS INTEGER)"
    for c in ("mothers_maiden_name", "present_address", "office_address", "present_email")
)
STP_COMMON = {
    **{n: n for n in (
        "offer_code", "bbn", "expiry_date", "full_name", "last_name", "first_name", "middle_name", "earliest_acct_open_date", "age",
        "branch_mnemonic", "branch_name", "new_segment", "employer_name", "present_address", "permanent_address", "office_landline1",
        "actual_date",
    )},
    "branch_region": "branch_region_name", "branch_area": "branch_area_code", "accountnumber": "depo_acct_num",
    "trb": "total_relationship_balance_value", "trb_bucket": BAND, "age_tier": TIER,
    "age_70": "CASE WHEN age >= 70 THEN 1 ELSE 0 END", "timezone": "'Asia/Manila'", "email": "present_email",
    "date_of_birth": "birthdate", "zipcode": "present_zip_code", "occupation": "occupation_details_text", "tin": "tin_comptin",
    "place_of_birth": "birth_place_name", "id_type": "primary_id_type", "id_number": "primary_id_number",
    "mother_maiden_name": "mothers_maiden_name", "employer_address": "office_address", "nature_of_business": "nature_of_work_code",
    "mobile_no": "priority_mobile_no1", "mobile_no2": "priority_mobile_no2", "home_landline1": "priority_home_landline1",
}


def _decoded(default: str) -> dict[str, str]:
    employment = f"""CASE employment_type_code WHEN '0' THEN 'Employed' WHEN '1' THEN 'Self-employed'
        WHEN '2' THEN 'Unemployed' {default} END"""
    return {
        "gender": f"CASE gender_code WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' {default} END",
        "civil_status": f"""CASE civil_status_code WHEN '0' THEN 'Single' WHEN '1' THEN 'Married' WHEN '2' THEN 'Separated'
            WHEN '3' THEN 'Widowed' {default} END""",
        "employment_type": employment,
        "employment_status": employment,
    }


OFFER_ROLES = (*BASE_ROLES, "df_pm_history", "prior_offers")
RATES = fixed.AUTO_RATES
AUTO_RULES = """is_with_al_flag = 0 AND is_with_salad_flag = 0 AND is_with_csl_flag = 0 AND depo_mob_count >= 3 AND age BETWEEN 21 AND 62
    AND adb_3m_avg >= 100000 AND deposit_ob >= 10000 AND is_with_pl_acct_woff_flag = 0 AND is_non_indiv_flag = 0 AND is_dosri_flag = 0
    AND is_enfis_flag = 0 AND is_risk_industry_flag = 0 AND b_score_cc_value >= 581 AND is_with_pl_flag = 0
    AND upper(trim(client_segment_name)) <> 'WEALTH' AND is_with_al_application_6m_flag <> 1 AND is_with_cc_application_flag <> 1
    AND trim(full_name) <> ''"""
AUTO_AMOUNT = """CAST(least(5000000, round((adb_3m_avg * 0.4 * 0.75 * 0.4 - coalesce(amort_all_loans, 0)) * term
    / (1 + rate_factor) / 1000) * 1000) AS INTEGER)"""
AUTO_STP = {
    **STP_COMMON, "term": "term", "al_ratecode": "al_ratecode", "max_loan_amount": "max_loan_amount", "offer_type": "'STP'",
    "product_crm": "'AL'", "spiel_id": "'Auto Loan STP'", "gender": "gender_code", "civil_status": "civil_status_code",
    "employment_type": "employment_type_code", "employment_status": "employment_type_code",
}


@query(
    f"""WITH {BASE_CTES}, {AUTO_CHECK}, chosen AS ({_first_account(AUTO_RULES)}),
        priced AS (SELECT chosen.*, al_ratecode, term, {AUTO_AMOUNT} AS max_loan_amount
            FROM chosen JOIN auto_check ON chosen.bbn = auto_check.bbn CROSS JOIN (VALUES {RATES}) AS rates(al_ratecode, term, rate_factor)
            WHERE passed = 1 AND chosen.bbn NOT IN ({RECENT_AUTO}) AND chosen.bbn NOT IN ({_held("ALSTP", False)})),
        coded AS (SELECT *, {_code("ALSTP", "bbn, al_ratecode, term")} AS offer_code FROM priced
            WHERE max_loan_amount BETWEEN 400000 AND 5000000)
        SELECT {_shown(contracts.AL_STP, AUTO_STP)} FROM coded""",
    roles=OFFER_ROLES,
)
def stp_auto(t):
    return offers.auto_stp(OfferTables(t), RUN)


CARD_RULES = """is_non_indiv_flag = 0 AND is_dosri_flag = 0 AND is_enfis_flag = 0 AND is_dnc_flag = 0 AND is_risk_industry_flag = 0
    AND client_segment_name <> 'WEALTH' AND is_card_canc_12m_flag = 0 AND is_with_credit_card_flag = 0 AND is_with_cc_application_flag = 0
    AND is_with_cc_propensity_flag = 1 AND age BETWEEN 21 AND 62 AND adb_3m_avg >= 31250 AND is_with_pl_acct_woff_flag = 0
    AND (is_payroll_acct_flag = 1 AND depo_mob_count >= 12 OR is_payroll_acct_flag = 0 AND depo_mob_count >= 3)"""
CARD_STP = {
    **STP_COMMON, **_decoded(""), "card_type": "card_type", "credit_limit": "credit_limit", "offer_type": "'STP'", "product_crm": "'CC'",
    "spiel_id": "'MC ' || split_part(card_type, ' ', 2)", "pid_count": KNOWN_COUNT,
}


@query(
    f"""WITH {BASE_CTES}, {CARD_CHECK},
        chosen AS ({_first_account(CARD_RULES, "AND bbn NOT IN (SELECT bbn FROM card_check WHERE passed = 1 OR overdue = 0)")}),
        priced AS (SELECT *, CAST(least(1000000, round(raw / 1000) * 1000) AS INTEGER) AS credit_limit FROM (
            SELECT *, CASE WHEN is_payroll_acct_flag = 1 THEN CAST(payr_sal_6m_avg AS DOUBLE) ELSE 0.4 * CAST(adb_3m_avg AS DOUBLE) END AS raw
            FROM chosen) WHERE raw >= 35000),
        coded AS (SELECT *, CASE WHEN credit_limit < 150000 THEN 'MasterCard Gold' WHEN credit_limit < 1000000 THEN 'MasterCard Platinum'
                ELSE 'MasterCard World' END AS card_type, {_code("CCSTP", "bbn")} AS offer_code
            FROM priced WHERE bbn NOT IN ({_held("CCSTP", False)}))
        SELECT {_shown(contracts.CC_STP, CARD_STP)} FROM coded""",
    roles=OFFER_ROLES,
)
def stp_card(t):
    return offers.card_stp(OfferTables(t), RUN)


HOME_RULES = """is_non_indiv_flag = 0 AND is_dosri_flag = 0 AND is_enfis_flag = 0 AND is_dnc_flag = 0 AND is_risk_industry_flag = 0
    AND client_segment_name <> 'wealth' AND age BETWEEN 21 AND 55 AND is_with_salad_flag = 0 AND is_with_csl_flag = 0
    AND is_with_pl_acct_woff_flag = 0 AND adb_3m_avg >= 125000 AND (b_score_cc_value <= 0 OR b_score_cc_value >= 581)"""
# amounts as text keep one decimal; the capacity is compared as a number
HOME_STP = {
    **STP_COMMON, **_decoded("ELSE ''"), "max_loan_term": "least(25, 65 - age)", "program_offer_type": "'DEPO TO HL CROSS SELL'",
    "hl_ratecode": "'STP'", "max_loan_amount": "CAST(CAST(amount AS BIGINT) AS VARCHAR) || '.0'", "max_amortization": "round(capacity, 3)",
    "product_crm": "'HL'", "spiel_id": "'HL'", "pid_count": KNOWN_COUNT,
}


@query(
    f"""WITH {BASE_CTES}, {HOME_LOANS}, chosen AS ({_first_account(HOME_RULES)}),
        priced AS (SELECT *, least(20000000, floor(capacity * (1 - pow(1.0056667, -12 * least(25, 65 - age))) / 0.0056667::DOUBLE / 1000)
                * 1000) AS amount
            FROM (SELECT chosen.*, greatest(CAST(0.4 * adb_3m_avg AS DOUBLE), CAST(gmi_value AS DOUBLE)) * 0.75::DOUBLE * 0.5::DOUBLE
                         - CAST(coalesce(amort_all_loans, 0) AS DOUBLE) AS capacity
                  FROM chosen LEFT JOIN home_loans ON chosen.bbn = home_loans.bbn
                  WHERE coalesce(has_hl_al_pl, 0) = 0 AND (oth_mob IS NULL OR oth_mob >= 6))),
        coded AS (SELECT *, {_code("HLSTP", "bbn")} AS offer_code FROM priced
            WHERE amount >= 1000000 AND bbn NOT IN ({_held("HLSTP", False)}))
        SELECT * REPLACE (CAST(max_amortization AS DOUBLE) AS max_amortization)
        FROM (SELECT {_shown(contracts.HL_STP, HOME_STP)} FROM coded)""",
    roles=OFFER_ROLES,
)
def stp_home(t):
    amounts = offers.home_stp(OfferTables(t), RUN)
    return amounts.withColumn("max_amortization", F.round(F.col("max_amortization").cast("double"), 3))


LIKELY_COMMON = {
    **{n: n for n in ("bbn", "full_name", "branch_code", "branch_name", "branch_area_code", "branch_region_name", "first_name", "last_name",
                      "middle_name", "offer_code", "expiry_date", "actual_date", "total_relationship_balance_value", "cust_mob_count")},
    "email_address_text": "present_email", "mobile_num_value": "priority_mobile_no", "client_segment_code": "client_segment_name",
    "deposit_segment_current_desc": "new_segment", "offer_type_desc": "'PTB'",
    "is_dnc_flag": "CASE WHEN is_dnc_flag = 1 THEN 'Y' ELSE 'N' END",
    "is_email_valid_flag": EMAIL_SQL.format("present_email"),
    "is_for_branch_flag": "CASE WHEN new_segment <> 'MASS MARKET' AND trim(priority_mobile_no) <> '' THEN 'Y' ELSE 'N' END",
}
MOBILE_FLAG = "CASE WHEN trim(priority_mobile_no) <> '' THEN 'Y' ELSE 'N' END"
AUTO_PTB = {
    **LIKELY_COMMON, "is_mobile_valid_flag": MOBILE_FLAG, "product_crm_code": "'AL'", "spiel_id_desc": "'AL Propensity'",
    "al_propensity_label_desc": "CASE WHEN propensity >= 0.6 THEN 'HIGH' WHEN propensity BETWEEN 0.3 AND 0.6 THEN 'MID' "
                                "WHEN propensity <= 0.3 THEN 'LOW' END",
}
AUTO_PTB_RULES = """is_non_indiv_flag = 0 AND is_with_al_application_12m_flag = 0 AND is_dosri_flag = 0 AND is_no_segment_flag = 0
    AND is_with_al_flag = 0 AND upper(trim(client_segment_name)) <> 'WEALTH' AND age BETWEEN 20 AND 64 AND trim(full_name) <> ''
    AND upper(full_name) NOT LIKE '%EMP NO%' AND upper(full_name) NOT LIKE '%EMPLOY%'"""


@query(
    f"""WITH {BASE_CTES}, chosen AS ({_first_account(AUTO_PTB_RULES)}),
        coded AS (SELECT *, {_code("ALPTB", "bbn")} AS offer_code FROM chosen WHERE bbn NOT IN ({_held("ALSTP", True)})
            AND bbn NOT IN ({_held("CCPTB", True)}) AND bbn NOT IN ({_held("ALPTB", False)}))
        SELECT {_shown(contracts.AL_PTB, {**AUTO_PTB, "bbn": "coded.bbn"})} FROM coded
        LEFT JOIN ptbcasatoal p ON coded.bbn = p.bbn""",
    roles=(*OFFER_ROLES, "ptbcasatoal"),
)
def ptb_auto(t):
    return offers.auto_ptb(OfferTables(t), RUN, blocked_mailboxes=["blocked+test"])


CARD_PTB_RULES = """trim(bbn) <> '' AND is_non_indiv_flag = 0 AND is_with_cc_propensity_flag = 1 AND is_dosri_flag = 0
    AND is_with_credit_card_flag = 0 AND is_with_cc_application_flag = 0 AND upper(trim(client_segment_name)) <> 'WEALTH'
    AND age BETWEEN 21 AND 62"""
CARD_PTB = {
    **LIKELY_COMMON, "bbn": "coded.bbn", "deposit_cluster_desc": "cluster_name", "product_crm_code": "'CC'",
    "spiel_id_desc": "'Cards Propensity'", "is_cust_contacted_3m_flag": "coalesce(is_contacted, 0)",
}


class CampaignTables(OfferTables):
    """The activity of the event month, moved to the run date of the offers."""

    def __getitem__(self, name: str):
        df = super().__getitem__(name)
        return df.withColumn("createdon", F.date_sub("createdon", CAMPAIGN_SHIFT)) if name == "activity" else df


CAMPAIGN_SHIFT = 9350  # days from the events to the orders' run date


@query(
    f"""WITH {BASE_CTES}, {_contacted_sql(RUN, activity=f"(SELECT * REPLACE (createdon - {CAMPAIGN_SHIFT} AS createdon) FROM activity)")},
        chosen AS ({_first_account(CARD_PTB_RULES)}),
        coded AS (SELECT *, {_code("CCPTB", "bbn")} AS offer_code FROM chosen WHERE bbn NOT IN ({_held("CCSTP", True)})
            AND bbn NOT IN ({_held("CCPTB", False)}))
        SELECT {_shown(contracts.CC_PTB, CARD_PTB)} FROM coded LEFT JOIN depo_clusters_v2 d ON coded.bbn = d.bbnumber
        LEFT JOIN contacted ON coded.bbn = contacted.bbn""",
    roles=(*OFFER_ROLES, "depo_clusters_v2", *CONTACT_ROLES),
)
def ptb_card(t):
    return offers.card_ptb(CampaignTables(t), RUN)


HOME_PTB_RULES = """is_non_indiv_flag = 0 AND is_with_hl_application_flag = 0 AND is_dosri_flag = 0 AND is_no_segment_flag = 0
    AND is_with_hl_flag = 0 AND client_segment_name <> 'wealth' AND age BETWEEN 21 AND 65"""
HOME_PTB = {
    **LIKELY_COMMON, "bbn": "coded.bbn", "is_mobile_num_valid_flag": MOBILE_FLAG, "product_crm_code": "'HL'", "spiel_id_desc": "'HL Propensity'",
    "hl_propensity_label_desc": "CASE WHEN hl_propensity_score >= 0.6 THEN 'HIGH' WHEN hl_propensity_score > 0.3 THEN 'MID' "
                                "WHEN hl_propensity_score <= 0.3 THEN 'LOW' END",
}


@query(
    f"""WITH {BASE_CTES}, chosen AS ({_first_account(HOME_PTB_RULES)}),
        coded AS (SELECT *, {_code("HLPTB", "bbn")} AS offer_code FROM chosen WHERE bbn NOT IN ({_held("HLSTP", True)})
            AND bbn NOT IN ({_held("ALPTB", True)}) AND bbn NOT IN ({_held("CCPTB", True)}) AND bbn NOT IN ({_held("HLPTB", False)}))
        SELECT {_shown(contracts.HL_PTB, HOME_PTB)} FROM coded LEFT JOIN casatohlptb p ON coded.bbn = p.bbn""",
    roles=(*OFFER_ROLES, "casatohlptb"),
)
def ptb_home(t):
    return offers.home_ptb(OfferTables(t), RUN, blocked_mailboxes=["blocked+test"])
