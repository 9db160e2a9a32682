"""Source tables of the marts, derived from the test tables.

Each role is one SQL text that Spark and DuckDB both read, so the Spark query and its oracle start from
the same rows. ``{customer}`` and the like stand for the test tables. The operators themselves are written
twice: with this package for Spark, by hand in SQL for the oracle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

RUN = "1998-06-15"
EVENT_RUN = "2024-01-20"

ROLES: dict[str, str] = {
    # every line of an order is one copy of the customer's account row
    "df_customer_account": """
        SELECT CAST(o.o_custkey AS STRING) AS bbnumber,
               'B' || CAST(o.o_orderkey AS STRING) AS account_basic_number,
               CAST(o.o_orderkey AS STRING) AS accountnumber,
               '7' || CAST(o.o_orderkey AS STRING) || '01' AS internal_accountnumber,
               'D' || CAST(o.o_orderkey AS STRING) AS deposit_account_number,
               CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'C' || CAST(o.o_orderkey AS STRING) ELSE '' END
                   AS credit_card_card_no,
               CASE WHEN o.o_orderpriority = '1-URGENT' AND l.l_returnflag = 'A' THEN 1 ELSE 0 END
                   AS credit_card_tag,
               CAST(l.l_quantity AS INT) AS deposit_months_on_books,
               CAST(l.l_linenumber AS INT) AS credit_card_months_on_books,
               CASE WHEN l.l_linestatus = 'O' THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) END
                   AS low_cost_deposit_mtd_adb,
               CAST(o.o_totalprice AS DECIMAL(18,2)) AS high_cost_deposit_mtd_adb,
               CASE WHEN l.l_linestatus = 'F' THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) END
                   AS low_cost_deposit_ob,
               CAST(o.o_totalprice AS DECIMAL(18,2)) AS high_cost_deposit_ob,
               CASE WHEN l.l_returnflag = 'R' AND l.l_discount > 0.08 THEN 1 ELSE 0 END AS dnc_tag,
               CAST(o.o_orderdate AS DATE) AS reporting_date
        FROM {orders} o JOIN {lineitem} l ON o.o_orderkey = l.l_orderkey
        WHERE CAST(o.o_orderdate AS DATE) <= DATE '1998-06-15'""",
    # every order is a loan, reported at the end of its month
    "df_pm_eq": """
        SELECT CAST(o_custkey AS STRING) AS bbn,
               CAST(o_orderkey AS STRING) AS app_number,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'AL' WHEN '2-HIGH' THEN 'HL' WHEN '3-MEDIUM' THEN 'CEL'
                    WHEN '4-NOT SPECIFIED' THEN 'CTS' ELSE 'PL' END AS product_code,
               CASE WHEN o_orderstatus = 'O' THEN 'N@BR5LBGSOP1' ELSE 'N1' END AS mutated_pn_number,
               CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END AS active_yesno,
               CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END AS booked_yesno,
               CAST(o_orderdate AS DATE) AS booking_date,
               CAST(floor(o_totalprice / 100) AS DECIMAL(18,2)) AS booked_amortization_amount,
               CASE WHEN o_totalprice > 400000 THEN '30' WHEN o_totalprice > 300000 THEN 'n/a' ELSE '0' END
                   AS days_past_due,
               last_day(CAST(o_orderdate AS DATE)) AS reporting_date
        FROM {orders}""",
    # older loans on the books at the last month end, for the exclusion tests
    "df_pm_history": """
        SELECT CAST(o_custkey AS STRING) AS bbn,
               CAST(o_orderkey AS STRING) AS app_number,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'CSL' WHEN '2-HIGH' THEN 'HL' WHEN '3-MEDIUM' THEN 'BEL'
                    WHEN '4-NOT SPECIFIED' THEN 'CTS' ELSE 'PL' END AS product_code,
               'N1' AS mutated_pn_number,
               CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS active_yesno,
               CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS booked_yesno,
               CAST(o_orderdate AS DATE) AS booking_date,
               CAST(floor(o_totalprice / 100) AS DECIMAL(18,2)) AS booked_amortization_amount,
               CASE WHEN o_totalprice > 450000 THEN '30' ELSE '0' END AS days_past_due,
               DATE '1998-05-31' AS reporting_date
        FROM {orders}
        WHERE CAST(o_orderdate AS DATE) <= DATE '1998-05-31'""",
    "auto_applications": """
        SELECT CAST(o_orderkey AS STRING) AS app_number,
               CASE WHEN o_orderstatus = 'P' THEN 'AL' ELSE 'PL' END AS product_cd,
               CAST(o_orderdate AS DATE) AS app_create_date
        FROM {orders}""",
    "pm_application": """
        SELECT CAST(l_orderkey AS STRING) AS app_number,
               CASE WHEN l_returnflag = 'N' THEN 'HL' ELSE 'AL' END AS product_code,
               CAST(l_shipdate AS DATE) AS app_create_date
        FROM {lineitem}""",
    "card_applications": """
        SELECT CAST(o_custkey AS STRING) AS bbn, CAST(o_orderdate AS DATE) AS app_create_date,
               CAST(o_orderdate AS DATE) AS business_date
        FROM {orders} WHERE o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM'""",
    "df_adb": """
        SELECT CAST(l_orderkey AS STRING) AS account_number,
               CAST(l_extendedprice * 10 AS DECIMAL(18,2)) AS outstanding_balance_amt,
               CAST(l_shipdate AS DATE) AS actual_date
        FROM {lineitem}""",
    "df_cards_accounts": """
        SELECT 'C' || CAST(o_orderkey AS STRING) AS card_number, CAST(o_custkey AS INT) AS customer_serno,
               CASE WHEN o_orderstatus = 'F' THEN 'CANC' ELSE 'ACTV' END AS card_generalstatus_code,
               CAST(o_orderdate AS TIMESTAMP) AS card_generalstatus_updatedate
        FROM {orders} WHERE o_orderpriority = '1-URGENT'""",
    "winnow_b_score_cc": """
        SELECT CAST(c_custkey AS STRING) AS custserno, CAST(floor(c_acctbal / 8) AS DOUBLE) AS b_score_cust
        FROM {customer}""",
    "dosri_distinct": "SELECT CAST(c_custkey AS STRING) AS bbn_winner FROM {customer} WHERE c_acctbal < -900",
    "enfis_bbn": "SELECT CAST(c_custkey AS STRING) AS bbn FROM {customer} WHERE c_acctbal BETWEEN 100 AND 200",
    "ref_risk_industry": "SELECT CAST(c_custkey AS STRING) AS bbn FROM {customer} WHERE c_nationkey = 7",
    "pl_active_accounts": """
        SELECT CAST(o_custkey AS STRING) AS bbn FROM {orders}
        WHERE o_orderpriority = '5-LOW' AND o_totalprice > 450000""",
    "pl_active_accounts_woff": "SELECT CAST(c_custkey AS STRING) AS bbn FROM {customer} WHERE c_acctbal < -950",
    "salad_accounts": "SELECT CAST(c_custkey AS STRING) AS bbn FROM {customer} WHERE c_acctbal BETWEEN 300 AND 400",
    "ptbcasatocc": "SELECT CAST(c_custkey AS STRING) AS bbn FROM {customer} WHERE c_acctbal > 1000",
    "ptbcasatoal": """
        SELECT CAST(c_custkey AS STRING) AS bbn, round(c_acctbal / 10000, 1) AS propensity FROM {customer}""",
    "casatohlptb": """
        SELECT CAST(c_custkey AS STRING) AS bbn, round(c_acctbal / 10000, 1) AS hl_propensity_score
        FROM {customer}""",
    "depo_segmentation_v2": """
        SELECT CAST(c_custkey AS STRING) AS bbnumber,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'MASS MARKET' ELSE c_mktsegment END AS new_segment
        FROM {customer} WHERE c_acctbal > -800""",
    "depo_clusters_v2": """
        SELECT CAST(c_custkey AS STRING) AS bbnumber, 'Cluster ' || c_mktsegment AS cluster_name
        FROM {customer} WHERE c_acctbal < 9000""",
    "incomeestimatorv2": """
        SELECT CAST(c_custkey AS STRING) AS bbn,
               CASE WHEN c_acctbal < 0 THEN '(1) Below 305k' WHEN c_acctbal < 2000 THEN '(2) 305k to 470k'
                    WHEN c_acctbal < 4000 THEN '(3) 470k to 835k' WHEN c_acctbal < 6000 THEN '(4) 835k to 1.5M'
                    WHEN c_acctbal < 8000 THEN '(5) 1.5M to 5M' WHEN c_acctbal < 9900 THEN '(6) Above 5M'
                    ELSE 'unrated' END AS label
        FROM {customer}""",
    "df_abt_customer": """
        SELECT CAST(c_custkey AS STRING) AS bbnumber,
               CAST(c_acctbal * 30 AS DECIMAL(18,2)) AS payroll_salary_cr_avg_6m,
               CAST(c_acctbal * 60 AS DECIMAL(18,2)) AS trb_amt_m0
        FROM {customer}""",
    "scpf": """
        SELECT '7 ' AS scab, ' ' || CAST(o_orderkey AS STRING) || ' ' AS scan, ' 01' AS scas,
               CASE WHEN o_orderstatus = 'O' THEN 'Y' ELSE 'N' END AS scai97,
               CASE WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END AS scaig3
        FROM {orders}""",
    "cust_info": """
        SELECT CAST(c_custkey AS STRING) AS bbnumber, lpad(CAST(c_custkey AS STRING), 9, '0') AS tin_comptin
        FROM {customer} WHERE c_acctbal > 0""",
    "dim_cust_indiv_pii": """
        SELECT CAST(c_custkey AS STRING) AS bbn,
               CASE WHEN c_acctbal > 9900 THEN 'EMP NO. ' || CAST(c_custkey AS STRING) ELSE c_name END AS full_name,
               substring(c_name, 1, 8) AS first_name, CAST(c_nationkey AS STRING) AS middle_name,
               substring(c_name, 10, 9) AS last_name,
               DATE '1930-01-01' + CAST(floor(c_acctbal + 1000) AS INT) * 2 AS birthdate,
               CASE WHEN c_nationkey < 12 THEN 'M' || CAST(c_custkey AS STRING) ELSE '' END AS mothers_maiden_name,
               'Place ' || CAST(c_nationkey AS STRING) AS birth_place_name
        FROM {customer}""",
    "dim_cust_indiv": """
        SELECT CAST(c_custkey AS STRING) AS bbn,
               CAST(DATE '1985-03-31' + c_nationkey * 100 AS TIMESTAMP) AS cust_create_date_ts,
               CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'F' WHEN c_mktsegment = 'MACHINERY' THEN 'X'
                    ELSE 'M' END AS gender_code,
               CASE WHEN c_nationkey < 6 THEN '0' WHEN c_nationkey < 12 THEN '1' WHEN c_nationkey < 18 THEN '2'
                    WHEN c_nationkey < 24 THEN '3' ELSE '9' END AS civil_status_code,
               CASE WHEN c_nationkey < 10 THEN '0' WHEN c_nationkey < 20 THEN '1' ELSE '2' END AS employment_type_code
        FROM {customer}""",
    "dim_cust_indiv_employment": """
        SELECT CAST(c_custkey AS STRING) AS bbn, 'Employer ' || c_mktsegment AS employer_name,
               'Job ' || CAST(c_nationkey AS STRING) AS occupation_details_text,
               CAST(c_nationkey AS STRING) AS nature_of_work_code
        FROM {customer} WHERE c_acctbal < 9500""",
    "dim_cust_class": """
        SELECT CAST(c_custkey AS STRING) AS bbn, ' ' || CAST(n_nationkey AS STRING) AS acct_origin_branch_code,
               n_name AS acct_origin_branch_name,
               CASE WHEN c_mktsegment = 'FURNITURE' AND c_acctbal > 5000 THEN 'Wealth ' ELSE 'RETAIL' END
                   AS client_segment_name,
               CASE WHEN c_acctbal > 9800 THEN ' Corporation' ELSE 'Individual' END AS cust_category_desc
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "branch_listing": """
        SELECT CAST(n_nationkey AS STRING) || ' ' AS branch_code, r_name AS area, n_name AS region,
               substring(r_name, 1, 3) || CAST(n_nationkey AS STRING) AS branchmnemonic
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "dim_cust_contact": """
        SELECT CAST(c_custkey AS STRING) AS bbn, CAST(c_custkey AS STRING) || '-' || slot AS cust_contact_key,
               kind AS contact_type_desc, category AS contact_category_desc
        FROM {customer} <slots>""",
    "dim_cust_contact_pii": """
        SELECT CAST(c_custkey AS STRING) || '-' || slot AS cust_contact_pii_key,
               CASE slot
                   WHEN '1' THEN 'user' || CAST(c_custkey AS STRING) ||
                        CASE WHEN c_mktsegment = 'BUILDING' THEN '@gmail.com' WHEN c_mktsegment = 'HOUSEHOLD' THEN ''
                             WHEN c_mktsegment = 'MACHINERY' THEN '@example.org' ELSE '@yahoo.com.ph' END
                   WHEN '2' THEN CASE WHEN c_nationkey < 15
                        THEN '0917-' || lpad(CAST(c_custkey AS STRING), 7, '0') ELSE 'none' END
                   WHEN '3' THEN '+63 918 ' || lpad(CAST(c_custkey AS STRING), 7, '0')
                   WHEN '4' THEN '9' || lpad(CAST(c_custkey AS STRING), 9, '7')
                   WHEN '5' THEN CASE WHEN c_nationkey < 8 THEN '8' || lpad(CAST(c_custkey AS STRING), 7, '0')
                        ELSE '0' || CAST(c_nationkey + 30 AS STRING) || lpad(CAST(c_custkey AS STRING), 7, '1') END
                   WHEN '6' THEN '(632) 5' || lpad(CAST(c_custkey AS STRING), 7, '4')
                   ELSE '12345' END AS contact_details_text
        FROM {customer} <slots>""",
    "dim_cust_address": """
        SELECT CAST(o_custkey AS STRING) AS bbn, CAST(o_orderkey AS STRING) AS cust_address_key,
               CASE o_orderstatus WHEN 'O' THEN 'Present' WHEN 'P' THEN 'Permanent' ELSE 'Office' END
                   AS address_type_desc,
               lpad(CAST(o_custkey AS STRING), 4, '0') AS zip_code
        FROM {orders} WHERE o_totalprice > 200000""",
    "dim_cust_address_pii": """
        SELECT CAST(o_orderkey AS STRING) AS cust_address_key, CAST(o_orderkey AS STRING) || ' Street'
                   AS address_line_1_text,
               CASE WHEN o_totalprice > 300000 THEN 'Unit 2' END AS address_line_2_text,
               o_orderpriority AS address_line_3_text
        FROM {orders}""",
    "dim_cust_id_proof": """
        SELECT CAST(o_custkey AS STRING) AS bbn, CAST(o_orderkey AS STRING) AS cust_id_proof_key,
               CASE WHEN o_orderstatus = 'P' THEN 'Primary' ELSE 'Secondary' END AS id_category_desc,
               substring(o_orderpriority, 1, 1) AS id_type_code
        FROM {orders}""",
    "dim_cust_id_proof_pii": """
        SELECT CAST(o_orderkey AS STRING) AS cust_id_proof_key, 'ID' || CAST(o_orderkey AS STRING) AS id_num_value
        FROM {orders}""",
    # earlier offers: customers who ordered lately hold a code numbered by their key
    "prior_offers": """
        SELECT CAST(o_custkey AS STRING) AS bbn,
               kind.prefix || CASE WHEN CAST(o_orderdate AS DATE) >= DATE '1998-06-01' THEN '0698' ELSE '0598' END
                   || 'B' || lpad(CAST(o_custkey AS STRING), 7, '0') AS offer_code,
               CAST(o_orderdate AS DATE) + 42 AS expiry_date, CAST(o_orderdate AS DATE) AS actual_date
        FROM {orders} JOIN (VALUES ('ALSTP', '1-URGENT'), ('CCSTP', '2-HIGH'), ('HLSTP', '3-MEDIUM'),
               ('ALPTB', '4-NOT SPECIFIED'), ('CCPTB', '5-LOW'), ('HLPTB', '1-URGENT')) AS kind(prefix, priority)
          ON o_orderpriority = kind.priority
        WHERE CAST(o_orderdate AS DATE) > DATE '1998-04-15'
          AND CAST(o_orderdate AS DATE) <= DATE '1998-06-15'""",
    # campaign activity from the event stream: a user's event is a contact attempt on the lead of that user
    "activity": """
        SELECT event_id AS activityid, CAST(ts AS DATE) AS createdon, user_id AS relatedtoid,
               CASE event_type WHEN 'click' THEN 'Offer' WHEN 'view' THEN 'LEAD' ELSE 'Task' END AS relatedtotypename,
               CASE WHEN event_type = 'purchase' THEN 200198 ELSE 1 END AS layoutid,
               CASE WHEN value < 10 THEN 1 WHEN value < 30 THEN 2 ELSE 3 END AS statusid,
               CASE WHEN value < 60 THEN 608 ELSE 1 END AS ownerid
        FROM {events}""",
    "lookupmaster": """
        SELECT r_regionkey AS lookupid, CASE WHEN r_regionkey < 4 THEN 16 ELSE 17 END AS groupkey, 608 AS ownerid,
               CASE r_regionkey WHEN 1 THEN 'Interested' WHEN 2 THEN 'For Call Back' ELSE 'No Answer' END AS name
        FROM {region}""",
    "act_ex1": """
        SELECT CAST(event_id AS STRING) AS act_ex1_id,
               CASE WHEN value > 5 THEN 'Contacted' ELSE 'Unreached' END AS act_ex1_2
        FROM {events}""",
    "lea_ex1": """
        SELECT c_custkey AS lea_ex1_id, CASE WHEN c_acctbal > 0 THEN CAST(c_custkey AS STRING) ELSE '' END AS lea_ex1_38
        FROM {customer}""",
    "leads": "SELECT c_custkey AS leadid, c_nationkey AS productid FROM {customer}",
    "products": """
        SELECT n_nationkey AS productid,
               CASE WHEN n_regionkey = 1 THEN 'Credit Card ' || n_name WHEN n_regionkey = 2 THEN 'MC Time Loan'
                    ELSE 'Loan' END AS name
        FROM {nation}""",
    "versions": """
        SELECT CAST(o_custkey AS STRING) AS bbn, o_orderkey AS version_id, o_orderstatus AS status,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS actual_date
        FROM {orders}""",
}

# contact rows every customer has; Spark explodes them in place, the oracle lists them as values
SLOTS = (
    ("1", "Present", "Email Address"), ("2", "Present", "Mobile Number 1"), ("3", "Permanent", "Mobile Number 1"),
    ("4", "Permanent", "Mobile Number 2"), ("5", "Present", "Landline Number 1"), ("6", "Office", "Landline Number 1"),
    ("7", "Permanent", "Mobile Number 3"),
)
SPARK_SLOTS = "LATERAL VIEW inline(array({})) slots AS slot, kind, category".format(
    ", ".join("struct" + str(row) for row in SLOTS)
)
VALUE_SLOTS = ", (VALUES {}) AS slots(slot, kind, category)".format(", ".join(map(str, SLOTS)))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
PLACEHOLDER = re.compile(r"\{(\w+)\}")


class TestTables:
    """The test tables of one scale, read on demand, and the roles derived from them."""

    __test__ = False

    def __init__(self, spark, directory: str):
        self.spark, self.directory = spark, directory

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        setattr(self, name, df)  # one schema lookup per table and query
        return df

    def role(self, name: str) -> DataFrame:
        text = ROLES[name].replace("<slots>", SPARK_SLOTS)
        return self.spark.sql(text, **{table: getattr(self, table) for table in set(PLACEHOLDER.findall(text))})

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{table: getattr(self, table) for table in set(PLACEHOLDER.findall(text))})


def with_roles(names: tuple[str, ...], body: str) -> str:
    """Oracle text: the named roles as CTEs, then the body (which may start with more CTEs)."""
    texts = {name: PLACEHOLDER.sub(r"\1", ROLES[name]).replace("<slots>", VALUE_SLOTS) for name in names}
    parts = [f"{name} AS ({texts[name]})" for name in names]
    text = body.strip()
    if not parts:
        return text
    if text.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + text[5:]
    return "WITH " + ",\n".join(parts) + "\n" + text
