"""The wide customer x account base table.

Shape of the plan: every customer-level input is first reduced to one row per customer and joined into
one customer profile - joins of unique keys, which cannot skew or multiply rows. The account rows, where
a single customer may own a large share, meet that profile in one join only, set up so that AQE can split a
hot customer's rows over several tasks. Inputs keyed by account or card are joined the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions import bands
from daymark.functions.bounds import DateLike, RunBounds, day, whole_months, whole_years
from daymark.functions.cleaning import empty_to_null, present
from daymark.functions.contacts import normalize_landline, normalize_mobile
from daymark.operators.contract import TableContract, conform
from daymark.operators.dedup import any_per_key, distinct_keys, gaps
from daymark.operators.joins import enrich_known, growing, join_splitting, joined_key
from daymark.operators.rollups import any_flag, any_flags, average_between, max_where
from daymark.plans.contracts import CROSS_SELL_BASE, STAGING_BASE
from daymark.sources.snapshots import previous_month_end

Tables = Mapping[str, DataFrame]

# Product codes and the reference pattern that marks a business loan.
AUTO_PRODUCT, HOME_PRODUCT, SALARY_PRODUCT, BUSINESS_PRODUCT = "AL", "HL", "CEL", "CTS"
BUSINESS_MARK = "%@BR5LBGSOP%"
CANCELLED = "CANC"
NON_INDIVIDUAL = ("PARTNERSHIP", "CORPORATION")

ACCOUNT_COLUMNS = (
    "bbnumber",
    "account_basic_number",
    "accountnumber",
    "internal_accountnumber",
    "deposit_account_number",
    "credit_card_card_no",
    "credit_card_tag",
    "deposit_months_on_books",
    "credit_card_months_on_books",
    "low_cost_deposit_mtd_adb",
    "high_cost_deposit_mtd_adb",
    "low_cost_deposit_ob",
    "high_cost_deposit_ob",
)


def accounts(customer_account: DataFrame) -> DataFrame:
    """One row per (customer, account): the row with the highest card tag, plus the do-not-call flag of
    all its copies.

    Both come out of one grouped pass; the smallest struct is the wanted row, because its first fields are
    the reversed tag and the rest only breaks ties.
    """
    keys = ["bbnumber", "accountnumber"]
    rest = [name for name in ACCOUNT_COLUMNS if name not in keys]
    named = present_key("bbnumber") & present_key("account_basic_number") & present_key("accountnumber")
    untagged = F.col("credit_card_tag").isNull().alias("untagged")
    ranked = F.struct(untagged, (-F.col("credit_card_tag")).alias("tag"), *[F.col(name) for name in rest])
    grouped = customer_account.groupBy(*keys).agg(
        F.min(F.when(named, ranked)).alias("chosen"), any_flag(F.col("dnc_tag") > 0).alias("dnc_tag")
    )
    return grouped.where(F.col("chosen").isNotNull()).select(
        *keys, *[F.col("chosen")[name].alias(name) for name in rest], "dnc_tag"
    )


def present_key(name: str) -> Column:
    return empty_to_null(name).isNotNull()


def product_flags(
    loans: DataFrame, auto_applications: DataFrame, home_applications: DataFrame, run_date: DateLike
) -> DataFrame:
    """Products held and applied for, one row per customer, from last month-end's loan snapshot."""
    b = RunBounds.of(run_date)
    held = {
        "is_with_al_flag": F.col("product_code") == AUTO_PRODUCT,
        "is_with_hl_flag": F.col("product_code") == HOME_PRODUCT,
        "is_with_csl_flag": F.col("product_code") == SALARY_PRODUCT,
        "is_with_bml_flag": (F.col("product_code") == BUSINESS_PRODUCT)
        & F.col("mutated_pn_number").like(BUSINESS_MARK),
    }
    per_application = any_flags(previous_month_end(loans, run_date, "reporting_date"), ["bbn", "app_number"], held)
    created, auto = F.col("app_create_date"), F.col("kind") == "auto"
    half, year = (created.between(day(start), day(b.month_start)) for start in (b.start_6m, b.start_12m))
    windows = {
        "is_with_al_application_6m_flag": auto & (F.col("product") == AUTO_PRODUCT) & half,
        "is_with_al_application_12m_flag": auto & (F.col("product") == AUTO_PRODUCT) & year,
        "is_with_hl_application_flag": ~auto & (F.col("product") == HOME_PRODUCT) & year,
    }
    # both kinds of applications in one grouped pass, so loans meet them in a single join
    kinds = (("auto", auto_applications, "product_cd"), ("home", home_applications, "product_code"))
    listed = [df.select("app_number", F.col(product).alias("product"), "app_create_date", F.lit(kind).alias("kind")) for kind, df, product in kinds]
    applications = any_flags(listed[0].unionByName(listed[1]), ["app_number"], windows)
    joined = enrich_known(per_application, applications, "app_number", ["bbn"], grows=True)
    return any_flags(joined, ["bbn"], {name: F.col(name) > 0 for name in [*held, *windows]})


def card_application_flag(applications: DataFrame, run_date: DateLike) -> DataFrame:
    b = RunBounds.of(run_date)
    recent = F.col("app_create_date").between(day(b.start_6m), day(b.month_start))
    return any_flags(applications, ["bbn"], {"is_with_cc_application_flag": recent})


def balance_3m(balances: DataFrame, run_date: DateLike) -> DataFrame:
    b = RunBounds.of(run_date)
    return average_between(
        balances, ["account_number"], "outstanding_balance_amt", "actual_date",
        day(b.start_3m), day(b.month_start), "adb_3m_avg",
    )


def card_profile(cards: DataFrame, scores: DataFrame, run_date: DateLike) -> DataFrame:
    """Behaviour score and recent-cancellation flag, one row per card."""
    b = RunBounds.of(run_date)
    cancelled = (F.col("card_generalstatus_code") == CANCELLED) & (
        F.col("card_generalstatus_updatedate") >= day(b.start_12m).cast("timestamp")
    )
    best = scores.groupBy("custserno").agg(F.max("b_score_cust").alias("b_score_cust"))
    # one row per card and customer before the join: a customer with very many card rows stays small
    reduced = (
        cards.where(F.col("card_number").isNotNull())
        .groupBy("card_number", F.col("customer_serno").cast("string").alias("custserno"))
        .agg(any_flag(cancelled).alias("is_card_canc_12m_flag"))
    )
    return (
        enrich_known(reduced, best, "custserno", ["card_number"], grows=True)
        .groupBy("card_number")
        .agg(F.max("b_score_cust").alias("b_score_cust"), F.max("is_card_canc_12m_flag").alias("is_card_canc_12m_flag"))
    )


def contact_summary(contacts: DataFrame, details: DataFrame) -> DataFrame:
    """E-mail and phone numbers by priority, one row per customer.

    The contact texts are read once and give the raw text and both normalised numbers.
    """
    text = F.col("contact_details_text")
    texts = details.groupBy(F.col("cust_contact_pii_key").alias("cust_contact_key")).agg(
        F.max(text).alias("email"),
        F.max(normalize_mobile(text)).alias("mobile"),
        F.max(normalize_landline(text)).alias("landline"),
    )
    kind, category = F.col("contact_type_desc"), F.col("contact_category_desc")
    wanted = contacts.where(F.trim(kind).isin("Present", "Permanent", "Office"))
    rows = enrich_known(wanted, texts, "cust_contact_key", ["bbn"], grows=True)

    def pick(value: str, wanted_kind: str, wanted_category: str) -> Column:
        return max_where(value, (kind == wanted_kind) & (category == wanted_category))

    def mobile(wanted_kind: str, number: int) -> Column:
        return pick("mobile", wanted_kind, f"Mobile Number {number}")

    def landline(wanted_kind: str) -> Column:
        return pick("landline", wanted_kind, "Landline Number 1")

    return rows.groupBy("bbn").agg(
        pick("email", "Present", "Email Address").alias("present_email"),
        F.coalesce(mobile("Present", 1), mobile("Permanent", 1)).alias("priority_mobile_no1"),
        F.coalesce(mobile("Present", 2), mobile("Permanent", 2)).alias("priority_mobile_no2"),
        F.coalesce(*[mobile(k, n) for k in ("Present", "Permanent") for n in (1, 2, 3)]).alias("priority_mobile_no"),
        F.coalesce(landline("Present"), landline("Permanent")).alias("priority_home_landline1"),
        landline("Office").alias("office_landline1"),
    )


def address_summary(addresses: DataFrame, details: DataFrame) -> DataFrame:
    lines = any_per_key(
        details.select("cust_address_key", "address_line_1_text", "address_line_2_text", "address_line_3_text"),
        ["cust_address_key"],
    )
    whole = F.concat_ws(" ", "address_line_1_text", "address_line_2_text", "address_line_3_text")
    kind = F.col("address_type_desc")
    return (
        enrich_known(addresses, lines, "cust_address_key", ["bbn"], grows=True)
        .groupBy("bbn")
        .agg(
            max_where("zip_code", kind == "Present").alias("present_zip_code"),
            max_where(whole, kind == "Present").alias("present_address"),
            max_where(whole, kind == "Permanent").alias("permanent_address"),
            max_where(whole, kind == "Office").alias("office_address"),
        )
    )


def id_summary(proofs: DataFrame, details: DataFrame) -> DataFrame:
    numbers = details.groupBy("cust_id_proof_key").agg(F.max("id_num_value").alias("id_num_value"))
    primary = F.col("id_category_desc") == "Primary"
    return (
        enrich_known(proofs, numbers, "cust_id_proof_key", ["bbn"], grows=True)
        .groupBy("bbn")
        .agg(
            max_where("id_type_code", primary).alias("primary_id_type"),
            max_where("id_num_value", primary).alias("primary_id_number"),
        )
    )


def branch_summary(classes: DataFrame, branches: DataFrame) -> DataFrame:
    listing = any_per_key(
        branches.select(
            F.trim("branch_code").alias("branch_key"),
            F.col("area").alias("branch_area_code"),
            F.col("region").alias("branch_region_name"),
            F.col("branchmnemonic").alias("branch_mnemonic"),
        ),
        ["branch_key"],
    )
    named = classes.select(
        "bbn",
        F.col("acct_origin_branch_code").alias("branch_code"),
        F.col("acct_origin_branch_name").alias("branch_name"),
        "client_segment_name",
        "cust_category_desc",
        F.trim("acct_origin_branch_code").alias("branch_key"),
    )
    return enrich_known(any_per_key(named, ["bbn"]), listing, "branch_key", ["bbn"]).drop("branch_key")


def list_flags(lists: Mapping[str, DataFrame]) -> DataFrame:
    """Customer lists, each a frame whose first column is the customer, as one row of flags per customer.

    All lists go through one grouped pass and later one join, however many there are.
    """
    mark = "__list"
    marked = [df.select(F.col(df.columns[0]).alias("bbn"), F.lit(flag).alias(mark)) for flag, df in lists.items()]
    return any_flags(reduce(DataFrame.union, marked), ["bbn"], {flag: F.col(mark) == flag for flag in lists})


def one_row_each(inputs: Sequence[tuple[DataFrame, str, Mapping[str, str | Column]]]) -> DataFrame:
    """Named columns of several customer-level inputs, one row per customer.

    Each input is a frame, its customer column and the wanted columns. All go through one grouped pass, every
    input as one struct, instead of a reduction and a join per input. Of several rows of a customer the one with the fewest gaps is
    kept, then the smallest.
    """
    parts, picks, names = [], [], []
    for i, (df, key, columns) in enumerate(inputs):
        chosen = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
        rows = df.select(F.col(key).alias("bbn"), *chosen)
        parts.append(rows.select("bbn", F.struct(gaps(rows, list(columns)).alias("__gaps"), *columns).alias(f"__{i}")))
        picks.append(F.min(f"__{i}").alias(f"__{i}"))
        names += [F.col(f"__{i}")[name].alias(name) for name in columns]
    united = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)
    return united.groupBy("bbn").agg(*picks).select("bbn", *names)


def customer_inputs(t: Tables, run_date: DateLike, as_declared_write_off: bool = False) -> list[DataFrame]:
    """Every customer-level input, reduced to one row per ``bbn``."""
    write_offs = t["pl_active_accounts" if as_declared_write_off else "pl_active_accounts_woff"]
    indiv = {
        "cust_mob_count": whole_months(run_date, "cust_create_date_ts"),
        "earliest_acct_open_date": F.col("cust_create_date_ts").cast("date"),
        "gender_code": "gender_code",
        "civil_status_code": "civil_status_code",
        "employment_type_code": "employment_type_code",
    }
    pii = {
        **{n: n for n in ("full_name", "first_name", "middle_name", "last_name")},
        "age": whole_years(run_date, "birthdate"),
        "birthdate": F.col("birthdate").cast("date"),
        "mothers_maiden_name": "mothers_maiden_name",
        "birth_place_name": "birth_place_name",
    }
    abt = {"payroll_salary_cr_avg_6m": "payroll_salary_cr_avg_6m", "trb_amt_m0": "trb_amt_m0"}
    employment = {n: n for n in ("employer_name", "occupation_details_text", "nature_of_work_code")}
    lists = {
        "is_with_cc_propensity_flag": t["ptbcasatocc"].select("bbn"),
        "is_dosri_flag": t["dosri_distinct"].select("bbn_winner"),
        "is_enfis_flag": t["enfis_bbn"].select("bbn"),
        "is_risk_industry_flag": t["ref_risk_industry"].select("bbn"),
        "is_with_pl_flag": t["pl_active_accounts"].select("bbn"),
        "is_with_pl_acct_woff_flag": write_offs.select("bbn"),
        "is_with_salad_flag": t["salad_accounts"].select("bbn"),
    }
    plain = [
        (t["dim_cust_indiv_pii"], "bbn", pii),
        (t["depo_segmentation_v2"], "bbnumber", {"new_segment": "new_segment"}),
        (t["df_abt_customer"], "bbnumber", abt),
        (t["incomeestimatorv2"], "bbn", {"label": "label"}),
        (t["dim_cust_indiv"], "bbn", indiv),
        (t["cust_info"], "bbnumber", {"tin_comptin": "tin_comptin"}),
        (t["dim_cust_indiv_employment"], "bbn", employment),
    ]
    return [
        one_row_each(plain),
        list_flags(lists),
        branch_summary(t["dim_cust_class"], t["branch_listing"]),
        product_flags(t["df_pm_eq"], t["staging_pm_al_non_grid_application_data"], t["pm_application"], run_date),
        card_application_flag(t["credit_card_processing_tu"], run_date),
        contact_summary(t["dim_cust_contact"], t["dim_cust_contact_pii"]),
        address_summary(t["dim_cust_address"], t["dim_cust_address_pii"]),
        id_summary(t["dim_cust_id_proof"], t["dim_cust_id_proof_pii"]),
    ]


def customer_profile(customers: DataFrame, inputs: list[DataFrame]) -> DataFrame:
    """One row per customer with the columns of every input."""
    profile = customers
    for frame in inputs:
        profile = profile.join(growing(frame), "bbn", "left")
    return profile


def _amount(column: str, data_type: str = "decimal(18,2)") -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast(data_type)


def _count(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast("int")


def staging_base(t: Tables, run_date: DateLike, as_declared_write_off: bool = False) -> DataFrame:
    """The base table: one row per (customer, account), 77 columns."""
    b = RunBounds.of(run_date)
    spine = accounts(t["df_customer_account"]).withColumnsRenamed(
        {
            "bbnumber": "bbn",
            "account_basic_number": "acct_basic_num",
            "accountnumber": "external_acct_num",
            "internal_accountnumber": "internal_acct_num",
            "deposit_account_number": "depo_acct_num",
            "credit_card_card_no": "credit_card_physical_num",
        }
    )
    customers = t["df_customer_account"].select(F.col("bbnumber").alias("bbn")).where(present_key("bbn"))
    profile = customer_profile(
        distinct_keys(customers, ["bbn"]), customer_inputs(t, run_date, as_declared_write_off)
    )
    balances = balance_3m(t["df_adb"], run_date).withColumnRenamed("account_number", "external_acct_num")
    cards = card_profile(t["df_cards_accounts"], t["winnow_b_score_cc"], run_date).withColumnRenamed(
        "card_number", "credit_card_physical_num"
    )
    payroll = any_per_key(
        t["scpf"].select(joined_key("scab", "scan", "scas").alias("internal_acct_num"), "scai97", "scaig3"),
        ["internal_acct_num"],
    )
    account = ["bbn", "external_acct_num"]
    # account and card numbers are close to unique here, so only missing ones need scattering; a customer can be large
    wide = enrich_known(spine, balances, "external_acct_num", account, splitting=False, grows=True)
    wide = enrich_known(wide, cards, "credit_card_physical_num", account, splitting=False, grows=True)
    wide = enrich_known(wide, payroll, "internal_acct_num", account, splitting=False, grows=True)
    wide = join_splitting(wide, growing(profile), ["bbn"])
    flags = [c.name for c in STAGING_BASE.columns if c.name.startswith("is_") and c.name in wide.columns]
    derived = {
        **{name: _count(name) for name in flags},
        "is_with_credit_card_flag": _count("credit_card_tag"),
        "depo_mob_count": _count("deposit_months_on_books"),
        "cc_mob_count": _count("credit_card_months_on_books"),
        "deposit_mtd_adb": F.coalesce("low_cost_deposit_mtd_adb", "high_cost_deposit_mtd_adb").cast("decimal(38,6)"),
        "deposit_ob": F.coalesce("low_cost_deposit_ob", "high_cost_deposit_ob").cast("decimal(38,6)"),
        "adb_3m_avg": _amount("adb_3m_avg"),
        "payr_sal_6m_avg": _amount("payroll_salary_cr_avg_6m"),
        "total_relationship_balance_value": _amount("trb_amt_m0"),
        "b_score_cc_value": _amount("b_score_cust", "double"),
        "is_dnc_flag": _count("dnc_tag"),
        "is_non_indiv_flag": bands.flag(F.trim(F.upper("cust_category_desc")).isin(*NON_INDIVIDUAL)),
        "is_no_segment_flag": bands.flag(F.col("new_segment").isNull()),
        "is_payroll_acct_flag": bands.flag(F.col("scai97") == "Y"),
        "is_acct_payroll_like_flag": bands.flag(F.col("scaig3") == "Y"),
        "gmi_value": bands.monthly_income("label"),
        "is_mobile_valid_flag": present("priority_mobile_no").cast("int"),
        "is_email_valid_flag": present("present_email").cast("int"),
        "expiry_date": day(b.expiry),
        "actual_date": day(b.run_date),
    }
    return conform(wide.withColumns(derived), STAGING_BASE, strict=True)


def cross_sell_base(staging: DataFrame, contract: TableContract = CROSS_SELL_BASE) -> DataFrame:
    """The published part of the base table."""
    return conform(staging, contract, strict=True)
