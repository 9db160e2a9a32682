"""Declared schemas of the produced tables.

Column names, types, keys and order are fixed values: existing tables and their readers depend on them.
"""

from __future__ import annotations

from daymark.operators.contract import TableContract

_FLAGS = " int, ".join(
    (
        "is_with_credit_card_flag", "is_with_al_flag", "is_with_hl_flag", "is_with_csl_flag", "is_with_bml_flag",
        "is_with_pl_flag", "is_with_pl_acct_woff_flag", "is_with_salad_flag", "is_with_cc_application_flag",
        "is_with_al_application_6m_flag", "is_with_al_application_12m_flag", "is_with_hl_application_flag",
    )
)

_BASE = f"""
    bbn string, acct_basic_num string, external_acct_num string, internal_acct_num string,
    depo_acct_num string, credit_card_physical_num string,
    full_name string, first_name string, middle_name string, last_name string,
    age int, client_segment_name string, {_FLAGS} int,
    depo_mob_count int, cc_mob_count int, deposit_mtd_adb decimal(38,6), deposit_ob decimal(38,6),
    adb_3m_avg decimal(18,2), payr_sal_6m_avg decimal(18,2), total_relationship_balance_value decimal(18,2),
    b_score_cc_value double, is_with_cc_propensity_flag int, is_card_canc_12m_flag int, is_dosri_flag int,
    is_enfis_flag int, is_dnc_flag int, is_non_indiv_flag int, is_no_segment_flag int,
    is_payroll_acct_flag int, is_acct_payroll_like_flag int, is_risk_industry_flag int, gmi_value decimal(18,2)
"""

STAGING_BASE = TableContract.from_ddl(
    "staging_cross_sell_base",
    f"""{_BASE},
    cust_mob_count int, earliest_acct_open_date date,
    gender_code string, civil_status_code string, employment_type_code string, birthdate date,
    mothers_maiden_name string, birth_place_name string, present_email string,
    priority_mobile_no1 string, priority_mobile_no2 string, priority_mobile_no string,
    priority_home_landline1 string, office_landline1 string,
    present_zip_code string, present_address string, permanent_address string, office_address string,
    primary_id_type string, primary_id_number string, tin_comptin string,
    employer_name string, occupation_details_text string, nature_of_work_code string,
    is_mobile_valid_flag int, is_email_valid_flag int,
    branch_code string, branch_name string, branch_area_code string, branch_region_name string,
    branch_mnemonic string, new_segment string, expiry_date date, actual_date date""",
    keys=("bbn", "external_acct_num"),
    partitions=("actual_date",),
)

CROSS_SELL_BASE = TableContract.from_ddl(
    "dm_cross_sell_base",
    f"{_BASE}, actual_date date",
    keys=("bbn", "external_acct_num"),
    partitions=("actual_date",),
)


def _stp(name: str, head: str, keys: tuple[str, ...], trb: str, propensity: str) -> TableContract:
    """The three pre-approved offer tables share everything after their heads, but for two types."""
    return TableContract.from_ddl(
        name,
        f"""{head},
        branch_region string, branch_area string, branch_mnemonic string, branch_name string,
        product_bundle string, new_segment string, accountnumber string, product_name string,
        qualified_casa string, promo_code string, ob string, ob_tier string,
        trb {trb}, trb_bucket string, age_tier string,
        casa_acct_php string, casa_acct_usd string, deal_acct_php string, deal_acct_usd string,
        gold_propensity {propensity}, age_70 int,
        agent_name string, purpose string, agent_remarks string, spiel string,
        other_card string, special_otherremarks string, timezone string, email string,
        gender string, civil_status string, date_of_birth date, zipcode string,
        employment_type string, employer_name string, occupation string, tin string,
        place_of_birth string, present_address string, permanent_address string,
        id_type string, id_number string, mother_maiden_name string, employment_status string,
        employer_address string, nature_of_business string,
        mobile_no string, mobile_no2 string, home_landline1 string, office_landline1 string,
        length_of_stay string, no_of_years_employed string, year_started_working string,
        current_industry string, updated_industry string, updated_position string,
        actual_date date""",
        keys=keys,
        partitions=("actual_date",),
    )


_NAMES = "full_name string, last_name string, first_name string, middle_name string"
_AGE = "earliest_acct_open_date date, age int, leads_type string"

AL_STP = _stp(
    "dm_casa_to_al_cross_sell_stp_offers",
    f"""offer_code string, term int, bbn string, expiry_date date, {_NAMES}, al_ratecode string,
    max_loan_amount int, offer_type string, product_crm string, spiel_id string, campaign_code string,
    {_AGE}, promo string, pid_count int""",
    ("term", "bbn", "al_ratecode"),
    "decimal(18,2)",
    "int",
)
CC_STP = _stp(
    "dm_casa_to_cc_cross_sell_stp_offers",
    f"""offer_code string, card_type string, bbn string, {_NAMES}, credit_limit int, offer_type string,
    product_crm string, spiel_id string, campaign_code string, {_AGE}, expiry_date date, promo string,
    pid_count int""",
    ("bbn",),
    "string",
    "decimal(11,10)",
)
HL_STP = _stp(
    "dm_casa_to_hl_cross_sell_stp_offers",
    f"""offer_code string, max_loan_term int, bbn string, program_offer_type string, expiry_date date, {_NAMES},
    hl_ratecode string, max_loan_amount string, max_amortization string, product_crm string, spiel_id string,
    campaign_code string, {_AGE}, promo string, pid_count int""",
    ("offer_code",),
    "string",
    "int",
)

_OFFER = (
    "offer_code string, offer_type_desc string, product_crm_code string, spiel_id_desc string, campaign_code string"
)
_LIKELY = """full_name string, email_address_text string, mobile_num_value string, client_segment_code string,
    deposit_segment_current_desc string, branch_code string"""

AL_PTB = TableContract.from_ddl(
    "dm_casa_to_al_cross_sell_ptb_offers",
    f"""bbn string, al_propensity_label_desc string, {_LIKELY}, {_OFFER},
    is_for_branch_flag string, is_dnc_flag string, is_mobile_valid_flag string, is_email_valid_flag string,
    expiry_date date, actual_date date""",
    keys=("bbn",),
    partitions=("actual_date",),
)
CC_PTB = TableContract.from_ddl(
    "dm_casa_to_cc_cross_sell_ptb_offers",
    f"""bbn string, branch_code string, branch_name string, branch_area_code string, branch_region_name string,
    full_name string, first_name string, last_name string, middle_name string,
    mobile_num_value string, email_address_text string, deposit_cluster_desc string,
    total_relationship_balance_value decimal(18,2), cust_mob_count int, {_OFFER},
    is_cust_contacted_3m_flag int, expiry_date date, actual_date date""",
    keys=("bbn",),
    partitions=("actual_date",),
)
HL_PTB = TableContract.from_ddl(
    "dm_casa_to_hl_cross_sell_ptb_offers",
    f"""bbn string, hl_propensity_label_desc string, {_LIKELY}, {_OFFER},
    is_dnc_flag string, is_mobile_num_valid_flag string, is_email_valid_flag string, is_for_branch_flag string,
    expiry_date date, actual_date date""",
    partitions=("actual_date",),
)

#: Columns of the offer tables that nothing here fills: campaigns and their agents do, after the load. Any other column that an input lacks is an error.
_BY_CAMPAIGN = (
    "campaign_code", "leads_type", "promo", "product_bundle", "product_name", "qualified_casa", "promo_code", "ob", "ob_tier", "casa_acct_php",
    "casa_acct_usd", "deal_acct_php", "deal_acct_usd", "gold_propensity", "agent_name", "purpose", "agent_remarks", "spiel", "other_card",
    "special_otherremarks", "length_of_stay", "no_of_years_employed", "year_started_working", "current_industry", "updated_industry", "updated_position",
)
NOT_FILLED: dict[str, tuple[str, ...]] = {
    AL_STP.name: (*_BY_CAMPAIGN, "pid_count"),
    CC_STP.name: _BY_CAMPAIGN,
    HL_STP.name: _BY_CAMPAIGN,
    **{c.name: ("campaign_code",) for c in (AL_PTB, CC_PTB, HL_PTB)},
}

CONTRACTS = {c.name: c for c in (STAGING_BASE, CROSS_SELL_BASE, AL_STP, CC_STP, HL_STP, AL_PTB, CC_PTB, HL_PTB)}
