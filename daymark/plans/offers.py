"""The six offer tables: pre-approved amounts (STP) and likely buyers (PTB) for three products.

Every job has the same shape: rules cut the base down first and one row per customer is kept, which is done
inside the map tasks; then customers barred by loans or by an unexpired offer are dropped - joins of unique
keys - and only the survivors are priced, numbered and widened to the declared columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions import bands, pricing
from daymark.functions.bounds import DateLike, add_months, as_date, day
from daymark.functions.cleaning import is_blank, present
from daymark.functions.codes import build_code, last_sequence
from daymark.functions.contacts import is_valid_email, yes_no
from daymark.operators.contract import TableContract, conform
from daymark.operators.dedup import any_per_key, first_per_key
from daymark.operators.joins import active_offers, exclude, exclude_active, growing, join_splitting
from daymark.operators.rollups import any_flags
from daymark.operators.rules import Tree, apply_rules
from daymark.operators.sequence import number_rows, number_weighted
from daymark.plans import contracts, loans, rulesets

Tables = Mapping[str, DataFrame]

TIMEZONE = "Asia/Manila"
MASS_SEGMENT = "MASS MARKET"


def offers_name(product: str, kind: str) -> str:
    return f"dm_casa_to_{product.lower()}_cross_sell_{kind.lower()}_offers_for_month"


def eligible(base: DataFrame, rules: Tree) -> DataFrame:
    """Base rows that pass the rules; rule fields may be written ``base.<column>``."""
    return apply_rules(base.alias("base"), rules)


def one_per_customer(df: DataFrame) -> DataFrame:
    """The customer's first account."""
    return first_per_key(df, ["bbn"], ["external_acct_num"])


def numbered(df: DataFrame, own_offers: DataFrame, product: str, kind: str, run_date: DateLike, order: Sequence[str]) -> DataFrame:
    """Drop customers who hold an unexpired offer of this table and code the rest, going on after the
    highest number of the month."""
    held = active_offers(own_offers, run_date, include_run_date=False)
    fresh = exclude(df, held, ["bbn"])
    coded = number_rows(fresh, order, last_sequence(held, run_date), "offer_number")
    return coded.withColumn("offer_code", build_code(product, kind, run_date, "offer_number"))


# --- pre-approved amounts ------------------------------------------------------------------------------


def _stp_columns(run_date: DateLike) -> dict[str, Column]:
    """Columns the three pre-approved tables fill alike, from base columns."""
    renamed = {
        "branch_region": "branch_region_name",
        "branch_area": "branch_area_code",
        "accountnumber": "depo_acct_num",
        "trb": "total_relationship_balance_value",
        "email": "present_email",
        "gender": "gender_code",
        "civil_status": "civil_status_code",
        "date_of_birth": "birthdate",
        "zipcode": "present_zip_code",
        "employment_type": "employment_type_code",
        "employment_status": "employment_type_code",
        "occupation": "occupation_details_text",
        "tin": "tin_comptin",
        "place_of_birth": "birth_place_name",
        "id_type": "primary_id_type",
        "id_number": "primary_id_number",
        "mother_maiden_name": "mothers_maiden_name",
        "employer_address": "office_address",
        "nature_of_business": "nature_of_work_code",
        "mobile_no": "priority_mobile_no1",
        "mobile_no2": "priority_mobile_no2",
        "home_landline1": "priority_home_landline1",
    }
    return {
        **{name: F.col(source) for name, source in renamed.items()},
        "trb_bucket": bands.balance_band("total_relationship_balance_value"),
        "age_tier": bands.age_tier("age"),
        "age_70": bands.is_aged("age"),
        "timezone": F.lit(TIMEZONE),
        "actual_date": day(run_date),
    }


def _identity_count(blank_is_missing: bool) -> Column:
    """How many of five identity details are known."""
    texts = ("mothers_maiden_name", "present_address", "office_address", "present_email")
    return bands.count_present(*texts, blank_is_missing=blank_is_missing) + F.col("birthdate").isNotNull().cast("int")


def _decoded(default: str | None) -> dict[str, Column]:
    employment = bands.decode("employment_type_code", bands.EMPLOYMENT_TYPES, default)
    return {
        "gender": bands.decode("gender_code", bands.GENDERS, default),
        "civil_status": bands.decode("civil_status_code", bands.CIVIL_STATUSES, default),
        "employment_type": employment,
        "employment_status": employment,
    }


def _fill(df: DataFrame, columns: Mapping[str, Column], contract: TableContract, later: Sequence[str] = ()) -> DataFrame:
    """Declared columns of an offer table. Those that no input has by declaration (``contracts.NOT_FILLED``), or that come ``later``, are NULL;
    any other missing column is an error."""
    return conform(df.withColumns(dict(columns)), contract, strict=True, pad=[*contracts.NOT_FILLED.get(contract.name, ()), *later])


def auto_stp(
    t: Tables,
    run_date: DateLike,
    rules: Tree = rulesets.AL_STP,
    rates: Sequence[tuple] = pricing.AUTO_RATES,
    per_account: bool = False,
) -> DataFrame:
    """Auto-loan amounts for every rate and term. ``per_account`` keeps every account of a customer.

    Offers are numbered before they are fanned out: a customer's amounts are an array, and only customer and number of offers are ordered to
    find the first number of each.
    """
    base = eligible(t["staging_cross_sell_base"], rules)
    base = base if per_account else one_per_customer(base)
    checks = loans.auto_loan_checks(t["df_pm_eq"], run_date).where(F.col("loan_criteria_pass") == 1)
    cleared = exclude(checks, loans.recent_auto_bookings(t["df_pm_eq"], run_date), ["bbn"])
    base = join_splitting(base, cleared, ["bbn"], "inner") if per_account else base.join(cleared, "bbn")
    own = t[offers_name("AL", "STP")]
    columns = {
        **_stp_columns(run_date),
        "offer_type": F.lit("STP"),
        "product_crm": F.lit("AL"),
        "spiel_id": F.lit("Auto Loan STP"),
    }
    if per_account:
        offers = base.select("*", F.inline(_auto_offers(rates)))
        filled = _fill(offers, columns, contracts.AL_STP, ("offer_code",)).drop("offer_code").distinct()
        order = ["bbn", "al_ratecode", "term"]
        coded = numbered(filled, own, "AL", "STP", run_date, [*order, *[name for name in filled.columns if name not in order]])
        return conform(coded, contracts.AL_STP, strict=True)
    held = active_offers(own, run_date, include_run_date=False)
    offered = base.withColumn("__offers", _auto_offers(rates)).where(F.size("__offers") > 0)
    # who holds an offer is left out before numbers are stored, so the rows to write don't read the table they go to
    counts = exclude(offered.select("bbn", F.size("__offers").alias("__count")), held, ["bbn"])
    firsts = number_weighted(counts, ["bbn"], "__count", last_sequence(held, run_date), "__first").select("bbn", "__first")
    spread = offered.join(firsts, "bbn").select("*", F.posexplode("__offers").alias("__place", "__offer"))
    offers = spread.select("*", "__offer.*", (F.col("__first") + F.col("__place")).alias("offer_number"))
    coded = offers.withColumn("offer_code", build_code("AL", "STP", run_date, "offer_number"))
    return _fill(coded, columns, contracts.AL_STP)


def _auto_offers(rates: Sequence[tuple]) -> Column:
    """A customer's offers in the order of their codes and terms: those whose amount lies in the offered range."""
    entries = [F.struct(F.lit(c).alias("al_ratecode"), F.lit(n).alias("term"), F.lit(f).alias("rate_factor")) for c, n, f in rates]

    def priced(entry: Column) -> Column:
        amount = pricing.auto_loan_amount("adb_3m_avg", "amort_all_loans", entry["term"], entry["rate_factor"])
        return F.struct(*[entry[k].alias(k) for k in ("al_ratecode", "term", "rate_factor")], amount.alias("max_loan_amount"))

    offered = F.filter(F.transform(F.array(*entries), priced), lambda o: o["max_loan_amount"].between(pricing.AUTO_MIN, pricing.AUTO_MAX))
    return F.array_sort(offered)


def card_stp(
    t: Tables,
    run_date: DateLike,
    rules: Tree = rulesets.CC_STP,
    exclude_good_loans: bool = True,
    blank_is_missing: bool = True,
) -> DataFrame:
    """Card limits and card types."""
    barred = loans.card_loan_exclusions(t["df_pm_eq"], run_date, exclude_good_loans)
    base = exclude(one_per_customer(eligible(t["staging_cross_sell_base"], rules)), barred, ["bbn"])
    raw = pricing.card_raw_limit("is_payroll_acct_flag", "payr_sal_6m_avg", "adb_3m_avg")
    offers = (
        base.withColumn("credit_limit", pricing.card_limit(raw))
        .withColumn("card_type", pricing.card_type("credit_limit"))
        .where(F.col("card_type").isNotNull())
    )
    coded = numbered(offers, t[offers_name("CC", "STP")], "CC", "STP", run_date, ["bbn"])
    columns = {
        **_stp_columns(run_date),
        **_decoded(None),
        "pid_count": _identity_count(blank_is_missing),
        "offer_type": F.lit("STP"),
        "product_crm": F.lit("CC"),
        "spiel_id": F.regexp_replace("card_type", "^MasterCard", "MC"),
    }
    return _fill(coded, columns, contracts.CC_STP)


def home_stp(
    t: Tables, run_date: DateLike, rules: Tree = rulesets.HL_STP, blank_is_missing: bool = True
) -> DataFrame:
    """Home-loan amounts for customers without home, auto or personal loans."""
    base = one_per_customer(eligible(t["staging_cross_sell_base"], rules))
    held = loans.home_loan_rollup(t["df_pm_eq_latest"], run_date)
    base = base.join(held, "bbn", "left").where(
        (F.coalesce("has_hl_al_pl", F.lit(0)) == 0) & (F.col("oth_mob").isNull() | (F.col("oth_mob") >= 6))
    )
    offers = base.withColumns(
        {
            "capacity": pricing.home_capacity("adb_3m_avg", "gmi_value", "amort_all_loans"),
            "years": pricing.home_term_years("age"),
        }
    ).withColumn("amount", pricing.home_loan_amount("capacity", "years"))
    offers = offers.where(F.col("amount") >= pricing.HOME_MIN)
    coded = numbered(offers, t[offers_name("HL", "STP")], "HL", "STP", run_date, ["bbn"])
    columns = {
        **_stp_columns(run_date),
        **_decoded(""),
        "pid_count": _identity_count(blank_is_missing),
        "max_loan_term": F.when(F.col("age") <= pricing.HOME_END_AGE, F.col("years")),
        "max_loan_amount": F.when(F.col("years") > 0, F.col("amount").cast("string")),
        "max_amortization": F.col("capacity").cast("string"),
        "program_offer_type": F.lit("DEPO TO HL CROSS SELL"),
        "hl_ratecode": F.lit("STP"),
        "product_crm": F.lit("HL"),
        "spiel_id": F.lit("HL"),
    }
    return _fill(coded, columns, contracts.HL_STP)


# --- likely buyers -------------------------------------------------------------------------------------


def is_card_product(name: Column | str) -> Column:
    """Card products by name, without the ones that only look like cards."""
    upper = F.upper(name)
    wanted = upper.like("%CREDIT CARD%") | upper.like("%MASTERCARD%") | upper.like("%MC%")
    return wanted & ~upper.like("%DIMA%") & ~upper.like("%TIME LOAN%") & ~upper.like("%CASHLINK%")


# The answers that count as a contact, and the ids that select card campaign activity where none are passed.
CONTACT_ANSWERS = ("Interested", "For Call Back", "Not Interested")
CAMPAIGN_OWNER, STATUS_GROUP, OFFER_LAYOUT = 608, 16, 200198


def contacted_customers(
    activity: DataFrame,
    statuses: DataFrame,
    calls: DataFrame,
    lead_customers: DataFrame,
    run_date: DateLike,
    owner: int = CAMPAIGN_OWNER,
    keep_blank: bool = False,
    leads: DataFrame | None = None,
    products: DataFrame | None = None,
    status_group: int = STATUS_GROUP,
    offer_layout: int = OFFER_LAYOUT,
) -> DataFrame:
    """Per customer with recent activity, whether somebody reached them in the last three months.

    ``owner``, ``status_group`` and ``offer_layout`` are ids of the installation that runs the campaigns.

    With ``leads`` and ``products`` only activity on leads for a card product counts. Without them every
    product does, which is how existing tables were filled: there the two tables were joined from the
    left and read nowhere.
    """
    recent = activity.where(
        F.col("createdon").between(day(add_months(run_date, -3)), day(run_date)) & (F.col("ownerid") == owner)
    )
    answers = (
        statuses.where((F.col("groupkey") == status_group) & (F.col("ownerid") == owner))
        .where(F.col("name").isin(*CONTACT_ANSWERS))
        .select(F.col("lookupid").alias("statusid"))
        .distinct()
    )
    reached = (
        calls.where(F.col("act_ex1_2") == "Contacted")
        .select(F.col("act_ex1_id").alias("activity_key"))
        .distinct()
        .withColumn("was_reached", F.lit(1))
    )
    known = F.col("lea_ex1_38").isNotNull() if keep_blank else ~is_blank("lea_ex1_38")
    customers = (
        lead_customers.where(known)
        .select(F.col("lea_ex1_id").alias("relatedtoid"), F.col("lea_ex1_38").alias("bbn"))
        .distinct()
    )
    if leads is not None and products is not None:
        wanted = products.where(is_card_product("name")).select("productid").distinct()
        of_cards = leads.join(wanted, "productid", "left_semi").select(F.col("leadid").alias("relatedtoid"))
        recent = recent.join(of_cards, "relatedtoid", "left_semi")
    kind = F.upper("relatedtotypename")
    by_call = ((F.col("layoutid") == offer_layout) | (kind == "OFFER")) & (F.col("was_reached") == 1)
    # activity that counts, reduced to one row per lead before it meets the lead's customer
    per_lead = any_flags(
        join_splitting(recent, answers.withColumn("has_answer", F.lit(1)), ["statusid"])
        .withColumn("activity_key", F.col("activityid").cast("string"))
        .join(growing(reached), "activity_key", "left"),
        ["relatedtoid"],
        {"is_contacted": (F.col("has_answer") == 1) & (by_call | (kind == "LEAD"))},
    )
    joined = join_splitting(growing(customers), per_lead, ["relatedtoid"], "inner")
    return any_flags(joined, ["bbn"], {"is_contacted": F.col("is_contacted") > 0})


def _buyer_columns(run_date: DateLike, mobile_flag: str, blank_is_missing: bool, blocked: Sequence[str]) -> dict[str, Column]:
    has_mobile = present("priority_mobile_no", blank_is_missing)
    return {
        "email_address_text": F.col("present_email"),
        "mobile_num_value": F.col("priority_mobile_no"),
        "client_segment_code": F.col("client_segment_name"),
        "deposit_segment_current_desc": F.col("new_segment"),
        "is_dnc_flag": yes_no(F.col("is_dnc_flag") == 1),
        mobile_flag: yes_no(has_mobile),
        "is_email_valid_flag": yes_no(is_valid_email("present_email", blocked_mailboxes=blocked)),
        "is_for_branch_flag": yes_no((F.col("new_segment") != MASS_SEGMENT) & has_mobile),
        "offer_type_desc": F.lit("PTB"),
        "actual_date": day(run_date),
    }


def exclude_holders(base: DataFrame, t: Tables, run_date: DateLike, offers: Sequence[tuple[str, str]]) -> DataFrame:
    """Drop customers who hold an unexpired offer of any of the tables, in one anti join."""
    held = [active_offers(t[offers_name(*offer)], run_date, include_run_date=True).select("bbn") for offer in offers]
    return exclude(base, reduce(DataFrame.union, held), ["bbn"])


def auto_ptb(
    t: Tables,
    run_date: DateLike,
    rules: Tree = rulesets.AL_PTB,
    blank_is_missing: bool = True,
    blocked_mailboxes: Sequence[str] = (),
) -> DataFrame:
    """Likely auto-loan buyers without an unexpired auto or card offer."""
    base = one_per_customer(eligible(t["staging_cross_sell_base"].where(present("bbn", blank_is_missing)), rules))
    base = exclude_holders(base, t, run_date, (("AL", "STP"), ("CC", "PTB")))
    coded = numbered(base, t[offers_name("AL", "PTB")], "AL", "PTB", run_date, ["bbn"])
    scored = coded.join(growing(any_per_key(t["ptbcasatoal"].select("bbn", "propensity"), ["bbn"])), "bbn", "left")
    columns = {
        **_buyer_columns(run_date, "is_mobile_valid_flag", blank_is_missing, blocked_mailboxes),
        "al_propensity_label_desc": bands.score_label("propensity", boundary_is_mid=True),
        "product_crm_code": F.lit("AL"),
        "spiel_id_desc": F.lit("AL Propensity"),
    }
    return _fill(scored, columns, contracts.AL_PTB)


def card_ptb(
    t: Tables,
    run_date: DateLike,
    rules: Tree = rulesets.CC_PTB,
    card_products_only: bool = False,
) -> DataFrame:
    """Likely card buyers without an unexpired card offer, with whether they were contacted lately."""
    base = one_per_customer(eligible(t["staging_cross_sell_base"], rules))
    base = exclude_active(base, t[offers_name("CC", "STP")], run_date, include_run_date=True)
    coded = numbered(base, t[offers_name("CC", "PTB")], "CC", "PTB", run_date, ["bbn"])
    clusters = t["depo_clusters_v2"].select(F.col("bbnumber").alias("bbn"), "cluster_name")
    contacted = contacted_customers(
        t["activity"],
        t["lookupmaster"],
        t["act_ex1"],
        t["lea_ex1"],
        run_date,
        leads=t["leads"] if card_products_only else None,
        products=t["products"] if card_products_only else None,
    )
    joined = coded.join(growing(any_per_key(clusters, ["bbn"])), "bbn", "left").join(contacted, "bbn", "left")
    columns = {
        "mobile_num_value": F.col("priority_mobile_no"),
        "email_address_text": F.col("present_email"),
        "deposit_cluster_desc": F.col("cluster_name"),
        "is_cust_contacted_3m_flag": F.coalesce("is_contacted", F.lit(0)),
        "offer_type_desc": F.lit("PTB"),
        "product_crm_code": F.lit("CC"),
        "spiel_id_desc": F.lit("Cards Propensity"),
        "actual_date": day(run_date),
    }
    return _fill(joined, columns, contracts.CC_PTB)


def home_ptb(
    t: Tables,
    run_date: DateLike,
    rules: Tree = rulesets.HL_PTB,
    blank_is_missing: bool = True,
    blocked_mailboxes: Sequence[str] = (),
) -> DataFrame:
    """Likely home-loan buyers without any unexpired home, auto-buyer or card-buyer offer."""
    base = one_per_customer(eligible(t["staging_cross_sell_base"], rules))
    base = exclude_holders(base, t, run_date, (("HL", "STP"), ("AL", "PTB"), ("CC", "PTB")))
    coded = numbered(base, t[offers_name("HL", "PTB")], "HL", "PTB", run_date, ["bbn"])
    scores = t["casatohlptb"].select("bbn", "hl_propensity_score")
    scored = coded.join(growing(any_per_key(scores, ["bbn"])), "bbn", "left")
    columns = {
        **_buyer_columns(run_date, "is_mobile_num_valid_flag", blank_is_missing, blocked_mailboxes),
        "hl_propensity_label_desc": bands.score_label("hl_propensity_score", boundary_is_mid=False),
        "product_crm_code": F.lit("HL"),
        "spiel_id_desc": F.lit("HL Propensity"),
    }
    return _fill(scored, columns, contracts.HL_PTB)


# Offer tables in the order they have to be filled: a later one reads the earlier ones of the same day.
BUILDERS: dict[str, Callable[..., DataFrame]] = {
    contracts.CC_STP.name: card_stp,
    contracts.AL_STP.name: auto_stp,
    contracts.HL_STP.name: home_stp,
    contracts.CC_PTB.name: card_ptb,
    contracts.AL_PTB.name: auto_ptb,
    contracts.HL_PTB.name: home_ptb,
}


def build(name: str, t: Tables, run_date: DateLike, **options: Any) -> DataFrame:
    return BUILDERS[name](t, as_date(run_date), **options)
