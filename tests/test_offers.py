"""Options of the base and offer plans, on tables derived from the smallest test tables."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from daymark.plans import base as B
from daymark.plans import offers
from daymark.showcase.marts import CampaignTables, MartTables
from daymark.showcase.roles import RUN, TestTables

DIRECTORY = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DIRECTORY).exists(), reason="test tables are not here")
ANY = {"rules": []}


@pytest.fixture(scope="module")
def tables(spark):
    made = CampaignTables(TestTables(spark, DIRECTORY))
    made.base = made.base.checkpoint()
    return made


def test_auto_offers_per_account(tables):
    rules = {"rules": [{"field": "adb_3m_avg", "operator": ">=", "value": 100000}]}
    once = offers.auto_stp(tables, RUN, rules=rules)
    every = offers.auto_stp(tables, RUN, rules=rules, per_account=True)
    assert 0 < once.count() < every.count()
    assert once.select("bbn", "al_ratecode", "term").distinct().count() == once.count()
    assert every.select("offer_code").distinct().count() == every.count()


def test_codes_continue_without_gaps(tables):
    made = offers.card_ptb(tables, RUN, rules=ANY)
    numbers = [int(r[0][-7:]) for r in made.select("offer_code").collect()]
    held = tables[offers.offers_name("CC", "PTB")].where("offer_code LIKE 'CCPTB0698%' AND actual_date < '1998-06-15'")
    first = max([int(r["offer_code"][-7:]) for r in held.collect()], default=0) + 1
    assert sorted(numbers) == list(range(first, first + len(numbers)))


def test_no_customer_gets_a_second_offer(tables):
    for name, build in offers.BUILDERS.items():
        options = {"rates": [("R", 60, 0.1)]} if build is offers.auto_stp else {}
        made = build(tables, RUN, rules=ANY, **options)
        held = tables[f"{name}_for_month"].where("expiry_date > '1998-06-15' AND actual_date < '1998-06-15'")
        assert made.join(held, "bbn", "left_semi").count() == 0
        assert made.select("bbn").distinct().count() == made.count()


def test_options(tables):
    good = offers.card_stp(tables, RUN, rules=ANY)
    other = offers.card_stp(tables, RUN, rules=ANY, exclude_good_loans=False)
    assert good.join(other, "bbn").count() < max(good.count(), other.count())
    strict = offers.auto_ptb(tables, RUN, rules=ANY)
    loose = offers.auto_ptb(tables, RUN, rules=ANY, blank_is_missing=False)
    assert strict.count() == loose.count()
    cards = offers.card_ptb(tables, RUN, rules=ANY, card_products_only=True).agg(F.sum("is_cust_contacted_3m_flag")).first()[0]
    all_products = offers.card_ptb(tables, RUN, rules=ANY).agg(F.sum("is_cust_contacted_3m_flag")).first()[0]
    assert cards <= all_products
    assert offers.build("dm_casa_to_hl_cross_sell_ptb_offers", tables, RUN, rules=ANY).count() > 0


def test_blank_customers_of_leads_can_be_kept(tables):
    inputs = [tables[n] for n in ("activity", "lookupmaster", "act_ex1", "lea_ex1")]
    strict = {r["bbn"] for r in offers.contacted_customers(*inputs, RUN).collect()}
    kept = {r["bbn"] for r in offers.contacted_customers(*inputs, RUN, keep_blank=True).collect()}
    assert kept - strict <= {""} and strict <= kept


def test_write_off_flag_can_follow_the_active_accounts(spark):
    made = B.staging_base(MartTables(TestTables(spark, DIRECTORY)), RUN, as_declared_write_off=True)
    assert made.where("is_with_pl_flag <> is_with_pl_acct_woff_flag").count() == 0


def test_base_has_one_row_per_account(tables):
    assert tables.base.select("bbn", "external_acct_num").distinct().count() == tables.base.count()
