"""All jobs of a run date, in order, from source tables to written partitions, twice."""

import uuid

import pytest
from pyspark.sql import functions as F

from daymark.plans import jobs, offers
from daymark.plans.contracts import CONTRACTS
from daymark.showcase.roles import ROLES, RUN, TestTables
from daymark.sources.registry import SOURCES

ALIASES = {
    "staging_pm_al_non_grid_application_data": "auto_applications",
    "credit_card_processing_tu": "card_applications",
    "df_pm_eq": "df_pm_history",
}


@pytest.fixture(scope="module")
def reader(spark):
    """Source tables made of the test tables, dressed with the date and validity columns reads look for."""
    roles = TestTables(spark, "/root/testdata/sf0.001")

    def read(name):
        df = roles.role(ALIASES.get(name, name))
        for source in SOURCES.values():
            if source.table != name:
                continue
            if source.mode in ("last", "exact") and source.column not in df.columns:
                df = df.withColumn(source.column, F.lit(RUN).cast("date"))
            df = df.withColumns({c: F.lit("0917-123-4567") for c in (*source.mobile, *source.landline) if c not in df.columns})
            if source.filters:
                df = df.withColumns({"current_row_flag": F.lit("Y"), "row_eff_end_date": F.lit("9999-12-31").cast("date")})
        return df

    return read


def test_sources_are_all_known():
    own = set(CONTRACTS)
    for name, source in SOURCES.items():
        assert source.table in own or isinstance(source.mode, (int, str)), name
    assert ROLES


def test_a_day_of_jobs_and_its_rerun(spark, reader, tmp_path_factory):
    database = f"marts_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database}")
    root = str(tmp_path_factory.mktemp("marts"))
    counts = {}
    for name in jobs.JOBS:
        done = jobs.run_job(spark, name, RUN, reader, database, root, metrics=True)
        counts[name] = done["rows"]
        table = spark.table(f"{database}.{name}")
        assert table.columns == [c for c in CONTRACTS[name].names if c != "actual_date"] + ["actual_date"]
        assert table.count() == done["rows"]
    assert counts["staging_cross_sell_base"] == counts["dm_cross_sell_base"] > 0
    assert any(counts[name] for name in offers.BUILDERS)

    last = "dm_casa_to_al_cross_sell_ptb_offers"
    before = spark.table(f"{database}.{last}").collect()
    jobs.run_job(spark, last, RUN, reader, database, root)
    assert sorted(spark.table(f"{database}.{last}").collect()) == sorted(before)
    assert jobs.check_job(spark, last, RUN, database).count() == 0

    # a customer holds one unexpired offer at most among the buyers' tables the jobs exclude from each other
    al, hl = (spark.table(f"{database}.dm_casa_to_{p}_cross_sell_ptb_offers").select("bbn") for p in ("al", "hl"))
    cc = spark.table(f"{database}.dm_casa_to_cc_cross_sell_ptb_offers").select("bbn")
    assert al.join(cc, "bbn").count() == 0 and hl.join(al, "bbn").count() == 0 and hl.join(cc, "bbn").count() == 0
