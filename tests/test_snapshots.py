import datetime as dt

import pytest

from daymark.operators.contract import TableContract
from daymark.sinks import tables
from daymark.sources import snapshots as S
from daymark.sources.registry import SOURCES, CatalogReader, Source, Sources, fusible, load, load_together

D = dt.date


@pytest.fixture
def daily(spark):
    dates = [D(2022, 9, 10), D(2022, 9, 11), D(2022, 12, 30), D(2022, 12, 31), D(2023, 1, 5), D(2023, 1, 10), D(2023, 1, 20)]
    return spark.createDataFrame([(d, i) for i, d in enumerate(dates)], "actual_date date, n int")


def days(df):
    return [r[0] for r in df.select("actual_date").orderBy("actual_date").collect()]


def test_reads(daily):
    run = "2023-01-10"
    assert days(S.last(daily, run)) == [D(2023, 1, 10)]
    assert days(S.last(daily, "2023-01-09")) == [D(2023, 1, 5)]
    assert days(S.last(daily, run, months_back=1)) == [D(2022, 12, 31)]
    assert days(S.last(daily, run, months_back=2)) == [D(2022, 9, 11)]
    assert days(S.last(daily, "2020-01-01")) == []
    assert days(S.first_in_month(daily, run)) == [D(2023, 1, 5)]
    assert days(S.first_in_month(daily, run, months_back=1)) == [D(2022, 12, 30)]
    assert days(S.exact(daily, "2023-01-09")) == []
    assert days(S.until(daily, run, inclusive=False))[-1] == D(2023, 1, 5)
    assert days(S.month_period(daily, run, 4)) == days(daily.where("actual_date > '2022-09-10' and actual_date <= '2023-01-10'"))
    assert days(S.month_period(daily, run, 0)) == [D(2023, 1, 5), D(2023, 1, 10)]
    assert days(S.month_period(daily, run, 4, include_current_month=False)) == days(daily.where("actual_date < '2023-01-01'"))
    with pytest.raises(ValueError):
        S.month_period(daily, run, 0, include_current_month=False)
    assert days(S.day_period(daily, run, 5)) == [D(2023, 1, 10)]
    assert days(S.date_range(daily, "2022-12-31", "2023-01-01", level="month"))[0] == D(2022, 12, 30)
    assert days(S.previous_month_end(daily, run)) == [D(2022, 12, 31)]
    assert days(S.previous_month_end(daily, "2022-12-05")) == []


def test_business_days(spark):
    rows = [(D(2023, 1, d), {31: "M", 16: "H"}.get(d, "")) for d in (2, 3, 4, 16, 31)]
    calendar = spark.createDataFrame(rows, "cdate_date date, pflag string")
    run = "2023-02-10"
    assert S.business_day(calendar, run) == D(2023, 1, 31)
    assert S.business_day(calendar, run, nth="half") == D(2023, 1, 16)
    assert [S.business_day(calendar, run, nth=n) for n in (-1, 1, 3, 99)] == [D(2023, 1, 2), D(2023, 1, 2), D(2023, 1, 4), D(2023, 1, 31)]
    with pytest.raises(LookupError):
        S.business_day(calendar, run, months_back=5)
    with pytest.raises(ValueError):
        S.business_day(calendar, run, nth="third")


def test_partitioned_table_is_read_from_partition_names(spark, daily, plan, tmp_path):
    contract = TableContract.from_ddl("snaps", "n int, actual_date date", partitions=("actual_date",))
    tables.create_table(spark, "snaps", contract, str(tmp_path / "snaps"))
    tables.write_table(daily, "snaps", contract)
    assert S.snapshot_column(spark, "snaps") == "actual_date"
    assert S.latest_partition(spark, "snaps", "2023-01-09") == D(2023, 1, 5)
    last = S.last_of_table(spark, "snaps", "2023-01-09")
    assert days(last) == [D(2023, 1, 5)]
    partition_filters = plan(last).split("PartitionFilters: [")[1].split("]")[0]
    assert "2023-01-05" in partition_filters
    tables.create_table(spark, "flat", TableContract.from_ddl("flat", "n int"), str(tmp_path / "flat"))
    with pytest.raises(ValueError):
        S.snapshot_column(spark, "flat")


def test_date_literal_reaches_the_scan(spark, daily, plan, tmp_path):
    daily.write.parquet(str(tmp_path / "daily"))
    text = plan(S.month_period(spark.read.parquet(str(tmp_path / "daily")), "2023-01-10", 4))
    assert "GreaterThan(actual_date,2022-09-10)" in text and "LessThanOrEqual(actual_date," in text


def test_source_cleans_before_it_filters(spark):
    rows = spark.createDataFrame([(" Y ", "0917-123-4567", D(2023, 1, 1))], "flag string, phone string, actual_date date")
    got = load(Source("t", "last", filters=("flag = 'Y'",), mobile=("phone",)), lambda _: rows, "2023-01-10").collect()
    assert [(r["flag"], r["phone"]) for r in got] == [("Y", "639171234567")]


def test_live_filter_reaches_the_scan(spark, plan, tmp_path):
    rows = spark.createDataFrame(
        [(" a ", "Y", D(9999, 12, 31)), ("b", "Y", None), ("c", "N", D(2023, 1, 1))],
        "bbn string, current_row_flag string, row_eff_end_date date",
    )
    rows.write.partitionBy("current_row_flag").parquet(str(tmp_path / "dim"))
    live = load(SOURCES["dim_cust_indiv"], lambda _: spark.read.parquet(str(tmp_path / "dim")), "2023-01-10")
    assert [r["bbn"] for r in live.collect()] == ["a"]
    text = plan(live)
    assert "(current_row_flag" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "IsNotNull(row_eff_end_date)" in text


def test_catalog_reader_takes_dates_from_partitions(spark, daily, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS gaps")
    contract = TableContract.from_ddl("enfis_bbn", "n int, actual_date date", partitions=("actual_date",))
    tables.create_table(spark, "gaps.enfis_bbn", contract, str(tmp_path / "enfis"))
    tables.write_table(daily, "gaps.enfis_bbn", contract)
    reader = CatalogReader(spark, {"enfis_bbn": "gaps"})
    assert days(load(SOURCES["enfis_bbn"], reader, "2023-01-09")) == [D(2023, 1, 5)]


def test_registry(spark):
    assert {s.mode for s in SOURCES.values()} <= {"full", "last", "exact", 1, 2, 4, 13}
    assert len([n for n in SOURCES if n.endswith("_for_month")]) == 6
    rows = spark.createDataFrame([("a", D(2023, 1, 1)), ("b", D(2023, 1, 2))], "bbn string, actual_date date")
    sources = Sources(lambda _: rows, "2023-01-01")
    sources.register(["enfis_bbn"])
    assert [r["bbn"] for r in spark.table("enfis_bbn").collect()] == ["a"]
    assert sources["enfis_bbn"] is sources["enfis_bbn"]


def test_reads_of_one_table_in_one_scan(spark, plan, tmp_path):
    rows = [("a", " Email 1\t", "Y"), ("b", "Landline", "Y"), ("c", "none", "Y"), ("d", "Email 2", "N"), ("e", None, "Y")]
    spark.createDataFrame(rows, "k string, kind string, current_row_flag string").write.parquet(f"{tmp_path}/t")
    live = "current_row_flag = 'Y'"
    specs = {"all": Source("t", filters=(live,)), "email": Source("t", filters=(live, "kind LIKE 'Email%'")), "line": Source("t", filters=(live, "kind = 'Landline'"))}
    reader = lambda table: spark.read.parquet(f"{tmp_path}/{table}")
    together = load_together(specs, reader, "2024-01-01")
    got = {(r["k"], name) for r in together.collect() for name in r["reads"]}
    assert got == {(r["k"], name) for name, spec in specs.items() for r in load(spec, reader, "2024-01-01").collect()}
    text = plan(together)
    assert "EqualTo(current_row_flag,Y)" in text
    without_all = load_together({n: specs[n] for n in ("email", "line")}, reader, "2024-01-01")
    assert sorted(r["k"] for r in without_all.collect()) == ["a", "b"]
    with pytest.raises(ValueError, match="more than their filters"):
        load_together({"all": specs["all"], "other": Source("t", "last")}, reader, "2024-01-01")
    assert fusible({**specs, "alone": Source("u")}) == [["all", "email", "line"]]
    assert ["dim_cust_contact", "dim_cust_contact_email", "dim_cust_contact_mobile", "dim_cust_contact_landline"] in fusible(SOURCES)
