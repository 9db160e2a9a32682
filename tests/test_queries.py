"""Every registered query against its oracle SQL, on the smallest tables."""

import datetime as dt
import math
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from daymark.showcase import ENTRIES
from daymark.showcase.roles import TABLES
from daymark.sinks import tables

DIRECTORY = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DIRECTORY).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DIRECTORY}/{name}.parquet'")
    return con


def cells(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return None if math.isnan(value) else round(value, 9)
        return value

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(ENTRIES) <= set(queries()) and set(ENTRIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query_matches_oracle(spark, duck, plan, name):
    df = queries()[name](spark, DIRECTORY)
    text = plan(df)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert unwanted not in text
    answer = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    assert sorted(df.columns) == sorted(columns)
    assert cells(df.columns, df.collect()) == cells(columns, answer.fetchall())


def test_entry(spark):
    df = entry(spark)
    assert len(df.columns) == 77 and not df.isEmpty()


def test_offer_code_nine_digits_has_every_customer(spark, tmp_path):
    keys = [1, 19_999, 20_000, 150_000, 30_000_000]
    spark.createDataFrame([(k,) for k in keys], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    got = {r["c_custkey"]: (r["code"], r["number"]) for r in queries()["offer_code_nine_digits"](spark, str(tmp_path)).collect()}
    assert got == {k: (f"ALPTB0698B{k * 50000:0{9 if k < 20_000 else 18}d}", k * 50000) for k in keys}


def test_compacted_months_of_one_file_and_of_several(spark, tmp_path, monkeypatch):
    rows = [(k, dt.date(1996, 1, 1 + k % 28), 1.0, "O") for k in range(60)] + [(60, dt.date(1996, 2, 3), 1.0, "O")]
    spark.createDataFrame(rows, "o_orderkey long, o_orderdate date, o_totalprice double, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    found = lambda: {r["day"]: (r["rows"], r["files"], r["fewer"], r["in_order"]) for r in queries()["compact_files"](spark, str(tmp_path)).collect()}
    assert found() == {"1996-01-01": (60, 1, 1, 1), "1996-02-01": (1, 1, 1, 1)}
    monkeypatch.setattr(tables, "compact", lambda *args, **options: [])
    left = found()
    assert left["1996-01-01"][1] > 1 and left["1996-01-01"][2] == 0 and left["1996-02-01"] == (1, 1, 1, 1)
