import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from daymark.operators import contract as C
from daymark.operators import quality
from daymark.operators.cleanse import cleanse
from daymark.shared import settle, shared_dir
from daymark.sinks import files, tables

D = dt.date
SNAPS = C.TableContract.from_ddl("snaps", "k string, n int, day date", keys=("k",), partitions=("day",), write_ordered_by=("k",))


@pytest.fixture
def table(spark, tmp_path):
    def make(contract=SNAPS, **options):
        name = f"t_{uuid.uuid4().hex[:10]}"
        assert tables.create_table(spark, name, contract, str(tmp_path / name), **options)
        return name

    return make


def rows(spark, data):
    return spark.createDataFrame(data, "n int, day date, k string, extra string")


def test_overwrite_replaces_only_the_written_partition(spark, table):
    name = table()
    tables.write_table(rows(spark, [(1, D(2024, 1, 1), "a", ""), (2, D(2024, 1, 2), "b", "")]), name, SNAPS)
    tables.write_table(rows(spark, [(9, D(2024, 1, 2), "c", "")]), name, SNAPS)
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [("a", 1, D(2024, 1, 1)), ("c", 9, D(2024, 1, 2))]
    tables.write_table(rows(spark, [(5, D(2024, 1, 2), "d", "")]), name, SNAPS, mode="append")
    assert spark.table(name).count() == 3


def test_insert_is_by_name_and_complete(spark, table):
    name = table()
    with pytest.raises(C.ContractError):
        tables.write_table(rows(spark, []).drop("n"), name, SNAPS)
    with pytest.raises(ValueError):
        tables.write_table(rows(spark, []).drop("n"), name)


def test_create(spark, table, tmp_path):
    name = table()
    assert not tables.create_table(spark, name, SNAPS, str(tmp_path / name))
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["day"]
    with pytest.raises(ValueError):
        tables.create_table(spark, "nowhere", SNAPS, None)
    spark.sql("CREATE DATABASE IF NOT EXISTS made")
    assert tables.create_all(spark, "made", str(tmp_path), [SNAPS]) == ["made.snaps"]
    commented = C.TableContract.from_ddl("c", "a int", comment="it's")
    tables.create_table(spark, f"{name}_c", commented, str(tmp_path / "c"))


def test_parts_and_each(spark, table):
    name, other = table(), table()
    frames = [rows(spark, [(i, D(2024, 1, 1), str(i), "")]) for i in range(2)]
    assert tables.write_parts([rows(spark, [])], name) is None
    tables.write_parts([*frames, rows(spark, [])], name, contract=SNAPS)
    assert spark.table(name).count() == 2
    assert tables.write_each({other: frames[0], name: rows(spark, [])}, contract=SNAPS) == [other]


def test_text_and_parquet(spark, tmp_path):
    data = spark.createDataFrame([("a", None, 1), (None, "b", None)], "x string, y string, n int")
    files.write_text(data, str(tmp_path / "text"))
    assert sorted(r[0] for r in spark.read.option("lineSep", "\n").text(str(tmp_path / "text")).collect()) == ["a||1\r", "|b|\r"]
    files.write_parquet(data, str(tmp_path / "pq"), ["n"])
    files.write_parquet(data.where("n = 1").withColumn("x", F.lit("new")), str(tmp_path / "pq"), ["n"])
    assert {(r["x"], r["n"]) for r in spark.read.parquet(str(tmp_path / "pq")).collect()} == {("new", 1), (None, None)}
    assert files.write_avro(data.limit(0), str(tmp_path / "avro")) is False


def test_metrics_copy_compact(spark, table, tmp_path):
    name = table()
    data = rows(spark, [(i, D(2024, 1, 1 + i % 2), str(i), "") for i in range(10)])
    assert tables.write_with_metrics(data, name, contract=SNAPS) == {"table": name, "rows": 10}
    before = {r["day"]: r[0] for r in spark.table(name).selectExpr("input_file_name()", "day").distinct().collect()}
    tables.compact(spark, name, str(tmp_path / "sorted"), ["day", "k"], where="day = '2024-01-01'")
    assert spark.table(name).count() == 10
    after = {r["day"]: r[0] for r in spark.table(name).selectExpr("input_file_name()", "day").distinct().collect()}
    assert [d for d in before if before[d] != after[d]] == [D(2024, 1, 1)]
    tables.copy_in_place(spark, name, str(tmp_path / "moved"))
    assert spark.table(name).count() == 10
    tables.write_table(data.where("n < 0"), name, SNAPS, replacing={"day": "2024-01-01"})
    assert [r["day"] for r in spark.table(name).select("day").distinct().collect()] == [D(2024, 1, 2)]
    with pytest.raises(Exception, match="another partition"):
        tables.write_table(data, name, SNAPS, replacing={"day": "2024-01-01"})
    tables.write_table(data, name, SNAPS)
    tables.copy_table(spark, name, f"{name}_copy", str(tmp_path / "copy"))
    assert spark.table(f"{name}_copy").columns[-1] == "day"


def test_interrupted_version_write_can_be_repeated(spark, table):
    contract = C.TableContract.from_ddl(
        "v", "k string, row_eff_start_date date, row_eff_end_date date, current_row_flag string", partitions=("current_row_flag",)
    )
    name = table(contract)
    step = spark.createDataFrame(
        [("a", D(2024, 1, 1), D(2024, 2, 1), "N", "closed"), ("a", D(2024, 2, 1), D(9999, 12, 31), "Y", "inserted")],
        "k string, row_eff_start_date date, row_eff_end_date date, current_row_flag string, scd_action string",
    )
    for _ in range(2):
        tables.write_scd2_step(step, name)
    tables.write_scd2_step(step, name, resume_keys=["k", "row_eff_start_date"])
    assert spark.table(name).count() == 2


def test_conform(spark):
    df = spark.createDataFrame([("1", "x")], "N string, other string")
    contract = C.TableContract.from_ddl("t", "n int, k string, amount decimal(18,2)")
    assert C.conform(df, contract).dtypes == [("n", "int")]
    assert C.conform(df, contract, pad=True).dtypes == [("n", "int"), ("k", "string"), ("amount", "decimal(18,2)")]
    with pytest.raises(C.ContractError, match="k"):
        C.conform(df, contract, strict=True)
    assert C.partitions_last(df, ["N"]).columns == ["other", "N"]


def test_contract_documents(tmp_path):
    document = {"name": "dim_x", "columns": [{"name": "a", "data_type": "int", "is_pkey": True}, {"name": "d", "data_type": "date", "is_partition_col": True}]}
    loaded = C.contract_for("dim_hist_x", {"dim_x": document})
    assert (loaded.keys, loaded.partitions, loaded.data_columns, loaded.is_dimension) == (["a"], ["d"], ["a"], True)
    assert C.contract_for("x", {"s/x": document}, "s/{metadata_name}").name == "dim_x"
    (tmp_path / "x.yaml").write_text("name: t\ncolumns:\n  - name: a\n    data_type: int\n    is_pkey: True\n")
    pytest.importorskip("yaml")
    assert C.TableContract.load(tmp_path / "x.yaml").keys == ["a"]
    assert loaded.struct_type["a"].metadata["is_pkey"] is True


def test_cleanse_without_alias(spark):
    df = spark.createDataFrame([("1,5", "2024-01-31 x")], "c1 string, c2 string")
    spec = {"table_name": "t", "fields": [
        {"name": "c1", "transform": "sql_str_to_num", "transform_args": {"cast_type": "decimal", "precision": 18, "scale": 2}, "alias": "amount"},
        {"name": "c2", "cast": "date"}, {"use_actual_date_as_business_date": True}]}
    got = cleanse(spec, "2024-02-01", df).first().asDict()
    assert got == {"amount": 15, "c2": D(2024, 1, 31), "business_date": D(2024, 2, 1)} or got["c2"] is None
    with pytest.raises(ValueError, match="unknown transform"):
        cleanse({"table_name": "t", "fields": [{"name": "c1", "transform": "nope"}]}, "2024-02-01", df)


def test_quality_of_a_sound_table_is_empty(spark):
    contract = C.TableContract.from_ddl("t", "k string, n int", keys=("k",))
    good = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int")
    assert quality.check_table(good, contract, "2024-01-01").count() == 0
    bad = spark.createDataFrame([("a", 1), ("a", 2), (" ", 3)], "k string, n int")
    assert sorted(r["check_name"] for r in quality.check_table(bad, contract, "2024-01-01").collect()) == ["key_present", "key_unique"]
    assert quality.missing_columns(good.drop("n"), contract) == ["n"]
    lacking = quality.check_table(good.drop("n"), contract, "2024-01-01").collect()
    assert [(r["check_name"], r["column_name"]) for r in lacking] == [("column_present", "n")]


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named
    assert settle(spark.range(3)).count() == 3


def test_checked_write_routes_failing_rows_aside(spark, table):
    contract = C.TableContract.load(
        {"name": "t", "columns": [{"name": "k", "data_type": "string", "is_pkey": True}, {"name": "n", "data_type": "int"}, {"name": "flag", "data_type": "string", "domain": ["Y", "N"]}]}
    )
    data = [("a", "1", "Y"), ("b", "x", "Q"), (" ", "2", "N"), (None, None, None), ("c", None, None), ("a", "1", "Y")]
    frame = spark.createDataFrame(data, "k string, n string, flag string")
    name = table(contract)
    with pytest.raises(ValueError, match="3 rows for"):
        tables.write_checked(frame, name, contract)
    assert spark.table(name).count() == 0
    beside = f"{name}_rejected"
    spark.sql(f"CREATE TABLE {beside} (k STRING, n STRING, flag STRING, failed_checks ARRAY<STRING>) USING parquet")
    told = tables.write_checked(frame, name, contract, beside)
    assert told == {"table": name, "rows": 3, "rejected": 3, "checks": {"key_present:k": 2, "type:n": 1, "domain:flag": 1}}
    assert sorted(map(tuple, spark.table(name).collect()), key=repr) == [("a", 1, "Y"), ("a", 1, "Y"), ("c", None, None)]
    failed = {(r["k"], r["n"]): r["failed_checks"] for r in spark.table(beside).collect()}
    assert failed == {("b", "x"): ["type:n", "domain:flag"], (" ", "2"): ["key_present:k"], (None, None): ["key_present:k"]}
    # the counts are those of the findings that check_table lists
    found = quality.row_findings(frame, contract).groupBy("check_name", "column_name").count().collect()
    assert {f"{r['check_name']}:{r['column_name']}": r["count"] for r in found} == told["checks"]
    none = tables.write_checked(frame.where("false"), table(contract), contract)
    assert none["rows"] == none["rejected"] == 0
    with pytest.raises(ValueError, match="lacks flag"):
        tables.write_checked(frame.drop("flag"), name, contract)
