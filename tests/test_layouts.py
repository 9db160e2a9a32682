"""Partitioned, bucketed and compacted tables: what is read, written and moved, and awkward partition values."""

import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from daymark.operators import contract as C
from daymark.operators import reconcile, scd
from daymark.shared import settle
from daymark.sinks import tables
from daymark.sources import versions as V

D = dt.date
TS = dt.datetime


@pytest.fixture
def table(spark, tmp_path):
    def make(ddl, partitions):
        name = f"t_{uuid.uuid4().hex[:10]}"
        contract = C.TableContract.from_ddl(name, ddl, partitions=partitions)
        assert tables.create_table(spark, name, contract, str(tmp_path / name))
        return name

    return make


def files_by(spark, name, column):
    return {r["p"]: set(r["f"]) for r in spark.table(name).groupBy(F.col(column).cast("string").alias("p")).agg(F.collect_set("_metadata.file_path").alias("f")).collect()}


DDL = "k string, n int, row_hash_value string, region string"


def scd1_table(spark, table, data):
    name = table(DDL, ("region",))
    rows = spark.createDataFrame(data, "k string, n int, region string")
    tables.write_table(scd.with_row_hash(rows), name)
    return name


def apply(spark, name, source):
    changes = scd.scd1_changes(spark.table(name), spark.createDataFrame(source, "k string, n int, region string"), ["k"], ["region"])
    return tables.write_scd1_changes(changes, name, ["k"])


def held(spark, name):
    return sorted((tuple(r) for r in spark.table(name).select("k", "n", "region").collect()), key=repr)


def test_moving_keys_leave_their_partition(spark, table):
    name = scd1_table(spark, table, [("1", 1, "A"), ("2", 2, "B"), ("3", 3, "B"), ("4", 4, "C"), ("5", 5, None), (None, 6, "B")])
    before = files_by(spark, name, "region")
    done = apply(spark, name, [("1", 1, "B"), ("5", 5, "x/y: z"), ("4", 4, "C"), ("7", 7, None)])
    assert held(spark, name) == sorted([("1", 1, "B"), ("2", 2, "B"), ("3", 3, "B"), ("4", 4, "C"), ("5", 5, "x/y: z"), (None, 6, "B"), ("7", 7, None)], key=repr)
    assert done["dropped"] == [("A",)]
    assert set(tables.partition_names(spark, name)) == {("B",), ("C",), ("x/y: z",), (None,)}
    # a partition without a changed key keeps its files
    assert files_by(spark, name, "region")["C"] == before["C"]
    # the same again changes nothing
    assert apply(spark, name, [("1", 1, "B"), ("5", 5, "x/y: z"), ("4", 4, "C")]) == {"written": [], "dropped": []}
    # emptying the partition of NULL
    apply(spark, name, [("7", 7, "C")])
    assert (None,) not in tables.partition_names(spark, name)
    assert len(held(spark, name)) == 7


def test_interrupted_move_can_be_repeated(spark, table):
    name = scd1_table(spark, table, [("1", 1, "A"), ("2", 2, "B")])
    source = spark.createDataFrame([("1", 9, "B")], "k string, n int, region string")
    changes = settle(scd.scd1_changes(spark.table(name), source, ["k"], ["region"]))
    # broken off before the emptied partition was dropped
    tables.write_table(scd.with_row_hash(spark.createDataFrame([("1", 9, "B"), ("2", 2, "B")], "k string, n int, region string")), name)
    assert len(held(spark, name)) == 3
    tables.write_scd1_changes(changes, name, ["k"])
    assert held(spark, name) == [("1", 9, "B"), ("2", 2, "B")]


def test_whole_merge_over_a_partitioned_table(spark, table):
    name = scd1_table(spark, table, [("1", 1, "A"), ("2", 2, "B")])
    source = spark.createDataFrame([("1", 1, "B"), ("3", 3, None)], "k string, n int, region string")
    tables.write_scd1(scd.scd1_merge(spark.table(name), source, ["k"]), name)
    assert held(spark, name) == sorted([("1", 1, "B"), ("2", 2, "B"), ("3", 3, None)], key=repr)
    assert ("A",) not in tables.partition_names(spark, name)


def test_changes_of_an_unpartitioned_table(spark, table):
    name = table("k string, n int, row_hash_value string", ())
    tables.write_table(scd.with_row_hash(spark.createDataFrame([("1", 1), ("2", 2)], "k string, n int")), name)
    changes = scd.scd1_changes(spark.table(name), spark.createDataFrame([("2", 5), ("3", 3)], "k string, n int"), ["k"])
    tables.write_scd1_changes(changes, name, ["k"])
    assert sorted((r["k"], r["n"]) for r in spark.table(name).collect()) == [("1", 1), ("2", 5), ("3", 3)]


def test_compaction_reduces_files_and_leaves_the_rest(spark, table, tmp_path):
    name = table("k int, pad string, at timestamp", ("at",))
    times = [TS(2024, 1, 1, 10, 30), TS(2024, 1, 2), None]
    rows = spark.range(600).selectExpr("cast(id as int) as k", "sha2(cast(id as string), 512) as pad", "cast(id % 3 as int) as p")
    stamp = F.element_at(F.array(*[F.lit(t).cast("timestamp") for t in times]), F.col("p") + 1)
    rows = rows.withColumn("at", stamp).drop("p")
    tables.write_table(rows.where("at is null or at < '2024-01-02'"), name, clustered=False, tasks=6)
    tables.write_table(rows.where("at = '2024-01-02'").orderBy("k"), name, mode="append", tasks=1, clustered=False)
    before = files_by(spark, name, "at")
    plan = tables.compact(spark, name, str(tmp_path / "new"), ["k"])
    after = files_by(spark, name, "at")
    assert {r["at"] for r in plan} == {"2024-01-01 10:30:00", None}
    assert len(before[None]) == 6 and len(after[None]) == 1 and len(after["2024-01-01 10:30:00"]) == 1
    assert after["2024-01-02 00:00:00"] == before["2024-01-02 00:00:00"]
    assert spark.table(name).count() == 600 and spark.table(name).select("k").distinct().count() == 600
    assert tables.compact(spark, name, str(tmp_path / "again"), ["k"]) == []
    # one large partition is cut into ranges of the key
    size = sum(r["bytes"] for r in tables.compaction_plan(spark.table(name).where("at is null"), ["at"], ["k"]).collect())
    tables.compact(spark, name, str(tmp_path / "ranges"), ["k"], where="at is null", file_bytes=size // 3)
    stats = sorted((r["least"]["k"], r["most"]["k"]) for r in tables.file_stats(spark.table(name).where("at is null"), ["at"], ["k"]).collect())
    assert 2 <= len(stats) <= 4
    assert all(a[1] < b[0] for a, b in zip(stats, stats[1:]))
    assert spark.table(name).where("at is null").count() == 200


def test_compaction_refuses_rows_that_came_meanwhile(spark, table, tmp_path, monkeypatch):
    name = table("k int, day date", ("day",))
    rows = spark.range(40).selectExpr("cast(id as int) as k", "date'2024-01-01' as day")
    tables.write_table(rows, name, clustered=False, tasks=4)
    plan = tables.compaction_plan

    def late(df, *options):
        found = plan(df, *options)
        found.collect()
        tables.write_table(rows.limit(1), name, mode="append")
        return found

    monkeypatch.setattr(tables, "compaction_plan", late)
    with pytest.raises(tables.TableChanged):
        tables.compact(spark, name, str(tmp_path / "new"), ["k"])
    assert spark.table(name).count() == 41


def test_as_of_read_prunes_months(spark, table, plan):
    name = table("k string, row_eff_start_date date, row_eff_end_date date, current_row_flag string, row_eff_start_month date", ("current_row_flag", "row_eff_start_month"))
    rows = spark.createDataFrame(
        [("a", D(2024, 1, 5), D(2024, 2, 10), "N"), ("a", D(2024, 2, 10), D(9999, 12, 31), "Y"), ("b", D(2024, 3, 1), D(9999, 12, 31), "Y")],
        "k string, row_eff_start_date date, row_eff_end_date date, current_row_flag string",
    )
    tables.write_table(V.with_start_month(rows), name)
    asked = V.valid_in_months(spark.table(name), "2024-02-09")
    assert [r["row_eff_start_date"] for r in asked.collect()] == [D(2024, 1, 5)]
    filters = next(line for line in plan(asked).splitlines() if "PartitionFilters" in line)
    assert "row_eff_start_month" in filters.split("PartitionFilters")[1].split("]")[0]
    assert [r["k"] for r in V.began_between(spark.table(name), "2024-02-01", "2024-03-01").orderBy("k").collect()] == ["a", "b"]


def test_month_whose_rows_all_close_is_dropped(spark, table):
    ddl = "k string, v string, row_hash_value string, row_eff_start_date date, row_eff_end_date date, current_row_flag string, row_eff_start_month date"
    name = table(ddl, ("current_row_flag", "row_eff_start_month"))
    first = scd.with_version_columns(scd.with_row_hash(spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")), "2024-01-10")
    tables.write_table(V.with_start_month(first), name)
    for date, source in (("2024-02-05", [("a", "x2"), ("b", "y2")]), ("2024-02-20", [("a", "x2")])):
        for _ in range(2):  # the second time nothing is left to do
            step = scd.scd2_step(V.current(spark.table(name)).drop(V.START_MONTH), spark.createDataFrame(source, "k string, v string"), ["k"], date)
            tables.write_scd2_months(V.with_start_month(step), name)
    assert ("Y", "2024-01-01") not in tables.partition_names(spark, name)
    got = sorted((r["k"], r["v"], str(r["row_eff_start_date"]), str(r["row_eff_end_date"]), r["current_row_flag"]) for r in spark.table(name).collect())
    assert got == [
        ("a", "x", "2024-01-10", "2024-02-05", "N"), ("a", "x2", "2024-02-05", "9999-12-31", "Y"),
        ("b", "y", "2024-01-10", "2024-02-05", "N"), ("b", "y2", "2024-02-05", "2024-02-20", "N"), ("b", "y2", "2024-02-20", "None", "Y"),
    ]


def test_bucketed_merge_moves_the_source_only(spark, tmp_path, plan):
    name = f"b_{uuid.uuid4().hex[:10]}"
    data = [(str(i), i) for i in range(50)] + [(None, 7)]
    first = scd.with_version_columns(scd.with_row_hash(spark.createDataFrame(data, "k string, n int")), "2024-01-01")
    tables.save_bucketed(first, name, str(tmp_path / "b"), ["k"], 4)
    source = spark.createDataFrame([*[(str(i), i + (i % 2)) for i in range(40)], ("new", 1), (None, 7)], "k string, n int")
    held = spark.table(name)
    stepped = scd.scd2_step(held, source, ["k"], "2024-02-01", buckets=4)
    plain = scd.scd2_step(held, source, ["k"], "2024-02-01")
    assert sorted(map(tuple, stepped.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    joined = plan(stepped)
    assert "SortMergeJoin" in joined or "ShuffledHashJoin" in joined
    # every exchange stands above the source, none above the table's scan
    lines = joined.splitlines()
    for n, line in enumerate(lines):
        if "Exchange" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            below = [x for x in lines[n + 1 :]]
            under = []
            for x in below:
                if len(x) - len(x.lstrip(" :+-")) <= depth:
                    break
                under.append(x)
            assert not any("FileScan" in x for x in under)
    tables.replace_bucketed(stepped.where("scd_action <> 'closed'").drop("scd_action"), name, str(tmp_path / "b2"), ["k"], 4)
    assert len(spark.table(name).inputFiles()) <= 6  # a file per bucket, one for rows without a key on either side
    again = scd.scd2_step(spark.table(name), source, ["k"], "2024-03-01", buckets=4)
    assert again.where("scd_action not in ('unchanged')").where("k is not null").count() == 0


def test_state_of_a_history(spark):
    ddl = "k string, v string, id long, actual_date date"
    history = spark.createDataFrame([("a", "1", 5, D(2024, 1, 1)), ("a", "2", 2, D(2024, 1, 3)), ("b", "1", 3, D(2024, 1, 2)), (None, "9", 4, D(2024, 1, 2))], ddl)
    state = scd.latest_state(history, ["k"], "id")
    source = spark.createDataFrame([("a", "2"), ("b", "7"), (None, "9"), (None, "8"), ("c", "1")], "k string, v string")
    fresh = scd.scd2_append_indexed(state, source, ["k"], "2024-01-04", "id", clean=False)
    assert sorted((r["k"] or "", r["v"]) for r in fresh.collect()) == [("", "8"), ("b", "7"), ("c", "1")]
    assert sorted(r["id"] for r in fresh.collect()) == [6, 7, 8]
    whole = scd.scd2_append(history, source, ["k"], "2024-01-04", "id", clean=False)
    assert sorted(map(repr, (tuple(r) for r in whole.select("k", "v", "id").collect()))) == sorted(map(repr, (tuple(r) for r in fresh.select("k", "v", "id").collect())))
    carried = scd.next_state(state, fresh, ["k"], "id")
    both = scd.latest_state(history.unionByName(fresh.select(*history.columns)), ["k"], "id")
    assert reconcile.is_equal(carried, both)
    with pytest.raises(Exception, match="before the latest row"):
        scd.scd2_append_indexed(state, source, ["k"], "2024-01-01", "id").collect()


def test_digests_of_equal_tables_need_no_row_shuffle(spark, plan):
    rows = spark.range(1000).selectExpr("id % 7 as p", "id", "cast(id as double) as x")
    same = reconcile.difference_by_digest(rows, rows.orderBy(F.desc("id")).withColumn("x", F.col("x").cast("float")), ["p"])
    assert same.count() == 0
    assert reconcile.differing_groups(rows, rows.union(rows.limit(1)), ["p"]) == [(0,)]
    assert reconcile.difference_by_digest(rows, rows.union(rows.limit(1))).collect()[0]["copies"] == 1
    nulls = spark.createDataFrame([(None, 1)], "p string, n int")
    found = reconcile.difference_by_digest(nulls, nulls.withColumn("n", F.lit(2)), ["p"]).collect()
    assert sorted((r["n"], r["side"]) for r in found) == [(1, "left_only"), (2, "right_only")]


def test_weighted_numbers_are_those_of_the_fanned_out_rows(spark):
    from daymark.operators.sequence import number_rows, number_weighted

    rows = spark.createDataFrame([(k, k % 3) for k in range(50)], "k int, w int")
    fanned = rows.where("w > 0").select("k", F.explode(F.sequence(F.lit(1), F.col("w"))).alias("place"))
    want = {(r["k"], r["place"]): r["sequence"] for r in number_rows(fanned, ["k", "place"], 7).collect()}
    firsts = {r["k"]: r["first"] for r in number_weighted(rows, ["k"], "w", 7, partitions=5).collect()}
    assert want == {(k, p): firsts[k] + p - 1 for k, p in want}


def test_only_listed_columns_are_padded(spark):
    df = spark.createDataFrame([("x",)], "k string")
    contract = C.TableContract.from_ddl("t", "k string, agent string, amount int")
    assert C.conform(df.withColumn("amount", F.lit(1)), contract, strict=True, pad=["Agent"]).columns == ["k", "agent", "amount"]
    with pytest.raises(C.ContractError, match="amount"):
        C.conform(df.withColumnRenamed("k", "K"), contract, strict=True, pad=["agent"])


def test_month_end_starts_no_scan(spark, table, plan):
    from daymark.sources import snapshots as S

    name = table("k int, day date", ("day",))
    tables.write_table(spark.createDataFrame([(1, D(2024, 1, 3)), (2, D(2024, 1, 30)), (3, D(2024, 2, 5)), (4, None)], "k int, day date"), name)
    # files don't matter for the date: those of the month's last day are gone when it is looked up
    there = S.previous_month_end_of_table(spark, name, "2024-02-10")
    assert [r["k"] for r in there.collect()] == [2]
    for path in there.inputFiles():
        Path(path.removeprefix("file://")).unlink()
    spark.sql(f"REFRESH TABLE {name}")
    found = S.previous_month_end_of_table(spark, name, "2024-02-10")
    assert "2024-01-30" in plan(found) and found.count() == 0
    assert "PartitionFilters: [isnotnull(day" in plan(found)
    assert S.previous_month_end_of_table(spark, name, "2024-06-10").count() == 0
