import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymark.operators import scd
from daymark.sources.versions import OPEN_END

D = dt.date
RUN, NOW = "2024-05-10", dt.datetime(2024, 5, 10, 9, 0)
OPEN = D(9999, 12, 31)
OLD = dt.datetime(2024, 1, 1, 9, 0)


def table(spark, rows, control=True):
    """rows: key, value, start, end, flag; the hash is worked out unless value is marked stale."""
    df = spark.createDataFrame(rows, "k string, v string, row_eff_start_date date, row_eff_end_date date, current_row_flag string")
    df = df.withColumn(scd.HASH, scd.row_hash(["k", "v"]))
    return scd.with_control_columns(df, "old", OLD) if control else df


def source(spark, rows):
    return spark.createDataFrame(rows, "k string, v string")


def state(df):
    columns = ["k", "v", "row_eff_start_date", "row_eff_end_date", "current_row_flag"]
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)


def merge(target, src, run=RUN, **options):
    return scd.scd2_merge(target, src, ["k"], run, user="new", now=NOW, **options)


START = D(2024, 1, 1)
TODAY = D(2024, 5, 10)


@pytest.mark.parametrize(
    ("target", "src", "expected"),
    [
        pytest.param([], [("a", "1")], [("a", "1", TODAY, OPEN, "Y")], id="new"),
        pytest.param([("a", "1", START, OPEN, "Y")], [("a", "1")], [("a", "1", START, OPEN, "Y")], id="same"),
        pytest.param(
            [("a", "1", START, OPEN, "Y")], [("a", "2")],
            [("a", "1", START, TODAY, "N"), ("a", "2", TODAY, OPEN, "Y")], id="changed",
        ),
        pytest.param(
            [("a", "1", START, OPEN, "Y")], [],
            [("a", "1", START, TODAY, "N"), ("a", "1", TODAY, None, "Y")], id="gone",
        ),
        pytest.param([("a", "1", START, None, "Y")], [], [("a", "1", START, None, "Y")], id="still gone"),
        pytest.param(
            [("a", "1", START, None, "Y")], [("a", "1")],
            [("a", "1", START, None, "N"), ("a", "1", TODAY, OPEN, "Y")], id="back unchanged",
        ),
        pytest.param(
            [("a", "1", START, None, "Y")], [("a", "2")],
            [("a", "1", START, None, "N"), ("a", "2", TODAY, OPEN, "Y")], id="back changed",
        ),
        pytest.param([("a", "1", TODAY, OPEN, "Y")], [("a", "2")], [("a", "2", TODAY, OPEN, "Y")], id="changed same day"),
        pytest.param([("a", "1", TODAY, OPEN, "Y")], [], [("a", "1", TODAY, None, "Y")], id="gone same day"),
        pytest.param([("a", "1", TODAY, None, "Y")], [("a", "1")], [("a", "1", TODAY, OPEN, "Y")], id="back same day"),
        pytest.param(
            [("a", "0", D(2023, 1, 1), START, "N"), ("a", "1", START, OPEN, "Y")], [("a", "1")],
            [("a", "0", D(2023, 1, 1), START, "N"), ("a", "1", START, OPEN, "Y")], id="history stays",
        ),
    ],
)
def test_truth_table(spark, target, src, expected):
    merged = merge(table(spark, target), source(spark, src))
    assert state(merged) == sorted(expected, key=repr)
    assert state(merge(merged, source(spark, src))) == sorted(expected, key=repr)


def test_missing_hash_counts_as_changed(spark):
    target = table(spark, [("a", "1", START, OPEN, "Y")]).withColumn(scd.HASH, F.lit(None).cast("string"))
    assert [r[4] for r in state(merge(target, source(spark, [("a", "1")])))] == ["N", "Y"]


def test_control_columns(spark):
    rows = merge(table(spark, [("a", "1", START, OPEN, "Y"), ("b", "1", START, OPEN, "Y")]), source(spark, [("a", "2"), ("b", "1")]))
    got = {(r["k"], r["current_row_flag"]): r for r in rows.collect()}
    closed, opened, kept = got["a", "N"], got["a", "Y"], got["b", "Y"]
    assert (closed[scd.CREATE_USER], closed[scd.UPDATE_USER], closed[scd.UPDATE_TS]) == ("old", "new", NOW)
    assert (opened[scd.CREATE_USER], opened[scd.CREATE_TS], opened[scd.UPDATE_TS]) == ("new", NOW, NOW)
    assert (kept[scd.UPDATE_USER], kept[scd.UPDATE_TS]) == ("old", OLD)
    with pytest.raises(ValueError):
        scd.scd2_merge(table(spark, []), source(spark, []), ["k"], RUN)
    bare = scd.scd2_merge(table(spark, [("a", "1", START, OPEN, "Y")], control=False), source(spark, []), ["k"], RUN)
    assert scd.CREATE_TS not in bare.columns and bare.count() == 2


def test_many_runs_keep_one_current_row_and_disjoint_intervals(spark):
    df = table(spark, [])
    days = ["2024-01-01", "2024-02-01", "2024-02-01", "2024-03-01", "2024-04-01"]
    contents = [[("a", "1"), ("b", "1")], [("a", "2")], [("a", "3"), ("b", "2")], [("b", "2")], [("a", "3"), ("c", "1")]]
    for run, rows in zip(days, contents, strict=True):
        df = spark.createDataFrame(merge(df, source(spark, rows), run).collect(), df.schema)
    rows = df.collect()
    for key in "abc":
        mine = sorted((r for r in rows if r["k"] == key), key=lambda r: r["row_eff_start_date"])
        assert sum(r["current_row_flag"] == "Y" for r in mine) == 1
        for left, right in zip(mine, mine[1:], strict=False):
            assert (left["row_eff_end_date"] or left["row_eff_start_date"]) <= right["row_eff_start_date"]


def test_hash_keeps_fields_apart(spark):
    row = spark.createDataFrame([("ab", "c", "a", "bc", None)], "a string, b string, c string, d string, e string")
    got = row.select(scd.row_hash(["a", "b"]), scd.row_hash(["c", "d"]), scd.row_hash(["a", "e"]), scd.row_hash(["a", "b"], ""), scd.row_hash(["c", "d"], "")).first()
    assert got[0] != got[1] and got[2] is not None and got[3] == got[4]


def test_scd1(spark):
    target = table(spark, [(k, "1", START, OPEN, "Y") for k in "abc"]).drop(*scd.VERSION_COLUMNS)
    merged = scd.scd1_merge(target, source(spark, [("a", "1"), ("b", "2"), ("d", "1")]), ["k"], "new", NOW)
    got = {r["k"]: (r["v"], r[scd.CREATE_USER], r[scd.UPDATE_USER]) for r in merged.collect()}
    assert got == {"a": ("1", "old", "old"), "b": ("2", "old", "new"), "c": ("1", "old", "old"), "d": ("1", "new", "new")}


def test_repair(spark):
    rows = [
        # two current rows: the open one stays although it started later
        ("a", "1", D(2024, 1, 1), D(2024, 2, 1), "Y"), ("a", "2", D(2024, 3, 1), OPEN, "Y"),
        # one content in adjoining intervals: one row with the whole interval
        ("b", "1", D(2024, 1, 1), D(2024, 2, 1), "N"), ("b", "1", D(2024, 2, 1), OPEN, "Y"),
        # the same content again after a gap, and after a tombstone: history, stays
        ("c", "1", D(2024, 1, 1), D(2024, 2, 1), "N"), ("c", "1", D(2024, 3, 1), OPEN, "Y"),
        ("d", "1", D(2024, 1, 1), D(2024, 2, 1), "N"), ("d", "1", D(2024, 2, 1), None, "N"), ("d", "2", D(2024, 3, 1), OPEN, "Y"),
        # a row stored twice
        ("e", "1", D(2024, 1, 1), OPEN, "Y"), ("e", "1", D(2024, 1, 1), OPEN, "Y"),
    ]
    repaired = state(scd.scd2_repair(table(spark, rows), ["k"]))
    joined = ("b", "1", D(2024, 1, 1), OPEN, "Y")
    assert repaired == sorted([rows[1], joined, *rows[4:9], rows[9]], key=repr)
    again = scd.scd2_repair(table(spark, repaired), ["k"])
    assert state(again) == repaired


def test_repair_keeps_what_comes_back(spark):
    rows = [
        ("a", "A", D(2024, 1, 1), D(2024, 2, 1), "N"), ("a", "A", D(2024, 2, 1), D(2024, 3, 1), "N"), ("a", "B", D(2024, 3, 1), D(2024, 6, 1), "N"),
        ("a", "A", D(2024, 6, 1), OPEN, "Y"),
    ]
    want = [("a", "A", D(2024, 1, 1), D(2024, 3, 1), "N"), rows[2], rows[3]]
    assert state(scd.scd2_repair(table(spark, rows), ["k"])) == sorted(want, key=repr)


def test_runs_dated_back_and_repeated_source_keys_are_refused(spark):
    held = table(spark, [("a", "1", START, OPEN, "Y"), ("b", "1", START, OPEN, "Y")])
    with pytest.raises(Exception, match="before the start of an open row"):
        merge(held, source(spark, [("a", "2"), ("b", "1")]), "2023-12-01").collect()
    # nothing would be closed
    assert len(merge(held, source(spark, [("a", "1"), ("b", "1")]), "2023-12-01").collect()) == 2
    for rows in ([("a", "1"), ("a", "1")], [("a", "1"), ("a", "2"), ("b", "1")]):
        with pytest.raises(Exception, match="more than once: a"):
            merge(held, source(spark, rows)).collect()
        with pytest.raises(Exception, match="more than once: a"):
            scd.scd1_merge(held.drop(*scd.VERSION_COLUMNS), source(spark, rows), ["k"], "new", NOW).collect()
    # rows without a key aren't keys
    assert len(merge(held, source(spark, [("a", "1"), ("b", "1"), (None, "1"), (None, "1")])).collect()) == 4


def test_hash_is_taken_of_what_the_table_holds(spark):
    held = scd.with_row_hash(spark.createDataFrame([("a", 5)], "k string, v int").withColumn("v", F.col("v").cast("decimal(18,2)")))
    held = scd.with_version_columns(held, START)
    merged = scd.scd2_merge(held, spark.createDataFrame([("a", 5.0)], "k string, v double"), ["k"], RUN)
    assert [(r["k"], r["row_eff_start_date"]) for r in merged.collect()] == [("a", START)]


def test_merge_can_repair_first(spark):
    twice = table(spark, [("a", "1", START, OPEN, "Y"), ("a", "1", START, OPEN, "Y")])
    assert state(merge(twice, source(spark, [("a", "1")]), repair=True)) == [("a", "1", START, OPEN, "Y")]


def test_append(spark):
    history = spark.createDataFrame(
        [("a", "1", 1, START), ("b", "1", 2, START), ("b", "2", 3, D(2024, 2, 1))], "k string, v string, id long, actual_date date"
    )
    new = scd.scd2_append(history, source(spark, [("a", "1 "), ("b", "1"), ("c", "n/a")]), ["k"], RUN, id_column="id")
    assert sorted(tuple(r) for r in new.collect()) == [("b", "1", 4, TODAY), ("c", "", 5, TODAY)]
    assert scd.scd2_append(history.drop("id"), source(spark, [("a", "1")]), ["k"], RUN).count() == 0
    keyless = history.drop("id").unionByName(spark.createDataFrame([(None, "7", START)], "k string, v string, actual_date date"))
    assert [r["v"] for r in scd.scd2_append(keyless, source(spark, [(None, "7"), (None, "8")]), ["k"], RUN, clean=False).collect()] == ["8"]


def test_migrate(spark):
    old = source(spark, [("a", "1"), ("b", "1")])
    moved = scd.migrate_to_scd2(old, source(spark, [("a", "1"), ("b", "2")]), ["k"], RUN, initial_date="2024-01-01")
    assert state(moved) == [("a", "1", START, OPEN, "Y"), ("b", "1", START, TODAY, "N"), ("b", "2", TODAY, OPEN, "Y")]
    assert str(OPEN) == OPEN_END
