"""Shapes that must hold at any size: no funnels, no pair explosions, hot keys combined or split."""

import pytest
from pyspark.sql import functions as F

from daymark.operators import dedup, joins, reconcile, rollups, scd
from daymark.operators.sequence import number_rows
from daymark.shared import settle
from daymark.showcase import ENTRIES, marts

HOT, REST = 30_000, 60_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key."""
    key = F.when(F.col("id") < HOT, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") / 3).cast("long")))
    return spark.range(0, HOT + REST, 1, 8).select(key.alias("k"), F.col("id").alias("n"), F.lit("x" * 20).alias("pad"))


def test_numbers_are_dense_and_spread(spark, skewed):
    numbered = number_rows(skewed, ["k", "n"], start=100, partitions=8)
    got = numbered.agg(F.min("sequence"), F.max("sequence"), F.countDistinct("sequence")).first()
    assert tuple(got) == (101, HOT + REST + 100, HOT + REST)
    ordered = numbered.orderBy("sequence").select("k", "n").collect()
    assert ordered == sorted(ordered)
    sizes = [len(p) for p in numbered.select("n").rdd.glom().collect()]
    assert max(sizes) < 2 * (HOT + REST) / 8


def test_numbering_never_funnels_rows(skewed, plan):
    text = plan(number_rows(skewed, ["k", "n"], partitions=8))
    big_side = text.split("BroadcastExchange")[0]
    assert "SinglePartition" not in big_side


def test_first_per_key_is_cut_in_the_map_tasks(skewed, plan):
    first = dedup.first_per_key(skewed, ["k"], [F.col("n").desc()])
    assert "WindowGroupLimit" in plan(first) and "Partial" in plan(first)
    assert first.where("k = 'hot'").select("n").collect() == [(HOT - 1,)]
    assert first.count() == skewed.select("k").distinct().count()


def test_flags_are_combined_before_the_shuffle(skewed, plan):
    text = plan(rollups.any_flags(skewed, ["k"], {"f": F.col("n") > 5}))
    assert "partial_max" in text


def test_rows_without_a_key_are_scattered(spark):
    rows = spark.range(0, 20_000, 1, 8).select(
        F.col("id"), F.when(F.col("id") < 15_000, "").otherwise(F.col("id").cast("string")).alias("card")
    )
    cards = spark.range(15_000, 18_000).select(F.col("id").cast("string").alias("card"), F.lit(1).alias("found"))
    with_blank = cards.union(spark.createDataFrame([("", 9)], "card string, found int"))
    forced = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in forced.items():
        spark.conf.set(name, value)
    try:
        joined = joins.enrich_known(rows, with_blank, "card", ["id"])
        sizes = [len(p) for p in joined.select("id").rdd.glom().collect()]
        assert joined.where("found = 1").count() == 3000 and joined.where("found = 9").count() == 0
        assert joined.where("card = ''").count() == 15_000
        assert sum(sizes) == 20_000 and max(sizes) < 10_000
    finally:
        for name in forced:
            spark.conf.unset(name)


def test_ties_of_a_hot_value_are_spread(skewed):
    numbered = number_rows(skewed, ["k"], partitions=8)
    sizes = [len(p) for p in numbered.select("n").rdd.glom().collect()]
    assert max(sizes) < 2 * (HOT + REST) / 8 and numbered.select("sequence").distinct().count() == HOT + REST


def test_hot_key_is_split_when_the_other_side_was_grouped(spark, skewed, plan):
    forced = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for name, value in forced.items():
        spark.conf.set(name, value)
    try:
        grouped = rollups.any_flags(skewed, ["k"], {"f": F.col("n") >= 0})
        joined = joins.join_splitting(skewed, grouped, ["k"])
        sizes = [len(p) for p in joined.select("n").rdd.glom().collect()]
        joined.collect()
        assert "skew=true" in plan(joined)
        assert sum(sizes) == HOT + REST and max(sizes) < HOT
    finally:
        for name in forced:
            spark.conf.unset(name)


def test_rows_without_a_business_key_are_scattered(spark):
    rows = spark.range(0, 8_000, 1, 4).select(F.lit(None).cast("string").alias("k"), F.col("id").cast("string").alias("v"))
    target = scd.with_version_columns(scd.with_row_hash(rows.limit(0)), "2024-01-01")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        merged = scd.scd2_merge(target, rows, ["k"], "2024-05-10")
        sizes = [len(p) for p in merged.select("v").rdd.glom().collect()]
        assert sum(sizes) == 8_000 and max(sizes) < 4_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_keys_of_different_types_still_meet(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "x")], "k long, w string")
    assert sorted(joins.join_splitting(left, right, ["k"]).select("v", "w").collect()) == [("a", "x"), ("b", None)]
    floats = spark.createDataFrame([(0.0, "x")], "k double, w string")
    zero = spark.createDataFrame([(-0.0, "a")], "k double, v string")
    assert joins.join_splitting(zero, floats, ["k"]).first()["w"] == "x"
    cards = spark.createDataFrame([("1",), ("",), (None,)], "k string")
    got = joins.enrich_known(cards, right, "k", ["k"]).select("k", "w").collect()
    assert {tuple(r) for r in got} == {("1", "x"), ("", None), (None, None)}


def test_reconcile_many_copies(spark):
    left = spark.range(0, 5_000, 1, 4).select(F.lit("same").alias("v"))
    right = spark.createDataFrame([("same",), ("other",), ("other",)], "v string")
    found = sorted(tuple(r) for r in reconcile.difference(left, right).collect())
    assert found == [("other", "right_only", 2), ("same", "left_only", 4999)]
    assert reconcile.difference_rows(left, right).count() == 5001
    assert reconcile.difference_count(left, right) == 5001
    assert not reconcile.is_equal(left, right) and reconcile.is_equal(left, left.repartition(2))


def test_reconcile_sees_both_sides(spark):
    left, right = (spark.createDataFrame([(v,) for v in values], "v int") for values in ([1, 2, 3], [2, 3]))
    assert reconcile.difference_count(left, right) == reconcile.difference_count(right, left) == 1


def test_merge_has_one_join_and_no_window(spark, plan):
    rows = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit("1").alias("v"))
    target = scd.with_version_columns(scd.with_row_hash(rows), "2024-01-01")
    text = plan(scd.scd2_merge(target, rows, ["k"], "2024-05-10"))
    assert text.count("Join") == 1 and "Window" not in text and "FullOuter" in text


def test_fan_out_needs_no_join(spark, plan):
    text = plan(joins.fan_out(spark.range(10), [{"a": 1}, {"a": 2}]))
    assert "Join" not in text and "Exchange" not in text


@pytest.mark.parametrize(
    "name",
    ["snap_last", "rules_nested", "rate_fan_out", "any_flags", "account_rows", "product_flags", "scd2_changes", "scd2_repair",
     "reconcile_diff", "dq_errors", "contacted_flag", "address_summary", "id_summary", "card_profile", "price_auto"],
)
def test_queries_stay_in_the_jvm_without_pair_joins(spark, plan, name):
    text = plan(ENTRIES[name](spark, "/root/testdata/sf0.001"))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text


def test_columns_are_pruned(spark, plan):
    text = plan(ENTRIES["any_flags"](spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in text


def test_contact_texts_are_not_broadcast(spark, plan):
    """Seven rows a customer, exploded and not yet counted: files of any length may hold more than the driver takes."""
    text = plan(ENTRIES["contact_summary"](spark, "/root/testdata/sf0.001"))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_base_broadcasts_lists_of_places_only(spark, plan):
    """Regions, nations and branches may be sent to all tasks; what has a row per customer, account or loan is merged."""
    text = plan(ENTRIES["base_wide"](spark, "/root/testdata/sf0.001"))
    # orders and lines meet in the test input, before the job
    sent = [line for line in text.split("\n") if "BroadcastHashJoin" in line and "orderkey" not in line]
    assert len(sent) == 3 and sum("nationkey" in line or "regionkey" in line for line in sent) == 2
    assert sum("SortMergeJoin" in line for line in text.split("\n")) == 17


def test_buyers_of_cards_meet_clusters_leads_and_calls_in_merges(spark, plan):
    text = plan(ENTRIES["ptb_card"](spark, "/root/testdata/sf0.001"))
    for key in ("bbn", "relatedtoid", "activity_key"):
        assert any(f"SortMergeJoin [{key}#" in line for line in text.split("\n"))


@pytest.mark.parametrize("name", ["stp_card", "stp_home", "stp_auto"])
def test_offers_build_their_base_without_guessed_broadcasts(spark, plan, monkeypatch, name):
    built = []
    monkeypatch.setattr(marts, "STORED", {})
    monkeypatch.setattr(marts, "settle", lambda df: built.append(plan(df)) or settle(df))
    ENTRIES[name](spark, "/root/testdata/sf0.001")
    lines = built[0].split("\n")
    assert len(built) == 1 and sum("SortMergeJoin" in line for line in lines) == 17
    assert sum("BroadcastHashJoin" in line and "orderkey" not in line for line in lines) == 3


@pytest.mark.parametrize("name", ["ptb_auto", "ptb_home"])
def test_buyers_meet_their_scores_in_a_merge(spark, plan, name):
    lines = plan(ENTRIES[name](spark, "/root/testdata/sf0.001")).split("\n")
    assert [line.split("- ")[1].split(" ")[0] for line in lines if "LeftOuter" in line] == ["SortMergeJoin"]
