import collections
import random

import pytest
from pyspark.sql import functions as F

from daymark.llm.numbering import number_within
from daymark.llm.sharding import shard_evenly, shard_table


def placed(corpus, rows, shards=5, parts=3):
    frame = corpus.createDataFrame([(i, t, "s", 0, 1) for i, t in rows], "doc_id long, text string, shard string, n int, best int").repartition(parts)
    return shard_evenly(frame, F.col("text"), shards=shards).collect()


def even(got, shards):
    held = collections.defaultdict(list)
    for r in got:
        held[r["shard"]].append(r["slot"])
    sizes = [len(held[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(got)
    assert all(sorted(x) == list(range(len(x))) for x in held.values())


def test_groups_stay_together_and_counts_are_even(corpus):
    rng = random.Random(1)
    rows = [(i, f"text {rng.randrange(300)}") for i in range(500)] + [(1000 + i, None) for i in range(40)] + [(2000, ""), (2001, ""), (3, "text 3"), (None, "nobody")]
    got = placed(corpus, rows)
    assert len(got) == len(rows)
    even(got, 5)
    where = collections.defaultdict(set)
    for r in got:
        where[r["text"]].add(r["shard"])
    del where[None]
    assert sum(len(s) > 1 for s in where.values()) <= 3


def test_group_larger_than_a_shard(corpus):
    rows = [(i, "the same") for i in range(200)] + [(200 + i, f"t{i // 2}") for i in range(200)]
    got = placed(corpus, rows, shards=8)
    even(got, 8)
    sizes = collections.Counter(r["shard"] for r in got if r["text"] == "the same")
    assert sum(n >= 30 for n in sizes.values()) >= 3  # not spread over all shards
    pairs = collections.defaultdict(set)
    for r in got:
        pairs[r["text"]].add(r["shard"])
    assert sum(len(s) > 1 for t, s in pairs.items() if t != "the same") < 25


@pytest.mark.parametrize("count", [0, 1, 4, 7])
def test_few_rows(corpus, count):
    even(placed(corpus, [(i, "same") for i in range(count)], shards=5), 5)


def test_same_answer_however_partitioned(corpus):
    rows = [(i, f"text {i % 90}") for i in range(300)]
    one, other = ({(r["doc_id"], r["shard"], r["slot"]) for r in placed(corpus, rows, parts=p)} for p in (1, 7))
    assert one == other


def test_contract_columns(corpus):
    import zlib

    rows = {1: "é", 2: None, 3: "", 4: "é"}
    got = {r["doc_id"]: r for r in shard_table(corpus.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()}
    assert {i: (r["size"], r["text_crc32"]) for i, r in got.items()} == {i: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows.items()}
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in got.values())


def test_numbers_are_gapless(corpus):
    frame = corpus.createDataFrame([(i % 3, i // 2, "x") for i in range(100)], "g int, id long, n string")
    got = number_within(frame, "g", "id", "number", 100, bucket_rows=7).collect()
    for g in range(3):
        own = sorted(r["number"] for r in got if r["g"] == g)
        assert own == list(range(len(own)))
