"""Even shards that keep linked documents together, by balanced label propagation.

Documents start in shards by a hash. In each round every group of linked documents looks where its members are (a grouped
count), wants all of them in the shard that has most, and moves there as far as that shard's quota lets it; a group that is
turned away looks at shards with room in the next round. A group larger than a shard is cut into pieces that fit, by a
hash, as some of its links must be cut in any case. Unlinked documents cost no cut edge wherever they go, so they are
dealt last, by number, into the room that is left. Counts of two shards then differ by one at most.

The driver sees one row per shard and round. Groups are handled by grouped counts and by joins whose hot keys can be split;
rows are numbered in buckets, never a shard at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import kept, twin_hash
from daymark.llm.numbering import number_within
from daymark.operators.joins import join_splitting

SHARDS = 24
ROUNDS = 8
KEY, PIECE, SHARD, PIECES, BEST = "__sh_key", "__sh_piece", "__sh_shard", "__sh_pieces", "__sh_best"


def _values(numbers: list[int]) -> Column:
    return F.array(*[F.lit(int(n)) for n in numbers])


def _loads(rows: DataFrame, shards: int) -> list[int]:
    out = [0] * shards
    for r in rows.groupBy(SHARD).agg(F.count(F.lit(1)).alias("n")).collect():
        out[r[SHARD]] = r["n"]
    return out


def _round(state: DataFrame, quota: list[int], opened: list[bool], shards: int) -> tuple[DataFrame, bool]:
    """One round: what the groups want, what the quotas allow, and the rows after the moves."""
    unit = [KEY, PIECE]
    here = state.groupBy(*unit, SHARD).agg(F.count(F.lit(1)).alias("n"))
    is_open = F.element_at(F.array(*[F.lit(x) for x in opened]), F.col(SHARD) + 1)
    taste = F.struct(is_open.alias("open"), F.col("n"), F.xxhash64(*unit, SHARD))
    wanted = here.groupBy(*unit).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("places"), F.max_by(SHARD, taste).alias("best"), F.max(is_open).alias("any"))
    free = [s for s in range(shards) if opened[s]] or list(range(shards))
    other = F.element_at(_values(free), (F.pmod(F.xxhash64(*unit, F.lit("other")), F.lit(len(free))) + 1).cast("int"))
    wanted = kept(wanted.withColumn("best", F.when(F.col("any") | (F.col("places") == 1), F.col("best")).otherwise(other)), "wanted")
    load, unsettled = [0] * shards, 0
    for r in wanted.groupBy("best").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("places") > 1, 1).otherwise(0)).alias("moving")).collect():
        load[r["best"]], unsettled = r["n"], unsettled + r["moving"]
    if not unsettled:
        return state, True
    # of a shard that too many want, the share of groups that fits is let in
    share = [min(1.0, q / n) if n else 1.0 for q, n in zip(quota, load, strict=True)]
    drawn = F.pmod(F.xxhash64(*unit, F.lit("draw")), F.lit(1 << 20)) / float(1 << 20)
    moves = wanted.where((F.col("places") > 1) & (drawn < F.element_at(F.array(*[F.lit(x) for x in share]), F.col("best") + 1))).select(*unit, F.col("best").alias(BEST))
    moved = join_splitting(state, moves, unit, "left").withColumn(SHARD, F.coalesce(BEST, F.col(SHARD))).drop(BEST)
    return kept(moved, "sharding"), False


def shard_evenly(docs: DataFrame, link: Column, doc_id: str = "doc_id", shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """All rows and columns with ``shard`` (0 to ``shards`` - 1) and ``slot`` (0, 1, ... in each shard), which replace such columns.

    Rows with equal ``link`` are linked; a null links with nothing. Repeated rows are placed one by one, so are rows of a
    null id. Counts of any two shards differ by one at most, also with fewer rows than shards. Answers depend on the
    rows only, not on how they are partitioned. An empty table gives an empty result.
    """
    rows = kept(docs.drop("shard", "slot").withColumn(KEY, F.when(link.isNotNull(), twin_hash(link))), "sharding-rows")
    total = rows.count()
    target = [total // shards + (s < total % shards) for s in range(shards)]
    groups = rows.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # pieces cut by a hash vary in size, so they are made to fill nine tenths of a shard at most
    most = max(1, int(0.9 * (total // shards)))
    cut = groups.select(KEY, F.ceil(F.col("n") / most).cast("int").alias(PIECES))
    spread = F.pmod(F.xxhash64(F.lit("start"), doc_id), F.lit(shards)).cast("int")
    joined = kept(join_splitting(rows, cut, [KEY], "left").withColumn(SHARD, spread), "sharding-groups")
    alone = joined.where(F.col(PIECES).isNull())
    state = joined.where(F.col(PIECES).isNotNull()).withColumn(PIECE, F.pmod(F.xxhash64(F.lit("piece"), doc_id), F.col(PIECES)))
    opened = [True] * shards
    for _ in range(rounds):
        state, settled = _round(state, target, opened, shards)
        if settled:
            break
        opened = [n < t for n, t in zip(_loads(state, shards), target, strict=True)]
    # linked rows over a shard's count, if any, join the unlinked ones
    numbered = kept(number_within(state.drop(PIECE), SHARD, doc_id, "slot", total), "sharding-linked")
    most_slots = F.element_at(_values(target), F.col(SHARD) + 1)
    stay = numbered.where(F.col("slot") < most_slots)
    pool = alone.unionByName(numbered.where(F.col("slot") >= most_slots).drop("slot")).withColumn("__sh_all", F.lit(0))
    held = [min(n, t) for n, t in zip(_loads(numbered, shards), target, strict=True)]
    first, at = [], 0
    for s in range(shards):
        first.append(at)
        at += target[s] - held[s]
    dealt = number_within(pool, "__sh_all", doc_id, "__sh_number", total)
    # the last shard that begins at or before the number and has room
    begins = [f if target[s] > held[s] else at + 1 for s, f in enumerate(first)]
    place = F.array_max(F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.element_at(_values(begins), s + 1) <= F.col("__sh_number")))
    dealt = dealt.withColumn(SHARD, place.cast("int"))
    slot = F.col("__sh_number") - F.element_at(_values(first), F.col(SHARD) + 1) + F.element_at(_values(held), F.col(SHARD) + 1)
    dealt = dealt.withColumn("slot", slot.cast("long")).drop("__sh_number", "__sh_all")
    return stay.unionByName(dealt).withColumn("shard", F.col(SHARD)).drop(KEY, PIECES, SHARD)


def shard_table(docs: DataFrame) -> DataFrame:
    """``documents`` in 24 shards of equal counts, equal texts linked: sizes, checksums, shard and slot of each row."""
    octets = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select("doc_id", (F.octet_length(octets) + 8).cast("long").alias("size"), F.crc32(octets).alias("text_crc32"), F.when(F.col("text").isNotNull(), twin_hash(F.col("text"))).alias("__sh_text"))
    placed = shard_evenly(narrow, F.col("__sh_text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
