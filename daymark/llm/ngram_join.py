"""Jaccard self-join of documents on word shingles with adaptive multi-match prefixes.

Shingles are ordered from rare to frequent by a count sketch of all documents. A set of n shingles that is to overlap another one by at
least o = ceil(t n) shares l of its first n - o + l shingles with it, for any l. l = 1 is the usual prefix filter; a document whose
first shingles look frequent takes the l that makes its estimated cost least: a longer prefix, in which l shingles must be shared before the
pair is verified. Two documents with different l must share as many as the smaller l says, within the prefixes that belong to it.

Equal sets are one class from the start. Links are wanted as connected classes, so each list of classes that share a prefix shingle has a hub, the
member whose prefix is the most shared, and all lists of a hub are one cluster. Members are first compared with their hub, which costs no more than the lists are
long and connects most of a group of near copies whatever its size. Any other link joins two members of some cluster, so clusters that are not connected
by then are searched: members outside of the hub's component against all members, in blocks, inside the tasks. First by prefixes (as many
shared shingles as the smaller l asks for) and outlines (counts of shingles by hash range, which bound what two sets can share), which only tells the
members that may still link; their whole sets are then read off their texts and compared. Tasks return members and spanning
forests, never pairs, so rows grow with the clusters and not with their squares.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.llm.common import bit_map, blocks, in_map, kept, lean, trim
from daymark.llm.components import components, forest
from daymark.llm.shingles import set_keys, shingle_sets
from daymark.operators.joins import join_splitting

WORDS = 4
PERCENT = 85
#: Counters of the sketch, as a power of two, and how many of them travel together.
SKETCH_BITS = 20
SKETCH_PART = 1 << 12
#: Largest l, and the cost of comparing one shingle against that of reading one list entry.
MOST_MATCHES = 8
COMPARE_COST = 0.05
#: Members of a block when prefixes and outlines, and when whole sets are compared, at most.
SEARCH_BLOCK = 1024
SET_BLOCK = 256
#: Bytes that a member brings per shingle of its set: outline alone, with its prefix, and as a whole set.
OUTLINE_BYTES, PREFIX_BYTES, SET_BYTES = 0.25, 2, 8
#: Bytes of a block, and bytes and rows that a task takes together, about. A single larger member stands alone.
BLOCK_BYTES = 4 << 20
TASK_BYTES = 12 << 20
TASK_ROWS = 4000
#: Bytes of text that are hashed at a time; there are about ten numbers of 8 bytes to a word.
TEXT_BYTES = 1 << 20


def sets(docs: DataFrame, text: str, size: int) -> DataFrame:
    """``row`` (as given), ``n`` and ``key`` of every row's set, and rows with parts of the count sketch (``part``, ``counts``)."""
    schema = T.StructType([docs.schema["row"], *T.StructType.fromDDL("n long, key binary, part int, counts binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        kind = None
        for block in blocks(batches, text, TEXT_BYTES):
            kind = block.schema.field("row").type
            row, shingle = shingle_sets(block.column(block.schema.get_field_index(text)), size)
            n = np.bincount(row, minlength=block.num_rows)
            counts += np.bincount((shingle >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
            keys = pa.array(set_keys(row, shingle, block.num_rows), pa.binary())
            none = pa.nulls(block.num_rows, pa.int32()), pa.nulls(block.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([block.column(block.schema.get_field_index("row")), pa.array(n, pa.int64()), keys, *none], names=schema.names)
        if kind is not None:
            # a part of small counts is mostly zeros or small numbers: four bytes each, which shuffles pack well
            parts = [counts[i : i + SKETCH_PART].astype("<u4").tobytes() for i in range(0, len(counts), SKETCH_PART)]
            k = len(parts)
            yield pa.RecordBatch.from_arrays([pa.nulls(k, kind), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.array(range(k), pa.int32()), pa.array(parts, pa.binary())], names=schema.names)

    return docs.mapInArrow(lean(run), schema)


def sketch(rows: DataFrame) -> np.ndarray:
    """The sum of the sketch's parts: 2^SKETCH_BITS counters at any size of the corpus."""

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SKETCH_PART, dtype=np.float64)
        for raw in frame["counts"]:
            total += np.frombuffer(raw, dtype="<u4")
        return pd.DataFrame({"part": frame["part"].iloc[:1], "counts": [total.astype("<f4").tobytes()]})

    # sums over groups of tasks first, so that a part's list is short wherever it is summed
    halfway = rows.where(F.col("part").isNotNull()).select("part", "counts", F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(16)).alias("g"))
    first = halfway.groupBy("part", "g").applyInPandas(added, "part int, counts binary")

    def again(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(raw, dtype="<f4").astype(np.float64) for raw in frame["counts"])
        return pd.DataFrame({"part": frame["part"].iloc[:1], "counts": [np.asarray(total).astype("<f4").tobytes()]})

    out = np.zeros(1 << SKETCH_BITS, dtype=np.float32)
    for r in first.groupBy("part").applyInPandas(again, "part int, counts binary").collect():
        out[r["part"] * SKETCH_PART : (r["part"] + 1) * SKETCH_PART] = np.frombuffer(r["counts"], dtype="<f4")
    return out


def prefix_of(shingle: np.ndarray, seen: np.ndarray, floor: float, percent: int, most: int = MOST_MATCHES) -> tuple[np.ndarray, int]:
    """The chosen prefix of a set, rare shingles first, and its l. ``seen``: sketched counts of its shingles; ``floor``: what chance adds to them."""
    n = len(shingle)
    overlap = -(-percent * n // 100)
    base = n - overlap
    order = np.lexsort((shingle, seen))[: base + min(most, overlap)]
    others = np.maximum(seen[order] - floor, 0)
    read = np.cumsum(others)[base:]
    matches = np.arange(1, len(read) + 1)
    cost = read + matches + COMPARE_COST * n * read / matches
    best = int(cost.argmin())
    return shingle[order[: base + best + 1]], best + 1


def outline(shingle: np.ndarray) -> bytes:
    """How many shingles fall in each of 2^k equal ranges of hashes, four to eight in each: the width of a count in bytes, then the counts."""
    bits = min(15, max(5, int(len(shingle)).bit_length() - 3))
    counts = np.bincount((shingle >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return b"\1" + counts.astype("<u1").tobytes() if counts.max() < 256 else b"\4" + counts.astype("<u4").tobytes()


def outlined(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{raw[0]}", offset=1).astype(np.int64)


def prefixes(docs: DataFrame, text: str, size: int, percent: int, counts: np.ndarray) -> DataFrame:
    """``key``, ``n``, ``l``, the prefix (hashes in order) and the outline of every row with a set."""
    spark = docs.sparkSession
    # the least counter's neighbourhood is what shingles get by sharing counters
    held = spark.sparkContext.broadcast((counts, float(np.median(counts))))
    schema = "row long, key binary, n long, l int, prefix array<long>, outline binary"
    schema = T.StructType([docs.schema["row"], *T.StructType.fromDDL(schema).fields[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketched, floor = held.value
        for block in blocks(batches, text, TEXT_BYTES):
            row, shingle = shingle_sets(block.column(block.schema.get_field_index(text)), size)
            keys = set_keys(row, shingle, block.num_rows)
            begins = np.searchsorted(row, np.arange(block.num_rows + 1))
            seen = sketched[(shingle >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
            filled = [i for i in range(block.num_rows) if keys[i] is not None]
            chosen = [prefix_of(shingle[begins[i] : begins[i + 1]], seen[begins[i] : begins[i + 1]], floor, percent) for i in filled]
            offsets = np.concatenate(([0], np.cumsum([len(p) for p, _ in chosen]))).astype(np.int32)
            values = np.concatenate([*[p for p, _ in chosen], np.empty(0, dtype=np.uint64)]).view(np.int64)
            columns = [
                block.column(block.schema.get_field_index("row")).take(pa.array(filled, pa.int64())), pa.array([keys[i] for i in filled], pa.binary()),
                pa.array((begins[1:] - begins[:-1])[filled], pa.int64()), pa.array([m for _, m in chosen], pa.int32()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                pa.array([outline(shingle[begins[i] : begins[i + 1]]) for i in filled], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(lean(run), schema)


def whole_sets(docs: DataFrame, wanted: DataFrame, text: str, size: int) -> DataFrame:
    """``v`` and the sorted set of the classes in ``wanted`` (v, row, key), read off the text of one of their rows.

    A map of bits of bounded size tells the tasks that read the texts which rows to look at; a few more may pass it, and the join sorts them out.
    """
    held = docs.sparkSession.sparkContext.broadcast(bit_map(wanted.select(F.xxhash64("row").alias("g"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for batch in batches:
            hashes = batch.column(batch.schema.get_field_index("h")).to_numpy().view(np.uint64)
            for block in blocks(iter([batch.filter(pa.array(in_map(bits, hashes)))]), text, TEXT_BYTES):
                row, shingle = shingle_sets(block.column(block.schema.get_field_index(text)), size)
                keys = set_keys(row, shingle, block.num_rows)
                begins = np.searchsorted(row, np.arange(block.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(begins), pa.array(shingle.view(np.int64)))], names=["key", "shingles"])

    made = docs.select(text, F.xxhash64("row").alias("h")).mapInArrow(lean(run), "key binary, shingles array<long>")
    # a set that several rows of one id have comes several times, which does no harm
    return kept(made.join(wanted.select("v", "key"), "key").select("v", "shingles"), "whole-sets")


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row, nothing else.

    Words are what stands between ASCII blanks, A-Z in lower case; shingles are runs of ``size`` words, of which a shorter text has its whole
    sequence. Two rows link when 100 times their common shingles are at least ``percent`` times all their shingles. The component is the smallest
    id that links reach; a null, empty or blank text links with nothing and is its own component. Repeated rows and rows of one id
    are linked as their texts are; a null id is the largest.
    """
    docs = docs.select(F.col(doc_id).alias("row"), F.col(text).alias("text"))
    made = kept(sets(docs, "text", size), "sets")
    rows = made.where(F.col("part").isNull()).select("row", "n", "key")
    counts = sketch(made)
    classes = prefixes(docs, "text", size, percent, counts).groupBy("key").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("l").alias("l"), F.first("prefix").alias("prefix"), F.first("outline").alias("outline"))
    classes = kept(classes.withColumn("v", F.monotonically_increasing_id()), "classes")

    entries = classes.select("v", F.explode("prefix").alias("token")).repartition("token")
    lists = entries.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = kept(entries.join(lists, "token"), "shared")
    clusters = kept(_clusters(shared, classes), "clusters")

    # first the hub of each cluster against its members that share as many of its lists as they must
    near = clusters.where("tested").select("hub", "v", F.col("v").alias("component"), (F.col("v") == F.col("hub")).alias("left"))
    links = _settled(near, classes, docs, size, percent, matched=True)

    state = join_splitting(clusters, components(links).select(F.col("vertex").alias("v"), "component"), ["v"])
    state = kept(state.select("hub", "v", F.coalesce("component", "v").alias("component"), "tested"), "cluster-state")
    main = F.max(F.when(F.col("v") == F.col("hub"), F.col("component")))
    found = state.groupBy("hub").agg(F.min("component").alias("x"), F.max("component").alias("y"), main.alias("main"), F.count(F.lit(1)).alias("n"), F.bool_and("tested").alias("all"))
    unsettled = found.where((F.col("x") != F.col("y")) & ((F.col("n") > 2) | ~F.col("all"))).select("hub", "main")
    members = join_splitting(state.drop("tested"), unsettled, ["hub"], "inner").withColumn("left", F.col("component") != F.col("main")).drop("main")
    more = _settled(kept(members, "unsettled"), classes, docs, size, percent, matched=False)
    found = components(links.unionByName(more))

    grouped = classes.select("key", "v", "row").join(found.select(F.col("vertex").alias("v"), "component"), "v", "left").withColumn("component", F.coalesce("component", "v"))
    least = grouped.groupBy("component").agg(F.min("row").alias("component_id"))
    named = join_splitting(grouped, least, ["component"], "inner").select("key", "component_id")
    told = join_splitting(rows.where(F.col("key").isNotNull()), named, ["key"], "inner")
    told = told.unionByName(rows.where(F.col("key").isNull()).withColumn("component_id", F.col("row")))
    return told.select(F.col("row").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def _clusters(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """``hub``, ``v`` and whether the two share as many of the hub's lists as the smaller l asks for; a hub is a member too."""
    weight = shared.groupBy("v").agg(F.sum("size").alias("weight"))
    weighed = join_splitting(shared.select("token", "v"), join_splitting(weight, classes.select("v", "l"), ["v"], "inner"), ["v"], "inner")
    hubs = weighed.groupBy("token").agg(F.max(F.struct("weight", "v", "l")).alias("h")).select("token", F.col("h.v").alias("hub"), F.col("h.l").alias("hub_l"))
    own = join_splitting(weighed.select("token", "v", "l"), hubs, ["token"], "inner")
    counted = own.groupBy("hub", "v").agg(F.count(F.lit(1)).alias("c"), F.max(F.least("l", "hub_l")).alias("l"))
    return counted.select("hub", "v", (F.col("c") >= F.col("l")).alias("tested"))


def _settled(members: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int, matched: bool) -> DataFrame:
    """Links (a, b), a spanning forest of them per block, between left members of clusters and members of other components.

    ``matched``: the members have been counted to share enough, so prefixes need not travel.
    """
    members = kept(join_splitting(members, classes.select("v", "n"), ["v"], "inner"), "cluster-members")
    known = classes.select("v", "l", "outline", *([] if matched else ["prefix"]))
    weight = OUTLINE_BYTES if matched else PREFIX_BYTES
    hopeful = kept(_in_blocks(members, known, SEARCH_BLOCK, weight, lambda frame: _searched(frame, percent), "hub long, v long").distinct(), "hopeful")
    chosen = whole_sets(docs, _wanted(hopeful.select("v"), classes), "text", size)
    left = kept(join_splitting(members, hopeful, ["hub", "v"], "inner"), "hopeful-members")
    return kept(_in_blocks(left, chosen, SET_BLOCK, SET_BYTES, lambda frame: _compared(frame, percent), "a long, b long"), "cluster-links")


def _in_blocks(members: DataFrame, carried: DataFrame, block: int, weight: float, run: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Runs ``run`` on every pair of a block of left members and a block of all members of a cluster.

    ``members`` (hub, v, component, left, n; stored) are dealt out first and then given what ``carried`` has for v, ``weight`` bytes for each of the n
    shingles of its set. Blocks and tasks are bounded by these bytes as well as by rows, counted after rows are copied for pairs of blocks. Column ``side`` tells left
    ones (0) from all (1); in a cluster of one block every member comes once, and left ones are marked 2.
    """
    size, own = F.col("n") * F.lit(float(weight)), F.col("left").cast("long")
    parts = lambda rows, size: F.greatest(F.ceil(rows / block), F.ceil(size / BLOCK_BYTES)).cast("int")
    sums = members.groupBy("hub").agg(F.sum(own).alias("ln"), F.sum(size * own).alias("ls"), F.count(F.lit(1)).alias("rn"), F.sum(size).alias("rs"))
    sizes = kept(sums.where("ln > 0").withColumns({"nl": parts(F.col("ln"), F.col("ls")), "nr": parts(F.col("rn"), F.col("rs"))}), "cluster-sizes")
    one = (F.col("nl") == 1) & (F.col("nr") == 1)
    copied = lambda left, right: F.coalesce(F.sum(F.when(one, F.col(right)).otherwise(F.col(left) * F.col("nr") + F.col(right) * F.col("nl"))), F.lit(0))
    rows, total = sizes.agg(copied("ln", "rn"), copied("ls", "rs")).collect()[0]
    tasks = max(1, -(-int(rows) // TASK_ROWS), -(-int(total) // TASK_BYTES))
    cut = join_splitting(members, sizes.select("hub", "nl", "nr"), ["hub"], "inner")
    spot, none = F.xxhash64("v"), F.lit(0)
    small = cut.where("nl = 1 AND nr = 1").select("*", none.alias("i"), none.alias("j"), F.when(F.col("left"), 2).otherwise(1).alias("side"))
    large = cut.where("nl > 1 OR nr > 1")
    left = large.where("left").withColumn("i", F.pmod(spot, F.col("nl")).cast("int")).withColumn("j", F.explode(F.sequence(none, F.col("nr") - 1))).withColumn("side", none)
    right = large.withColumn("j", F.pmod(spot, F.col("nr")).cast("int")).withColumn("i", F.explode(F.sequence(none, F.col("nl") - 1))).withColumn("side", F.lit(1))
    dealt = small.unionByName(left).unionByName(right).select("hub", "v", "component", "n", "i", "j", "side")
    # many small clusters to a task; a pair of blocks is whole in one
    dealt = dealt.withColumn("task", F.pmod(F.xxhash64("hub", "i", "j"), F.lit(tasks)))

    def each(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [run(frame.take(rows)) for rows in frame.groupby(["hub", "i", "j"]).indices.values()]
        trim()
        return pd.concat(parts, ignore_index=True)

    return join_splitting(dealt, carried, ["v"], "inner").groupBy("task").applyInPandas(each, schema)


def _sides(frame: pd.DataFrame) -> list[pd.DataFrame]:
    return [frame[frame["side"] != 1], frame[frame["side"] != 0]]


def _shares(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each array on the left how many of its values each array on the right holds; values of an array are distinct."""
    every, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    ends = np.cumsum([0, *map(len, left), *map(len, right)])
    own = [place[a:b] for a, b in zip(ends, ends[1 : len(left) + 1], strict=False)]
    there, sizes = place[ends[len(left)] :], np.array([len(x) for x in right])
    sums = np.concatenate(([0], np.cumsum(sizes)))
    marked = np.zeros(len(every), dtype=np.int64)
    for values in own:
        marked[values] = 1
        total = np.concatenate(([0], np.cumsum(marked[there])))
        yield total[sums[1:]] - total[sums[:-1]]
        marked[values] = 0


def _searched(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Members that may link to one of another component, by sizes, prefixes and outlines."""
    sides = _sides(frame)
    (v, w), (n, m), (c, d), (p, q) = ([s[x].to_numpy() for s in sides] for x in ("v", "n", "component", "l"))
    outlines = [[outlined(x) for x in s["outline"]] for s in sides]
    wide = np.array([len(x) for x in outlines[1]])
    folded: dict[tuple[int, int], np.ndarray] = {}
    hopeful: set[int] = set()
    counted = "prefix" in frame.columns
    shares = _shares(list(sides[0]["prefix"]), list(sides[1]["prefix"])) if counted and len(v) and len(w) else None
    for i in range(len(v)):
        fits = (d != c[i]) & (np.minimum(m, n[i]) * 100 >= np.maximum(m, n[i]) * percent)
        if shares is not None:
            fits &= next(shares) >= np.minimum(q, p[i])
        own = outlines[0][i]
        for size in np.unique(wide[fits]):
            least = min(len(own), int(size))
            at = np.flatnonzero(wide == size)
            if (key := (int(size), least)) not in folded:
                folded[key] = np.stack([outlines[1][k].reshape(least, -1).sum(axis=1) for k in at])
            good = fits[at]
            most = np.minimum(folded[key][good], own.reshape(least, -1).sum(axis=1)).sum(axis=1)
            may = at[good][100 * most >= percent * (n[i] + m[at[good]] - most)]
            if len(may):
                hopeful.add(int(v[i]))
                hopeful.update(w[may].tolist())
    chosen = sorted(hopeful)
    return pd.DataFrame({"hub": np.full(len(chosen), frame["hub"].iloc[0], dtype=np.int64), "v": np.array(chosen, dtype=np.int64)})


def _compared(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A spanning forest of the links between members of different components, by whole sets."""
    sides = _sides(frame)
    if sides[0].empty or sides[1].empty:
        return pd.DataFrame({"a": np.empty(0, dtype=np.int64), "b": np.empty(0, dtype=np.int64)})
    (v, w), (c, d), (x, y) = ([s[k].to_numpy() for s in sides] for k in ("v", "component", "shingles"))
    sizes, rows, columns = np.array([len(k) for k in y]), [], []
    for i, shared in enumerate(_shares(list(x), list(y))):
        met = np.flatnonzero((d != c[i]) & (100 * shared >= percent * (len(x[i]) + sizes - shared)))
        rows.append(np.full(len(met), i))
        columns.append(met)
    ids, number = np.unique(np.concatenate([v, w]), return_inverse=True)
    a, b = number[np.concatenate(rows)], number[len(v) + np.concatenate(columns)]
    root = forest(a, b, len(ids))
    tied = np.flatnonzero(root != np.arange(len(ids)))
    return pd.DataFrame({"a": ids[tied], "b": ids[root[tied]]})


def _wanted(ends: DataFrame, classes: DataFrame) -> DataFrame:
    return kept(classes.select("v", "row", "key").join(ends.distinct(), "v", "left_semi"), "wanted")


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, unchanged, without those that link to a smaller id. Rows of one id are one document: all stay or none."""
    classes = near_classes(docs, doc_id, text, size, percent)
    gone = kept(classes.where("doc_id <> component_id").select(F.col("doc_id").alias("__nj_gone")).distinct(), "near-copies")
    return docs.join(gone, F.col(doc_id) == F.col("__nj_gone"), "left_anti")
