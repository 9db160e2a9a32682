"""Near-duplicate vectors by a dual traversal of cover trees: all pairs within a label whose cosine reaches a threshold.

On unit vectors a cosine of c is a distance of sqrt(2 - 2 c), so bounds of a metric hold. Equal vectors are one class from the start. A
coarse tree is fitted on a bounded sample of classes: centres in the order of farthest-first traversal, whose beginnings are nested nets, cut into levels of
halving radii. Every class goes down that tree to a leaf, and the leaves' covering radii are taken over all classes, so pruning is
exact however poor the sample. Leaves are cut into blocks of bounded size, and pairs of blocks whose leaves may lie within the distance are the tasks.

In a task each block gets a cover tree of its own, levels again halving radii, and the two trees are walked together: a pair of nodes
is dropped if the centres are farther apart than both covering radii and the distance allow; else the wider node is opened. Nodes without
finer structure are compared by a matrix product. A task returns counts and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.llm.common import kept
from daymark.llm.components import components, forest
from daymark.operators.joins import join_splitting

THRESHOLD = 0.98
#: Classes that the coarse trees are fitted on, in all, and centres of one label's tree.
SAMPLE = 8192
MOST_CENTRES = 512
#: Classes of a block.
BLOCK = 1024
#: Nodes of up to so many vectors are compared whole.
LEAF = 48
#: What distances computed in double precision may be off by.
SLACK = 1e-7


def usable(vector: Column, label: Column) -> Column:
    """Whether a vector takes part: it and its label are there, all components are finite, and one isn't zero."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    sound = F.forall(vector, number) & F.exists(vector, lambda x: x != 0)
    return vector.isNotNull() & label.isNotNull() & F.coalesce(sound, F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    # scaled by the largest component first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Node:
    """Members of a block around a centre (row numbers), the covering radius, and children of half the scale."""

    def __init__(self, centre: int, members: np.ndarray, radius: float):
        self.centre, self.members, self.radius = centre, members, radius
        self.children: list[Node] | None = None

    def open(self, x: np.ndarray) -> list[Node]:
        """Children: centres at least half this radius apart, members with their nearest. None come if nearly all members would be centres."""
        if self.children is None:
            self.children = []
            if len(self.members) > LEAF and self.radius > 0:
                own = x[self.members]
                nearest = np.linalg.norm(own - x[self.centre], axis=1)
                chosen, belongs = [self.centre], np.zeros(len(own), dtype=np.int64)
                most = max(4, len(own) // 8)
                while nearest.max() > self.radius / 2 and len(chosen) <= most:
                    far = int(nearest.argmax())
                    distance = np.linalg.norm(own - own[far], axis=1)
                    closer = distance < nearest
                    belongs[closer], nearest = len(chosen), np.minimum(nearest, distance)
                    chosen.append(int(self.members[far]))
                if len(chosen) <= most and len(chosen) > 1:
                    for k, c in enumerate(chosen):
                        held = belongs == k
                        if held.any():
                            self.children.append(Node(c, self.members[held], float(nearest[held].max())))
        return self.children


def tree(x: np.ndarray) -> Node:
    return Node(0, np.arange(len(x)), float(np.linalg.norm(x - x[0], axis=1).max()))


def linked(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all pairs of raw vectors of two blocks whose cosine reaches the threshold; with ``same`` the blocks are one, and x < y."""
    distance = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    ua, ub = unit(a), unit(b)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    stack = [(tree(ua), tree(ub))]
    while stack:
        s, t = stack.pop()
        if np.linalg.norm(ua[s.centre] - ub[t.centre]) > s.radius + t.radius + distance:
            continue
        first = s if s.radius >= t.radius else t
        for wider in (first, t if first is s else s):
            if wider.open(ua if wider is s else ub):
                stack += [(c, t) for c in s.children] if wider is s else [(s, c) for c in t.children]
                break
        else:
            near = ua[s.members] @ ub[t.members].T >= threshold - SLACK
            i, j = np.nonzero(near)
            found.append((s.members[i], t.members[j]))
    x = np.concatenate([f[0] for f in found]) if found else np.empty(0, dtype=np.int64)
    y = np.concatenate([f[1] for f in found]) if found else np.empty(0, dtype=np.int64)
    if same:
        # one tree is walked against a copy of itself
        x, y = x[x < y], y[x < y]
    sure = np.empty(len(x), dtype=bool)
    for k in range(0, len(x), 1 << 16):
        p, q = a[x[k : k + (1 << 16)]], b[y[k : k + (1 << 16)]]
        sure[k : k + (1 << 16)] = (p * q).sum(axis=1) / (np.sqrt((p * p).sum(axis=1)) * np.sqrt((q * q).sum(axis=1))) >= threshold
    return x[sure], y[sure]


def centres(x: np.ndarray, most: int) -> np.ndarray:
    """Farthest-first order of unit vectors: every beginning is a net whose radius is what the next centre was away."""
    chosen = [0]
    nearest = np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < min(most, len(x)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return x[chosen]


def levels(net: np.ndarray) -> list[int]:
    """How many of the centres each level holds: enough for covering radii of 2, 1, 1/2, ..."""
    out, nearest = [1], np.linalg.norm(net - net[0], axis=1)
    for k in range(1, len(net)):
        while nearest[k:].max() <= 2.0 ** (1 - len(out)):
            out.append(k)
        nearest = np.minimum(nearest, np.linalg.norm(net - net[k], axis=1))
    return [*out, len(net)]


def descend(x: np.ndarray, net: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaf and distance to it of unit vectors: level by level to the nearest centre that hangs below the one before."""
    at, distance = np.zeros(len(x), dtype=np.int64), np.linalg.norm(x - net[0], axis=1)
    before = 1
    for count in levels(net):
        if count <= before:
            continue
        # the parent of a new centre is the nearest centre of the level before
        parent = np.arange(count)
        parent[before:] = np.linalg.norm(net[before:count, None] - net[None, :before], axis=2).argmin(axis=1)
        all_distances = np.sqrt(np.maximum(0, 2 - 2 * x @ net[:count].T))
        all_distances[parent[None, :] != at[:, None]] = np.inf
        at = all_distances.argmin(axis=1)
        before = count
    return at, np.linalg.norm(x - net[at], axis=1)


def near_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row, nothing else.

    Rows link if their labels are equal, their vectors are of one length, and the cosine in double precision is at least ``threshold``.
    Rows of a null label and vectors that are null, empty, zero, or hold null or non-finite components link with nothing. Repeated rows
    and rows of one id link as others do. The component is the smallest id that links reach; ``kept`` tells whether it is the row's own. A
    null id counts as the largest.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("x"), F.col(label).alias("label"))
    takes = usable(F.col("x"), F.col("label"))
    alone = rows.where(~takes).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    sound = rows.where(takes).select("vec_id", F.transform("x", lambda v: v + F.lit(0.0)).alias("x"), F.col("label").cast("string").alias("label"), F.size("x").alias("dim"))
    grouped = sound.groupBy("label", "dim", "x").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    classes = kept(grouped.withColumn("v", F.monotonically_increasing_id()), "vector-classes")

    nets = _nets(classes, sample, block)
    held = spark.sparkContext.broadcast(nets)

    def place(frames):
        for frame in frames:
            leaf, distance = np.zeros(len(frame), dtype=np.int64), np.full(len(frame), 2.0)
            for key, part in frame.groupby(["label", "dim"]).indices.items():
                if key in held.value:
                    x = unit(np.stack(frame["x"].to_numpy()[part]))
                    leaf[part], distance[part] = descend(x, held.value[key])
            yield frame.assign(leaf=leaf, distance=distance)

    placed = kept(classes.mapInPandas(place, T.StructType([*classes.schema.fields, *T.StructType.fromDDL("leaf long, distance double").fields])), "placed")
    leaves = placed.groupBy("label", "dim", "leaf").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n"))
    leaves = kept(leaves.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")), "leaves")

    tasks = _tasks(leaves, held, threshold)
    cut = join_splitting(placed, leaves.select("label", "dim", "leaf", "blocks"), ["label", "dim", "leaf"], "inner")
    cut = cut.withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    tasks = tasks.withColumn("own", (F.col("leaf_a") == F.col("leaf_b")) & (F.col("block_a") == F.col("block_b")))
    sides = tasks.select("label", "dim", F.col("leaf_a").alias("leaf"), F.col("block_a").alias("block"), "task", F.lit(0).alias("side"), "own").unionByName(
        tasks.where(~F.col("own")).select("label", "dim", F.col("leaf_b").alias("leaf"), F.col("block_b").alias("block"), "task", F.lit(1).alias("side"), "own")
    )
    dealt = join_splitting(cut.select("label", "dim", "leaf", "block", "v", "copies", "x"), sides, ["label", "dim", "leaf", "block"], "inner")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["side", "v"])
        x, side, ids, copies = np.stack(frame["x"].to_numpy()), frame["side"].to_numpy(), frame["v"].to_numpy(), frame["copies"].to_numpy()
        split, same = int((side == 0).sum()), bool(frame["own"].iloc[0])
        if not same and split in (0, len(x)):  # a block that the hash left empty
            return pd.DataFrame({"v": ids[:0], "n": ids[:0], "root": ids[:0]})
        i, j = linked(x[:split], x if same else x[split:], threshold, same)
        j = j if same else j + split
        n = np.bincount(i, copies[j], len(x)) + np.bincount(j, copies[i], len(x))
        root = forest(i, j, len(x))
        hit = n > 0
        return pd.DataFrame({"v": ids[hit], "n": n[hit].astype(np.int64), "root": ids[root[hit]]})

    told = kept(dealt.groupBy("task").applyInPandas(compare, "v long, n long, root long"), "vector-links")
    counts = told.groupBy("v").agg(F.sum("n").alias("n"))
    found = components(told.select(F.col("v").alias("a"), F.col("root").alias("b")))
    named = classes.select("label", "dim", "x", "copies", "least", "v").join(found.select(F.col("vertex").alias("v"), "component"), "v", "left").join(counts, "v", "left").withColumn("component", F.coalesce("component", "v"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = join_splitting(named, smallest, ["component"], "inner").select("label", "dim", F.col("x").alias("y"), F.xxhash64("x").alias("h"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    # arrays are compared behind a hash of theirs, which spreads the rows of a label
    member = join_splitting(sound.withColumn("h", F.xxhash64("x")), named, ["label", "dim", "h"], "inner").where(F.col("x") == F.col("y"))
    out = member.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _nets(classes: DataFrame, sample: int, block: int) -> dict[tuple[str, int], np.ndarray]:
    """Centres of each label and length of vectors, from about ``sample`` classes in all; labels beyond the sample have a single leaf."""
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > block).orderBy(F.desc("n"), "label", "dim").limit(sample // 16).collect()
    total = sum(r["n"] for r in large)
    if not total:
        return {}
    some = classes.where(F.pmod(F.xxhash64(F.lit("sample"), "x"), F.lit(1 << 30)) < int(min(1.0, sample / total) * (1 << 30)))
    wanted = [(r["label"], r["dim"]) for r in large]
    keep = F.struct("label", "dim").isin([F.struct(F.lit(a), F.lit(b)) for a, b in wanted])
    got: dict[tuple[str, int], list] = {}
    for r in some.where(keep).select("label", "dim", "x").limit(2 * sample).collect():
        got.setdefault((r["label"], r["dim"]), []).append(r["x"])
    size = {(r["label"], r["dim"]): r["n"] for r in large}
    out = {}
    for key in wanted:
        if key in got:
            x = unit(np.array(sorted(got[key])))
            out[key] = centres(x, min(MOST_CENTRES, -(-size[key] // block)))
    return out


def _tasks(leaves: DataFrame, held, threshold: float) -> DataFrame:
    """Pairs of blocks whose leaves may hold vectors within the distance: the coarse trees against themselves."""
    distance = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    a = leaves.select("label", "dim", F.col("leaf").alias("leaf_a"), F.col("radius").alias("ra"), F.col("blocks").alias("na"))
    b = leaves.select("label", "dim", F.col("leaf").alias("leaf_b"), F.col("radius").alias("rb"), F.col("blocks").alias("nb"))
    both = a.join(b, ["label", "dim"]).where("leaf_a <= leaf_b")

    @F.pandas_udf("double")
    def apart(label: pd.Series, dim: pd.Series, i: pd.Series, j: pd.Series) -> pd.Series:
        nets = held.value
        return pd.Series([float(np.linalg.norm(nets[k][p] - nets[k][q])) if (k := (x, y)) in nets else 0.0 for x, y, p, q in zip(label, dim, i, j, strict=True)])

    near = both.where(apart("label", "dim", "leaf_a", "leaf_b") <= F.col("ra") + F.col("rb") + distance)
    blocks = near.withColumn("block_a", F.explode(F.sequence(F.lit(0), F.col("na") - 1))).withColumn("block_b", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    blocks = blocks.where((F.col("leaf_a") < F.col("leaf_b")) | (F.col("block_a") <= F.col("block_b")))
    return kept(blocks.select("label", "dim", "leaf_a", "block_a", "leaf_b", "block_b").withColumn("task", F.monotonically_increasing_id()), "block-pairs")
