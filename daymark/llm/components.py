"""Connected components of links, by contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import kept
from daymark.operators.joins import join_splitting


def components(edges: DataFrame) -> DataFrame:
    """``vertex`` and ``component`` (the smallest vertex reachable) of all vertices in ``edges`` (columns a and b, of one type, no nulls).

    In each round every vertex joins the first of itself and its neighbours in the order of a hash; the vertices that are joined are
    the next round's graph. A star is done after two rounds, whatever its size, and a path shrinks by a constant factor in each. Hubs cost no more than
    others: neighbours are reduced by partial minima and joins split hot keys.
    """
    links = kept(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "links")
    loops = edges.where("a = b").select(F.col("a").alias("vertex"))
    where: DataFrame | None = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        luck = lambda c: F.struct(F.xxhash64(F.lit("order"), c).alias("luck"), F.col(c).alias("vertex"))
        joins = both.groupBy("a").agg(F.min(luck("b")).alias("best")).select(F.col("a").alias("vertex"), F.least("best", luck("a"))["vertex"].alias("to"))
        joins = kept(joins, "joins")
        if where is None:
            where = joins.select("vertex", F.col("to").alias("root"))
        else:
            moved = join_splitting(where, joins.select(F.col("vertex").alias("root"), "to"), ["root"])
            where = kept(moved.select("vertex", F.coalesce("to", "root").alias("root")), "roots")
        left = join_splitting(links, joins.select(F.col("vertex").alias("a"), F.col("to").alias("x")), ["a"], "inner")
        right = join_splitting(left, joins.select(F.col("vertex").alias("b"), F.col("to").alias("y")), ["b"], "inner")
        links = kept(right.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a <> b").distinct(), "links")
    if where is None:
        return loops.distinct().select("vertex", F.col("vertex").alias("component"))
    least = where.groupBy("root").agg(F.min("vertex").alias("component"))
    found = join_splitting(where, least, ["root"], "inner").select("vertex", "component")
    alone = loops.distinct().join(found, "vertex", "left_anti").select("vertex", F.col("vertex").alias("component"))
    return found.unionByName(alone)


def forest(x: np.ndarray, y: np.ndarray, count: int) -> np.ndarray:
    """The smallest number connected to each of ``count`` numbers by pairs (x, y)."""
    root = np.arange(count)
    while True:
        least = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new
