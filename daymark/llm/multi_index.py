"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised separately, by codebooks fitted on a bounded sample; a pair of centroids is a cell, and the index
holds every row in its cell. For a query the cells come in the order of their summed squared distance D (to the centroid of each half), drawn from a
heap over both sorted lists, and entries of the cells that are drawn are reranked by exact distance.

Where the traversal stops follows from the data. A query's first cells give ``bound``, the squared k-th distance among a few representatives of each cell,
as a scale of its surroundings. Some queries are searched whole beforehand; over their true neighbours ``ratio`` is the quantile ``wanted`` of the excess of D over
the query's least D, in units of ``bound``. Cells up to ``least D + ratio * bound`` are opened: few in clustered data, most of them in data without structure.

Reranking streams the rows of opened cells past blocks of queries (see ``streams``), so no pair of query and row is ever a Spark row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymark.llm import streams
from daymark.llm.common import kept
from daymark.operators.joins import join_splitting

#: Rows that codebooks are fitted on, at most, and bytes of them; centroids of a half, at most; rows a cell is meant to hold.
SAMPLE, SAMPLE_BYTES = 16384, 64 << 20
CENTROIDS = 256
CELL_ROWS = 32
#: Representatives of a cell, and how many of them a query looks at for its bound.
REPRESENTATIVES, LOOKED_AT = 16, 64
#: Queries that are searched whole to set the ratio, and the share of their neighbours that must be found.
TRIAL_QUERIES, WANTED = 64, 0.995
ROUNDS = 8

Model = dict[int, tuple[np.ndarray, np.ndarray]]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of two matrices, by a matrix product."""
    return np.maximum(0, (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None] - 2 * x @ y.T)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows of equal number, from their differences; large and small components are scaled where squares would leave the range."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        gap = x - y
        out = np.sqrt((gap * gap).sum(axis=1))
        odd = np.flatnonzero((~np.isfinite(out)) | (out < 1e-140))
        if len(odd):
            top = np.abs(x[odd] / 2 - y[odd] / 2).max(axis=1, initial=0)
            safe = np.where(top > 0, top, 1)
            part = (x[odd] / 2 - y[odd] / 2) / safe[:, None]
            out[odd] = 2 * (safe * np.sqrt((part * part).sum(axis=1))) * (top > 0)
    return out


def k_means(x: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Centroids of the rows of a sample: distinct rows to begin with, then rounds of means."""
    distinct = np.unique(x, axis=0)
    if len(distinct) <= k:
        return distinct
    centres = distinct[np.random.default_rng(seed).choice(len(distinct), k, replace=False)]
    for _ in range(ROUNDS):
        near = np.concatenate([squared(x[a : a + 4096], centres).argmin(axis=1) for a in range(0, len(x), 4096)])
        sums, counts = np.zeros_like(centres), np.bincount(near, minlength=k)
        np.add.at(sums, near, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(1, counts)[:, None], centres)
    return centres


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = x.shape[1] // 2
    return x[:, :middle], x[:, middle:]


def books(model: Model, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks for vectors of ``dim`` components: one centroid at 0 in each half for lengths that the sample didn't hold."""
    return model.get(dim) or (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)))


def cells_of(x: np.ndarray, model: Model) -> np.ndarray:
    first, second = books(model, x.shape[1])
    a, b = halves(x)
    return squared(a, first).argmin(axis=1) * len(second) + squared(b, second).argmin(axis=1)


def traverse(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int]]:
    """Pairs of centroids (as cell numbers) in ascending order of their summed distances: each pair is pushed once, by its left neighbour or, at the edge, from above."""
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap = [(float(first[rows[0]] + second[columns[0]]), 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        yield total, int(rows[i]) * len(second) + int(columns[j])
        if j + 1 < len(columns):
            heapq.heappush(heap, (float(first[rows[i]] + second[columns[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(rows):
            heapq.heappush(heap, (float(first[rows[i + 1]] + second[columns[0]]), i + 1, 0))


class Rerank:
    """Queries of one block with the cells each of them opens, and the nearest rows so far."""

    def __init__(self, queries: pd.DataFrame, model: Model, k: int, scale: float):
        self.ident = queries["vec_id"].to_numpy()
        self.x = np.stack(queries["x"].to_numpy())
        self.scale, self.model = scale, model
        self.small = self.x * scale
        first, second = books(model, self.x.shape[1])
        self.weight = (self.small * self.small).sum(axis=1)
        a, b = halves(self.small)
        self.to_first, self.to_second, self.width = squared(a, first), squared(b, second), len(second)
        self.reach = queries["reach"].to_numpy()
        self.best = streams.Best(len(queries), k, -np.inf)

    def feed(self, rows: pd.DataFrame) -> None:
        ident, cell, x = rows["vec_id"].to_numpy(), rows["cell"].to_numpy(), np.stack(rows["x"].to_numpy())
        small = x * self.scale
        weight = (small * small).sum(axis=1)
        step = max(1, streams.PAIRS // len(ident))
        for a in range(0, len(self.ident), step):
            part = slice(a, a + step)
            away = self.to_first[part][:, cell // self.width] + self.to_second[part][:, cell % self.width]
            opened = (away <= self.reach[part, None]) & (self.ident[part, None] != ident[None])
            rough = np.where(opened, squared(self.small[part], small), np.inf)
            # what the matrix product may be off by
            slack = 1e-12 * (weight[None] + self.weight[part, None])
            bar = (self.best.bar()[part] * self.scale) ** 2
            if len(ident) > self.best.k:
                least = np.partition(rough + slack, self.best.k - 1, axis=1)[:, self.best.k - 1]
                bar = np.minimum(bar, least)
            i, j = np.nonzero(opened & (rough - slack <= bar[:, None] * (1 + 1e-9)))
            most = max(1, streams.PAIRS // max(1, x.shape[1]))
            for c in range(0, len(i), most):
                p, q = i[c : c + most] + a, j[c : c + most]
                self.best.add(p, -distances(self.x[p], x[q]), ident[q])

    def result(self) -> pd.DataFrame:
        slot, score, ident = self.best.entries()
        return pd.DataFrame({"query_id": self.ident[slot], "vec_id": ident, "score": -score})


class Index:
    """Every usable row of a table in its cell. ``rows`` has ``vec_id, dim, x, cell``; what the driver holds is bounded: codebooks and cell sizes."""

    def __init__(self, rows: DataFrame, model: Model, scale: float, count: int):
        self.rows, self.model, self.scale, self.count = rows, model, scale, count
        sizes = rows.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"))
        self.sizes = {(r["dim"], r["cell"]): r["n"] for r in sizes.where(F.col("dim").isin([*model]) if model else F.lit(False)).collect()}

    @property
    def spark(self) -> SparkSession:
        return self.rows.sparkSession


def usable(vector: Column) -> Column:
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce(F.forall(vector, number) & F.exists(vector, lambda x: x != 0), F.lit(False))


def build(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE, cell_rows: int = CELL_ROWS) -> Index:
    """Fit the codebooks on at most ``sample`` rows and put every usable row in its cell."""
    named = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    single = kept(streams.one_per_id(named.where(usable(F.col("x"))), "vec_id").withColumn("dim", F.size("x")), "vectors")
    sizes = single.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform("x", F.abs))).alias("top"))
    count, top = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("top"), F.lit(1.0))).collect()[0]
    common = sizes.orderBy(F.desc("n"), "dim").limit(16).collect()  # other lengths have one cell each
    # a power of two, so that nothing is rounded
    scale = float(2.0 ** -np.clip(np.floor(np.log2(top)), -1000, 1000)) if not 1e-100 < top < 1e100 else 1.0
    model: Model = {}
    for r in common:
        most = max(1, min(sample, SAMPLE_BYTES // (8 * r["dim"])))
        share = int(min(1.0, 1.2 * most / r["n"]) * (1 << 30))
        some = single.where((F.col("dim") == r["dim"]) & (F.pmod(F.xxhash64(F.lit("fit"), "vec_id"), F.lit(1 << 30)) < share)).select("x").limit(most).collect()
        if some:
            x = np.array(sorted(s["x"] for s in some)) * scale
            k = int(max(1, min(CENTROIDS, round((r["n"] / cell_rows) ** 0.5), max(1, len(x) // 8))))
            a, b = halves(x)
            model[r["dim"]] = (k_means(a, k), k_means(b, k))
    held = single.sparkSession.sparkContext.broadcast((model, scale))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cell = np.zeros(len(frame), dtype=np.int64)
            for _, at in frame.groupby("dim").indices.items():
                cell[at] = cells_of(np.stack(frame["x"].to_numpy()[at]) * held.value[1], held.value[0])
            yield frame.assign(cell=cell)

    placed = kept(single.mapInPandas(place, "vec_id long, x array<double>, dim int, cell long"), "cells")
    return Index(placed, model, scale, count)


def _nearest(index: Index, queries: DataFrame, rows: DataFrame, spans: int, blocks: int, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: queries with ``reach`` and ``q_block``, against rows that have the blocks that open their cell."""
    held = index.spark.sparkContext.broadcast((index.model, index.scale))
    columns = ["vec_id", "dim", "x", "cell", "reach", "q_block"]
    passing = rows.withColumn("reach", F.lit(None).cast("double")).select(*columns).withColumn("span", streams.span_of(F.col("vec_id"), spans))
    met = streams.meet(queries.select(*columns), passing, spans, blocks * spans, "vec_id")
    found = met.mapInPandas(lambda frames: streams.run_tasks(frames, lambda q: Rerank(q, *_with(held.value, k))), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _with(held: tuple[Model, float], k: int) -> tuple[Model, int, float]:
    return held[0], k, held[1]


def _bounds(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """Queries with ``bound``: the squared k-th distance among representatives of a query's first cells, infinite where there are fewer."""
    one = Window.partitionBy("dim", "cell").orderBy(F.xxhash64("vec_id"), "vec_id")
    some = kept(index.rows.withColumn("at", F.row_number().over(one)).where(F.col("at") <= REPRESENTATIVES).select("dim", "cell", F.col("vec_id").alias("r_id"), F.col("x").alias("r_x")), "representatives")
    held = index.spark.sparkContext.broadcast((index.model, index.scale, index.sizes))

    def first_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, scale, sizes = held.value
        for frame in frames:
            ids, dims, cells = [], [], []
            for dim, at in frame.groupby("dim").indices.items():
                if dim not in model:
                    continue
                first, second = model[dim]
                a, b = halves(np.stack(frame["x"].to_numpy()[at]) * scale)
                for q, da, db in zip(frame["vec_id"].to_numpy()[at], squared(a, first), squared(b, second), strict=True):
                    seen = 0
                    for _, cell in traverse(da, db):
                        if n := sizes.get((dim, cell)):
                            ids.append(q), dims.append(dim), cells.append(cell)
                            seen += min(n, REPRESENTATIVES)
                            if seen > LOOKED_AT:
                                break
            yield pd.DataFrame({"vec_id": ids, "dim": dims, "cell": cells})

    wanted = queries.mapInPandas(first_cells, "vec_id long, dim int, cell long")
    seen = join_splitting(wanted, some, ["dim", "cell"], "inner").where("vec_id <> r_id")
    pairs = join_splitting(seen, queries.select("vec_id", "x"), ["vec_id"], "inner")
    away = F.sqrt(F.aggregate(F.zip_with("x", "r_x", lambda a, b: (a - b) * F.lit(index.scale)), F.lit(0.0), lambda s, g: s + g * g))
    order = Window.partitionBy("vec_id").orderBy("away", "r_id")
    nearest = pairs.select("vec_id", "r_id", away.alias("away")).withColumn("at", F.row_number().over(order)).where(F.col("at") == k)
    bounds = nearest.select("vec_id", (F.col("away") * F.col("away")).alias("bound"))
    return queries.join(bounds, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))


def _with_least(index: Index, queries: DataFrame) -> DataFrame:
    """Queries with ``d_min``, the summed distance of the first cell."""
    held = index.spark.sparkContext.broadcast((index.model, index.scale))

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, scale = held.value
        for frame in frames:
            least = np.zeros(len(frame))
            for dim, at in frame.groupby("dim").indices.items():
                a, b = halves(np.stack(frame["x"].to_numpy()[at]) * scale)
                first, second = books(model, dim)
                least[at] = squared(a, first).min(axis=1) + squared(b, second).min(axis=1)
            yield frame.assign(d_min=least)

    return queries.mapInPandas(add, "vec_id long, x array<double>, dim int, cell long, d_min double")


def _ratio(index: Index, bounded: DataFrame, k: int, wanted: float) -> float:
    """Excess of D over the first cell's, in units of ``bound``, that the share ``wanted`` of the neighbours of some queries searched whole doesn't pass."""
    known = bounded.where((F.col("bound") < float("inf")) & (F.col("bound") > 0))
    trial = known.orderBy(F.xxhash64(F.lit("trial"), "vec_id"), "vec_id").limit(TRIAL_QUERIES).withColumn("reach", F.lit(float("inf"))).withColumn("q_block", F.lit(0))
    trial = kept(trial, "trial-queries")
    whole = _nearest(index, trial, index.rows.withColumn("q_block", F.lit(0)), streams.spans_for(index.count), 1, k)
    asked = trial.select(F.col("vec_id").alias("query_id"), "x", "dim", "bound", "d_min")
    found = whole.join(index.rows.select("vec_id", "cell"), "vec_id").join(asked, "query_id").collect()  # TRIAL_QUERIES times k rows
    ratios = []
    for r in found:
        first, second = books(index.model, r["dim"])
        a, b = halves(np.array([r["x"]]) * index.scale)
        away = squared(a, first)[0, r["cell"] // len(second)] + squared(b, second)[0, r["cell"] % len(second)]
        ratios.append((away - r["d_min"]) / r["bound"])
    return max(0.0, float(np.quantile(ratios, wanted))) if ratios else np.inf


def search(index: Index, is_query: Column, k: int = 10, wanted: float = WANTED, block: int = streams.QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row of the index that ``is_query`` (a condition on ``vec_id``) picks, the ``k`` nearest other rows found.

    Nearest first by Euclidean distance in double precision on the vectors as they are, ties by the smaller id; all other rows, if there are fewer than
    ``k``. Rows without id and vectors that are null, empty, zero or hold null, NaN or infinite components aren't in the index; of several rows of
    one id the one with the smallest vector stands for all. Vectors are near only to vectors of the same number of components. Copies are rows like others, with
    ties among them. An empty table gives an empty result.
    """
    queries = kept(_with_least(index, index.rows.where(F.coalesce(is_query, F.lit(False)))), "queries")
    bounded = kept(_bounds(index, queries, k), "bounds")
    # a bound of 0 says that all neighbours are copies, which lie in the query's own cell
    further = F.when(F.col("bound") == 0, F.lit(0.0)).when(F.col("bound") == float("inf"), F.col("bound")).otherwise(F.lit(_ratio(index, bounded, k, wanted)) * F.col("bound"))
    reach = F.col("d_min") + further
    reached = bounded.withColumn("reach", reach + F.lit(1e-9) * (1 + reach))
    count = queries.count()
    blocks, spans = streams.blocks_for(count, block), streams.spans_for(index.count)
    placed = kept(_blocks(index, reached, blocks, count), "query-blocks")

    held = index.spark.sparkContext.broadcast((index.model, index.scale, {c for c in index.sizes}))

    def opened(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, scale, occupied = held.value
        for frame in frames:
            drawn: set[tuple[int, int, int]] = set()
            for (dim, q_block), at in frame.groupby(["dim", "q_block"]).indices.items():
                if dim not in model:
                    drawn.add((q_block, dim, 0))
                    continue
                first, second = model[dim]
                a, b = halves(np.stack(frame["x"].to_numpy()[at]) * scale)
                for reach, da, db in zip(frame["reach"].to_numpy()[at], squared(a, first), squared(b, second), strict=True):
                    for total, cell in traverse(da, db):
                        if total > reach:
                            break
                        if (dim, cell) in occupied:
                            drawn.add((q_block, dim, cell))
            yield pd.DataFrame(sorted(drawn), columns=["q_block", "dim", "cell"])

    cells = kept(placed.mapInPandas(opened, "q_block int, dim int, cell long").distinct(), "opened-cells")
    rows = join_splitting(index.rows, cells, ["dim", "cell"], "inner")
    return _nearest(index, placed, rows, spans, blocks, k)


def _blocks(index: Index, queries: DataFrame, blocks: int, count: int) -> DataFrame:
    """Queries in blocks of about equal size, neighbouring cells together, so that a block's queries open much the same cells."""
    if blocks == 1:
        return queries.withColumn("q_block", F.lit(0))
    counts = queries.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.orderBy("dim", "cell")) - F.col("n"))  # a row per cell, of which there is a bounded number
    size = -(-count // blocks)
    inside = F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.col("n"))
    joined = join_splitting(queries, before, ["dim", "cell"], "inner")
    return joined.withColumn("q_block", F.floor((F.col("before") + inside) / size).cast("int")).drop("before", "n")


def digest(rows: DataFrame) -> DataFrame:
    """The query: every hundredth id against all rows."""
    return search(build(rows), F.col("vec_id") % 100 == 0)
