"""Hard negatives by rotated one-bit codes: rows of another label that score within a window below an anchor's positives.

Vectors are integers (``floor(steps * x)``), so scores are exact. Every vector u is rotated by a fixed orthogonal matrix and coded by the signs of
its components: with b = signs / sqrt(d) the alignment <b, u> is stored, and what it leaves, u - <b, u> b, is coded again, ``LEVELS`` times. An
anchor v is rotated too and its components written as ``BITS`` bit planes, so that <b, v> is a sum of popcounts of ``code & plane``. The
estimate of a score is the sum of alignments times <b, v>; the rest r of u stands at right angles to the last b, so by Cauchy and Schwarz the score lies
within |r| * sqrt(|v|^2 - <b, v>^2) of it (and what the planes round off times the coded part). That holds for sure, not just mostly: a pair
whose interval can't reach what is asked for goes, level by level, and the pairs that are left are scored in integers.

Anchors stand in blocks that rows pass by in spans (see ``streams``); a first pass finds the positives, a second one the windows' negatives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm import streams
from daymark.llm.common import kept

LEVELS = 4
BITS = 6
#: Squared length of an integer vector from which on scores times 100 would leave 64 bits.
TOO_LONG = 2.0**56
#: What intervals computed in double precision may be off by, as a share of the product of both lengths.
SLACK = 1e-9
SEED = 20240229


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.where(np.diag(r) < 0, -1.0, 1.0)


def words_of(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words, filled up with zeros."""
    n, d = bits.shape
    full = np.zeros((n, max(1, -(-d // 64)) * 64), dtype=bool)
    full[:, :d] = bits
    return np.packbits(full, axis=1).view(np.uint64)


class Codes:
    """Codes of rows: ``words`` (n, LEVELS, w) and ``figures`` (n, LEVELS, 3) - alignment, length of the rest, length of the coded part."""

    def __init__(self, words: np.ndarray, figures: np.ndarray, length: np.ndarray):
        self.words, self.figures, self.length = words, figures, length
        self.ones = np.bitwise_count(words).sum(axis=2, dtype=np.int64)

    @classmethod
    def of(cls, x: np.ndarray) -> Codes:
        n, d = x.shape
        rest = x.astype(np.float64) @ rotation(d) if d else np.zeros((n, 0))
        coded = np.zeros_like(rest)
        words, figures = [], np.zeros((n, LEVELS, 3))
        for level in range(LEVELS):
            above = rest >= 0
            b = np.where(above, 1.0, -1.0) / np.sqrt(max(1, d))
            along = (b * rest).sum(axis=1)
            coded += along[:, None] * b
            rest = rest - along[:, None] * b
            words.append(words_of(above))
            figures[:, level] = np.stack([along, np.linalg.norm(rest, axis=1), np.linalg.norm(coded, axis=1)], axis=1)
        return cls(np.stack(words, axis=1), figures, np.linalg.norm(x.astype(np.float64), axis=1))


class Planes:
    """Rotated anchors as bit planes: component = low + step * (sum of 2^k * bit k), off by ``error`` in length at most."""

    def __init__(self, x: np.ndarray):
        n, self.dim = x.shape
        v = x.astype(np.float64) @ rotation(self.dim) if self.dim else np.zeros((n, 0))
        self.low = v.min(axis=1, initial=np.inf) if self.dim else np.zeros(n)
        width = (v.max(axis=1, initial=-np.inf) if self.dim else np.zeros(n)) - self.low
        self.step = width / ((1 << BITS) - 1)
        whole = np.rint((v - self.low[:, None]) / np.where(self.step > 0, self.step, 1)[:, None]).astype(np.int64)
        rounded = self.low[:, None] + self.step[:, None] * whole
        self.error = np.linalg.norm(v - rounded, axis=1)
        self.sum = rounded.sum(axis=1)
        self.length = np.linalg.norm(v, axis=1)
        self.words = np.stack([words_of((whole >> k) & 1 == 1) for k in range(BITS)], axis=1)

    def along(self, i: np.ndarray, codes: Codes, j: np.ndarray, level: int) -> np.ndarray:
        """<b, v> of pairs, by popcounts."""
        code = codes.words[j, level]
        total = np.zeros(len(i), dtype=np.int64)
        for k in range(BITS):
            total += np.bitwise_count(code & self.words[i, k]).sum(axis=1, dtype=np.int64) << k
        over = self.low[i] * codes.ones[j, level] + self.step[i] * total
        return (2 * over - self.sum[i]) / np.sqrt(max(1, self.dim))


def survivors(planes: Planes, codes: Codes, i: np.ndarray, j: np.ndarray, may: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs (anchor i, row j) those that ``may(i, least, most)`` keeps at every level."""
    estimate = np.zeros(len(i))
    for level in range(LEVELS):
        t = planes.along(i, codes, j, level)
        along, rest, coded = codes.figures[j, level].T
        estimate += along * t
        sure = np.maximum(0, np.abs(t) - planes.error[i])
        within = rest * np.sqrt(np.maximum(0, planes.length[i] ** 2 - sure**2)) + coded * planes.error[i] + SLACK * (1 + planes.length[i] * codes.length[j])
        stays = may(i, estimate - within, estimate + within)
        i, j, estimate = i[stays], j[stays], estimate[stays]
    return i, j


def scores(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs."""
    out = np.empty(len(i), dtype=np.int64)
    step = max(1, streams.PAIRS // max(1, a.shape[1]))
    for k in range(0, len(i), step):
        out[k : k + step] = np.einsum("ij,ij->i", a[i[k : k + step]], b[j[k : k + step]])
    return out


def _packed(x: np.ndarray) -> list[bytes]:
    """Integer rows as bytes of the narrowest type that all of a row's components fit."""
    top = np.abs(x).max(axis=1, initial=0)
    out = []
    for row, most in zip(x, top, strict=True):
        out.append(row.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes())
    return out


def _unpacked(values: pd.Series, dim: int) -> np.ndarray:
    kinds = {2: "<i2", 4: "<i4", 8: "<i8"}
    if not dim:
        return np.zeros((len(values), 0), dtype=np.int64)
    return np.stack([np.frombuffer(v, dtype=kinds[len(v) // dim]) for v in values]).astype(np.int64)


CODED = "vec_id long, label string, dim int, x binary, codes binary, figures binary"


def coder(steps: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Vectors to integers and their codes; vectors whose scores might not fit 64 bits are left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, at in frame.groupby("dim").indices.items():
                part = frame.iloc[at]
                x = np.floor(steps * np.stack(part["x"].to_numpy()).astype(np.float64).reshape(len(part), dim))
                with np.errstate(over="ignore"):
                    fits = (x * x).sum(axis=1) < TOO_LONG
                part, x = part[fits], x[fits].astype(np.int64)
                if len(part):
                    codes = Codes.of(x)
                    bytes_of = lambda m: [r.tobytes() for r in m]
                    yield pd.DataFrame({"vec_id": part["vec_id"], "label": part["label"], "dim": dim, "x": _packed(x), "codes": bytes_of(codes.words), "figures": bytes_of(codes.figures)})

    return run


class _Rows:
    """A batch of rows, unpacked."""

    def __init__(self, rows: pd.DataFrame):
        dim = int(rows["dim"].iloc[0])
        self.ident, self.label = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.x = _unpacked(rows["x"], dim)
        words = np.stack([np.frombuffer(c, dtype=np.uint64) for c in rows["codes"]]).reshape(len(rows), LEVELS, -1)
        figures = np.stack([np.frombuffer(f) for f in rows["figures"]]).reshape(len(rows), LEVELS, 3)
        self.codes = Codes(words, figures, np.linalg.norm(self.x.astype(np.float64), axis=1))


class _Anchors:
    def __init__(self, rows: pd.DataFrame):
        self.ident, self.label = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.x = _unpacked(rows["x"], int(rows["dim"].iloc[0]))
        self.planes = Planes(self.x)

    def pairs(self, rows: _Rows, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of equal labels, or of unequal ones, a bounded number at a time; never an anchor with itself."""
        step = max(1, streams.PAIRS // len(rows.ident))
        for a in range(0, len(self.ident), step):
            mask = (self.label[a : a + step, None] == rows.label[None]) == same
            mask &= self.ident[a : a + step, None] != rows.ident[None]
            i, j = np.nonzero(mask)
            if len(i):
                yield i + a, j


class Positives:
    """The best rows of an anchor's own label."""

    def __init__(self, anchors: pd.DataFrame, count: int):
        self.a = _Anchors(anchors)
        self.best = streams.Best(len(anchors), count, np.int64(-(1 << 62)))

    def feed(self, frame: pd.DataFrame) -> None:
        rows = _Rows(frame)
        for i, j in self.a.pairs(rows, same=True):
            bar = self.best.bar()
            i, j = survivors(self.a.planes, rows.codes, i, j, lambda i, least, most: most >= bar[i])
            score = scores(self.a.x, rows.x, i, j)
            good = score >= bar[i]
            self.best.add(i[good], score[good], rows.ident[j[good]])

    def result(self) -> pd.DataFrame:
        slot, score, ident = self.best.entries()
        return pd.DataFrame({"anchor_id": self.a.ident[slot], "score": score, "vec_id": ident})


class Negatives:
    """For each anchor and positive the best rows of other labels that score within the positive's window."""

    def __init__(self, anchors: pd.DataFrame, count: int, low: int, high: int, positives: int):
        self.a, self.per = _Anchors(anchors), positives
        self.ident = np.zeros((len(anchors), positives), dtype=np.int64)
        self.score = np.zeros((len(anchors), positives), dtype=np.int64)
        # a window without whole numbers is that of no positive
        self.least, self.most = np.ones((len(anchors), positives), dtype=np.int64), np.zeros((len(anchors), positives), dtype=np.int64)
        for n, (ids, values) in enumerate(zip(anchors["p_ids"], anchors["p_scores"], strict=True)):
            for k, (p, s) in enumerate(zip(ids, values, strict=True)):
                self.ident[n, k], self.score[n, k] = p, s
                self.least[n, k], self.most[n, k] = -(-low * int(s) // 100), high * int(s) // 100
        self.best = streams.Best(len(anchors) * positives, count, np.int64(-(1 << 62)))

    def feed(self, frame: pd.DataFrame) -> None:
        rows = _Rows(frame)
        for i, j in self.a.pairs(rows, same=False):
            bar = np.maximum(self.best.bar().reshape(-1, self.per), self.least)

            def may(i: np.ndarray, least: np.ndarray, most: np.ndarray, bar: np.ndarray = bar) -> np.ndarray:
                out = np.zeros(len(i), dtype=bool)
                for k in range(self.per):
                    out |= (self.least[i, k] <= self.most[i, k]) & (most >= bar[i, k]) & (least <= self.most[i, k])
                return out

            i, j = survivors(self.a.planes, rows.codes, i, j, may)
            score = scores(self.a.x, rows.x, i, j)
            for k in range(self.per):
                good = (score >= bar[i, k]) & (score <= self.most[i, k]) & (self.least[i, k] <= self.most[i, k])
                self.best.add(i[good] * self.per + k, score[good], rows.ident[j[good]])

    def result(self) -> pd.DataFrame:
        slot, score, ident = self.best.entries()
        n, k = slot // self.per, slot % self.per
        return pd.DataFrame({"anchor_id": self.a.ident[n], "positive_id": self.ident[n, k], "positive_score": self.score[n, k], "negative_id": ident, "negative_score": score})


def mine(
    rows: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, steps: int = 256, block: int = streams.QUERIES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of every anchor, positive and negative.

    ``is_anchor`` is a condition on the column ``vec_id``. An anchor's positives are the first ``positives`` other rows of its label, by
    descending score and then id; a positive's negatives the first ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``. A positive without such rows has none in the result.

    Rows without id, label or vector and vectors with null, NaN or infinite components take no part, nor do vectors so long that scores
    would leave 64 bits (squared length of the integers 2^56 and more). Of several rows of one id the first by label, then vector, stands for all. Rows
    meet only rows of the same number of components; empty vectors all score 0. Labels are compared as text. Other columns
    are not looked at. An empty table gives an empty result.
    """
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    named = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("x"))
    sound = named.where(F.col("label").isNotNull() & F.coalesce(F.forall("x", number), F.lit(False)))
    single = streams.one_per_id(sound, "vec_id").withColumn("dim", F.size("x"))
    coded = kept(single.mapInPandas(coder(steps), CODED), "one-bit-codes").withColumn("anchor", F.coalesce(is_anchor, F.lit(False)))
    sizes = coded.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("anchor"), 1)).alias("anchors")).collect()[0]
    spans, blocks = streams.spans_for(sizes["rows"]), streams.blocks_for(sizes["anchors"], block)

    placed = coded.where("anchor").withColumn("q_block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).drop("anchor")
    passing = coded.drop("anchor").withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("span", streams.span_of(F.col("vec_id"), spans))

    near = streams.meet(placed, passing, spans, blocks * spans, "vec_id")
    found = near.mapInPandas(lambda frames: streams.run_tasks(frames, lambda q: Positives(q, positives)), "anchor_id long, score long, vec_id long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= positives)
    own = kept(ranked.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p")), "positives")

    armed = placed.join(own.select(F.col("anchor_id").alias("vec_id"), F.col("p.vec_id").alias("p_ids"), F.col("p.score").alias("p_scores")), "vec_id")
    none = F.lit(None).cast("array<bigint>")
    windows = streams.meet(armed, passing.withColumns({"p_ids": none, "p_scores": none}), spans, blocks * spans, "vec_id")
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    mined = windows.mapInPandas(lambda frames: streams.run_tasks(frames, lambda q: Negatives(q, negatives, low, high, positives)), schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    last = mined.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return last.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def digest(rows: DataFrame) -> DataFrame:
    """The query: one label in seven moved on by one, every fiftieth row an anchor."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i]))::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score
    FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, n.other_id AS negative_id,
       p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id)
QUALIFY rank <= 3
"""
