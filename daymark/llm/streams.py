"""Tasks in which a block of queries meets a stream of rows.

Such a task is keyed by (length of the vectors, block of queries, span of rows). Its queries (side 0) are held, its rows (side 1) pass by in Arrow
batches and are forgotten, so that memory depends on the block of queries alone, and what a task returns on the queries, not on the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Queries of a block; spans at most, and rows of a span where there are fewer.
QUERIES = 4096
SPANS = 256
SPAN_ROWS = 4096
#: Pairs whose figures are held at a time.
PAIRS = 1 << 20
TASK = ["dim", "q_block", "span"]


class Search(Protocol):
    def feed(self, rows: pd.DataFrame) -> None: ...
    def result(self) -> pd.DataFrame: ...


def one_per_id(rows: DataFrame, vec_id: str) -> DataFrame:
    """Of several rows of an id the first in the order of their other columns; rows without an id go."""
    others = [c for c in rows.columns if c != vec_id]
    least = rows.where(F.col(vec_id).isNotNull()).groupBy(vec_id).agg(F.min(F.struct(*others)).alias("least"))
    return least.select(vec_id, "least.*")


def spans_for(count: int) -> int:
    return max(1, min(SPANS, -(-count // SPAN_ROWS)))


def blocks_for(count: int, block: int = QUERIES) -> int:
    return max(1, -(-count // block))


def span_of(key: Column, spans: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("span"), key), F.lit(spans)).cast("int")


def meet(queries: DataFrame, rows: DataFrame, spans: int, tasks: int, order: str) -> DataFrame:
    """Queries (with ``dim``, ``q_block``) copied to every span, and rows (with all of TASK), of one layout, sorted so that a task's queries come first.

    Both frames have the same columns. What grows with the product of both sides is only how often narrow rows travel: a
    query once per span, of which there is a bounded number, and a row once per block of queries.
    """
    copied = queries.withColumn("span", F.explode(F.sequence(F.lit(0), F.lit(spans - 1)))).withColumn("side", F.lit(0))
    both = copied.unionByName(rows.withColumn("side", F.lit(1)))
    return both.repartition(tasks, *TASK).sortWithinPartitions(*TASK, "side", order)


def run_tasks(frames: Iterator[pd.DataFrame], begin: Callable[[pd.DataFrame], Search]) -> Iterator[pd.DataFrame]:
    """Walk through sorted rows of several tasks: collect a task's queries, feed it its rows, return what it found."""
    key: tuple | None = None
    held: list[pd.DataFrame] = []
    search: Search | None = None
    for frame in frames:
        if not len(frame):
            continue
        marks = frame[[*TASK, "side"]].to_numpy()
        cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(frame)], strict=True):
            part = frame.iloc[a:b]
            *now, side = marks[a]
            if tuple(now) != key:
                if search is not None:
                    yield search.result()
                key, held, search = tuple(now), [], None
            if side == 0:
                held.append(part)
            elif held or search is not None:
                if search is None:
                    search, held = begin(pd.concat(held, ignore_index=True)), []
                search.feed(part)
    if search is not None:
        yield search.result()


class Best:
    """The first ``k`` entries of every slot: by descending score, ties by ascending id."""

    def __init__(self, slots: int, k: int, worst: object):
        self.k, self.slots = k, slots
        self.score = np.full((slots, k), worst)
        self.ident = np.zeros((slots, k), dtype=np.int64)
        self.count = np.zeros(slots, dtype=np.int64)

    def bar(self) -> np.ndarray:
        """What an entry must reach, equal ones included."""
        return self.score[:, -1]

    def add(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        touched = np.unique(slot)
        if not len(touched):
            return
        row, place = np.nonzero(np.arange(self.k) < self.count[touched][:, None])
        slot = np.concatenate([touched[row], slot])
        score = np.concatenate([self.score[touched[row], place], score])
        ident = np.concatenate([self.ident[touched[row], place], ident])
        order = np.lexsort((ident, -score, slot))
        slot, score, ident = slot[order], score[order], ident[order]
        first = np.concatenate([[0], np.flatnonzero(slot[1:] != slot[:-1]) + 1])
        at = np.arange(len(slot)) - np.repeat(first, np.diff([*first, len(slot)]))
        stays = at < self.k
        self.score[slot[stays], at[stays]], self.ident[slot[stays], at[stays]] = score[stays], ident[stays]
        np.maximum.at(self.count, slot[stays], at[stays] + 1)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, place = np.nonzero(np.arange(self.k) < self.count[:, None])
        return slot, self.score[slot, place], self.ident[slot, place]
