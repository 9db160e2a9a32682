import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm import multi_index as mi

SCHEMA = "vec_id long, embedding array<double>, cell string, reach string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)


def found(df, every, k=10, **options):
    got = mi.search(mi.build(df), F.col("vec_id") % every == 0, k, **options)
    out = {}
    for r in got.orderBy("query_id", "rank").collect():
        rows = out.setdefault(r["query_id"], [])
        rows.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(rows)
    return out


def brute(rows, every, k=10):
    sound = {i: v for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)}
    out = {}
    for q, x in sound.items():
        if q % every == 0:
            near = sorted((math.dist(x, y), i) for i, y in sound.items() if i != q and len(y) == len(x))[:k]
            if near:
                out[q] = [(i, d) for d, i in near]
    return out


@pytest.mark.parametrize("kind", ["flat", "clustered", "copies"])
def test_recall(corpus, kind, monkeypatch):
    rng = np.random.default_rng(5)
    n, dim = 4000, 24
    x = rng.normal(size=(n, dim))
    if kind == "clustered":
        x = rng.normal(size=(60, dim))[rng.integers(60, size=n)] + 0.15 * x
    if kind == "copies":  # a third of all rows are one vector, and as many lie close to another
        x[: n // 3] = x[0]
        x[n // 3 : 2 * n // 3] = x[-1] + 0.01 * x[n // 3 : 2 * n // 3]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    monkeypatch.setattr(mi.streams, "SPAN_ROWS", 700)
    opened = []
    near = mi._nearest

    def counting(index, queries, data, spans, blocks, k):
        opened.append((data.count(), blocks))
        return near(index, queries, data, spans, blocks, k)

    monkeypatch.setattr(mi, "_nearest", counting)
    got, want = found(frame(corpus, rows), 40, block=25), brute(rows, 40)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    for q, near in got.items():
        assert all(abs(d - math.dist(x[q], x[i])) <= 1e-12 * max(1, d) for i, d in near)
        assert near == sorted(near, key=lambda r: (r[1], r[0]))
    if kind == "clustered":  # blocks of queries see a part of the rows only
        assert opened[-1][0] < 0.75 * n * opened[-1][1]


def test_few_rows_are_searched_whole(corpus):
    rows = [(0, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.5]), (2, [1.0, 2.0, 2.5]), (5, [9.0, 9.0, 9.0]), (10, [0.0, 0.1, 0.0])]
    assert found(frame(corpus, rows), 5) == brute(rows, 5)


def test_odd_rows(corpus):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (5, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.0, 0.0]), (None, [1.0, 2.0]), (3, None), (4, []), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (10, [3.0]), (11, [4.0]), (12, [2.0]), (15, [1.0, 2.0, 3.0]), (20, [1e200, 1e200]), (21, [1.1e200, 1e200]), (25, [1e-200, 0.0])]
    want = brute(rows, 5)
    got = found(frame(corpus, rows), 5)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert all(math.isclose(a, b, rel_tol=1e-12) for (_, a), (_, b) in zip(got[q], want[q]))
    # repeated rows count once
    assert found(frame(corpus, [*rows, rows[0], rows[1]]), 5) == got


def test_empty(corpus):
    assert found(frame(corpus, []), 5) == {}
    assert found(frame(corpus, [(0, [1.0])]), 5) == {}


def test_traversal_is_ordered_and_whole():
    rng = np.random.default_rng(1)
    first, second = rng.integers(0, 9, 7).astype(float), rng.integers(0, 9, 5).astype(float)
    drawn = list(mi.traverse(first, second))
    assert sorted(c for _, c in drawn) == list(range(35))
    assert [t for t, _ in drawn] == sorted(t for t, _ in drawn)
    assert all(t == first[c // 5] + second[c % 5] for t, c in drawn)
