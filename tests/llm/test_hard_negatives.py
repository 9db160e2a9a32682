import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, anchor string, q_block string, x string"


def brute(rows, anchors, positives=5, negatives=3, low=50, high=95, steps=256):
    sound = [(i, [math.floor(steps * c) for c in v], str(label)) for i, v, label in rows if i is not None and v is not None and label is not None and all(c is not None and math.isfinite(c) for c in v)]
    sound = [r for r in sound if sum(c * c for c in r[1]) < 2**56]
    out = []
    for a, x, label in sound:
        if not anchors(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), b, other) for b, y, other in sound if b != a and len(y) == len(x))
        for s, p, _ in [r for r in scored if r[2] == label][:positives]:
            fit = [(n, b) for n, b, other in scored if other != label and low * -s <= 100 * -n <= high * -s]
            out += [(a, p, rank, b, -s, -n) for rank, (n, b) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)


def mined(df, every=5, **options):
    got = hn.mine(df, F.col("vec_id") % every == 0, **options)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("dim,kind", [(64, "flat"), (10, "clustered"), (100, "grid")])
def test_equals_brute_force(corpus, dim, kind, monkeypatch):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(400, dim))
    if kind == "clustered":
        x = rng.normal(size=(12, dim))[rng.integers(12, size=400)] + 0.05 * x
    if kind == "grid":  # many equal scores and equal vectors
        x = rng.integers(-1, 2, size=(400, dim)) / 16
        x[100:220] = x[7]
    rows = [(int(i), [float(c) for c in v], int(rng.integers(3))) for i, v in enumerate(x)]
    monkeypatch.setattr(hn.streams, "SPAN_ROWS", 150)
    assert mined(frame(corpus, rows).repartition(5), block=30) == brute(rows, lambda i: i % 5 == 0)


def test_odd_rows(corpus):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.6, 0.6], 2), (5, [0.0, 0.0], 1), (10, [-1.0, -0.2], 2), (3, [0.7, 0.0], 2), (4, [0.7, 0.0], 2),
        (None, [1.0, 1.0], 1), (6, None, 1), (7, [1.0, 1.0], None), (8, [nan, 1.0], 1), (9, [inf, 1.0], 2), (11, [None, 1.0], 2), (15, [], 1), (16, [], 1), (17, [], 2),
        (20, [1e200, 1.0], 1), (25, [0.5], 1), (26, [0.7], 1), (27, [0.6], 3),
    ]
    assert mined(frame(corpus, rows)) == brute(rows, lambda i: i % 5 == 0)
    # a repeated row counts once; of two rows of an id the first by label, then vector
    again = [*rows, rows[0], rows[2], (3, [0.9, 0.9], 3)]
    assert mined(frame(corpus, again)) == brute(rows, lambda i: i % 5 == 0)


def test_empty(corpus):
    assert mined(frame(corpus, [])) == []
    assert mined(frame(corpus, [(1, [1.0], 1)])) == []


def test_intervals_hold():
    rng = np.random.default_rng(3)
    for dim in (1, 17, 64, 130):
        a, b = (rng.integers(-400, 400, size=(40, dim)) for _ in range(2))
        b[:5] = a[:5]
        b[5] = 0
        planes, codes = hn.Planes(a), hn.Codes.of(b)
        i, j = (k.ravel() for k in np.indices((40, 40)))
        true = (a[i] * b[j]).sum(axis=1)
        widths = []

        def may(p, least, most, i=i, j=j, true=true, widths=widths):
            assert (least <= true).all() and (true <= most).all()
            widths.append(float((most - least).mean()))
            return np.ones(len(p), dtype=bool)

        hn.survivors(planes, codes, i, j, may)
        assert widths == sorted(widths, reverse=True)
        # most pairs of unlike vectors can't reach a high score, and go before they are scored
        if dim == 64:
            kept = hn.survivors(planes, codes, i, j, lambda p, least, most: most >= planes.length[p] ** 2 * 0.8)[0]
            assert len(kept) < len(i) / 4
