import math
import random

import numpy as np
import pytest

from daymark.llm import cover_tree as ct


def brute(rows, threshold):
    def cosine(a, b):
        a, b = (np.array(x, dtype=float) for x in (a, b))
        return float((a * b).sum() / (math.sqrt((a * a).sum()) * math.sqrt((b * b).sum())))

    def sound(r):
        return r[2] is not None and r[1] is not None and len(r[1]) > 0 and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if sound(a) and sound(b) and a[2] == b[2] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        g = find(i)
        known = least.get(g)
        least[g] = r[0] if known is None else known if r[0] is None else min(known, r[0])
    return sorted(((r[0], links[i], least[find(i)], r[0] == least[find(i)]) for i, r in enumerate(rows)), key=repr)


def vectors(rng, count=160, dim=8):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(12)]
    rows = []
    for i in range(count):
        c = rng.choice(centres)
        spread = rng.choice((0.0, 0.03, 0.1, 0.3))
        scale = rng.choice((1.0, 2.5, 1e-3))
        rows.append((i * 3, [scale * (x + rng.gauss(0, spread)) for x in c], rng.choice((0, 0, 0, 1))))
    return rows


ODD = [
    (1001, None, 0), (1002, [], 0), (1003, [0.0] * 8, 0), (1004, [1.0, None, 1.0], 0), (1005, [1.0, float("nan"), 1.0], 0), (1006, [float("inf"), 1.0, 1.0], 0), (1007, [1.0, 2.0, 3.0], None),
    (1008, [1.0, 2.0, 3.0], 0), (1009, [2.0, 4.0, 6.0], 0), (1009, [2.0, 4.0, 6.0], 0), (1010, [-1.0, -2.0, -3.0], 0), (1011, [-0.0, 1.0], 0), (1012, [0.0, 2.0], 0), (None, [1.0, 2.0, 3.0], 0),
]


@pytest.mark.parametrize(("threshold", "block"), [(0.98, 1024), (0.9, 20), (0.98, 7)])
def test_against_all_pairs(corpus, rows_of, threshold, block):
    rows = vectors(random.Random(block)) + ODD
    frame = corpus.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, component_id int").repartition(3)
    got = ct.near_vectors(frame, threshold=threshold, block=block, sample=64)
    assert rows_of(got) == brute(rows, threshold)


def test_empty_table(corpus):
    frame = corpus.createDataFrame([], "vec_id long, embedding array<float>, label int")
    got = ct.near_vectors(frame)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"] and got.count() == 0


def test_walk_finds_what_a_product_finds():
    rng = np.random.default_rng(2)
    for spread in (0.01, 0.2, 2.0):
        centres = rng.normal(size=(9, 12))
        a, b = (centres[rng.integers(0, 9, n)] + spread * rng.normal(size=(n, 12)) for n in (300, 211))
        want = set(zip(*np.nonzero(ct.unit(a) @ ct.unit(b).T >= 0.98), strict=True))
        assert set(zip(*ct.linked(a, b, 0.98, False), strict=True)) == want
        same = {(i, j) for i, j in zip(*np.nonzero(ct.unit(a) @ ct.unit(a).T >= 0.98), strict=True) if i < j}
        assert set(zip(*ct.linked(a, a, 0.98, True), strict=True)) == same


def test_leaves_cover_and_levels_halve():
    rng = np.random.default_rng(3)
    x = ct.unit(rng.normal(size=(400, 5)))
    net = ct.centres(x, 60)
    steps = ct.levels(net)
    assert steps[0] == 1 and steps[-1] == 60 and steps == sorted(steps)
    leaf, distance = ct.descend(x, net)
    assert np.allclose(distance, np.linalg.norm(x - net[leaf], axis=1))


def test_tree_prunes():
    rng = np.random.default_rng(4)
    centres = ct.unit(rng.normal(size=(10, 16)))
    x = ct.unit(np.repeat(centres, 100, axis=0) + 0.01 * rng.normal(size=(1000, 16)))
    root = ct.tree(x)
    assert len(root.open(x)) >= 5 and sum(len(c.members) for c in root.children) == 1000
    assert all(np.linalg.norm(x[c.members] - x[c.centre], axis=1).max() <= c.radius + 1e-9 for c in root.children)
