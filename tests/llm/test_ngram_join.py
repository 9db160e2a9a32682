import random
import re

import numpy as np
import pyarrow as pa
import pytest

from daymark.llm import ngram_join as nj
from daymark.llm import shingles
from daymark.llm.components import components


def shingle_set(t, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if len(words) < size:
        return frozenset({tuple(words)} if words else ())
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(docs, size, percent):
    sets = [shingle_set(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and 100 * shared >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(docs):
        groups.setdefault(find(i), []).append(d)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs)), key=repr)


def corpus_of(rng, families=25, extra=()):
    words = [f"w{i}é" for i in range(300)]
    common = [rng.choice(words) for _ in range(30)]
    docs, number = list(extra), 100
    for _ in range(families):
        base = [rng.choice(words) for _ in range(rng.choice((2, 3, 5, 20, 60, 200)))]
        if rng.random() < 0.4:
            base += common
        for _ in range(rng.choice((1, 2, 3, 12))):
            own = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 4))):
                own[rng.randrange(len(own))] = rng.choice(words).upper()
            docs.append((number, rng.choice((" ", "\n", "\t ")).join(own)))
            number += 1
    rng.shuffle(docs)
    return docs


EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (6, "one two"), (7, "a b c d"), (8, "A B\x0bC D"), (9, "a\x1fb c d e")]


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80), (2, 50)])
def test_against_all_pairs(corpus, rows_of, size, percent):
    docs = corpus_of(random.Random(size), extra=EDGES)
    got = nj.near_classes(corpus.createDataFrame([(d, t, 0, "k") for d, t in docs], "doc_id long, text string, v int, key string"), size=size, percent=percent)
    assert rows_of(got) == brute(docs, size, percent)


def test_many_matches_and_small_sketch(corpus, rows_of, monkeypatch):
    """Frequent shingles everywhere, so that prefixes are lengthened."""
    monkeypatch.setattr(nj, "SKETCH_BITS", 12)
    rng = random.Random(8)
    phrases = [" ".join(f"p{k}x{i}" for i in range(12)) for k in range(12)]
    docs = [(i, " ".join(rng.sample(phrases, 8))) for i in range(150)]
    got = nj.near_classes(corpus.createDataFrame(docs, "doc_id long, text string"))
    assert rows_of(got) == brute(docs, 4, 85)


def test_prefixes_share_what_they_must():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        seen = lambda s: (s % np.uint64(7)).astype(float) * 40
        chosen, matches = nj.prefix_of(a, seen(a), 10.0, 85)
        assert len(chosen) == len(a) - -(-85 * len(a) // 100) + matches
        b = np.unique(np.concatenate([a[: int(len(a) * 0.95) + 1], rng.integers(0, 1 << 62, 1, dtype=np.uint64)]))
        shared = len(np.intersect1d(a, b))
        x, y = (nj.outlined(nj.outline(s)) for s in (a, b))
        least = min(len(x), len(y))
        assert np.minimum(x.reshape(least, -1).sum(axis=1), y.reshape(least, -1).sum(axis=1)).sum() >= shared
        if 100 * shared >= 85 * (len(a) + len(b) - shared):
            other, more = nj.prefix_of(b, seen(b), 10.0, 85)
            least = min(matches, more)
            base = lambda s: len(s) - -(-85 * len(s) // 100)
            assert len(np.intersect1d(chosen[: base(a) + least], other[: base(b) + least])) >= least


def test_drop_and_empty(corpus):
    docs = corpus.createDataFrame([(i, t, "a") for i, t in EDGES], "doc_id long, text string, component_id string")
    assert sorted(r["doc_id"] for r in nj.drop_near_copies(docs).collect()) == [1, 2, 3, 4, 6, 6, 7, 9]
    assert nj.near_classes(docs.limit(0)).count() == 0 and nj.drop_near_copies(docs.limit(0)).count() == 0


def test_shingles_of_pieces(monkeypatch):
    """Texts longer than what is hashed at once, and slices of a column."""
    monkeypatch.setattr(shingles, "PIECE", 64)
    rng = random.Random(2)
    texts = [None, "", "a", "x" * 500 + " y z w v", "q " * 200] + ["".join(rng.choice("ab é \t\nC") for _ in range(rng.randint(0, 300))) for _ in range(60)]
    column = pa.array(texts).slice(1)
    row, shingle = shingles.shingle_sets(column, 4)
    want = [shingle_set(t, 4) for t in texts[1:]]
    mine = [set(shingle[row == i].tolist()) for i in range(len(want))]
    assert all(len(want[i] & want[j]) == len(mine[i] & mine[j]) for i in range(len(want)) for j in range(i + 1))


def test_components(corpus, rows_of):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5000, 5000)] + [(rng.randrange(300, 700), rng.randrange(300, 700)) for _ in range(150)]
    root = {v: v for e in edges for v in e}
    for _ in range(500):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert rows_of(components(corpus.createDataFrame(edges, "a long, b long"))) == sorted(root.items(), key=repr)
    assert components(corpus.createDataFrame([], "a long, b long")).count() == 0
