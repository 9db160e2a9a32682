import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daymark.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(n, factor=5):
    out = []
    forms = {}
    for w in n:
        near = [v for v in n if one_edit(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        forms[w] = best if best is not None and n[best] >= factor * n[w] else None
        out.append([w, n[w], len(near)])
    rows = []
    for w, c, k in out:
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.append((w, c, k, forms[w], n[forms[w]] if forms[w] else None, root))
    return sorted(rows)


def told(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


@pytest.mark.parametrize("block", [3, 40, 1024])
def test_equals_brute_force(corpus, block):
    rng = random.Random(block)
    letters = "abé\U0001f600"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(160)}
    # one long beginning and one long ending that most words share
    words |= {"commonbeginning" + "".join(rng.choice("xy") for _ in range(rng.randint(0, 6))) for _ in range(60)}
    words |= {"".join(rng.choice("xy") for _ in range(rng.randint(0, 6))) + "commonending" for _ in range(60)}
    n = {w: rng.choice([1, 2, 10, 55, 300, 300]) for w in words}
    df = corpus.createDataFrame([(w, c, "x", 1) for w, c in n.items()], "word string, n long, form string, task int")
    assert told(spelling.variants(df.repartition(4), block=block)) == brute(n)


def test_long_words_and_chains(corpus, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK_CHARS", 20000)
    long = "x" * 9000
    n = {long: 700, long + "y": 100, long + "yz": 15, long + "yzz": 3, "a": 5, "b": 25, "ab": 1}
    df = corpus.createDataFrame(list(n.items()), "word string, n long")
    got = told(spelling.variants(df))
    assert got == brute(n)
    assert {r[0]: r[5] for r in got}[long + "yzz"] == long


def test_words_of_texts(corpus):
    texts = [(1, "Hello,HELLO hellö x" + " wordless" * 9), (2, None), (3, ""), (None, "wordless ÀÉÎwordless"), (4, "Straße straße"), (5, "42"), (1, "wordless")]
    want = Counter()
    for key, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 3 == 0 else run
            if len(word) >= 5:
                want[word] += 1
    df = corpus.createDataFrame([(*t, "n") for t in texts], "doc_id long, text string, word string")
    got = spelling.words(df, least_length=5, least=2, slip_one_in=3)
    assert {r["word"]: r["n"] for r in got.collect()} == {w: c for w, c in want.items() if c >= 2}


def test_empty_and_null_words(corpus):
    df = corpus.createDataFrame([], "word string, n long")
    assert told(spelling.variants(df)) == []
    df = corpus.createDataFrame([(None, 3), ("", 4), ("cat", 1), ("cat", 2), ("cats", 15)], "word string, n long")
    assert told(spelling.variants(df)) == [("cat", 3, 1, "cats", 15, "cats"), ("cats", 15, 1, None, None, "cats")]
    assert told(spelling.digest(corpus.createDataFrame([], "doc_id long, text string"))) == []


def test_a_pair_is_told_once_in_all(corpus):
    # both halves agree, so prefix and suffix groups both hold the pair
    df = corpus.createDataFrame([("abcdefgh", 1), ("abcdXfgh", 1)], "word string, n long")
    assert {r["n_near"] for r in spelling.near_words(df).collect()} == {1}
    assert spelling.near_words(df).agg(F.count("word")).collect()[0][0] == 2
