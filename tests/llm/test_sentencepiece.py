import gc
import random
import weakref
from pathlib import Path

import numpy as np
import pytest

from daymark.llm import sentencepiece_scan as sc
from daymark.llm.common import trim
from daymark.llm.pieces import Lattice, load

MODEL = Path(sc.MODEL)
needs_model = pytest.mark.skipif(not MODEL.exists(), reason="the public vocabulary is not here")


def texts(rng, count=60):
    letters = "  ▁\nabcdethonr.,<>0é執😀\t\x00"
    words = ["the", "on", "tion", "ing", "and", "Zürich", "naïve", "x1"]
    out = [None, "", " ", "   ", "\n", "▁", "<s> <0x41>", "a" * 900, "nospaceatall" * 80, " " * 700, "日本語" * 200]
    for _ in range(count):
        out.append("".join(rng.choice(letters) for _ in range(rng.randint(1, 400))))
        out.append(" ".join("".join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 120))))
    return out


@needs_model
@pytest.mark.parametrize("chunk", [64, 300, 1 << 15])
def test_same_ids_as_the_library_and_back(corpus, chunk):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=str(MODEL))
    rows = [(i, t, 1.5) for i, t in enumerate(texts(random.Random(chunk)))] + [(3, "again and again " * 30, 0.0)] * 2
    docs = corpus.createDataFrame(rows, "doc_id long, text string, token_ids double").repartition(3)
    model = sc.model_bytes(corpus, sc.MODEL)
    coded = sc.decode(sc.encode(docs, model, chunk=chunk), model)
    got = coded.collect()
    assert coded.columns == ["doc_id", "text", "token_ids", "decoded"] and len(got) == len(rows)
    for r in got:
        assert r["token_ids"] == (None if r["text"] is None else sp.encode(r["text"]))
        assert r["decoded"] == (None if r["text"] is None else r["text"].replace("▁", " "))
    assert all(r["round_trip"] for r in sc.checked(docs, model).collect())
    assert sc.checked(docs.limit(0), model).count() == 0


def paths(lattice, text):
    """All rows of pieces that spell a text."""
    if not text:
        yield []
    for k in range(1, min(len(text), lattice.longest) + 1):
        if lattice.weight(text[:k]) is not None:
            for rest in paths(lattice, text[k:]):
                yield [text[:k], *rest]


def small(rng):
    pieces = {c: (i, -rng.uniform(2, 6)) for i, c in enumerate("▁abc")}
    for _ in range(14):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(2, 4)))
        pieces.setdefault(rng.choice(("", "▁")) + p, (len(pieces) + 10, -rng.uniform(2, 8)))
    return Lattice(pieces, None, 99, merges=False)


def scanned(lattice, text, chunk):
    whole, around = sc.normalized(text), lattice.longest
    count = max(1, -(-len(whole) // chunk))
    parts = [whole[max(0, i * chunk - around) : (i + 1) * chunk + around] for i in range(count)]
    at = [(0 if i == 0 else around, len(p) if i == count - 1 else (0 if i == 0 else around) + chunk, i == 0, i == count - 1) for i, p in enumerate(parts)]
    matrices = [sc.transfer(lattice, p, *a) for p, a in zip(parts, at, strict=True)]
    ahead = [np.zeros(1)]
    for m in matrices:
        ahead.append((ahead[-1][:, None] + m).max(axis=0))
    state, ids = 0, []
    for k in range(count - 1, -1, -1):
        came = int((ahead[k] + matrices[k][:, state]).argmax())
        ids.insert(0, sc.trace(lattice, parts[k], *at[k], came, state))
        state = came
    product = matrices[0]
    for m in matrices[1:]:
        product = sc.times(product, m)
    return np.frombuffer(b"".join(ids), dtype="<i4").tolist(), float(product[0, 0])


def test_unigram_scores_against_all_paths():
    rng = random.Random(7)
    for _ in range(40):
        lattice = small(rng)
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 11)))
        best = max(sum(lattice.weight(p) for p in row) for row in paths(lattice, sc.normalized(t)))
        weigh = {i: w for i, w in lattice.pieces.values()}
        ids = np.frombuffer(lattice.encode(sc.normalized(t)), dtype="<i4").tolist()
        assert sum(weigh[i] for i in ids) == pytest.approx(best)
        long = t * 12
        mine, weight = scanned(lattice, long, 20)
        whole = np.frombuffer(lattice.encode(sc.normalized(long)), dtype="<i4").tolist()
        assert sum(weigh[i] for i in mine) == pytest.approx(sum(weigh[i] for i in whole)) == pytest.approx(weight)


def test_products_are_associative():
    rng = np.random.default_rng(1)
    a, b, c = (np.where(rng.random((5, 5)) < 0.4, -np.inf, rng.normal(size=(5, 5))) for _ in range(3))
    assert np.allclose(sc.times(sc.times(a, b), c), sc.times(a, sc.times(b, c)))


@needs_model
def test_bytes_that_make_no_character(corpus):
    model = sc.model_bytes(corpus, sc.MODEL)
    lattice = load(model)
    ids = [lattice.bytes_at + 0xC3, lattice.bytes_at + 0x28]
    coded = corpus.createDataFrame([(ids,), ([],), (None,)], "token_ids array<int>")
    assert [r["decoded"] for r in sc.decode(coded, model).collect()] == ["�(", "", None]


def merging():
    words = ["the", "on", "tion", "ing", "and", "ab", "abab", "bab"]
    pieces = dict.fromkeys("▁abdeghinot") | dict.fromkeys(w[:k] for w in words for k in range(1, len(w) + 1))
    return Lattice({p: (i, -float(i)) for i, p in enumerate(pieces)}, None, 99, merges=True)


def test_words_that_come_again_outlive_many_that_do_not(monkeypatch):
    monkeypatch.setattr("daymark.llm.pieces.MEMO", 64)
    lattice, rng, looked_up = merging(), random.Random(3), []
    word = lattice.word
    lattice.word = lambda text: looked_up.append(text) or word(text)
    for _ in range(400):
        lattice.encode("▁the" + "".join("▁" + "".join(rng.choices("abdeghinot", k=12)) for _ in range(8)))
    assert looked_up.count("▁the") == 1
    assert len(lattice._words) + len(lattice._words.older) <= 64


def test_short_words_as_merged():
    lattice, rng = merging(), random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choices(["▁", "a", "b", "ab", "the", "ti", "on", "ing", "é"], k=rng.randint(1, 9)))
        ids = [i for piece in lattice.merged(text) for i in lattice.ids(piece)]
        assert np.frombuffer(lattice._short_word(text), dtype="<i4").tolist() == ids


@needs_model
def test_short_texts_meet_python_once(corpus):
    model = sc.model_bytes(corpus, sc.MODEL)
    docs = corpus.createDataFrame([(1, "one"), (2, None), (3, ""), (4, "x" * 40_000)], "doc_id long, text string")
    told = sc.checked(docs, model)
    assert told.columns == ["doc_id", "token_ids", "n_tokens", "round_trip"]
    # nothing in Python is done above the union of short and long texts, and short ones come from the table
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert 0 <= plan.index("Union") < plan.index("MapInArrow")
    assert {r["doc_id"]: (r["n_tokens"], r["round_trip"]) for r in told.where("doc_id < 4").collect()}.keys() == {1, 2, 3}
    assert [r["n_tokens"] for r in told.where("doc_id in (2, 3)").orderBy("doc_id").collect()] == [None, 0]
    assert told.where("round_trip").count() == 4


@needs_model
def test_other_steps_free_the_model():
    """Workers take turns at tasks of all steps: what one keeps of an earlier step, the others can't use."""
    held = weakref.ref(load(MODEL.read_bytes()))
    gc.disable()
    try:
        trim(caches=True)
        assert held() is not None
        trim()
        assert held() is None
    finally:
        gc.enable()
