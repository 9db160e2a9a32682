import random
import re

import pytest

import corpus_pipeline as cp
from daymark.llm.common import table

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choice(("the", "on", "er", "ing", "and", "re")) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(corpus, tmp_path_factory):
    """A small corpus with planted cases; the path and what is planted."""
    rng = random.Random(11)
    passages = [words(rng, 40) for _ in range(3)]
    clean = [words(rng, rng.randint(40, 90)) for _ in range(60)]
    menu = "Home | About | Contact us"
    docs = [(i, f"{menu}\n{t}" if i % 2 else t, "en", f"s{i % 2}") for i, t in enumerate(clean)]
    docs += [(100, clean[4], "en", "s0"), (101, clean[6] + " onon", "en", "s0"), (102, words(rng, 20) + " " + passages[0].upper() + " " + words(rng, 20), "en", "s0"), (103, None, None, None), (104, "", None, "s0"), (105, "12 34 %%", None, "s0")]
    path = tmp_path_factory.mktemp("corpus")
    corpus.createDataFrame([(*d, len(d[1] or "")) for d in docs], FIELDS).repartition(2).write.parquet(f"{path}/documents.parquet")
    corpus.createDataFrame(list(enumerate(passages)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), clean, menu


def test_planted_cases(corpus, folder):
    path, clean, menu = folder
    got = {r["doc_id"]: r for r in cp.run(corpus, path).collect()}
    assert sorted(got) == list(range(60))
    assert all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in got.values())
    # the menu lines are gone, all else is there
    assert [got[i]["n_chars"] for i in range(60)] == [len(t) for t in clean]


def test_stages_one_by_one(corpus, folder):
    path, clean, menu = folder
    docs = table(corpus, path, "documents")
    kept = [{r["doc_id"] for r in stage(corpus, docs, path).collect()} for _, stage in cp.STAGES]
    everything = {*range(60), *range(100, 106)}
    assert kept == [everything - {103, 104, 105}, everything, everything - {100, 101}, everything - {102}, everything]
    for name, stage in cp.STAGES[:-1]:
        assert stage(corpus, docs, path).columns == docs.columns, name
    lines = {r["doc_id"]: r["text"] for r in cp.lines(corpus, docs, path).collect()}
    assert all(lines[i] == clean[i] for i in range(60)) and lines[103] is None and lines[104] == ""


def test_odd_tables(corpus, folder):
    path, _, _ = folder
    docs = table(corpus, path, "documents")
    for _, stage in cp.STAGES:
        assert stage(corpus, docs.limit(0), path).count() == 0
        narrow = stage(corpus, docs.select("doc_id", "text").limit(5), path)
        assert set(narrow.columns) >= {"doc_id", "lang"}
        more = docs.limit(5).selectExpr("*", "1 AS n", "'x' AS row", "2 AS shard", "'k' AS key")
        assert stage(corpus, more, path).count() <= 5


def test_stages_are_named_and_registered():
    from __spark_entry__ import oracle_sql, queries

    assert [re.sub(r"\W", "", n) for n, _ in cp.STAGES] == ["language", "line_dedup", "near_copies", "decontamination", "sentencepiece"]
    assert "pipeline" in queries() and "pipeline" not in oracle_sql()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries() if re.match(r"op\d+_", n)) == list(range(1, 14))


@pytest.mark.parametrize("languages", [2, 40])
def test_language_stage_whatever_the_number_of_languages(corpus, languages):
    rng = random.Random(languages)
    tongues = [["".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(150)] for letters in (rng.sample("abcdefghijklmnopqrstuvwxyzäöüéèñçøå", 18) for _ in range(languages))]
    text = lambda k, n: " ".join(rng.choices(tongues[k], k=n))
    docs = [(n, text(n % languages, rng.randint(5, 60)), f"l{n % languages}", "s", 0) for n in range(60 * languages)]
    short = [(10_000 + n, text(n % languages, 4), None, "s", 0) for n in range(80)]
    foreign = [(20_000 + n, "".join(rng.choices("абвгдежзиклмнопрст ", k=200)), None, "s", 0) for n in range(40)]
    got = {r["doc_id"] for r in cp.language(corpus, corpus.createDataFrame(docs + short + foreign, FIELDS), "").collect()}
    assert {d[0] for d in short} <= got and {d[0] for d in docs} <= got
    assert not {d[0] for d in foreign} & got
