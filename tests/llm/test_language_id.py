import random
import zlib

import numpy as np

from daymark.llm import language_id as li

SYLLABLES = {"aa": ["the", "on", "er", "ing", "and"], "bb": ["qué", "los", "ción", "en", "ar"], "cc": ["sch", "ung", "ei", "zü", "en"]}


def text(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(words))


def corpus_of(rng, count=400):
    return [(i, text(rng, lang := rng.choice(list(SYLLABLES)), rng.choice((3, 20, 100))), lang, "s") for i in range(count)]


def test_held_out_accuracy(corpus):
    rows = corpus_of(random.Random(1))
    docs = corpus.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    told = li.identify(docs.select("doc_id", "text"), li.learned(docs)).select("*", li.held_out().alias("held_out")).collect()
    truth = {r[0]: r[2] for r in rows}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in told)
    mine = [r["lang_pred"] == truth[r["doc_id"]] for r in told if r["held_out"]]
    assert len(told) == 400 and len(mine) > 90 and np.mean(mine) > 0.97
    assert all(0 <= r["score"] <= 1 for r in told)


def test_labels_of_held_out_rows_and_sources_do_not_matter(corpus):
    rows = corpus_of(random.Random(2), 120)
    schema = "doc_id long, text string, lang string, source string"
    wrong = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, "other") for i, t, lang, _ in rows]
    answers = []
    for data in (rows, wrong):
        docs = corpus.createDataFrame(data, schema)
        answers.append({r["doc_id"]: (r["lang_pred"], r["score"]) for r in li.identify(docs, li.learned(docs)).collect()})
    assert answers[0] == answers[1]


def test_odd_texts(corpus):
    docs = corpus.createDataFrame(corpus_of(random.Random(3), 150), "doc_id long, text string, lang string, source string")
    model = li.learned(docs)
    long = text(random.Random(4), "bb", 90_000)
    odd = [(1, None, 5.0), (2, "", 5.0), (3, "12 %% 🙂\n", 5.0), (4, "a", 5.0), (5, long, 5.0), (5, long, 5.0), (None, "ung ei schen zü", 5.0), (7, "日本語", 5.0)]
    told = li.identify(corpus.createDataFrame(odd, "doc_id long, text string, score double"), model)
    assert told.columns == ["doc_id", "text", "lang_pred", "score"]
    got = {(r["doc_id"], r["lang_pred"]) for r in told.collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (5, "bb"), (None, "cc")} <= got and told.count() == 8
    assert all(r["score"] == 0 for r in told.collect() if r["lang_pred"] == "und")
    assert li.identify(docs.limit(0), model).count() == 0


def test_nothing_to_learn_from(corpus):
    docs = corpus.createDataFrame([(0, "some text", None), (2, None, "aa"), (3, "...", "aa")], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in li.identify(docs, li.learned(docs)).collect()] == ["und"] * 3


def test_scores_are_those_of_the_kernel():
    """Weights by bucket give what kernel values against the landmarks give."""
    rng = random.Random(5)
    texts = [text(rng, lang, 15) for lang in SYLLABLES for _ in range(20)]
    labels = [lang for lang in SYLLABLES for _ in range(20)]
    marks = 8
    model = li.fit(texts, labels, landmarks=marks, bits=14)
    spectra = [set(li.spectrum(t, 14).tolist()) for t in texts]
    landmark = [i for k in range(3) for i in range(20 * k, 20 * k + marks)]
    kernel = np.array([[len(a & spectra[i]) / np.sqrt(len(a) * len(spectra[i])) for i in landmark] for a in spectra])
    values, vectors = np.linalg.eigh(kernel[landmark])
    good = values > 1e-6 * values.max()
    features = kernel @ (vectors[:, good] / np.sqrt(values[good]))
    target = np.array([[1.0 if x == y else -1.0 for y in SYLLABLES] for x in labels])
    solved = np.linalg.solve(features.T @ features + li.RIDGE * 60 * np.eye(features.shape[1]), features.T @ target)
    present = np.zeros((60, len(model.weights)))
    for k, s in enumerate(spectra):
        at = model.place[sorted(s)]
        present[k, at[at >= 0]] = 1 / np.sqrt(len(s))
    assert np.allclose(present @ model.weights, features @ solved, atol=1e-3)


def test_long_texts_are_walked_whole():
    t = text(random.Random(6), "aa", 60_000)
    whole = set(li.spectrum(t, 18).tolist())
    assert set(li.spectrum(t[:200_000], 18).tolist()) | set(li.spectrum(t[199_990:], 18).tolist()) >= whole
