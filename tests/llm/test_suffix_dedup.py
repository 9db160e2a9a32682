import collections
import random

import pytest

from daymark.llm import suffix_dedup as sd


def brute(docs, length):
    bodies = [(d, (t or "").encode()) for d, t in docs]
    seen = collections.Counter(b[i : i + length] for _, b in bodies for i in range(len(b) - length + 1))
    out = []
    for d, b in bodies:
        spans = []
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        rest = b"".join(b[a:z] for a, z in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(b)], strict=True))
        out.append((d, len(b), len(b) - len(rest), [tuple(s) for s in spans], rest))
    return sorted(out, key=repr)


def corpus_of(rng, count=60):
    letters = "abcdefgh é"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [text(rng.choice((15, 30, 45, 90, 200))) for _ in range(8)] + ["z" * 100, "ab" * 40]
    docs = [(1, None), (2, ""), (3, "short"), (4, "y" * 41), (5, "y" * 40), (6, text(300)), (None, text(50))]
    for i in range(count):
        parts = []
        for _ in range(rng.choice((1, 2, 3))):
            p = rng.choice(passages)
            cut = rng.randrange(len(p) // 2)
            parts += [text(rng.choice((0, 3, 20, 60))), p[rng.choice((0, cut)) : len(p) - rng.choice((0, cut // 2))]]
        docs.append((10 + i, "".join(parts) + text(rng.choice((0, 10)))))
    return [*docs, docs[20], (900, docs[21][1])]


@pytest.mark.parametrize(("hot", "parts"), [(10_000, 20_000), (10_000, 7), (4, 50)])
def test_against_brute_force(corpus, rows_of, hot, parts):
    docs = corpus_of(random.Random(parts + hot))
    frame = corpus.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, name string, begin int").repartition(4)
    got = sd.without_repeats(frame, length=40, hot_from=hot, part_suffixes=parts).collect()
    mine = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], [(s["begin"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in got), key=repr)
    assert mine == brute(docs, 40)


def test_small_segments_and_runs(corpus, monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(sd, "SEGMENT_BITS", 8)
    import numpy as np

    data = "".join(rng.choice("abc") for _ in range(2000)).encode()
    data = data[:900] + data[100:500] + data[900:]
    at, hashes = sd.anchors(np.frombuffer(data, dtype=np.uint8), np.array([0, 700, 700, len(data)]), 40)
    assert len(at) and (np.diff(at) > 0).all()
    # every string of 40 bytes within one text has an anchor with its whole 20 bytes inside
    for i in range(len(data) - 39):
        if not (i < 700 < i + 40):
            assert ((at >= i) & (at + 20 <= i + 40)).any()


def test_merge_equals_sort():
    rng = random.Random(4)
    for _ in range(200):
        runs, everything = [], []
        for _ in range(rng.choice((1, 2, 3, 7))):
            keys = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) for _ in range(rng.randrange(15)))
            everything += keys
            shared = [0, *[sd.common(a, b, 0) for a, b in zip(keys, keys[1:])]][: len(keys)]
            runs.append(sd.Run([(s, k[s:]) for s, k in zip(shared, keys, strict=True)]))
        out = list(sd.LoserTree(runs).merged())
        assert [k for _, _, k, _ in out] == sorted(everything)
        before = b""
        for shared, _, key, _ in out:
            assert shared <= sd.common(before, key, 0)
            if before and key != before:
                assert shared == sd.common(before, key, 0)
            before = key


def test_empty_table(corpus):
    assert sd.without_repeats(corpus.createDataFrame([], "doc_id long, text string")).count() == 0


def test_whole_copies(corpus, rows_of):
    """Many rows of few texts, one of them in a third of all rows, next to texts that share a part with a copied one or nothing."""
    rng = random.Random(17)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    hot, other, short = text(150), text(90), text(12)
    docs = [(i, hot) for i in range(60)] + [(100 + i, other) for i in range(2)] + [(200 + i, short) for i in range(5)]
    docs += [(300 + i, text(30) + hot[20 + i : 90] + text(30)) for i in range(20)] + [(400 + i, text(120)) for i in range(40)] + [(7, hot), (7, hot)]
    rng.shuffle(docs)
    got = sd.without_repeats(corpus.createDataFrame(docs, "doc_id long, text string").repartition(5), length=40).collect()
    mine = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], [(s["begin"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in got), key=repr)
    assert mine == brute(docs, 40)


def test_copies_that_share_a_bit(corpus, monkeypatch):
    """Maps of so few bits that single texts share them with copied ones: none of those is told to be copied."""
    import pyarrow as pa

    from daymark.llm import common

    monkeypatch.setattr(common, "MAP_BITS", 6)
    monkeypatch.setattr(common, "PART_BITS", 3)
    monkeypatch.setattr(sd, "MAP_BITS", 6)
    rng = random.Random(23)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    copied = [text(70) for _ in range(12)]
    docs = [(i, c) for i, c in enumerate(copied * 3)] + [(100 + i, text(60)) for i in range(60)] + [(200 + i, text(20) + copied[i][:50]) for i in range(12)]
    rows = corpus.createDataFrame([(t.encode(), t, i) for i, t in docs], "body binary, name string, g long").selectExpr("*", "xxhash64(name) AS h")
    copies = sd.Copies(sd.text_names(rows, 40))
    assert copies.mistaken.any()
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in rows.collect()])
    told = {name for name, sure in zip(batch.column("name").to_pylist(), copies.surely(batch), strict=True) if sure}
    assert told <= set(copied)
    standing = [name for part in copies.standing(iter([batch])) for name in part.column("name").to_pylist()]
    assert set(standing) == {t for _, t in docs}


@pytest.mark.parametrize("hot", [10_000, 3])
def test_texts_that_go_on_repeating_themselves(corpus, monkeypatch, hot):
    """Equal surroundings every few bytes of a text are a row or two, not one for each place, and count as often as they stand."""
    rng = random.Random(31 + hot)
    text = lambda n: "".join(rng.choice("cdefgh é") for _ in range(n))
    docs = [(i, text(rng.randrange(30)) + "ab" * 1500 + text(30)) for i in range(6)] + [(10, "xyz" * 700), (11, text(50) + "xyz" * 13 + "q" + text(50))]
    docs += [(20 + i, text(40) + "ab" * 19 + text(1 + i)) for i in range(8)] + [(40, "ab" * 60 + text(90) + "ab" * 60), (41, "ab" * 20), (42, text(200))]
    written, write = {}, sd.kept

    def counted(df, name):
        out = write(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(sd, "kept", counted)
    got = sd.without_repeats(corpus.createDataFrame(docs, "doc_id long, text string").repartition(3), length=40, hot_from=hot).collect()
    mine = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], [(s["begin"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in got), key=repr)
    assert mine == brute(docs, 40)
    assert written["surroundings"] < 500
    assert written.get("hot-strings", 0) < 2500
    assert ("hot-strings" in written) == (hot == 3)


def test_hot_strings_that_reach_each_other(corpus, monkeypatch):
    """A string that stands every other byte of many texts is a row or two for each text, also at the ends, whose surroundings all differ."""
    rng = random.Random(41)
    text = lambda n: "".join(rng.choice("cdefgh é") for _ in range(n))
    docs = [(i, text(45) + "ab" * 60 + text(45)) for i in range(20)] + [(90, text(60) + "ab" * 20 + text(3)), (91, "ab" * 19 + "a" + text(50))]
    most, write = [], sd.kept

    def counted(df, name):
        out = write(df, name)
        if name == "hot-strings":
            most.append(out.groupBy("digest").count().agg({"count": "max"}).collect()[0][0])
        return out

    monkeypatch.setattr(sd, "kept", counted)
    got = sd.without_repeats(corpus.createDataFrame(docs, "doc_id long, text string").repartition(3), length=40, hot_from=3).collect()
    mine = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], [(s["begin"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in got), key=repr)
    assert mine == brute(docs, 40)
    assert most and most[0] <= 3 * len(docs)
