import random
import tracemalloc

import numpy as np

from daymark.llm import decontaminate as dc

LETTERS = "abcdefghij klmnopqrst uvwxyz"


def text(rng, n):
    return "".join(rng.choice(LETTERS) for _ in range(n))


def edited(rng, t, edits):
    out = list(t)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = "#"
        elif kind == 1:
            out.insert(at, "#")
        else:
            del out[at]
    return "".join(out)


def within(pattern, t, edits):
    """Whether a part of t is within the edits of the pattern, by the whole table."""
    row = np.zeros(len(t) + 1, dtype=int)
    for i, c in enumerate(pattern, 1):
        new = np.empty_like(row)
        new[0] = i
        for j, d in enumerate(t, 1):
            new[j] = min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1)
        row = new
    return row.min() <= edits


def brute(docs, items, window, step, rate, q):
    plain = lambda t: "".join(map(chr, dc.plain(t)))
    out = set()
    for d, t in docs:
        for i, item in items:
            if not t or not item or len(item) < q:
                continue
            n = min(len(item), window)
            for b in sorted({*range(0, len(item) - n, step), len(item) - n}):
                if within(plain(item)[b : b + n], plain(t), dc.budget(n, q, rate)[0]):
                    out.add((d, i))
    return out


def test_against_whole_tables(corpus):
    rng = random.Random(4)
    items = [(i, text(rng, n)) for i, n in enumerate((30, 45, 90, 130))]
    docs = [(0, None), (1, ""), (2, text(rng, 150))]
    for k in range(24):
        _, item = items[k % len(items)]
        part = item if k % 3 else item[: max(40, len(item) // 2)]
        docs.append((k + 3, text(rng, 40) + edited(rng, part.upper() if k % 2 else part, k % 7) + text(rng, 30)))
    window, step, rate, q = 40, 7, 0.1, 6
    got = dc.contaminated(
        corpus.createDataFrame(docs, "doc_id long, text string"), corpus.createDataFrame([*items, (9, None), (10, ""), (11, "ab")], "item_id long, text string"),
        window=window, step=step, rate=rate, q=q,
    )
    found = {(r["doc_id"], r["item_id"]) for r in got.collect()}
    assert found == brute(docs, items, window, step, rate, q)
    assert len(found) > 10


def test_blocks_long_texts_and_clean(corpus, monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(dc, "PIECE", 500)
    items = [(i, text(rng, 120)) for i in range(6)]
    index = dc.build_index(items)
    long = "".join(text(rng, 480) + t for _, t in items)
    assert [p[0] for p in dc.passages(index, long)] == [0, 1, 2, 3, 4, 5]
    for (_, a, b, edits, _), (_, t) in zip(dc.passages(index, long), items, strict=True):
        assert long[a:b] == t and edits == 0
    docs = corpus.createDataFrame([(1, long, 7), (1, long, 7), (2, "nothing", 8), (None, None, 9)], "doc_id long, text string, item_id int")
    benchmark = corpus.createDataFrame(items, "item_id long, text string")
    assert dc.contaminated(docs, benchmark, index_chars=130).count() == 12
    assert sorted(r["item_id"] for r in dc.clean(docs, benchmark, index_chars=130).collect()) == [8, 9]
    assert dc.contaminated(docs.limit(0), benchmark).count() == 0
    assert dc.clean(docs, benchmark.limit(0)).count() == 4


def test_case_and_blanks_cost_no_edits():
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéèñçøåłžđабвгдежзийαβγδςıﬁ"
    for _ in range(40):
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(30)]
        item = " ".join(words)
        index = dc.build_index([(7, item), (8, f"\n  {item[:60].strip()}\n")])
        wrapped = "".join(w + rng.choice(["  ", "\n    ", " \t", "  "]) for w in words).strip()
        for copy in (item.upper(), item.lower(), item.title(), item.swapcase(), wrapped, wrapped.upper()):
            t = "xx  yy. " + copy + " .zz"
            found = dc.passages(index, t)
            assert [p[0] for p in found] == [7, 8] and [p[3] for p in found] == [0, 0]
            assert t[found[0][1] : found[0][2]] == copy


def test_short_items(corpus):
    items = [(1, "Ünder 12"), (2, "twenty characters ab"), (3, "x"), (4, "今天天气"), (5, "  "), (6, "twenty-three characters")]
    index = dc.build_index(items)
    held = lambda t: [p[0] for p in dc.passages(index, t)]
    assert held("so ünder  12, they") == [1] and held("ÜNDER 12") == [1] and held("under 12") == [] and held("wünder 12") == [] and held("ünder 123") == []
    assert dc.passages(index, "so ünder  12, they") == [(1, 3, 12, 0, 1)]
    # one edit in 20 characters wherever it is
    for i in range(20):
        assert held("so " + items[1][1][:i] + "#" + items[1][1][i + 1 :] + " they") == [2]
        assert held("so " + items[5][1][:i] + items[5][1][i + 1 :] + " they") == [6]
    assert held("so twenty charac##rs ab they") == [] and held("an x. Max") == [3] and held("Max") == [] and held("了今天天气很") == [4] and held("a  b") == []
    docs = corpus.createDataFrame([(1, "so ünder  12, they"), (2, "clean"), (3, "say twenty_characters ab twice")], "doc_id long, text string")
    benchmark = corpus.createDataFrame([*items, (7, None), (8, "")], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in dc.contaminated(docs, benchmark).collect()) == [(1, 1), (3, 2)]
    assert [r["doc_id"] for r in dc.clean(docs, benchmark).collect()] == [2]


def test_slices_tell_the_same():
    rng = random.Random(8)
    rule, two = "-" * 400, "=-" * 150
    items = [(0, "-" * 100), (1, rule), (2, two), (3, text(rng, 300)), (4, "ab " * 90)]
    block = dc.build_index(items)
    for body in ("-" * 1500, two + rule + two, edited(rng, "-" * 900, 30), text(rng, 200) + items[3][1] + rule, edited(rng, items[3][1] * 2, 8), "ab " * 400, ""):
        whole = dc.passages(block, body, pairs=1 << 40)
        for pairs in (1, 300, 5_000, 60_000):
            assert dc.passages(block, body, pairs=pairs) == whole
    assert [p[0] for p in dc.passages(block, "-" * 1500)] == [0, 1]


def test_rule_lines_need_bounded_memory():
    block = dc.build_index([(0, "-" * 100)])
    dc.passages(block, "-")  # tables that all texts share
    tracemalloc.start()
    try:
        found = dc.passages(block, "-" * dc.PIECE)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [(i, begin, edits) for i, begin, _, edits, _ in found] == [(0, 0, 0)] and found[0][2] > dc.PIECE - dc.BAND
    assert peak < 300 << 20
