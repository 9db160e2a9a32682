from pyspark.sql import functions as F

from daymark.llm.line_dedup import drop_boilerplate_lines


def brute(pages, ratio, least):
    site = {}
    for i, (_, host, text) in enumerate(pages):
        site.setdefault(host, []).append(i)
    out = []
    for _, (d, host, text) in enumerate(pages):
        lines = [] if text is None else text.split("\n")
        carry = lambda x: sum(x in {y.strip(" \t\r") for y in (pages[i][2] or "").split("\n")} for i in site[host])  # noqa: B023, E731
        common = {x for x in (y.strip(" \t\r") for y in lines) if x and carry(x) >= least and carry(x) > ratio * len(site[host])}
        left = [y for y in lines if y.strip(" \t\r") not in common]
        gone = any(y.strip(" \t\r") for y in left)
        out.append((d, host, "\n".join(left) if gone else text, len(lines), len(lines) - len(left) if gone else 0))
    return sorted(out, key=repr)


PAGES = [
    *[(i, "a", f"menu\nown {i}\n\n  menu\t\nfoot é\r\n{'x' * 3000 if i == 3 else ''}") for i in range(8)],
    (8, "a", "menu\nfoot é"), (9, "a", None), (10, "a", ""), (11, "a", "\n\n"), (12, "b", "menu\nother"), (13, "", "menu\nq"), (14, None, "menu\nnull host"), (15, None, "menu\nnull host too"),
    (1, "a", "menu\nown 1\n\n  menu\t\nfoot é\r\n"), (16, "a", "own 1\nown 2"),
]


def test_against_brute_force(corpus, rows_of, plan):
    frame = corpus.createDataFrame([(*p, "extra", 5) for p in PAGES], "doc_id long, source string, text string, pages string, n long")
    for ratio, least in ((0.3, 2), (0.1, 1), (0.1, 2), (0.9, 1)):
        got = drop_boilerplate_lines(frame, F.col("source"), max_ratio=ratio, min_pages=least)
        assert got.columns == ["doc_id", "source", "text", "pages", "n", "n_lines", "n_dropped"]
        assert rows_of(got, "doc_id", "source", "text", "n_lines", "n_dropped") == brute(PAGES, ratio, least)
    text = plan(got)
    assert not any(x in text for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_empty_and_without_counts(corpus):
    frame = corpus.createDataFrame([], "doc_id long, source string, text string")
    assert drop_boilerplate_lines(frame, F.col("source")).count() == 0
    assert drop_boilerplate_lines(frame, F.col("source"), counts=False).columns == frame.columns
