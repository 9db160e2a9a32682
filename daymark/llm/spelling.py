"""Spelling variants: words one inserted, deleted or replaced character apart, grouped under their most frequent form.

Two words of m and m or m - 1 characters differ by a single edit if and only if their common prefix and common suffix together reach m - 1. Then one of both has
at least m // 2 characters, so only words that share their first or their last m // 2 need to be compared: every word stands in four
groups. Groups are cut into tiles; in a tile the words of two blocks are padded matrices of code points, one aligned left and one aligned right, and prefix
and suffix lengths of all pairs come from comparing column by column. A tile returns counts and the best near word for each word, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import kept
from daymark.operators.joins import join_splitting

#: Words of a block at most, characters of a block about.
BLOCK, BLOCK_CHARS = 1024, 1 << 21
#: Small groups are compared side by side in tiles of so many words.
TILE = 256
#: Rows of a task, about.
TASK_ROWS = 16384
#: Side of the words of a group that is one tile.
WHOLE = 2
RUN = "([A-Za-zÀ-ÿ]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_slips(run: Column, key: Column, one_in: int) -> Column:
    """A run with a character dropped where the hash of key and run says so: a stated share of slips of the pen."""
    h = F.crc32(F.encode(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run), "UTF-8"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def words(docs: DataFrame, text: str = "text", key: str = "doc_id", least_length: int = 6, least: int = 5, slip_one_in: int | None = 199) -> DataFrame:
    """``word`` and ``n`` (occurrences in all texts) of the words with at least ``least_length`` characters and ``least`` occurrences.

    Words are maximal runs of Latin letters, A to Z lower-cased. Runs are counted in the tasks before anything is shuffled.
    """
    runs = docs.select(F.col(key).alias("key"), F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(1))).alias("run"))
    lower = runs.select("key", F.translate("run", UPPER, LOWER).alias("run"))
    word = with_slips(F.col("run"), F.col("key"), slip_one_in) if slip_one_in else F.col("run")
    long_enough = lower.select(word.alias("word")).where(F.length("word") >= least_length)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common beginnings of all rows of two matrices of code points."""
    out = np.zeros((len(a), len(b)), dtype=np.int32)
    alive = np.ones((len(a), len(b)), dtype=bool)
    for c in range(a.shape[1]):
        alive &= a[:, c, None] == b[None, :, c]
        if not alive.any():
            break
        out += alive
    return out


class Block:
    """Words of m and m - 1 characters as matrices of m columns."""

    def __init__(self, words: list[str], m: int):
        self.long = np.array([len(w) == m for w in words])
        points = np.frombuffer("".join(w.ljust(m, "\0") + w.rjust(m, "\0") for w in words).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(words), 2, m)
        self.left, self.right = points[:, 0], points[:, 1, ::-1]


def near_in(a: Block, b: Block, m: int, suffix: bool, same_group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) one edit apart, where the row of ``a`` has m characters. With ``suffix`` pairs with m // 2 first characters in common are left to the
    group of that prefix."""
    prefix = shared(a.left, b.left)
    near = prefix + shared(a.right, b.right) >= m - 1
    near &= a.long[:, None]
    # a word is no neighbour of itself
    near &= ~((prefix == m) & b.long[None])
    if suffix:
        near &= prefix < m // 2
    if same_group is not None:
        near &= same_group
    return np.nonzero(near)


def _tiles(frame: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Rows of both sides of the tiles of one kind and length, the small groups of a tile told apart by a mask."""
    group = frame.groupby(["affix", "i", "j"], sort=False).ngroup().to_numpy()
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    packed: list[np.ndarray] = []
    size = 0
    side = frame["side"].to_numpy()
    for rows in np.split(order, cuts):
        if side[rows[0]] != WHOLE:  # a tile of a large group
            if len(set(side[rows])) == 2:
                yield rows[side[rows] == 0], rows[side[rows] == 1], None
        elif len(rows) > 1:
            if packed and size + len(rows) > TILE:
                together = np.concatenate(packed)
                yield together, together, group[together][:, None] == group[together][None]
                packed, size = [], 0
            packed.append(rows)
            size += len(rows)
    if packed:
        together = np.concatenate(packed)
        yield together, together, group[together][:, None] == group[together][None]


def _compare(frame: pd.DataFrame) -> pd.DataFrame:
    """Of all tiles of a task: for each word how many near words they hold, and the best of them."""
    word, n = frame["word"].to_numpy(), frame["n"].to_numpy()
    source, target = [], []
    for (suffix, m), at in frame.groupby(["suffix", "m"]).indices.items():
        for a, b, mask in _tiles(frame.iloc[at]):
            left = Block(list(word[at[a]]), m)
            right = left if a is b else Block(list(word[at[b]]), m)
            i, j = near_in(left, right, m, bool(suffix), mask)
            short = ~right.long[j]
            source += [at[a[i]], at[b[j[short]]]]
            target += [at[b[j]], at[a[i[short]]]]
    s = np.concatenate(source) if source else np.zeros(0, dtype=np.int64)
    t = np.concatenate(target) if target else np.zeros(0, dtype=np.int64)
    edges = pd.DataFrame({"word": word[s], "near": word[t], "near_n": n[t]})
    best = edges.sort_values(["word", "near_n", "near"], ascending=[True, False, True]).drop_duplicates("word")
    counts = edges.groupby("word").size()
    return best.assign(n_near=counts.loc[best["word"]].to_numpy() if len(best) else np.zeros(0, dtype=np.int64))[["word", "n_near", "near", "near_n"]]


def near_words(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n_near, near, near_n`` of the words (column ``word``, each once, none empty, with ``n``) that have near words: how many, and the one of largest ``n``,
    of equal ones the first in code-point order."""
    length = F.length("word")
    keys = F.array(*[F.struct(F.lit(suffix).alias("suffix"), m.cast("int").alias("m"), affix.alias("affix")) for m in (length, length + 1) for suffix, affix in ((0, F.left(F.col("word"), F.floor(m / 2).cast("int"))), (1, F.right(F.col("word"), F.floor(m / 2).cast("int"))))])
    key = ["suffix", "m", "affix"]
    members = vocabulary.select("word", "n", F.explode(keys).alias("key")).select("key.*", "word", "n")
    sizes = members.groupBy(*key).agg(F.count(F.lit(1)).alias("members"), F.sum((F.length("word") == F.col("m")).cast("int")).alias("full"))
    # a group of one word, or without a word of the full length, holds no pair of its own
    worth = sizes.where((F.col("members") > 1) & (F.col("full") > 0))
    parts = F.greatest(F.ceil(F.col("members") / block), F.ceil(F.col("members") * F.col("m") / BLOCK_CHARS)).cast("int")
    told = kept(join_splitting(members, worth.select(*key, parts.alias("parts")), key, "inner"), "affix-groups")

    mine = F.pmod(F.xxhash64(F.lit("tile"), "word"), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    small = told.where("parts = 1").select(*key, "word", "n", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(WHOLE).alias("side"))
    large = told.where("parts > 1")
    rows = large.where(F.length("word") == F.col("m")).select(*key, "word", "n", mine.alias("i"), F.explode(every).alias("j"), F.lit(0).alias("side"))
    columns = large.select(*key, "word", "n", F.explode(every).alias("i"), mine.alias("j"), F.lit(1).alias("side"))
    tiles = small.unionByName(rows).unionByName(columns)

    weight = told.agg(F.coalesce(F.sum(F.col("parts")), F.lit(0)), F.coalesce(F.sum(F.col("parts") * F.col("m")), F.lit(0))).collect()[0]
    tasks = max(1, -(-int(weight[0]) // TASK_ROWS), -(-int(weight[1]) // BLOCK_CHARS))
    dealt = tiles.withColumn("task", F.pmod(F.xxhash64(*key, "i", "j"), F.lit(tasks)))
    found = dealt.repartition(tasks, "task").groupBy("task").applyInPandas(_compare, "word string, n_near long, near string, near_n long")
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    return summed.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def variants(vocabulary: DataFrame, factor: int = 5, block: int = BLOCK) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``vocabulary`` (``word``, ``n``).

    ``n_near`` counts the words one edit away; ``form`` is the one of largest ``n`` (ties: the first in code-point order) if that is at least ``factor``
    times the word's own, else null; ``root`` is where following forms ends, the word itself if it has none. Null and empty words go, repeated rows of a word are
    summed. Further columns are not looked at; an empty table gives an empty result.
    """
    vocabulary = kept(vocabulary.where(F.length("word") > 0).groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    near = near_words(vocabulary, block)
    frequent = F.col("near_n") >= factor * F.col("n")
    formed = kept(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, F.col("near")).alias("form"), F.when(frequent, F.col("near_n")).alias("form_n")
        ),
        "forms",
    )
    rooted = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        # n grows along forms by the factor, so doubling steps end after a few rounds
        rooted = kept(rooted, "roots")
        further = rooted.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = join_splitting(rooted, further, ["root"])
        if moved.where(F.col("next").isNotNull()).isEmpty():
            break
        rooted = moved.select("word", F.coalesce("next", "root").alias("root"))
    return formed.join(rooted, "word", "left").withColumn("root", F.coalesce("root", "word")).select("word", "n", "n_near", "form", "form_n", "root")


def digest(docs: DataFrame) -> DataFrame:
    """The query: words of at least 6 characters and 5 occurrences, one occurrence in 199 with a slip. Null texts have no words; a null id counts as empty text."""
    return variants(words(docs))


#: The four groups don't appear here: near words share what is left after one character is taken out of either or both. The checksum is worked out byte by byte.
SQL = r"""
WITH RECURSIVE crc AS (
    SELECT list(c ORDER BY b) AS t FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS b))
), runs AS (
    SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS r FROM documents)
    GROUP BY ALL
), marked AS (
    SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
    FROM marked, crc
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cut AS (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word
), formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
           CASE WHEN b.other_n >= 5 * w.n THEN b.other END AS form, CASE WHEN b.other_n >= 5 * w.n THEN b.other_n END AS form_n
    FROM words w LEFT JOIN best b USING (word)
), walk AS (
    SELECT word, word AS reached, 0 AS step FROM formed
    UNION ALL SELECT walk.word, formed.form, step + 1 FROM walk JOIN formed ON walk.reached = formed.word WHERE formed.form IS NOT NULL
), last AS (SELECT word, arg_max(reached, step) AS root FROM walk GROUP BY word)
SELECT word, n, n_near, form, form_n, root FROM formed JOIN last USING (word)
"""
