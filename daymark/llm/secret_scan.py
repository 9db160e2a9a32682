"""Secrets in texts: patterns, and a battery of randomness tests over unbroken runs of encoded characters.

A candidate is a piece of at least 20 characters, outside of any pattern match, of a run of characters of the base64 and URL alphabets. What
joins words in paths and names ('/', '+', '-', '_') is also a symbol of these alphabets, so a run is cut in every way that leaves one encoding: at
all four, at all but one, at all but those of base64 and at all but those of base64url; the longest pieces between the cuts are candidates,
the run as a whole among them if it fits. The smallest alphabet that holds a candidate's characters is taken for its encoding. Three tests ask whether its symbols look drawn evenly and independently from that
alphabet: chi-squared over symbol classes, Wald-Wolfowitz runs above and below the middle, and lag-one serial correlation; Fisher's
method joins them. A candidate that they reject as random is dropped.

The others still have to be improbable as ordinary text. How symbols follow each other in ordinary text is counted over all texts, candidates and matches left out; under that
chain the likelihood ratio of "random" to "ordinary" has mean 1, so its inverse is a valid p-value, and a long run can reach a far smaller one
than a short run. Benjamini-Hochberg within each length class, over a histogram of p-values of all texts, sets the threshold. Every
candidate counts as a test, but of those of a class that overlap only the most improbable counts as a find; of found candidates that overlap
the longest is reported. A token that holds '-' behind words joined by '-' (and so for each of the four) is judged together with
them and in its own pieces, not by itself.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.llm.common import blocks, kept

#: Fixed patterns; a match that fails its length is dropped after it has taken its place.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")

SHORTEST = 20
RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
#: Pieces of a run that fit one encoding, by the separators that they may hold.
PIECES = tuple(re.compile(rf"[A-Za-z0-9{held}]{{20,}}") for held in ("+/", "_-", "+", "/", "_", "-", ""))
_JOINED = re.compile(r"[+/_-]")
#: Lengths at which a new class of candidates begins.
CLASSES = (20, 32, 48, 96)
#: Share of false finds among finds, per length class.
FALSE_SHARE = 0.01
#: Below this the battery rejects a candidate as not random.
EVEN = 0.01
#: Bins of -log10(p) in the histogram.
BINS, PER_UNIT = 400, 10

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_INDEX = np.full(128, -1, dtype=np.int64)
for _i, _c in enumerate(SYMBOLS):
    _INDEX[ord(_c)] = _i
_INDEX[ord("-")], _INDEX[ord("_")] = 62, 63

#: Encodings from the smallest alphabet to the largest, symbols in the order of their values.
ENCODINGS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "hex upper": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base36 upper": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": SYMBOLS,
    "base64url": SYMBOLS[:62] + "-_",
}
_SETS = {name: frozenset(symbols) for name, symbols in ENCODINGS.items()}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Pattern matches as (start, kind, end), by start and then kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Pieces of runs of encoded characters that touch no pattern match, decimal numbers left out, by start; and what they leave out of ordinary text, in runs or parts of runs."""
    out, apart, at, reach = [], [], 0, 0
    for m in RUN.finditer(text):
        start, end = m.span()
        near = []  # matches that touch this run, apart and in order
        if reach > start:
            near.append((start, reach))
        while at < len(taken) and taken[at][0] < end:
            a, b = taken[at][0], taken[at][2]
            if b > max(reach, start):
                near.append((max(a, reach), b))
                reach = b
            at += 1
        whole = [(start, end)] if not near else []
        pieces = {p.span() for own in PIECES for p in own.finditer(text, start, end)} if _JOINED.search(m[0]) else whole
        begins = [a for a, _ in near]
        own = []
        for a, b in sorted(pieces):
            k = bisect_left(begins, b)
            if not (k and near[k - 1][1] > a) and not text[a:b].isdigit():
                own.append((a, b))
        out += own
        if not near:
            apart += whole if not m[0].isdigit() else []
        else:
            to = 0
            for a, b in own:
                if b > to:
                    apart.append((max(a, to), b))
                    to = b
    return out, apart


def encoding(token: str) -> str | None:
    have = frozenset(token)
    return next((name for name, symbols in _SETS.items() if have <= symbols), None)


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_squared_tail(x: float, degrees: int) -> float:
    """Upper tail by the cube-root normal approximation."""
    if x <= 0:
        return 1.0
    spread = 2 / (9 * degrees)
    return _normal_tail(((x / degrees) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))


def battery(token: str, name: str) -> float:
    """Joint p-value of the hypothesis that the token's symbols are random in its alphabet."""
    alphabet = ENCODINGS[name]
    values = np.array([alphabet.index(c) for c in token])
    n, size = len(values), len(alphabet)
    cells = max(2, min(size, n // 5))
    # symbols in equal classes, or in classes whose expected counts follow their sizes
    counts = np.bincount(values * cells // size, minlength=cells)
    expected = n * np.bincount(np.arange(size) * cells // size, minlength=cells) / size
    even = chi_squared_tail(float(((counts - expected) ** 2 / expected).sum()), cells - 1)
    high = values >= size / 2
    n1, n2 = int(high.sum()), int(n - high.sum())
    if n1 and n2:
        mean, changes = 2 * n1 * n2 / n + 1, 1 + int((high[1:] != high[:-1]).sum())
        variance = (mean - 1) * (mean - 2) / (n - 1)
        runs = 2 * _normal_tail(abs(changes - mean) / math.sqrt(variance)) if variance > 0 else 1.0
    else:
        runs = 2.0 ** (1 - n)
    centred = values - values.mean()
    square = float((centred**2).sum())
    serial = 2 * _normal_tail(abs(float((centred[1:] * centred[:-1]).sum()) / square + 1 / n) * math.sqrt(n)) if square else 0.0
    return chi_squared_tail(-2 * sum(math.log(max(p, 1e-300)) for p in (even, runs, serial)), 6)


def surprise(token: str, size: int, follows: np.ndarray) -> float:
    """-log10 of the p-value under the chain of ordinary text, whose logarithms base 10 ``follows`` holds."""
    at = _INDEX[np.frombuffer(token.encode(), dtype=np.uint8)]
    return max(0.0, float(-follows[at[:-1], at[1:]].sum()) - (len(token) - 1) * math.log10(size))


def pair_counts(text: str) -> np.ndarray:
    """How often each symbol follows each other one in a text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    at = np.where(points < 128, _INDEX[np.minimum(points, 127)], -1)
    both = (at[1:] >= 0) & (at[:-1] >= 0)
    return np.bincount(at[:-1][both] * 64 + at[1:][both], minlength=4096)


def settled(pieces: list[dict], *order: str) -> list[dict]:
    """Pieces that don't overlap, taken as far as they are free: the largest by ``order`` (of ``p`` and ``length``) first, of equals the first in the text."""
    out, starts, ends = [], [], []
    size = {"p": lambda x: -x["p"], "length": lambda x: x["start"] - x["end"]}
    for x in sorted(pieces, key=lambda x: (*[size[o](x) for o in order], x["start"])):
        k = bisect_left(starts, x["end"])
        if not (k and ends[k - 1] > x["start"]):
            starts.insert(k, x["start"])
            ends.insert(k, x["end"])
            out.append(x)
    return out


def length_class(length) -> int:
    return sum(length >= c for c in CLASSES) - 1


SPAN = "array<struct<start:long,kind:int,end:long>>"
TOKEN = "array<struct<start:long,end:long,token:string>>"
SCORED = "array<struct<start:long,end:long,bin:int,class:int,p:double,told:int>>"


def scan(docs: DataFrame, doc_id: str, text: str, false_share: float = FALSE_SHARE) -> DataFrame:
    """Per row its id as ``doc_id``, ``base`` (pattern matches) and ``found`` (random runs), as arrays of positions in code points.

    Whole texts count. A null or empty text has none. Every row is answered, repeated rows and null ids too; other columns
    are left aside. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    first = T.StructType([T.StructField("doc_id", id_type), *_fields(f"base {SPAN}, tokens {TOKEN}, pairs array<long>")])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(4096, dtype=np.int64)
        kind = None
        for block in blocks(batches, "text"):
            kind = block.schema.field("doc_id").type
            base, tokens = [], []
            for t in block.column(block.schema.get_field_index("text")).to_pylist():
                t = t or ""
                spans = base_spans(t)
                base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
                runs, apart = candidates(t, spans)
                tokens.append([{"start": a, "end": b, "token": t[a:b]} for a, b in runs])
                pairs += pair_counts(t)
                for a, b in [*apart, *[(a, b) for a, _, b in spans]]:
                    pairs -= pair_counts(t[a:b])
            yield pa.RecordBatch.from_arrays([block.column(block.schema.get_field_index("doc_id")), pa.array(base, _SPANS), pa.array(tokens, _TOKENS), pa.nulls(len(base), pa.list_(pa.int64()))], names=["doc_id", "base", "tokens", "pairs"])
        if kind is not None:  # one more row for the counts of this task
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, _SPANS), pa.nulls(1, _TOKENS), pa.array([pairs.tolist()], pa.list_(pa.int64()))], names=["doc_id", "base", "tokens", "pairs"])

    seen = kept(rows.mapInArrow(look, first), "secret-candidates")
    totals = seen.where(F.col("pairs").isNotNull()).select(F.posexplode("pairs")).groupBy("pos").agg(F.sum("col").alias("n"))
    counts = np.ones(4096)
    for r in totals.collect():  # 4,096 sums at any size
        counts[r["pos"]] += max(0, r["n"])  # overlapping matches are taken off twice
    chain = counts.reshape(64, 64)
    held = spark.sparkContext.broadcast(np.log10(chain / chain.sum(axis=1, keepdims=True)))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        follows = held.value
        for batch in batches:
            scored = []
            for tokens in batch.column(batch.schema.get_field_index("tokens")).to_pylist():
                own = []
                for x in tokens:
                    name = encoding(x["token"])
                    p = surprise(x["token"], len(ENCODINGS[name]), follows) if battery(x["token"], name) >= EVEN else 0.0
                    own.append({"start": x["start"], "end": x["end"], "bin": min(BINS, int(p * PER_UNIT)), "class": length_class(len(x["token"])), "p": p, "told": 0})
                for c in range(len(CLASSES)):  # a find counts once in its class, a test each time
                    for x in settled([x for x in own if x["class"] == c], "p", "length"):
                        x["told"] = x["bin"]
                scored.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scored, _SCORED)], names=["doc_id", "base", "scored"])

    second = T.StructType([first["doc_id"], first["base"], *_fields(f"scored {SCORED}")])
    judged = kept(seen.where(F.col("pairs").isNull()).select("doc_id", "base", "tokens").mapInArrow(judge, second), "secret-scores")
    histogram = judged.select(F.inline("scored")).groupBy("class", F.col("told").alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most len(CLASSES) * (BINS + 1) rows
    least = thresholds({(r["class"], r["bin"]): r["n"] for r in histogram}, false_share)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for scored in batch.column(2).to_pylist():
                passed = settled([x for x in scored if x["bin"] >= least[x["class"]]], "length", "p")
                found.append([{"start": x["start"], "kind": 3, "end": x["end"]} for x in sorted(passed, key=lambda x: x["start"])])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, _SPANS)], names=["doc_id", "base", "found"])

    return judged.mapInArrow(settle, T.StructType([first["doc_id"], first["base"], *_fields(f"found {SPAN}")]))


def thresholds(histogram: dict[tuple[int, int], int], false_share: float = FALSE_SHARE) -> list[int]:
    """Per length class the least bin that Benjamini-Hochberg lets through; a bin's p-value is its largest."""
    out = []
    for c in range(len(CLASSES)):
        total = sum(n for (k, _), n in histogram.items() if k == c)
        least, above = BINS + 1, 0
        for b in range(BINS, 0, -1):
            above += histogram.get((c, b), 0)
            if above and 10 ** (-b / PER_UNIT) * total <= false_share * above:
                least = b
        out.append(least)
    return out


def _fields(text: str) -> list[T.StructField]:
    return T.StructType.fromDDL(text).fields


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_TOKENS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("token", pa.string())]))
_SCORED = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("bin", pa.int32()), ("class", pa.int32()), ("p", pa.float64()), ("told", pa.int32())]))


def report(found: DataFrame) -> DataFrame:
    """Counts of each kind and all spans as text, from what ``scan`` returns."""
    names = F.array(*[F.lit(k) for k in KINDS])
    written = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.size("found").cast("long").alias("n_random"),
        F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"), written(F.array_sort(F.concat("base", "found"))).alias("spans"),
    )
