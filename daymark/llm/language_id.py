"""Language of a text from a blended-spectrum string kernel with Nyström landmarks and kernel ridge regression.

A text is the set of its character n-grams of length 1 to 4, hashed to buckets; the kernel of two texts is the number of
buckets both have, over the geometric mean of how many each has. A few labelled texts are landmarks. Scores of all languages
are linear in the kernel values against the landmarks, and those are linear in the presence vector, so a block of
texts is scored by one matrix product: presence (texts x buckets) times weights (buckets x languages).

The classifier is fitted on a bounded sample (``PER_LANGUAGE`` rows of each language, ``MAX_SAMPLE`` in all); everything else, whole
texts of all rows, is scored in the tasks that read them, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.llm.common import blocks, lean

#: Bounds of the fitted sample; texts over MAX_CHARS are left out of the sample only.
PER_LANGUAGE = 300
MAX_SAMPLE = 6000
MAX_CHARS = 100_000
LANDMARKS_PER_LANGUAGE = 64
RIDGE = 1e-3
ORDERS = 4
BUCKET_BITS = 18
UNKNOWN = "und"
SHARPNESS = 4.0

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Code point to its lower-case letter, and to a blank if it is no letter."""
    if not _LETTERS:
        out = np.full(0x110000, 32, dtype=np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _LETTERS.append(out)
    return _LETTERS[0]


def code_points(text: str) -> np.ndarray:
    return letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]


def spectrum(text: str, bits: int = BUCKET_BITS, orders: int = ORDERS, seen: np.ndarray | None = None) -> np.ndarray:
    """Sorted distinct buckets of the text's n-grams; runs of non-letters count as one blank. Empty without letters.

    A long text is walked in pieces that overlap by ``orders - 1`` characters, so memory stays bounded.
    """
    points = code_points(text)
    blank = points == 32
    if blank.all():
        return np.empty(0, dtype=np.int64)
    points = points[~(blank & np.concatenate(([False], blank[:-1])))]
    seen = np.zeros(1 << bits, dtype=bool) if seen is None else seen
    step = 1 << 18
    for start in range(0, len(points), step):
        piece = points[start : start + step + orders - 1].astype(np.uint64)
        hashes = np.zeros(len(piece), dtype=np.uint64)
        for n in range(1, orders + 1):
            if len(piece) < n:
                break
            hashes = (hashes[: len(piece) - n + 1] * np.uint64(0x9E3779B97F4A7C15)) + piece[n - 1 :] + np.uint64(n)
            mixed = hashes * np.uint64(0xD6E8FEB86659FD93)
            seen[(mixed >> np.uint64(64 - bits)).astype(np.int64)] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


@dataclass(frozen=True)
class Model:
    """Languages in alphabetical order; place: bucket to row of weights or -1; weights: rows x languages."""

    languages: tuple[str, ...]
    place: np.ndarray
    weights: np.ndarray
    bits: int
    orders: int


def fit(texts: list[str], labels: list[str], landmarks: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE, bits: int = BUCKET_BITS, orders: int = ORDERS) -> Model:
    """One-versus-rest kernel ridge regression over Nyström features of the landmarks, the first texts of each language."""
    spectra = [spectrum(t, bits, orders) for t in texts]
    rows = [i for i, s in enumerate(spectra) if len(s)]
    languages = tuple(sorted({labels[i] for i in rows}))
    place = np.full(1 << bits, -1, dtype=np.int32)
    if not rows:
        return Model((), place, np.zeros((0, 0), dtype=np.float32), bits, orders)
    taken: dict[str, list[int]] = {}
    for i in rows:
        taken.setdefault(labels[i], []).append(i)
    marks = [i for own in taken.values() for i in own[:landmarks]]
    buckets = np.unique(np.concatenate([spectra[i] for i in marks]))
    place[buckets] = np.arange(len(buckets), dtype=np.int32)

    def presence(which: list[int]) -> np.ndarray:
        out = np.zeros((len(which), len(buckets)), dtype=np.float32)
        for k, i in enumerate(which):
            at = place[spectra[i]]
            out[k, at[at >= 0]] = 1 / np.sqrt(len(spectra[i]))
        return out

    base = presence(marks)
    gram = (base @ base.T).astype(np.float64)
    values, vectors = np.linalg.eigh(gram)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    features = np.concatenate([(presence(rows[k : k + 256]) @ base.T).astype(np.float64) @ root for k in range(0, len(rows), 256)])
    target = np.array([[1.0 if labels[i] == one else -1.0 for one in languages] for i in rows])
    weigh = np.array([len(rows) / (len(languages) * len(taken[labels[i]])) for i in rows])[:, None]
    square = features.T @ (features * weigh) + ridge * len(rows) * np.eye(features.shape[1])
    solved = np.linalg.solve(square, features.T @ (target * weigh))
    return Model(languages, place, (base.T.astype(np.float64) @ (root @ solved)).astype(np.float32), bits, orders)


def predict(model: Model, texts: list[str | None], seen: np.ndarray) -> tuple[list[str], list[float], list[float]]:
    """Language, score and lead of each text, 64 texts to a matrix product.

    The lead is the raw score's distance to the next language's, or to 0 if there is one language only: unlike the score it isn't shared out among
    the languages.
    """
    names, scores, leads = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
    if not model.languages:
        return names, scores, leads
    for start in range(0, len(texts), 64):
        block = [(i, spectrum(t, model.bits, model.orders, seen)) for i, t in enumerate(texts[start : start + 64], start) if t]
        block = [(i, s) for i, s in block if len(s)]
        if not block:
            continue
        present = np.zeros((len(block), len(model.weights)), dtype=np.float32)
        for k, (_, s) in enumerate(block):
            at = model.place[s]
            present[k, at[at >= 0]] = 1
        raw = (present @ model.weights).astype(np.float64) / np.sqrt([[len(s)] for _, s in block])
        shares = np.exp(SHARPNESS * (raw - raw.max(axis=1, keepdims=True)))
        shares /= shares.sum(axis=1, keepdims=True)
        most = np.sort(raw, axis=1)
        ahead = most[:, -1] - (most[:, -2] if len(model.languages) > 1 else 0)
        for (i, _), share, by in zip(block, shares, ahead, strict=True):
            best = int(share.argmax())
            names[i], scores[i], leads[i] = model.languages[best], float(share[best]), float(by)
    return names, scores, leads


def sample(rows: DataFrame, key: Column, text: str, label: str, per_label: int = PER_LANGUAGE, most: int = MAX_SAMPLE) -> list:
    """About ``per_label`` labelled rows of each label, ``most`` in all, chosen by a hash of ``key``: a bounded list in a fixed order.

    The share of rows to take comes from counts of all rows, so no row is moved that isn't taken.
    """
    usable = rows.where(F.col(label).isNotNull() & F.col(text).isNotNull() & (F.length(text) <= MAX_CHARS)).select(F.xxhash64(key).alias("h"), F.col(text).alias("t"), F.col(label).cast("string").alias("l"))
    counts = {r["l"]: r["n"] for r in usable.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(most).collect()}
    each = max(1, min(per_label, most // max(1, len(counts))))
    wanted = [(F.col("l") == name) & (F.col("h") <= min(2**63 - 1, int(-(2**63) + min(1.0, each / n) * (2**64 - 1)))) for name, n in counts.items()]
    if not wanted:
        return []
    some = wanted[0]
    for one in wanted[1:]:
        some = some | one
    # twice the bound is far outside of what the hash lets through; ties of repeated rows are cut here
    return sorted(usable.where(some).limit(2 * most).collect(), key=lambda r: (r["h"], r["t"]))


def identify(docs: DataFrame, model: Model, text: str = "text", language: str = "lang_pred", score: str = "score", lead: str | None = None) -> DataFrame:
    """All rows and columns with ``language`` and ``score`` (0 to 1), and ``lead`` if it is named, which replace columns of these names.

    ``und`` and 0 for a null text, an empty one, one without letters, and for all if the model learned nothing. Other texts get a
    learned language, of equal scores the alphabetically first. Whole texts count, however long. Repeated rows get equal answers.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    numbers = [score, *([lead] if lead else [])]
    docs = docs.drop(language, *numbers)
    schema = T.StructType([*docs.schema.fields, T.StructField(language, T.StringType()), *[T.StructField(n, T.DoubleType()) for n in numbers]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = held.value
        seen = np.zeros(1 << fitted.bits, dtype=bool)
        for block in blocks(batches, text):
            names, *told = predict(fitted, block.column(block.schema.get_field_index(text)).to_pylist(), seen)
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(names, pa.string()), *[pa.array(x, pa.float64()) for x in told[: len(numbers)]]], names=[*block.schema.names, language, *numbers])

    return docs.mapInArrow(lean(run), schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from: CRC-32 of the id as text leaves 1 when divided by 3."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang") -> Model:
    """A model of the rows that aren't held out."""
    rows = sample(docs.where(~held_out(doc_id)), F.col(doc_id), text, label)
    return fit([r["t"] for r in rows], [r["l"] for r in rows])
