"""Passages of a benchmark in documents, with a few edits: q-gram filter in diagonal bands, then banded alignment.

Each benchmark item is cut into windows that overlap. If a document holds a window with at most k edits, the two share at least
w + 1 - q (k + 1) q-grams (the q-gram lemma), all within k + 1 neighbouring diagonals, a diagonal being the place in the document less the
place in the item. Bands of diagonals overlap by k, so one band holds them all. Shared q-grams are counted per document, item and band; a window that
meets its bound is aligned with that part of the document within the band. Nothing that the definition asks for is lost, and
nothing else is reported. Texts are compared with case folded and runs of blanks as one space. Where a window is too short for its edits to leave
a q-gram whole, q is smaller; items under q characters that have no edits are looked up whole, between word boundaries.

The benchmark is the stated query set: it is cut into blocks of bounded size, each block's q-gram index goes to all tasks, and all documents pass by
each block in the tasks that read them. No document is moved.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from daymark.llm.common import blocks, lean

GRAM = 12
WINDOW = 100
STEP = 20
ERROR_RATE = 0.05
#: Characters of benchmark text that one index holds; more text makes more blocks.
INDEX_CHARS = 4_000_000
#: Diagonals that a band holds besides the overlap.
BAND = 16
#: Characters of a document that are looked at together, and of the filter table (bits of the hash).
PIECE = 1 << 18
TABLE_BITS = 22
#: Shared q-grams (place in the document, place in an item) that are held together.
PAIRS = 1 << 20
#: Cells of the alignments that are worked out together.
CELLS = 1 << 20

_FOLDS: list = []


def folds() -> tuple[np.ndarray, np.ndarray, dict[int, list[int]], np.ndarray]:
    """By code point: what it folds to (a blank to a space), how many code points that are, these if several, and whether words are made of it."""
    if not _FOLDS:
        one, many = np.arange(0x110000, dtype=np.uint32), np.ones(0x110000, dtype=np.uint8)
        wide, word = {}, np.zeros(0x110000, dtype=bool)
        for c in range(0x110000):
            s = chr(c)
            if s.isspace():
                one[c] = 32
                continue
            word[c] = s.isalnum()
            low = s.upper().casefold()  # upper first, as ı and i have one capital
            if len(low) == 1:
                one[c] = ord(low)
            else:
                many[c], wide[c] = len(low), [ord(x) for x in low]
        for a, b in ((0x0E00, 0x10A0), (0x1780, 0x1800), (0x2E80, 0xD800), (0xF900, 0xFB00), (0xFF66, 0xFFDD), (0x20000, 0x110000)):
            word[a:b] = False  # scripts that don't part words, or join particles to them
        _FOLDS.append((one, many, wide, word))
    return _FOLDS[0]


def folded(text: str, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Code points with case folded and every run of blanks as one space; and if asked for, the place in the text of each."""
    one, many, wide, _ = folds()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    out, at = one[points], np.arange(len(points)) if places else None
    size = many[points]
    if (size != 1).any():
        out = np.repeat(out, size)
        first = np.cumsum(size, dtype=np.int64) - size
        for k in np.flatnonzero(size != 1):
            out[first[k] : first[k] + size[k]] = wide[int(points[k])]
        at = np.repeat(at, size) if places else None
    blank = out == 32
    again = blank[1:] & blank[:-1]
    if again.any():
        keep = np.concatenate(([True], ~again))
        out, at = out[keep], at[keep] if places else None
    return out, at


def plain(text: str) -> np.ndarray:
    """The code points of ``folded``."""
    return folded(text)[0]


def item_points(text: str) -> np.ndarray:
    """``plain`` without blanks at the ends, which are no part of a passage."""
    points = plain(text)
    inner = np.flatnonzero(points != 32)
    return points[inner[0] : inner[-1] + 1] if len(inner) else points[:0]


def gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every run of q code points."""
    n = len(points) - q + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    wide = points.astype(np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(q):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += wide[i : i + n]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xD6E8FEB86659FD93)


def gram(length: int, q: int = GRAM, rate: float = ERROR_RATE) -> int:
    """The largest size up to q of which the edits allowed in ``length`` characters leave one gram whole at least."""
    return max(1, min(q, length // (int(rate * length) + 1)))


def budget(length: int, q: int = GRAM, rate: float = ERROR_RATE) -> tuple[int, int]:
    """Edits allowed in a window of ``length`` characters and the grams, of the size that ``gram`` tells, that must be shared."""
    edits = int(rate * length)
    return edits, length + 1 - gram(length, q, rate) * (edits + 1)


@dataclass(frozen=True)
class Index:
    """q-grams of items, sorted by hash, with their places in the row of all items (``at``), and the items' windows; ``items`` are their numbers in the block."""

    items: list[int]
    texts: list[np.ndarray]
    hashes: np.ndarray
    item_of: np.ndarray
    place_of: np.ndarray
    at: np.ndarray
    table: np.ndarray
    windows: list[list[tuple[int, int, int, int]]]
    least: np.ndarray
    overlap: int
    q: int
    reach: int


@dataclass(frozen=True)
class Block:
    """A block of items: an index for each size of gram, and by length the hashes of items that are looked up whole, their numbers and texts."""

    ids: list
    parts: list[Index]
    whole: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def build_index(items: list[tuple[object, str]], q: int = GRAM, window: int = WINDOW, step: int = STEP, rate: float = ERROR_RATE) -> Block:
    """Items of blanks only are in no index."""
    texts = [item_points(t) for _, t in items]
    parts: dict[int, list[int]] = {}
    whole: dict[int, list[int]] = {}
    for i, t in enumerate(texts):
        length = min(len(t), window)
        if 0 < len(t) < q and not int(rate * length):
            whole.setdefault(len(t), []).append(i)
        elif length:
            parts.setdefault(gram(length, q, rate), []).append(i)
    short = {}
    for n, own in sorted(whole.items()):
        rows = np.stack([texts[i] for i in own])
        hashes = np.concatenate([gram_hashes(t, n) for t in rows])
        order = np.argsort(hashes, kind="stable")
        short[n] = (hashes[order], np.array(own)[order], rows[order])
    return Block([i for i, _ in items], [_part(own, [texts[i] for i in own], size, window, step, rate) for size, own in sorted(parts.items())], short)


def _part(items: list[int], texts: list[np.ndarray], q: int, window: int, step: int, rate: float) -> Index:
    """``windows`` of an item: begin, length, edits, shared q-grams."""
    each = [gram_hashes(t, q) for t in texts]
    hashes = np.concatenate([*each, np.empty(0, dtype=np.uint64)])
    item_of = np.repeat(np.arange(len(items)), [len(h) for h in each]).astype(np.int64)
    place_of = np.concatenate([*[np.arange(len(h)) for h in each], np.empty(0, dtype=np.int64)]).astype(np.int64)
    order = np.argsort(hashes, kind="stable")
    table = np.zeros(1 << TABLE_BITS, dtype=bool)
    table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
    windows = []
    for t in texts:
        n = len(t)
        length = min(n, window)
        begins = sorted({*range(0, n - length, step), n - length})
        windows.append([(b, length, *budget(length, q, rate)) for b in begins])
    least = np.array([min((w[3] for w in own), default=1 << 30) for own in windows])
    overlap = max((w[2] for own in windows for w in own), default=0)
    return Index(items, texts, hashes[order], item_of[order], place_of[order], order, table, windows, least, overlap, q, 2 * window + 2 * BAND)


def shared_grams(index: Index, points: np.ndarray, pairs: int = PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Item, place in the item and place in the document of shared q-grams, in slices of about ``pairs``.

    Texts of few different grams, such as rules of dashes, share each with very many places. Slices of the document overlap by the reach of
    a window, and where one is too rich at any width, slices of the items do so too, so each window stands in one of them with all its grams.
    """
    hashes = gram_hashes(points, index.q)
    places = np.flatnonzero(index.table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
    low = np.searchsorted(index.hashes, hashes[places], "left")
    count = np.searchsorted(index.hashes, hashes[places], "right") - low
    places, low, count = places[count > 0], low[count > 0], count[count > 0]
    start = 0
    while start < len(places):
        # grams up to the next start and those within reach of them
        full = start + max(1, int(np.searchsorted(np.cumsum(count[start : start + pairs]), pairs, "right")))
        stop = int(np.searchsorted(places, places[full - 1] + 1 - index.reach, "left"))
        if full >= len(places):
            stop = full = len(places)
        elif stop <= start or places[stop] - places[start] < index.reach:
            stop = int(np.searchsorted(places, places[start] + index.reach, "left"))
            full = int(np.searchsorted(places, places[start] + 2 * index.reach, "left"))
        own = slice(start, full)
        if int(count[own].sum()) <= pairs:
            yield _expanded(index, places[own], low[own], count[own])
        else:
            wide = max(index.reach, pairs // (2 * index.reach))
            for g in range(0, len(index.hashes), wide):
                # occurrences of a gram stand by their place in the block
                a, c = _within(index, low[own], count[own], g, g + wide + index.reach)
                yield _expanded(index, places[own], a, c)
        start = stop


def _within(index: Index, low: np.ndarray, count: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of each run of the index whose places in the block are in [begin, end)."""
    runs, back = np.unique(np.stack([low, low + count]), axis=1, return_inverse=True)
    edges = np.array([[a + np.searchsorted(index.at[a:b], begin), a + np.searchsorted(index.at[a:b], end)] for a, b in runs.T])[back.ravel()]
    return edges[:, 0], edges[:, 1] - edges[:, 0]


def _expanded(index: Index, places: np.ndarray, low: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    total = int(count.sum())
    at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(total)
    return index.item_of[at], index.place_of[at], np.repeat(places, count)


def candidate_windows(index: Index, points: np.ndarray, pairs: int = PAIRS) -> Iterator[list[tuple[int, int, int, int, int, int]]]:
    """Item, begin, length, edits, first diagonal of the band, shared q-grams, for all windows that meet their bound in a band; a list per slice.

    A window that stands in two slices is told by both, with all its grams by one at least.
    """
    for item, place, there in shared_grams(index, points, pairs):
        if len(item):
            yield _banded(index, item, place, there)


def _banded(index: Index, item: np.ndarray, place: np.ndarray, there: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    # bands begin every BAND diagonals and hold BAND + overlap of them, the overlap being the most edits that any window may have
    overlap = index.overlap
    diagonal = there - place
    first = np.floor_divide(diagonal, BAND)
    keys = [np.stack([item, first, place])]
    for back in range(1, -(-overlap // BAND) + 1):
        also = diagonal - (first - back) * BAND < BAND + overlap
        keys.append(np.stack([item[also], first[also] - back, place[also]]))
    item, band, place = np.concatenate(keys, axis=1)
    least, wide, long = int(band.min()), int(band.max() - band.min()) + 1, int(place.max()) + 1
    if (int(item.max()) + 1) * wide * long < 1 << 63:
        # item, band and place as one number, which sorts faster
        rest, place = np.divmod(np.sort((item * wide + (band - least)) * long + place), long)
        item, band = np.divmod(rest, wide)
        band += least
    else:
        order = np.lexsort((place, band, item))
        item, band, place = item[order], band[order], place[order]
    edge = np.flatnonzero((np.diff(item) != 0) | (np.diff(band) != 0)) + 1
    begins, ends = np.concatenate(([0], edge)), np.concatenate((edge, [len(item)]))
    enough = ends - begins >= index.least[item[begins]]
    out = []
    for a, b in zip(begins[enough], ends[enough], strict=True):
        which = int(item[a])
        own = place[a:b]
        for begin, length, edits, shared in index.windows[which]:
            got = int(np.searchsorted(own, begin + length - index.q, "right") - np.searchsorted(own, begin, "left"))
            if got >= shared:
                out.append((which, begin, length, edits, int(band[a]) * BAND, got))
    return out


def align(patterns: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Edit distances of each pattern (rows of equal length w) to what stands on the diagonals of its text (rows of length w + width - 1).

    Entry d of a row is the least distance of the pattern to a part of the text that ends on diagonal d; paths begin on
    any diagonal free of charge and stay within them.
    """
    n, w = patterns.shape
    width = texts.shape[1] - w + 1
    steps = np.arange(width, dtype=np.int32)
    row = np.zeros((n, width), dtype=np.int32)
    for i in range(w):
        differ = (texts[:, i : i + width] != patterns[:, i : i + 1]).astype(np.int32)
        best = row + differ
        best[:, :-1] = np.minimum(best[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(best - steps, axis=1) + steps
    return row


def verified(index: Index, points: np.ndarray, found: list[tuple[int, int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Item, begin and end in the document, edits, shared q-grams of the candidates that align within their edits."""
    out = []
    by_shape: dict[tuple[int, int], list] = {}
    for one in found:
        by_shape.setdefault((one[2], one[3]), []).append(one)
    nothing = np.uint32(0xFFFFFFFF)
    for (length, edits), group in by_shape.items():
        # the band, and as far beside it as the edits can lead
        width = BAND + edits + 2 * edits
        many = max(1, CELLS // (length + width))
        for k in range(0, len(group), many):
            part = group[k : k + many]
            patterns = np.stack([index.texts[i][b : b + length] for i, b, *_ in part])
            begin = np.array([b + d - edits for _, b, _, _, d, _ in part])
            cells = begin[:, None] + np.arange(length + width - 1)
            inside = (cells >= 0) & (cells < len(points))
            texts = np.where(inside, points[np.clip(cells, 0, len(points) - 1)], nothing)
            distance = align(patterns, texts)
            best = distance.argmin(axis=1)
            for one, at, to, d in zip(part, begin, best, distance[np.arange(len(part)), best], strict=True):
                if d <= edits:
                    start = int(at + to)
                    out.append((one[0], max(0, start), min(len(points), start + length), int(d), one[5]))
    return out


def whole_words(block: Block, points: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Number, begin and end of items that are looked up whole and stand between word boundaries."""
    word = folds()[3][points]
    inside = np.concatenate(([False], word[1:] & word[:-1], [False]))
    for n, (hashes, numbers, rows) in block.whole.items():
        if n > len(points):
            continue
        begins = np.flatnonzero(~(inside[: len(points) - n + 1] | inside[n:]))
        for k in range(0, len(begins), PIECE):
            at = begins[k : k + PIECE]
            own = points[at[0] : at[-1] + n]
            found = gram_hashes(own, n)[at - at[0]]
            low, high = np.searchsorted(hashes, found, "left"), np.searchsorted(hashes, found, "right")
            for j in np.flatnonzero(high > low):
                for one in range(low[j], high[j]):
                    if (points[at[j] : at[j] + n] == rows[one]).all():
                        yield int(numbers[one]), int(at[j]), int(at[j]) + n


def passages(block: Block, text: str, pairs: int = PAIRS) -> list[tuple[object, int, int, int, int]]:
    """Per item that a text holds: item id, begin and end of what its windows cover, least edits, most shared q-grams.

    A long text is looked at in pieces that overlap by more than a window can reach.
    """
    points, out = plain(text), {}

    def add(item: int, a: int, b: int, edits: int, shared: int) -> None:
        old = out.get(item, (a, b, edits, shared))
        out[item] = (min(old[0], a), max(old[1], b), min(old[2], edits), max(old[3], shared))

    for index in block.parts:
        for start in range(0, max(1, len(points) - index.reach), PIECE):
            piece = points[start : start + PIECE + index.reach]
            for found in candidate_windows(index, piece, pairs):
                for item, a, b, edits, shared in verified(index, piece, found):
                    add(index.items[item], a + start, b + start, edits, shared)
    if block.whole:
        for item, a, b in whole_words(block, points):
            add(item, a, b, 0, 1)
    if not out:
        return []
    at = folded(text, places=True)[1]
    return [(block.ids[i], int(at[min(a, len(at) - 1)]), int(at[max(b, 1) - 1]) + 1, edits, shared) for i, (a, b, edits, shared) in sorted(out.items())]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, step: int = STEP, rate: float = ERROR_RATE, q: int = GRAM, index_chars: int = INDEX_CHARS,
) -> DataFrame:
    """A row per row of ``docs`` and item found in it: ids, begin and end in code points, edits, shared q-grams.

    Found means: one of the item's windows of ``window`` characters (the whole item if it is shorter), which begin every ``step``
    characters and at its end, is in the text with at most ``rate`` times its length edits, after case is folded, runs of blanks are made one space
    and blanks at the ends of the item are left out. An item under ``q`` characters that ``rate`` allows no edit has to stand between word
    boundaries, as it would be in parts of words all over; scripts that don't part words have a boundary everywhere. Null and empty texts hold
    nothing; null items and items of blanks only are in nothing.
    Repeated documents and items are reported each. Items over ``index_chars`` characters are indexed in a block of their own.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kinds = {f.name: f for f in benchmark.select(F.col(item_id).alias("item_id")).schema}
    schema = T.StructType([rows.schema["doc_id"], kinds["item_id"], *T.StructType.fromDDL("start long, end long, edits int, shared int").fields])
    out = None
    for index in indexes(benchmark, item_id, item_text, window, step, rate, q, index_chars):
        found = _search(rows, index, schema)
        out = found if out is None else out.unionByName(found)
    return out


def clean(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, step: int = STEP, rate: float = ERROR_RATE, q: int = GRAM, index_chars: int = INDEX_CHARS,
) -> DataFrame:
    """The rows of ``docs``, unchanged, in which ``contaminated`` finds no item."""
    for index in indexes(benchmark, item_id, item_text, window, step, rate, q, index_chars):
        docs = _without(docs, index, text)
    return docs


def indexes(benchmark: DataFrame, item_id: str, item_text: str, window: int, step: int, rate: float, q: int, index_chars: int) -> Iterator[Block]:
    """The benchmark in blocks of about ``index_chars`` characters, one at least, one after the other."""
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("item")).where(F.length("item") > 0)
    size = items.agg(F.sum(F.length("item")).alias("n")).collect()[0]["n"] or 0
    count = max(1, -(-size // index_chars))
    for k in range(count):
        block = items.where(F.pmod(F.xxhash64("item_id", "item"), F.lit(count)) == k).collect()
        yield build_index(sorted(((r["item_id"], r["item"]) for r in block), key=repr), q, window, step, rate)


def _without(docs: DataFrame, index: Block, text: str) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for block in blocks(batches, text):
            texts = block.column(block.schema.get_field_index(text)).to_pylist()
            yield block.filter(pa.array([not t or not passages(own, t) for t in texts], pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


def _search(rows: DataFrame, index: Block, schema: T.StructType) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(index)
    kinds = [to_arrow_type(f.dataType) for f in schema.fields[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for block in blocks(batches, "text"):
            ids = block.column(block.schema.get_field_index("doc_id"))
            found = [(k, *p) for k, t in enumerate(block.column(block.schema.get_field_index("text")).to_pylist()) if t for p in passages(own, t)]
            if found:
                at, *rest = zip(*found, strict=True)
                columns = [ids.take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip(rest, kinds, strict=True)]]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(lean(run), schema)
