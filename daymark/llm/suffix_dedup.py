"""Removal of repeated byte strings from texts, by a distributed merge sort of suffixes that knows common prefixes.

A string of ``length`` bytes is repeated if it also starts anywhere else. Texts that occur twice as a whole go first: counts of their 128-bit names tell,
and one row of each stands for the others in what follows. Each string has an anchor: of the quarter-length strings in it the one
with the least hash, the leftmost of equal ones. Equal strings have equal anchors at equal places, so it is enough to look at suffixes that begin at anchors,
one in a hundred and fifty bytes, and of these only at the ones whose anchor string occurs twice, which counts of hashes tell. An anchor's
surroundings are the bytes that strings around it can reach. Where equal surroundings occur twice (again counts of hashes, 128 bits), every string in them is
repeated. What is left are the ends of repeated passages: anchor strings with several surroundings, one of them unique. Those suffixes are sorted.

Every task sorts its suffixes, keeps each as the length of its common prefix with the one before and the rest (front coding), and hands the run out by a
hash of the anchor string. The runs of a part are merged by a loser tree whose nodes remember how long a prefix each loser shares with the winner that
beat it: of two candidates the one that shares more with the last output is smaller, and only when both share equally much are bytes
compared, from there on. The merged order comes with the common prefixes of neighbours, so suffixes with one anchor string stand together. Within
such a group, strings at each place around the anchor are compared over the whole group at once.

An anchor string with very many different surroundings isn't merged in one task: its strings are dealt out by their own hashes and counted.
In the end only texts that lose a part move to meet what they lose; the others are written where they are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import MAP_BITS, bit_map, blocks, in_map, kept
from daymark.llm.shingles import BASE, mix
from daymark.operators.joins import join_splitting

LENGTH = 400
#: Bytes that are hashed together; their number's bits are the low bits of the keys that minima are taken of.
SEGMENT_BITS = 19
#: Suffixes of one part of the merge, and different surroundings from which an anchor string is dealt out by its strings instead.
PART_SUFFIXES = 4000
HOT = 30_000
#: Such strings that all tasks are told of; those with most surroundings come first.
MOST_HOT = 1_000_000
#: Bytes of suffixes that a task sorts as one run.
RUN_BYTES = 48 << 20
ENTRY = 20


class Places:
    """Powers for hashing substrings by prefix sums, for texts up to a size."""

    def __init__(self, size: int):
        step = pow(BASE, -1, 1 << 64)
        self.up = np.concatenate(([np.uint64(1)], np.cumprod(np.full(size, BASE, dtype=np.uint64))))
        self.down = np.concatenate(([np.uint64(1)], np.cumprod(np.full(size, step, dtype=np.uint64))))

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums along the last axis, beginning with 0."""
        out = np.zeros((*data.shape[:-1], data.shape[-1] + 1), dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: data.shape[-1]], axis=-1, out=out[..., 1:])
        return out


_PLACES: dict[int, Places] = {}


def places(size: int) -> Places:
    if size not in _PLACES:
        _PLACES[size] = Places(size)
    return _PLACES[size]


def least_in_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` keys."""
    now, have = keys, 1
    while have * 2 <= width:
        now = np.minimum(now[:-have], now[have:])
        have *= 2
    count = len(keys) - width + 1
    return np.minimum(now[:count], now[width - have : width - have + count])


def core(length: int) -> int:
    """Bytes of an anchor string. Shorter ones are fewer, as a string has more to choose from, but stand in more places."""
    return length // 4


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors, ``own`` bytes long, of all strings of ``length`` bytes within the texts that ``offsets`` bound."""
    half, size = own or length // 2, 1 << SEGMENT_BITS
    table = places(size)
    low = np.uint64(size - 1)
    found, hashes = [], []
    step = size - length
    for start in range(0, max(0, int(offsets[-1]) - length + 1), step):
        piece = data[start : start + size]
        sums = table.sums(piece)
        count = len(piece) - half + 1
        gram = mix((sums[half : half + count] - sums[:count]) * table.down[:count])
        # strings that lie within one text: no boundary among their inner bytes
        inner = offsets[(offsets > start) & (offsets < start + len(piece))] - start
        strings = len(piece) - length + 1
        change = np.zeros(strings + 1, dtype=np.int32)
        np.add.at(change, np.clip(inner - length + 1, 0, strings), 1)
        np.add.at(change, np.clip(inner, 0, strings), -1)
        within = np.cumsum(change[:strings]) == 0
        if not within.any():
            continue
        least = least_in_windows((gram & ~low) | np.arange(count, dtype=np.uint64), length - half + 1)[within]
        at = np.unique((least[np.concatenate(([True], least[1:] != least[:-1]))] & low).astype(np.int64))
        found.append(at + start)
        hashes.append(gram[at])
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    at, first = np.unique(np.concatenate(found), return_index=True)
    return at, np.concatenate(hashes)[first]


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column and where its values begin; nulls are empty."""
    column = column.fill_null(b"") if column.null_count else column
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, dtype=np.uint8)
    return data, offsets - offsets[0]


class Copies:
    """Tells which texts surely occur twice as a whole, and one row of each, by maps of bits of bounded size.

    A text that occurs once may share its bit with a copied one; such texts are in a map of their own. Where many are, more rows count as if they were
    alone, which costs work and changes nothing.
    """

    def __init__(self, named: DataFrame):
        bucket = F.shiftrightunsigned("h", 64 - MAP_BITS)
        copied = named.where("n > 1")
        alike = copied.select(bucket.alias("bucket")).distinct()
        mistaken = named.where("n = 1").withColumn("bucket", bucket).join(alike, "bucket", "left_semi")
        self.copied, self.mistaken, self.first = bit_map(copied.select(F.col("h").alias("g"))), bit_map(mistaken.select(F.col("h").alias("g"))), bit_map(copied.select("g"))

    def surely(self, batch: pa.RecordBatch) -> np.ndarray:
        h = _hashes(batch, "h")
        return in_map(self.copied, h) & ~in_map(self.mistaken, h)

    def standing(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows without further copies of a text, in blocks."""
        for batch in batches:
            stays = ~self.surely(batch) | in_map(self.first, _hashes(batch, "g"))
            yield from blocks(iter([batch.filter(pa.array(stays))]), "body")


def _hashes(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(column)).to_numpy().view(np.uint64)


def text_names(texts: DataFrame, length: int) -> DataFrame:
    """``name``, ``h`` (its hash), ``size``, rows ``n`` and the least row hash ``g`` of each text that is long enough to lose anything."""
    long = texts.where(F.length("body") >= length).select("name", "h", "g", F.length("body").alias("size"))
    return long.groupBy("name", "h").agg(F.first("size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("g").alias("g"))


def count_anchors(texts: DataFrame, copies: Broadcast, length: int) -> DataFrame:
    """``g`` and ``n`` of anchor strings (their hashes) that occur more than once in the column ``body``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in copies.value.standing(batches):
            _, hashes = anchors(*_buffers(batch.column(0)), length, core(length))
            g, n = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n)], names=["g", "n"])

    return texts.select("body", "h", "g").mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).where("n > 1")


def common(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of two strings that share ``start`` bytes."""
    most = min(len(a), len(b))
    if a[start:most] == b[start:most]:
        return most
    step = 8
    while a[start : start + step] == b[start : start + step]:
        start += step
        step *= 2
    while step > 1:
        step //= 2
        if a[start : start + step] == b[start : start + step]:
            start += step
    return start


class Run:
    """A front-coded sorted run: rows of (common prefix with the one before, rest, ...)."""

    def __init__(self, rows: list[tuple]):
        self.rows, self.at, self.key, self.shared = rows, -1, b"", 0
        self.advance()

    def advance(self) -> None:
        self.at += 1
        if self.at < len(self.rows):
            self.shared = self.rows[self.at][0]
            self.key = self.key[: self.shared] + self.rows[self.at][1]

    @property
    def done(self) -> bool:
        return self.at >= len(self.rows)


def pack(rows: list[tuple[bytes, bytes, bytes]]) -> bytes:
    """A sorted run of (key, before, entries), front-coded: lengths, then the rests of the keys, then the other columns, packed together."""
    keys = [r[0] for r in rows]
    shared = [0, *[common(a, b, 0) for a, b in zip(keys, keys[1:], strict=False)]]
    lengths = np.array([(h, len(k) - h, len(left), len(entries)) for h, (k, left, entries) in zip(shared, rows, strict=True)], dtype="<i4")
    parts = [len(rows).to_bytes(4, "little"), lengths.tobytes(), *[k[h:] for h, k in zip(shared, keys, strict=True)], *[r[1] for r in rows], *[r[2] for r in rows]]
    return zlib.compress(b"".join(parts), 4)


def unpack(packed: bytes) -> list[tuple[int, bytes, bytes, bytes]]:
    """Rows of a run: bytes shared with the key before, the rest of the key, what stands before it, entries."""
    raw = zlib.decompress(packed)
    count = int.from_bytes(raw[:4], "little")
    lengths = np.frombuffer(raw, dtype="<i4", count=4 * count, offset=4).reshape(count, 4)
    at, columns = 4 + 16 * count, []
    for k in (1, 2, 3):
        ends = at + np.cumsum(lengths[:, k])
        columns.append([raw[b - n : b] for b, n in zip(ends.tolist(), lengths[:, k].tolist(), strict=True)])
        at = int(ends[-1])
    return list(zip(lengths[:, 0].tolist(), *columns, strict=True))


class LoserTree:
    """Merges front-coded runs. ``shared[i]``: bytes that run i's key has in common with the last output."""

    def __init__(self, runs: list[Run]):
        self.runs, self.shared = runs, [0] * len(runs)
        size = 1
        while size < len(runs):
            size *= 2
        self.size = size
        self.losers = [-1] * size
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size if node - self.size < len(self.runs) else -1
        winner, self.losers[node] = self._play(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def _play(self, i: int, j: int) -> tuple[int, int]:
        """Winner and loser; the loser's ``shared`` becomes what it shares with the winner."""
        if i < 0 or self.runs[i].done:
            return j, i
        if j < 0 or self.runs[j].done:
            return i, j
        p, q = self.shared[i], self.shared[j]
        if p != q:
            # the last output is no larger than either, so sharing more of it means being smaller; the loser shares as much with the winner
            return (i, j) if p > q else (j, i)
        a, b = self.runs[i].key, self.runs[j].key
        h = common(a, b, p)
        smaller = h == len(a) and (h < len(b) or i < j) or (h < len(a) and h < len(b) and a[h] < b[h])
        if smaller:
            self.shared[j] = h
            return i, j
        self.shared[i] = h
        return j, i

    def merged(self) -> Iterator[tuple[int, int, bytes, tuple]]:
        """Bytes shared with the output before, run, key, row, in order."""
        while self.winner >= 0 and not self.runs[self.winner].done:
            i = self.winner
            run = self.runs[i]
            yield self.shared[i], i, run.key, run.rows[run.at]
            run.advance()
            self.shared[i] = run.shared  # its next key shares this with the one just put out
            node, winner = (self.size + i) // 2, i
            while node >= 1:
                winner, self.losers[node] = self._play(winner, self.losers[node])
                node //= 2
            self.winner = winner


def repeated_reach(rights: list[bytes], lefts: list[bytes], weights: np.ndarray, groups: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix how far before its anchor its first repeated string begins and its last one; -1 and length where none is.

    ``rights`` begin at the anchor, ``lefts`` end there; ``groups`` tells suffixes of one anchor string, ``weights`` occurrences.
    All strings of an anchor hold the anchor string, so together they cover one stretch.
    """
    half = length - core(length)
    n, width = len(rights), half + length
    table = places(1 << int(width).bit_length())
    joined = b"".join(left.rjust(half, b"\0") + right.ljust(length, b"\0") for left, right in zip(lefts, rights, strict=True))
    data = np.frombuffer(joined, dtype=np.uint8).reshape(n, width)
    before, behind = np.array([len(x) for x in lefts]), np.array([len(x) for x in rights])
    first, last = np.full(n, -1), np.full(n, length)
    own = groups.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    # places ahead of the anchor a few at a time, and few enough rows at a time for their sums
    many = max(1, min(half + 1, (1 << 22) // max(1, n)))
    for start in range(0, half + 1, many):
        ahead = np.arange(start, min(half + 1, start + many))
        strings = np.empty((n, len(ahead)), dtype=np.uint64)
        for k in range(0, n, 4096):
            sums = table.sums(data[k : k + 4096])
            strings[k : k + 4096] = (sums[:, half + length - ahead] - sums[:, half - ahead]) * table.down[half - ahead]
        row, x = np.nonzero((before[:, None] >= ahead) & (behind[:, None] >= length - ahead))
        key = mix(mix(strings[row, x] + own[row]) + (x + start).astype(np.uint64))
        order = np.argsort(key, kind="stable")
        equal = key[order][1:] == key[order][:-1]
        again = weights[row] > 1
        again[order[1:]] |= equal
        again[order[:-1]] |= equal
        np.maximum.at(first, row[again], x[again] + start)
        np.minimum.at(last, row[again], x[again] + start)
    return first, last


def merge_part(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """Merges a part's runs and tells the stretches that repeated strings cover: text (a, b), begin, end."""
    half = core(length)
    runs = [Run(unpack(rows)) for rows in frame["rows"]]
    texts, begins, ends = [], [], []
    waiting: list[tuple[bytes, bytes, bytes, int]] = []
    group, began = 0, 0

    def settle() -> None:
        if not waiting:
            return
        # equal surroundings from several runs are one suffix with several occurrences
        merged: dict[tuple[int, bytes, bytes], list[bytes]] = {}
        for right, left, entries, g in waiting:
            merged.setdefault((g, right, left), []).append(entries)
        entries = [b"".join(e) for e in merged.values()]
        weights = np.array([len(e) // ENTRY for e in entries])
        numbers = np.array([g for g, _, _ in merged])
        first, last = repeated_reach([r for _, r, _ in merged], [x for _, _, x in merged], weights, numbers, length)
        for k in np.flatnonzero(first >= 0):
            for i in range(0, len(entries[k]), ENTRY):
                at = int.from_bytes(entries[k][i + 16 : i + 20], "little")
                texts.append(entries[k][i : i + 16])
                begins.append(at - int(first[k]))
                ends.append(at + length - int(last[k]))
        waiting.clear()

    for shared, _, right, row in LoserTree(runs).merged():
        if shared < half:
            if len(waiting) - began == 1 and len(waiting[-1][2]) == ENTRY:
                waiting.pop()  # it stands alone: the map of bits let it pass
            if len(waiting) >= 2000:
                settle()
            group, began = group + 1, len(waiting)
        waiting.append((right, row[2], row[3], group))
    settle()
    return pd.DataFrame({"text": pd.Series(texts, dtype=object), "begin": np.array(begins, dtype=np.int64), "end": np.array(ends, dtype=np.int64)})


def _suffixes(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Anchors of a batch: place, hash, row, where its text begins and ends; the texts' names; the bytes."""
    data, offsets = _buffers(batch.column(batch.schema.get_field_index("body")))
    at, hashes = anchors(data, offsets, length, core(length))
    row = np.searchsorted(offsets, at, "right") - 1
    return at, hashes, row, offsets[row], offsets[row + 1], batch.column(batch.schema.get_field_index("name")).to_pylist(), data


def _around(data: np.ndarray, at: int, begin: int, end: int, length: int) -> tuple[bytes, bytes, bytes]:
    """What stands before an anchor and from it on, as far as its strings reach, and a 128-bit digest of both."""
    left = data[max(begin, at - (length - core(length))) : at].tobytes()
    right = data[at : min(end, at + length)].tobytes()
    return left, right, hashlib.blake2b(len(left).to_bytes(4, "little") + left + right, digest_size=16).digest()


def surroundings(texts: DataFrame, copies: Broadcast, bits: np.ndarray, length: int) -> DataFrame:
    """Anchors whose string is repeated: its hash ``g``, the digest of the surroundings (ca, cb), the text's name (ta, tb), and two longs for the rest.

    These rows are what grows with repeated content, so they are kept narrow: place << 32, bytes before << 20, bytes from it on << 8,
    and how many times the task has met them (255 stands for more). A text that goes on repeating itself has equal surroundings every few bytes: as long as
    each reaches the next they are one row, and ``further`` tells how far from the first place the last one is.
    """
    held = texts.sparkSession.sparkContext.broadcast(bits)
    fields = ["g", "ca", "cb", "ta", "tb", "packed", "further"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in copies.value.standing(batches):
            at, hashes, row, begin, end, names, data = _suffixes(batch, length)
            rows: dict[tuple[bytes, int], list] = {}
            chains: dict[bytes, tuple[int, int, int]] = {}  # by digest: the text's row, first and last place
            for i in np.flatnonzero(in_map(held.value, hashes)):
                first = int(begin[i])
                place = int(at[i]) - first
                left, right, digest = _around(data, int(at[i]), first, int(end[i]), length)
                text, start, last = chains.get(digest, (-1, 0, 0))
                if text != row[i] or place - last > len(left) + len(right):
                    start = place
                chains[digest] = (int(row[i]), start, place)
                key = (names[row[i]], start)
                if key in rows:
                    rows[key][4] += 1
                    rows[key][5] = max(rows[key][5], place - start)
                else:
                    rows[key] = [int(hashes[i].view(np.int64)), digest, len(left), len(right), 1, 0]
            if rows:
                digests = np.frombuffer(b"".join([v[1] for v in rows.values()]), dtype=">i8").astype(np.int64)
                texts_ = np.frombuffer(b"".join([k[0] for k in rows]), dtype=">i8").astype(np.int64)
                packed = [(k[1] << 32) | (v[2] << 20) | (v[3] << 8) | min(255, v[4]) for k, v in rows.items()]
                columns = [np.array([v[0] for v in rows.values()]), digests[::2], digests[1::2], texts_[::2], texts_[1::2], np.array(packed), np.array([v[5] for v in rows.values()])]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=fields)

    return texts.select("name", "body", "h", "g").mapInArrow(run, ", ".join(f"{f} long" for f in fields))


def _stretch(packed: str) -> tuple[Column, Column]:
    """Where the surroundings begin and end in their text, the first ones of a row that stands for several."""
    rest = F.col(packed)
    at = F.shiftright(rest, 32)
    return at - F.shiftright(rest, 20).bitwiseAND(F.lit(4095)), at + F.shiftright(rest, 8).bitwiseAND(F.lit(4095))


def _name(a: str, b: str) -> Column:
    return F.concat(*[F.unhex(F.lpad(F.hex(F.col(x)), 16, "0")) for x in (a, b)])


def sorted_runs(texts: DataFrame, copies: Broadcast, bits: np.ndarray, open_bits: np.ndarray, hot: np.ndarray, parts: int, length: int) -> DataFrame:
    """Front-coded runs, a part after the other: suffixes whose surroundings are wanted, those of hot anchor strings left out."""
    held = texts.sparkSession.sparkContext.broadcast((bits, open_bits, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, wanted, left_out = held.value
        number, size, suffixes = 0, 0, {}

        def coded() -> Iterator[pa.RecordBatch]:
            name = (TaskContext.get().partitionId() << 24) + number
            for part, rows in groupby(sorted(suffixes.items(), key=lambda x: x[0]), key=lambda x: x[0][0]):
                packed = pack([(right, left, bytes(entries)) for (_, right, left), entries in rows])
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([name], pa.int64()), pa.array([packed], pa.binary())], names=["part", "run", "rows"])

        for batch in copies.value.standing(batches):
            at, hashes, row, begin, end, names, data = _suffixes(batch, length)
            part = (hashes % np.uint64(parts)).astype(np.int64)
            chosen = np.flatnonzero(in_map(known, hashes) & ~np.isin(hashes, left_out))
            around = [_around(data, a, b, e, length) for a, b, e in zip(at[chosen].tolist(), begin[chosen].tolist(), end[chosen].tolist(), strict=True)]
            tops = np.frombuffer(b"".join([x[2][:8] for x in around]), dtype=">u8")
            for k in np.flatnonzero(in_map(wanted, tops)):
                i, (left, right, _) = chosen[k], around[k]
                key = (int(part[i]), right, left)
                entry = names[row[i]] + (int(at[i]) - int(begin[i])).to_bytes(4, "little")
                old = suffixes.get(key)
                if old is None:
                    suffixes[key] = bytearray(entry)
                    size += len(left) + len(right) + 300
                elif len(old) == ENTRY:
                    # surroundings met twice lose all their strings without the merge, which has to know no more than that there are several
                    old += entry
                    size += ENTRY
            if size > RUN_BYTES:
                yield from coded()
                number, size, suffixes = number + 1, 0, {}
        yield from coded()

    return texts.select("name", "body", "h", "g").mapInArrow(run, "part long, run long, rows binary")


def hot_strings(texts: DataFrame, copies: Broadcast, hot: np.ndarray, length: int) -> DataFrame:
    """Stretches (text, begin, end) of strings around hot anchor strings that occur more than once, dealt out by the strings' own hashes.

    Surroundings that a block holds twice lose all their strings without that; two of them show others that their strings are repeated, further ones are left out.
    Equal strings that reach each other in a text are one row with their number.
    """
    held = texts.sparkSession.sparkContext.broadcast(hot)
    ahead = length - core(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = held.value
        for batch in copies.value.standing(batches):
            at, hashes, row, begin, end, names, data = _suffixes(batch, length)
            rows, last, done, met = [], {}, -1, Counter()
            for i in np.flatnonzero(np.isin(hashes, wanted)):
                around = _around(data, int(at[i]), int(begin[i]), int(end[i]), length)[2]
                met[around] += 1
                if met[around] > 2:
                    continue
                # neighbouring anchors are in some of the same strings, each of which counts once
                for start in range(max(int(begin[i]), int(at[i]) - ahead, done + 1), min(int(at[i]), int(end[i]) - length) + 1):
                    digest = hashlib.blake2b(data[start : start + length].tobytes(), digest_size=16).digest()
                    place, done = start - int(begin[i]), start
                    chain = last.get(digest)
                    if chain is not None and chain[0] == row[i] and place <= chain[1][3]:
                        chain[1][3] = place + length
                        chain[1][4] += 1
                        continue
                    rows.append([digest, names[row[i]], place, place + length, 1])
                    last[digest] = (row[i], rows[-1])
            for k in range(0, len(rows), 20_000):
                types = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows[k : k + 20_000], strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["digest", "text", "begin", "end", "n"])

    strings = kept(texts.select("name", "body", "h", "g").mapInArrow(run, "digest binary, text binary, begin long, end long, n long"), "hot-strings")
    again = strings.groupBy("digest").agg(F.sum("n").alias("n")).where("n > 1").select("digest")
    return join_splitting(strings.drop("n"), again, ["digest"], "inner").select("text", "begin", "end").distinct()


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, part_suffixes: int = PART_SUFFIXES, hot_from: int = HOT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``spans`` (begin, end of removed stretches, in bytes) and ``kept`` (the other bytes) of every row.

    A byte goes if a string of ``length`` bytes that holds it also starts anywhere else, in this or another text, overlaps included; strings are judged on the texts
    as given. No string reaches over the end of a text. Null and empty texts have no bytes, texts shorter than ``length`` lose none. Repeated rows
    repeat each other's strings, so they lose all bytes if they are long enough. Other columns are left aside.
    """
    if not 16 <= length < 4096:
        raise ValueError("length must be from 16 to 4095 bytes")
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    texts = docs.select(F.col(doc_id).alias("doc_id"), body.alias("body")).withColumn("name", F.substring(F.unhex(F.sha2("body", 256)), 1, 16))
    texts = texts.withColumns({"h": F.xxhash64("name"), "g": F.xxhash64("name", "doc_id")})
    named = kept(text_names(texts, length), "text-names")
    copies = docs.sparkSession.sparkContext.broadcast(Copies(named))
    bits = bit_map(count_anchors(texts, copies, length))
    around = kept(surroundings(texts, copies, bits, length), "surroundings")
    met = F.sum(F.col("packed").bitwiseAND(F.lit(255)))
    classes = kept(around.groupBy("ca", "cb").agg(met.alias("n"), F.first("g").alias("g")), "surrounding-classes")
    # every string of surroundings that occur twice is repeated
    twice = classes.where("n > 1").select("ca", "cb")
    begin, end = _stretch("packed")
    reaching = around.where(end - begin >= length).select("ca", "cb", "ta", "tb", "packed", "further")
    last = (end + F.col("further")).alias("end")
    stretches = join_splitting(reaching, twice, ["ca", "cb"], "inner").select(_name("ta", "tb").alias("text"), begin.alias("begin"), last)
    open_strings = classes.groupBy("g").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1")
    open_strings = kept(open_strings.select("g", "kinds"), "open-strings")
    total = open_strings.agg(F.sum("kinds").alias("n")).collect()[0]["n"] or 0
    hot = open_strings.where(F.col("kinds") > hot_from).orderBy(F.desc("kinds"), "g").limit(MOST_HOT).select("g").collect()
    hot = np.array(sorted(r["g"] for r in hot), dtype=np.int64).view(np.uint64)
    wanted = join_splitting(classes.select("g", "ca"), open_strings, ["g"], "inner").select(F.col("ca").alias("g"))
    runs = sorted_runs(texts, copies, bits, bit_map(wanted), hot, max(1, -(-total // part_suffixes)), length)
    merged = runs.groupBy("part").applyInPandas(lambda frame: merge_part(frame, length), "text binary, begin long, end long")
    stretches = stretches.unionByName(merged)
    if len(hot):
        stretches = stretches.unionByName(hot_strings(texts, copies, hot, length))
    whole = named.where("n > 1").select(F.col("name").alias("text"), F.lit(0).cast("long").alias("begin"), F.col("size").cast("long").alias("end"))
    stretches = stretches.unionByName(whole).withColumnRenamed("text", "name")
    spans = kept(stretches.groupBy("name").agg(F.collect_set(F.struct("begin", "end")).alias("found")), "spans")
    losing = docs.sparkSession.sparkContext.broadcast(bit_map(spans.select(F.xxhash64("name").alias("g"))))
    id_type = texts.schema["doc_id"].dataType
    schema = f"doc_id {id_type.simpleString()}, n_bytes long, n_removed long, spans array<struct<begin:long,end:long>>, kept binary"

    def moves(batch: pa.RecordBatch) -> np.ndarray:
        return in_map(losing.value, _hashes(batch, "h")) & ~copies.value.surely(batch)

    def stay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(iter([batch.filter(pa.array(~moves(batch)))]), "body"):
                ids, bodies = (block.column(block.schema.get_field_index(c)) for c in ("doc_id", "body"))
                found = [[(0, len(b))] if gone and len(b) >= length else [] for gone, b in zip(copies.value.surely(block), bodies.to_pylist(), strict=True)]
                yield _cut(ids, bodies.to_pylist(), found)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(moves(batch))).select(["doc_id", "name", "body"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "body"):
            ids, bodies, found = (block.column(block.schema.get_field_index(c)) for c in ("doc_id", "body", "found"))
            yield _cut(ids, bodies.to_pylist(), [[(x["begin"], x["end"]) for x in own or []] for own in found.to_pylist()])

    asked = texts.select("doc_id", "name", "body", "h")
    moving = asked.mapInArrow(move, texts.select("doc_id", "name", "body").schema)
    joined = join_splitting(moving, spans, ["name"]).select("doc_id", "body", "found")
    return asked.mapInArrow(stay, schema).unionByName(joined.mapInArrow(cut, schema))


def _cut(ids: pa.Array, bodies: list[bytes], found: list[list[tuple[int, int]]]) -> pa.RecordBatch:
    """Texts without the stretches found in them."""
    spans, rest, removed = [], [], []
    for content, own in zip(bodies, found, strict=True):
        merged: list[list[int]] = []
        for begin, end in sorted(own):
            if merged and begin <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([begin, end])
        edges = [0, *[e for span in merged for e in span], len(content)]
        rest.append(b"".join(content[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        spans.append([{"begin": a, "end": b} for a, b in merged])
        removed.append(len(content) - len(rest[-1]))
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    columns = [ids, pa.array([len(c) for c in bodies], pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(rest, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])


def report(cleaned: DataFrame) -> DataFrame:
    """Counts, the digest of what is left and what is left as text, U+FFFD for cut characters, from what ``without_repeats`` returns."""
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), text.alias("kept_text"))
