"""Sets of word shingles as 64-bit hashes, for whole batches of texts at a time."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Fixed: bytes between words, and upper to lower case.
_SPLIT = np.zeros(256, dtype=bool)
_SPLIT[9:14] = _SPLIT[32] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

BASE = 0x100000001B3
#: Bytes that are hashed together; a longer text is taken in pieces that end between words.
PIECE = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64."""
    inverse = pow(BASE, -1, 1 << 64)
    make = lambda b: np.concatenate(([np.uint64(1)], np.cumprod(np.full(n - 1, b, dtype=np.uint64))))
    return make(BASE), make(inverse)


def _word_hashes(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and begin of each word; words end at split bytes and before ``begins``."""
    inside = ~_SPLIT[data]
    if not inside.any():
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    fresh = np.zeros(len(data) + 1, dtype=bool)
    fresh[begins] = True
    fresh[0] = True
    first = inside & (fresh[:-1] | ~np.concatenate(([False], inside[:-1])))
    last = inside & (fresh[1:] | ~np.concatenate((inside[1:], [False])))
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    size = 1 << max(12, int(len(data)).bit_length())
    up, down = _powers(size)
    sums = np.concatenate(([np.uint64(0)], np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)))
    return mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), a


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word of a string column, in order."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32 if pa.types.is_string(column.type) else np.int64)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, dtype=np.uint8)
    offsets = offsets - offsets[0]
    hashes, rows, start = [], [], 0
    while start < len(data):
        stop = min(len(data), start + PIECE)
        if stop < len(data):
            # back to a place between words, or on to the end of a word that fills the piece
            near = np.flatnonzero(_SPLIT[data[start:stop]])
            starts = offsets[(offsets > start) & (offsets <= stop)]
            cut = max([*(near[-1:] + start + 1), *starts[-1:]], default=0)
            if cut <= start:
                on = np.flatnonzero(_SPLIT[data[stop:]])
                later = offsets[offsets > stop]
                cut = min([*(on[:1] + stop), *later[:1]], default=len(data))
            stop = int(cut)
        inner = offsets[(offsets >= start) & (offsets <= stop)] - start
        h, at = _word_hashes(data[start:stop], inner)
        hashes.append(h)
        rows.append(np.searchsorted(offsets, at + start, "right") - 1)
        start = stop
    if not hashes:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(rows)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each distinct shingle, by row and then hash. A text of fewer words has its whole sequence as the only shingle, one without words none."""
    hashes, rows = words(column)
    if not len(hashes):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    joint = np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64)
    for i in range(size):
        joint = joint * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(joint)]
    whole = rows[: len(joint)] == rows[size - 1 :] if len(joint) else np.empty(0, dtype=bool)
    counts = np.bincount(rows, minlength=len(column))
    first = np.concatenate(([0], np.cumsum(counts)))
    short = np.flatnonzero((counts > 0) & (counts < size))
    few = np.zeros(len(short), dtype=np.uint64)
    for i in range(size - 1):
        have = counts[short] > i
        few[have] = few[have] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[first[short[have]] + i]
    row = np.concatenate([rows[: len(joint)][whole], short])
    shingle = mix(np.concatenate([joint[whole], few + counts[short].astype(np.uint64)]))
    order = np.lexsort((shingle, row))
    row, shingle = row[order], shingle[order]
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])))
    return row[new], shingle[new]


def set_keys(row: np.ndarray, shingle: np.ndarray, count: int) -> list[bytes | None]:
    """A 128-bit name of each row's set; none for an empty set."""
    begins = np.searchsorted(row, np.arange(count + 1))
    out: list[bytes | None] = [None] * count
    filled = np.flatnonzero(begins[1:] > begins[:-1])
    if len(filled):
        a = np.add.reduceat(mix(shingle + np.uint64(1)), begins[filled])
        b = np.add.reduceat(mix(shingle ^ np.uint64(0xA5A5A5A5A5A5A5A5)), begins[filled])
        raw = np.stack([a, b], axis=1).astype("<u8").tobytes()
        for k, i in enumerate(filled):
            out[i] = raw[16 * k : 16 * k + 16]
    return out
