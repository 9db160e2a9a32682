"""SentencePiece ids of whole texts by a max-plus scan over chunks, and back.

A text longer than a chunk is cut at fixed places, whatever stands there. The state at a cut is the piece that reaches over it or ends
at it; the candidates are read off the characters around the cut, so both chunks beside it list the same ones. A chunk becomes a matrix: the
weight of the best path from each state at its left cut to each state at its right cut. Matrices combine by max-plus products, which are
associative: blocks of chunks first, then the few blocks of a text, then the chunks inside each block. With the states at its two
cuts known, each chunk traces its own path, whichever task has it. A text within one chunk has a single start and end state and
is traced at once.

No model is trained: the pieces and scores are those of a given model file.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.llm.common import blocks, kept, lean
from daymark.llm.pieces import MINUS, SPACE, Lattice, load

CHUNK = 1 << 15
#: Chunks whose matrices one task combines; a string holds 2 GB at most, so a text has at most 256 such blocks.
BLOCK = 256
#: Bytes of text encoded at a time; encoding and decoding workers stand side by side.
TEXT_BYTES = 1 << 20
ROW = "__sp_row"
#: Where the model lies unless another path is given.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def normalized(text: str, first: bool = True) -> str:
    return (SPACE if first else "") + text.replace(" ", SPACE)


def states(lattice: Lattice, text: str, cut: int) -> list[tuple[int, int]]:
    """Begin and end of every piece that begins before ``cut`` and ends at or behind it."""
    n = len(text)
    return [
        (b, e)
        for b in range(max(0, cut - lattice.longest), cut)
        for e in range(cut, min(n, b + lattice.longest) + 1)
        if lattice.weight(text[b:e]) is not None
    ]


def _edges(lattice: Lattice, text: str, left: int, right: int) -> tuple[int, int] | None:
    """The first and the last place between two cuts that no piece reaches over."""
    right = min(right, len(text))
    if not lattice.falls_apart or (word := lattice.cut.search(text, left, right)) is None or word.end() >= right:
        return None
    first, back = word.end(), 64
    while True:
        begin = max(first, right - back)
        # the word that the search begins in may be cut off, as may the last one; ends of the others are places
        ends = [m.end() for m in lattice.cut.finditer(text, begin, right)][:-1]
        if ends:
            return first, ends[-1]
        if begin == first:
            return first, first
        back *= 4


def transfer(lattice: Lattice, text: str, left: int, right: int, first: bool, last: bool) -> np.ndarray:
    """Weights from each state at ``left`` to each at ``right``; one state only before the first chunk and behind the last."""
    entries = [(left, left)] if first else states(lattice, text, left)
    exits = [(right, right)] if last else states(lattice, text, right)
    out = np.full((len(entries), len(exits)), MINUS)
    if (edge := _edges(lattice, text, left + (0 if first else lattice.longest), right)) is not None:
        head = [_at(lattice.forward(text, e, None if first else text[b:e], edge[0]), edge[0]) for b, e in entries]
        tail = _to_exits(lattice, text, lattice.forward(text, edge[1], None, right), exits, last)
        return np.add.outer(np.array(head) + lattice.measure(text[edge[0] : edge[1]]), np.array(tail))
    for k, (b, e) in enumerate(entries):
        out[k] = _to_exits(lattice, text, lattice.forward(text, e, None if first else text[b:e], right), exits, last)
    return out


def _at(reached: dict, place: int) -> float:
    return reached[place][0] if place in reached else MINUS


def _to_exits(lattice: Lattice, text: str, reached: dict, exits: list[tuple[int, int]], last: bool) -> list[float]:
    if last:
        return [_at(reached, exits[0][0])]
    out = []
    for b, e in exits:
        fits = b in reached and lattice.meet(reached[b][2], text[b:e])
        out.append(reached[b][0] + lattice.weight(text[b:e]) if fits else MINUS)
    return out


def trace(lattice: Lattice, text: str, left: int, right: int, first: bool, last: bool, entry: int, exit_: int) -> bytes:
    """Ids behind the entry state's piece, up to the exit state's piece and with it."""
    b, e = (left, left) if first else states(lattice, text, left)[entry]
    goal, end = (right, right) if last else states(lattice, text, right)[exit_]
    before = None if first else text[b:e]
    closing = b"" if last else lattice.coded(text[goal:end])
    edge = _edges(lattice, text, left + (0 if first else lattice.longest), right)
    if edge is not None and goal >= edge[1]:
        head = lattice.back(lattice.forward(text, e, before, edge[0]), edge[0])
        tail = lattice.back(lattice.forward(text, edge[1], None, goal), goal)
        middle = lattice.encode(text[edge[0] : edge[1]])
    else:
        head, middle = lattice.back(lattice.forward(text, e, before, goal), goal), b""
        tail = []
    return b"".join(map(lattice.coded, head)) + middle + b"".join(map(lattice.coded, tail)) + closing


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def _pack(m: np.ndarray) -> bytes:
    return np.array(m.shape, dtype="<i4").tobytes() + m.astype("<f8").tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype="<f8", offset=8).reshape(np.frombuffer(raw, dtype="<i4", count=2))


def model_bytes(spark: SparkSession, path: str) -> bytes:
    """Content of one model file, a few MB: a path on the driver, or an address (scheme://...) that Spark reads."""
    if "://" not in path:
        return Path(path).read_bytes()
    return bytes(spark.read.format("binaryFile").load(path).select("content").collect()[0]["content"])


def encode(docs: DataFrame, model: bytes, text: str = "text", ids: str = "token_ids", chunk: int = CHUNK) -> DataFrame:
    """All rows and columns with ``ids``, an array of int, which replaces a column of that name.

    The ids are those of the model's own encoding with its word-begin mark and without begin and end marks. A null text
    has null ids, an empty one none. Texts longer than ``chunk`` characters go through the scan, whole; there is no
    bound on a text but that of a string. Repeated rows are encoded one by one. An empty table gives an empty result.
    """
    short, long = _parted(docs.drop(ids), text, chunk)
    return _encode_short(short, model, text, ids).unionByName(_encode_long(long, model, text, ids, chunk))


def _parted(docs: DataFrame, text: str, chunk: int) -> tuple[DataFrame, DataFrame]:
    if chunk < 64:
        raise ValueError("a chunk must be longer than the pieces that reach over its ends")
    # empty and null lengths compare as not long
    long = F.coalesce(F.length(text) > chunk, F.lit(False))
    return docs.where(~long), docs.where(long)


def _lists(parts: list[bytes | None]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) // 4 if p else 0 for p in parts], out=offsets[1:])
    values = pa.array(np.frombuffer(b"".join(p for p in parts if p), dtype="<i4"))
    none = pa.array([p is None for p in parts], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=none)


def _coded(lattice: Lattice, texts: list[str | None]) -> list[bytes | None]:
    return [None if t is None else lattice.encode(normalized(t)) if t else b"" for t in texts]


def _encode_short(docs: DataFrame, model: bytes, text: str, ids: str) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = load(held.value)
        for block in blocks(batches, text, TEXT_BYTES):
            parts = _coded(lattice, block.column(block.schema.get_field_index(text)).to_pylist())
            yield pa.RecordBatch.from_arrays([*block.columns, _lists(parts)], names=[*block.schema.names, ids])

    return docs.mapInArrow(lean(run, caches=True), schema)


def _encode_long(docs: DataFrame, model: bytes, text: str, ids: str, chunk: int) -> DataFrame:
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)
    rows = kept(docs.withColumn(ROW, F.monotonically_increasing_id()), "long-texts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around = load(held.value).longest
        for batch in batches:
            for row, t in zip(batch.column(0), batch.column(1), strict=True):
                whole = normalized(t.as_py())
                count = max(1, -(-len(whole) // chunk))
                for i in range(count):
                    begin = max(0, i * chunk - around)
                    part = whole[begin : (i + 1) * chunk + around]
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (row.as_py(), i, count, part)], schema=cut_schema)

    cut_schema = pa.schema([("row", pa.int64()), ("i", pa.int64()), ("n", pa.int64()), ("part", pa.string())])
    chunks = rows.select(ROW, text).mapInArrow(lean(cut, caches=True), "row long, i long, n long, part string")
    chunks = kept(chunks.repartition(F.xxhash64("row", "i")), "chunks")

    def places(i: int, n: int, part: str, around: int) -> tuple[int, int, bool, bool]:
        left = 0 if i == 0 else around
        return left, len(part) if i == n - 1 else left + chunk, i == 0, i == n - 1

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = load(held.value)
        for batch in batches:
            told = batch.to_pylist()
            packed = [_pack(transfer(lattice, r["part"], *places(r["i"], r["n"], r["part"], lattice.longest))) for r in told]
            columns = [pa.array([r["row"] for r in told], pa.int64()), pa.array([r["i"] for r in told], pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "i", "m"])

    single = kept(chunks.mapInArrow(lean(matrices, caches=True), "row long, i long, m binary").withColumn("block", F.floor(F.col("i") / BLOCK)), "matrices")

    def product(frame: pd.DataFrame) -> pd.DataFrame:
        out = None
        for raw in frame.sort_values("i")["m"]:
            out = _unpack(raw) if out is None else times(out, _unpack(raw))
        return pd.DataFrame({"row": frame["row"].iloc[:1], "block": frame["block"].iloc[:1], "m": [_pack(out)]})

    def path(found: list[np.ndarray], entry: int, exit_: int | None) -> list[tuple[int, int]]:
        """States between matrices on the best path from an entry state to an exit state (None: the only one)."""
        ahead = [np.where(np.arange(found[0].shape[0]) == entry, 0.0, MINUS)]
        for m in found:
            ahead.append((ahead[-1][:, None] + m).max(axis=0))
        at = 0 if exit_ is None else exit_
        out = []
        for k in range(len(found) - 1, -1, -1):
            came = int((ahead[k] + found[k][:, at]).argmax())
            out.append((came, at))
            at = came
        return out[::-1]

    def over_blocks(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        between = path([_unpack(m) for m in frame["m"]], 0, None)
        return pd.DataFrame({"row": frame["row"], "block": frame["block"], "entry": [a for a, _ in between], "exit": [b for _, b in between]})

    def over_chunks(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("i")
        between = path([_unpack(m) for m in frame["m"]], int(frame["entry"].iloc[0]), int(frame["exit"].iloc[0]))
        return pd.DataFrame({"row": frame["row"], "i": frame["i"], "entry": [a for a, _ in between], "exit": [b for _, b in between]})

    products = single.groupBy("row", "block").applyInPandas(product, "row long, block long, m binary")
    ends = products.groupBy("row").applyInPandas(over_blocks, "row long, block long, entry int, exit int")
    known = single.join(ends, ["row", "block"]).groupBy("row", "block").applyInPandas(over_chunks, "row long, i long, entry int, exit int")

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = load(held.value)
        for batch in batches:
            told = batch.to_pylist()
            parts = [trace(lattice, r["part"], *places(r["i"], r["n"], r["part"], lattice.longest), r["entry"], r["exit"]) for r in told]
            columns = [pa.array([r["row"] for r in told], pa.int64()), pa.array([r["i"] for r in told], pa.int64()), _lists(parts)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "i", "ids"])

    done = chunks.join(known, ["row", "i"]).mapInArrow(lean(traced, caches=True), "row long, i long, ids array<int>")
    whole = done.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("i", "ids"))).alias("all")).select(F.col("row").alias(ROW), F.flatten("all.ids").alias(ids))
    return rows.join(whole, ROW, "left").drop(ROW)


def _spelled(lattice: Lattice, column: pa.ListArray) -> Iterator[str | None]:
    """The text of each list of ids, one at a time."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    for a, b, there in zip(ends, ends[1:], column.is_valid().to_pylist(), strict=False):
        if not there:
            yield None
            continue
        said = "".join(map(lattice.texts.__getitem__, values[a:b].tolist()))
        said = said[1:] if said.startswith(" ") else said
        try:
            said.encode()
        except UnicodeEncodeError:
            said = said.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        yield said


def decode(coded: DataFrame, model: bytes, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """All rows and columns with the text of ``ids`` in ``out``, which replaces a column of that name; null for null, empty for none.

    The word-begin mark in front goes; bytes that make no character become U+FFFD. A text comes back as it was, but
    that U+2581, which the vocabulary uses for the blank, comes back as a blank.
    """
    coded = coded.drop(out)
    held = coded.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*coded.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = load(held.value)
        for batch in batches:
            said = list(_spelled(lattice, batch.column(batch.schema.get_field_index(ids))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(said, pa.string())], names=[*batch.schema.names, out])

    return coded.mapInArrow(lean(run, caches=True), schema)


def checked(docs: DataFrame, model: bytes, text: str = "text", ids: str = "token_ids", chunk: int = CHUNK) -> DataFrame:
    """All rows and columns but the text, with ``token_ids``, ``n_tokens`` and whether the ids decode to the text (``round_trip``).

    Null texts have null ids and no number, and decode to null. U+2581 in a text is taken as the blank that it comes back as.
    Short texts are encoded and decoded in one step, so no text goes back to where it came from.
    """
    short, long = _parted(docs.drop(ids), text, chunk)
    return _verdicts(short, model, text, ids).unionByName(_verdicts(_encode_long(long, model, text, ids, chunk), model, text, ids))


def _verdicts(rows: DataFrame, model: bytes, text: str, ids: str) -> DataFrame:
    """Rows without their text, with ``ids`` unless they have them, number and ``round_trip``."""
    held = rows.sparkSession.sparkContext.broadcast(model)
    others = [f for f in rows.schema.fields if f.name not in (text, ids)]
    added = T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType())), *T.StructType.fromDDL("n_tokens long, round_trip boolean").fields])
    known = ids in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = load(held.value)
        for block in blocks(batches, text, TEXT_BYTES):
            texts = block.column(block.schema.get_field_index(text)).to_pylist()
            lists = block.column(block.schema.get_field_index(ids)) if known else _lists(_coded(lattice, texts))
            same = [said == (None if t is None else t.replace(SPACE, " ")) for t, said in zip(texts, _spelled(lattice, lists), strict=True)]
            numbers = pa.compute.list_value_length(lists).cast(pa.int64())
            columns = [block.column(block.schema.get_field_index(f.name)) for f in others]
            yield pa.RecordBatch.from_arrays([*columns, lists, numbers, pa.array(same, pa.bool_())], names=[*[f.name for f in others], *added.names])

    return rows.mapInArrow(lean(run, caches=True), T.StructType([*others, *added.fields]))
