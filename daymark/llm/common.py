"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.session import configure
from daymark.shared import scratch_path

#: Bytes of text that one Python step holds at a time.
BLOCK_BYTES = 4 << 20


#: Session settings of the operators that hand rows to Python: smaller Arrow batches, as several workers share an executor.
SETTINGS = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings of the package and of this subpackage."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return configure(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read from there: lineage ends here, and its size is known."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks(batches: Iterator[pa.RecordBatch], text: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows of at most ``most`` bytes of text; a longer single row stands alone."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


#: Functions that drop what a module keeps in a Python worker between tasks.
CACHES: list[Callable[[], None]] = []


def trim(caches: bool = False) -> None:
    """Give memory back to the system, caches of other steps included unless ``caches`` are to stay: Python workers live on between tasks, and what one of them has kept the others can't use."""
    if not caches:
        for drop in CACHES:
            drop()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run: Callable[[Iterator], Iterator], caches: bool = False) -> Callable[[Iterator], Iterator]:
    """A function over a task's batches that leaves no freed memory behind, and nothing cached but for ``caches``."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            trim(caches)

    return wrapped


def twin_hash(*columns: Column) -> Column:
    """128 bits as a struct of two differently seeded 64-bit hashes."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit("second"), *columns).alias("b"))


#: Bits of a map of hashes, at any size, and of its parts, which are filled apart. Too few bits let more pass, never less.
MAP_BITS = 26
PART_BITS = 18


def bit_map(hashes: DataFrame) -> np.ndarray:
    """2^MAP_BITS bits (8 MB), set where the top bits of the hashes in column ``g`` point: filled in tasks and put together here."""
    top = F.shiftrightunsigned(F.col("g"), 64 - MAP_BITS)
    dealt = hashes.select(F.shiftright(top, PART_BITS).cast("int").alias("part"), top.bitwiseAND(F.lit((1 << PART_BITS) - 1)).cast("int").alias("bit")).distinct().repartition("part")

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: dict[int, np.ndarray] = {}
        for frame in frames:
            for part, rows in frame.groupby("part").indices.items():
                parts.setdefault(part, np.zeros(1 << PART_BITS, dtype=bool))[frame["bit"].to_numpy()[rows]] = True
        if parts:
            yield pd.DataFrame({"part": list(parts), "bits": [np.packbits(p).tobytes() for p in parts.values()]})

    out = np.zeros(1 << MAP_BITS >> 3, dtype=np.uint8)
    size = 1 << PART_BITS >> 3
    for r in dealt.mapInPandas(fill, "part int, bits binary").collect():
        out[r["part"] * size : (r["part"] + 1) * size] |= np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    top = (hashes.astype(np.uint64) >> np.uint64(64 - MAP_BITS)).astype(np.int64)
    return (bits[top >> 3] >> (7 - (top & 7)).astype(np.uint8)) & 1 == 1
