"""File exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.sinks.tables import spread


def text_lines(df: DataFrame, separator: str = "|", line_end: str = "\r") -> DataFrame:
    """One text column per row: fields joined, NULL as '', and a closing carriage return."""
    fields = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in df.columns]
    return df.select(F.concat(F.concat_ws(separator, *fields), F.lit(line_end)).alias("value"))


def write_text(df: DataFrame, path: str, separator: str = "|", mode: str = "overwrite", single_file: bool = False) -> None:
    """Delimited text without header. ``single_file`` funnels all rows into one task: small exports only."""
    lines = text_lines(df, separator)
    (lines.coalesce(1) if single_file else lines).write.mode(mode).text(path)


def write_parquet(
    df: DataFrame, path: str, partitions: Sequence[str] = (), mode: str = "overwrite", clustered: bool = True
) -> None:
    """Snappy Parquet under a path, replacing only the partitions written."""
    writer = (spread(df, partitions) if clustered else df).write.mode(mode).option("compression", "snappy")
    if partitions:
        writer = writer.partitionBy(*partitions).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_avro(df: DataFrame, path: str, mode: str = "overwrite", tasks: int = 0, compression: str = "snappy") -> bool:
    """Avro under a path; an empty frame leaves the target alone. Needs spark-avro on the classpath."""
    if df.isEmpty():
        return False
    rows = df.coalesce(tasks) if tasks > 0 else df
    rows.write.mode(mode).format("avro").option("compression", compression).save(path)
    return True
