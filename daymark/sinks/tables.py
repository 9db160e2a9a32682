"""Catalog tables: creating, writing, exporting to and compacting."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.operators import quality
from daymark.operators.contract import TableContract, conform, partitions_last
from daymark.operators.scd import ACTION, CLOSED, LEFT, UNCHANGED
from daymark.shared import scratch_path, settle
from daymark.sources.versions import START_MONTH

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def _partition_overwrite(spark: SparkSession, mode: str) -> Iterator[None]:
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def quote(table: str) -> str:
    return ".".join(f"`{part.strip('`')}`" for part in table.split("."))


# --- creation ---------------------------------------------------------------------------------------


def create_table(
    spark: SparkSession,
    table: str,
    contract: TableContract,
    location: str | None,
    replace: bool = False,
    file_format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> bool:
    """Create a table from its contract unless it exists; True when it was created."""
    if location is None:
        raise ValueError(f"no location given for table {table}")
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {quote(table)}")
    elif spark.catalog.tableExists(table):
        return False
    columns = ", ".join(f"`{c.name}` {c.data_type}" for c in contract.columns)
    clauses = [f"CREATE TABLE {quote(table)} ({columns}) USING {file_format}"]
    if options:
        clauses.append("OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")")
    if contract.partitions:
        clauses.append(f"PARTITIONED BY ({', '.join(f'`{p}`' for p in contract.partitions)})")
    clauses.append(f"LOCATION '{location}'")
    if contract.comment:
        comment = contract.comment.replace("\\", "\\\\").replace("'", "\\'")
        clauses.append(f"COMMENT '{comment}'")
    spark.sql(" ".join(clauses))
    return True


def create_delimited_table(
    spark: SparkSession, table: str, contract: TableContract, location: str, replace: bool = True, separator: str = "|"
) -> bool:
    """A table over delimited text files."""
    return create_table(spark, table, contract, location, replace, "csv", {"sep": separator, "header": "false"})


def create_all(
    spark: SparkSession, database: str, root: str, contracts: Iterable[TableContract], replace: bool = True
) -> list[str]:
    created = []
    for contract in contracts:
        table = f"{database}.{contract.name}"
        if create_table(spark, table, contract, f"{root.rstrip('/')}/{contract.name}", replace):
            created.append(table)
    return created


# --- layout -----------------------------------------------------------------------------------------


def spread(df: DataFrame, partitions: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Cluster rows by table partition before a write, so that a task writes few files.

    Without an explicit number Spark may split a partition value that holds most of the rows over
    several tasks (AQE rebalancing), where a plain repartition would send it to one.
    """
    if not partitions and not order:
        return df
    if partitions:
        df = df.hint("rebalance", *[F.col(name) for name in partitions])
    return df.sortWithinPartitions(*partitions, *order)


# --- writing ----------------------------------------------------------------------------------------


def write_table(
    df: DataFrame,
    table: str,
    contract: TableContract | None = None,
    mode: str = "overwrite",
    strict: bool = True,
    clustered: bool = True,
    replacing: Mapping[str, object] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Insert by column name. An overwrite of a partitioned table replaces only the partitions written.

    ``replacing`` names one partition by the values of all partition columns: it is replaced by the rows
    of that partition even when there are none, and rows of others are refused.
    """
    spark = df.sparkSession
    if contract is not None:
        df = conform(df, contract, strict)
    target = spark.catalog.listColumns(table)
    missing = [c.name for c in target if c.name not in df.columns]
    if missing:
        raise ValueError(f"{table}: columns missing from the frame: {missing}")
    rows = df.select(*[F.col(f"`{c.name}`") for c in target])
    if clustered:
        order = contract.write_ordered_by if contract is not None else ()
        rows = spread(rows, [c.name for c in target if c.isPartition], order)
    if tasks is not None:
        rows = rows.repartition(tasks)
    if replacing is not None:
        _replace_partition(rows, table, {c.name: replacing[c.name] for c in target if c.isPartition})
        return df
    with _partition_overwrite(spark, "dynamic"):
        rows.write.mode(mode).insertInto(quote(table))
    return df


#: How a partition whose value is NULL is named.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Values of all partition columns, as text; None stands for NULL.
Values = tuple[str | None, ...]


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def partition_names(spark: SparkSession, table: str) -> dict[Values, str]:
    """Partitions of a table: their values, unescaped, and the names of their folders."""
    names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {quote(table)}").collect()]
    return {tuple(None if (v := part.split("=", 1)[1]) == NULL_PARTITION else unquote(v) for part in name.split("/")): name for name in names}


def values_of(df: DataFrame, partitions: Sequence[str]) -> set[Values]:
    """Values of the partition columns that rows have, written as partitions are named."""
    return {tuple(r) for r in df.select(*[F.col(f"`{p}`").cast("string") for p in partitions]).distinct().collect()}


def in_partitions(partitions: Sequence[str], chosen: Iterable[Values], types: Mapping[str, str]) -> Column:
    """Rows of the chosen partitions: a filter on the columns themselves, which prunes."""

    def one(name: str, value: str | None) -> Column:
        return F.col(f"`{name}`").isNull() if value is None else F.col(f"`{name}`") == F.lit(value).cast(types[name])

    return reduce(or_, [reduce(and_, [one(p, v) for p, v in zip(partitions, values, strict=True)]) for values in sorted(chosen, key=repr)], F.lit(False))


def _literal(value: object) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(values: Mapping[str, object]) -> str:
    return ", ".join(f"`{name}` = {_literal(value)}" for name, value in values.items())


def _replace_partition(rows: DataFrame, table: str, values: Mapping[str, object]) -> None:
    """Overwrite exactly one partition, also by nothing."""
    inside = [F.col(name).cast("string").eqNullSafe(F.lit(None if value is None else str(value)).cast("string")) for name, value in values.items()]
    other = F.raise_error(F.lit(f"{table}: a row belongs to another partition than {dict(values)}")).cast("boolean")
    own = rows.where(F.when(reduce(and_, inside), F.lit(True)).otherwise(other)).drop(*values)
    view = f"replacing_{uuid.uuid4().hex}"
    own.createOrReplaceTempView(view)
    try:
        rows.sparkSession.sql(f"INSERT OVERWRITE TABLE {quote(table)} PARTITION ({_spec(values)}) SELECT * FROM {view}")
    finally:
        rows.sparkSession.catalog.dropTempView(view)


def drop_partitions(spark: SparkSession, table: str, chosen: Iterable[Values]) -> None:
    """Empty partitions and take them out of the catalog; ones that aren't there are passed over."""
    partitions = partition_columns(spark, table)
    there = partition_names(spark, table)
    nothing = spark.createDataFrame([], spark.table(table).schema)
    for values in sorted(set(chosen) & there.keys(), key=repr):
        named = dict(zip(partitions, values, strict=True))
        _replace_partition(nothing, table, named)
        spark.sql(f"ALTER TABLE {quote(table)} DROP IF EXISTS PARTITION ({_spec(named)})")


def write_parts(frames: Sequence[DataFrame], table: str, mode: str = "overwrite", **options) -> DataFrame | None:
    """Several frames into one table: united by name and written once. None, and nothing happens, when all are empty."""
    if not frames:
        return None
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole if _write_if_any(whole, table, mode, options) else None


def write_each(frames: Mapping[str, DataFrame], mode: str = "overwrite", **options) -> list[str]:
    """One table per frame; empty frames are passed over. Returns the tables written."""
    return [table for table, frame in frames.items() if _write_if_any(frame, table, mode, options)]


def _write_if_any(df: DataFrame, table: str, mode: str, options: Mapping[str, object]) -> bool:
    """Write a frame and tell whether it had rows, counted by the write. Only where an empty write would
    clear the table - an overwrite without partitions - the frame is looked at beforehand."""
    partitioned = any(c.isPartition for c in df.sparkSession.catalog.listColumns(table))
    if mode == "overwrite" and not partitioned and df.isEmpty():
        return False
    return write_with_metrics(df, table, mode=mode, **options)["rows"] > 0


def save_table(
    df: DataFrame,
    table: str,
    path: str,
    partitions: Sequence[str] = (),
    mode: str = "overwrite",
    cut_lineage: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """``saveAsTable`` at a path, partition columns last, optionally checkpointed before."""
    if partitions:
        df = partitions_last(df, partitions)
    if cut_lineage:
        df = settle(df)
    if tasks is not None:
        df = df.repartition(tasks)
    writer = df.write.mode(mode).option("path", path)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.saveAsTable(quote(table))
    return df


# --- versioned tables -------------------------------------------------------------------------------


def write_scd2_step(
    step: DataFrame, table: str, action: str = "scd_action", closed: str = "closed", resume_keys: Sequence[str] | None = None
) -> None:
    """Apply an ``scd2_step`` to its table, which is partitioned by the current flag.

    Rows closed by the run are appended to the history; the current partition is then replaced. The
    step is settled first, because its input is the very partition that gets replaced. A run that broke
    off between the two writes can be repeated: closed rows that the history holds already are not appended
    again. They are told by ``resume_keys``, by default by all columns but the control columns, and are looked for only among rows
    that end where closed rows end.
    """
    rows = settle(step)
    ended = rows.where(F.col(action) == closed).drop(action)
    _append_missing(ended, step.sparkSession.table(table).where("current_row_flag = 'N'"), table, resume_keys)
    write_table(rows.where(F.col(action) != closed).drop(action), table, mode="overwrite")


def _append_missing(ended: DataFrame, history: DataFrame, table: str, resume_keys: Sequence[str] | None) -> None:
    """Append closed rows that the history doesn't hold yet."""
    same = resume_keys or [c for c in ended.columns if not c.startswith("ctrl_") and c != "current_row_flag"]
    ends = [r[0] for r in ended.select("row_eff_end_date").distinct().collect()]  # the run date, and NULL of tombstones
    dates = [e for e in ends if e is not None]
    near = F.col("row_eff_end_date").isin(dates) if dates else F.lit(False)
    near = F.coalesce(near, F.lit(False)) | (F.col("row_eff_end_date").isNull() if None in ends else F.lit(False))
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in same])
    there = history.where(near).select(mark.alias("__mark"), F.struct(*[F.col(f"`{c}`") for c in same]).alias("__row")).distinct()
    fresh = ended.withColumn("__mark", mark).alias("e").join(
        there.alias("h"), (F.col("e.__mark") == F.col("h.__mark")) & F.struct(*[F.col(f"e.`{c}`") for c in same]).eqNullSafe(F.col("h.__row")), "left_anti"
    )
    write_table(settle(fresh.drop("__mark")), table, mode="append")


def write_scd2_months(step: DataFrame, table: str, resume_keys: Sequence[str] | None = None) -> None:
    """Apply an ``scd2_step`` to a table that is partitioned by the current flag and the month in which a version begins.

    The step has the derived month (``versions.with_start_month``). Rows that the run closes move from their month's current partition to
    its history; of the current partitions only those that lose or gain rows are written again, the others keep their files. Like
    ``write_scd2_step`` it can be repeated after it broke off.
    """
    spark = step.sparkSession
    rows = settle(step)
    flag, month = F.col("current_row_flag"), START_MONTH
    changed = rows.where(F.col(ACTION) != UNCHANGED)
    months = {v for (v,) in values_of(changed, [month])}
    closed = rows.where(F.col(ACTION) == CLOSED).drop(ACTION)
    types = dict(rows.dtypes)
    history = spark.table(table).where((flag == "N") & in_partitions([month], {(m,) for m in months}, types))
    _append_missing(closed, history, table, resume_keys)
    touched = rows.where((F.col(ACTION) != CLOSED) & in_partitions([month], {(m,) for m in months}, types)).drop(ACTION)
    held = values_of(touched, [month])
    write_table(touched, table, mode="overwrite")
    order = partition_columns(spark, table)
    drop_partitions(spark, table, [tuple("Y" if p == "current_row_flag" else m for p in order) for m in months if (m,) not in held])


def write_scd1(merged: DataFrame, table: str) -> None:
    """Put an ``scd1_merge`` in the place of the table that it read: the rows are settled, then written over it.

    Partitions of which the merge left no row are taken away. To write only the partitions that changed, see ``write_scd1_changes``.
    """
    spark, rows = merged.sparkSession, settle(merged)
    partitions = partition_columns(spark, table)
    write_table(rows, table, mode="overwrite")
    if partitions:
        drop_partitions(spark, table, partition_names(spark, table).keys() - values_of(rows, partitions))


def write_scd1_changes(changes: DataFrame, table: str, keys: Sequence[str]) -> dict[str, list[Values]]:
    """Apply ``scd1_changes`` to the table they were found in: only partitions that changed keys enter or leave are read in full and written.

    Keys that changed are taken out of the partitions that held them and put where they belong now; all these partitions are replaced in one
    commit. Those left without a row are dropped after it: until then a key that moved is in both, so a run that breaks off there is to be repeated
    with the same changes, which gives the same table. Returns the values of the partitions written and dropped.
    """
    spark, rows = changes.sparkSession, settle(changes)
    partitions = partition_columns(spark, table)
    target = spark.table(table)
    fresh = rows.drop(LEFT)
    if not partitions:
        if rows.isEmpty():
            return {"written": [], "dropped": []}
        stays = target.join(fresh.select(*keys), list(keys), "left_anti").select(*target.columns)
        write_table(settle(stays.unionByName(fresh)), table, mode="overwrite")
        return {"written": [()], "dropped": []}
    left = rows.where(F.col(LEFT).isNotNull()).select(f"{LEFT}.*")
    touched = values_of(fresh, partitions) | values_of(left, partitions)
    held = target.where(in_partitions(partitions, touched, dict(target.dtypes)))
    stays = held.join(fresh.select(*keys), list(keys), "left_anti").select(*target.columns)
    whole = settle(stays.unionByName(fresh))
    filled = values_of(whole, partitions)
    write_table(whole, table, mode="overwrite")
    drop_partitions(spark, table, touched - filled)
    return {"written": sorted(filled, key=repr), "dropped": sorted(touched - filled, key=repr)}


# --- bucketed current rows --------------------------------------------------------------------------


def save_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int, spread_rows: bool = True) -> None:
    """A table whose files are bucketed and sorted by the keys, so that merges into it don't shuffle it.

    ``spread_rows=False`` is for rows that already lie by bucket, as a merge into such a table leaves them: nothing moves and a bucket stays one file.
    """
    rows = df.repartition(buckets, *keys) if spread_rows else df
    rows.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(quote(table))


def replace_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Put rows that were merged from a bucketed table in its place: written beside it, then taken into use under its name."""
    beside = f"{table}_{uuid.uuid4().hex[:12]}"
    save_bucketed(df, beside, path, keys, buckets, spread_rows=False)
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {quote(table)}")
    spark.sql(f"ALTER TABLE {quote(beside)} RENAME TO {quote(table)}")


# --- upkeep -----------------------------------------------------------------------------------------


#: Bytes of a file that compaction aims at.
FILE_BYTES = 128 << 20


class TableChanged(RuntimeError):
    """Files of a table are others than those that were read."""


def file_stats(df: DataFrame, partitions: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``file, bytes, rows, least, most`` of the files under a frame, with their partition values as text: only the sort columns are read."""
    key = F.struct(*[F.col(f"`{c}`") for c in order]) if order else F.lit(0)
    named = df.select(
        *[F.col(f"`{p}`").cast("string").alias(p) for p in partitions], F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), key.alias("__key")
    )
    return named.groupBy(*partitions, "file", "bytes").agg(F.count(F.lit(1)).alias("rows"), F.min("__key").alias("least"), F.max("__key").alias("most"))


def compaction_plan(df: DataFrame, partitions: Sequence[str], order: Sequence[str], file_bytes: int = FILE_BYTES) -> DataFrame:
    """Per partition ``files``, ``bytes``, ``rows``, the number of files ``wanted``, and whether it is to be rewritten.

    It is, if it has more files than its bytes fill (one more than the least is left alone where that is several), or if ranges of the sort columns overlap. The
    ranges of a partition's files are compared in their order, so the window holds a row per file.
    """
    stats = file_stats(df, partitions, order)
    by_key = Window.partitionBy(*partitions, F.lit(0)).orderBy("least", "most", "file")
    overlap = stats.withColumn("overlaps", F.coalesce(F.max("most").over(by_key.rowsBetween(Window.unboundedPreceding, -1)) > F.col("least"), F.lit(False)))
    whole = overlap.groupBy(*partitions).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.max("overlaps").alias("overlaps")
    )
    wanted = F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(file_bytes))).cast("int")
    planned = whole.withColumn("wanted", wanted)
    crowded = F.col("files") > F.when(F.col("wanted") == 1, 1).otherwise(F.col("wanted") + 1)
    return planned.withColumn("rewrite", crowded | F.col("overlaps"))


def compact(
    spark: SparkSession, table: str, path: str, order: Sequence[str], where: str | None = None, tasks: int | None = None, file_bytes: int = FILE_BYTES
) -> list[dict]:
    """Rewrite the partitions of a table that have too many or unsorted files, under a new ``path``, as few files with ranges of the sort columns.

    A partition that fits one file is written by one task. Larger ones are cut into ranges of (partition, sort columns), as many as their bytes fill
    (or ``tasks``). The new files stand beside the old ones; then each partition, or the table, is pointed at them. Readers see the old files or the new
    ones, and the old ones stay for who clears them up. If the table got or lost files meanwhile, ``TableChanged`` is raised and nothing is
    switched. ``where`` picks whole partitions, which are rewritten in any case; the others keep their place. Returns the plan of the partitions that were rewritten.
    """
    partitions = partition_columns(spark, table)
    order = [c for c in order if c not in partitions]
    spark.sql(f"REFRESH TABLE {quote(table)}")
    chosen = spark.table(table) if where is None else spark.table(table).where(where)
    before = sorted(chosen.inputFiles())
    judged = compaction_plan(chosen, partitions, order, file_bytes)
    plan = [r.asDict() for r in (judged.where("rewrite") if where is None else judged).collect()]
    if not plan:
        return []
    if not partitions and where is not None:
        raise ValueError(f"{table} has no partitions to choose from")
    types = dict(chosen.dtypes)
    values = lambda r: tuple(r[p] for p in partitions)
    small, large = [r for r in plan if r["wanted"] == 1], [r for r in plan if r["wanted"] > 1]
    for group, ranged in ((small, False), (large, True)):
        if not group:
            continue
        rows = chosen.where(in_partitions(partitions, [values(r) for r in group], types)) if partitions else chosen
        count = sum(r["wanted"] for r in group) if ranged else max(1, math.ceil(sum(r["bytes"] for r in group) / file_bytes))
        keys = [F.col(f"`{c}`") for c in ([*partitions, *order] if ranged else partitions)]
        dealt = rows.repartitionByRange(tasks or count, *keys) if ranged else rows.repartition(count, *keys) if keys else rows.repartition(1)
        writer = dealt.sortWithinPartitions(*partitions, *order).write.mode("append")
        (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    _refuse_if_changed(spark, table, where, before)
    switch_location(spark, table, path, partitions, chosen={values(r) for r in plan} if partitions else None)
    return plan


def _refuse_if_changed(spark: SparkSession, table: str, where: str | None, before: list[str]) -> None:
    spark.sql(f"REFRESH TABLE {quote(table)}")
    now = sorted((spark.table(table) if where is None else spark.table(table).where(where)).inputFiles())
    if now != before:
        raise TableChanged(f"{table} has other files than those that were read; nothing was switched")


def switch_location(
    spark: SparkSession, table: str, path: str, partitions: Sequence[str], where: str | None = None, chosen: Iterable[Values] | None = None
) -> None:
    """Point a table, or its partitions (all, those ``where`` picks, or those ``chosen``), at files that were written under ``path``."""
    if not partitions:
        spark.sql(f"ALTER TABLE {quote(table)} SET LOCATION '{path}'")
    else:
        names = partition_names(spark, table)
        if where is not None:
            chosen = values_of(spark.table(table).where(where), partitions)
        for values in names if chosen is None else sorted(set(chosen) & names.keys(), key=repr):
            spec = _spec(dict(zip(partitions, values, strict=True)))
            spark.sql(f"ALTER TABLE {quote(table)} PARTITION ({spec}) SET LOCATION {_literal(path.rstrip('/') + '/' + names[values])}")
    spark.sql(f"REFRESH TABLE {quote(table)}")


def copy_table(spark: SparkSession, table: str, copy: str, path: str, validate: bool = True) -> None:
    """Copy a table and check that the copy holds the same rows: by digests per partition, row by row only where these differ."""
    source = spark.table(table)
    partitions = partition_columns(spark, table)
    save_table(spread(source, partitions), copy, path, partitions)
    if validate:
        _refuse_if_differing(source, spark.table(copy), partitions, f"{copy} differs from {table}")


def copy_in_place(spark: SparkSession, table: str, path: str) -> None:
    """Copy a table's files to a new path, check that they hold the same rows, and point the table at them. Raises ``TableChanged`` if the table
    got or lost files meanwhile."""
    spark.sql(f"REFRESH TABLE {quote(table)}")
    source = spark.table(table)
    before = sorted(source.inputFiles())
    partitions = partition_columns(spark, table)
    writer = spread(source, partitions).write
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    there = spark.read.schema(source.schema).parquet(path).select(*source.columns)
    _refuse_if_differing(source, there, partitions, f"the copy of {table} at {path} differs")
    _refuse_if_changed(spark, table, None, before)
    switch_location(spark, table, path, partitions)


def _refuse_if_differing(source: DataFrame, copy: DataFrame, partitions: Sequence[str], what: str) -> None:
    from daymark.operators.reconcile import difference_by_digest

    differing = difference_by_digest(source, copy, partitions).agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first()["n"]
    if differing:
        raise ValueError(f"{what} in {differing} rows")


# --- metrics ----------------------------------------------------------------------------------------


def observed(df: DataFrame, name: str | None = None) -> tuple[DataFrame, Observation]:
    """The frame and an observation of its row count, filled in by the write itself."""
    observation = Observation(name or f"load_{uuid.uuid4().hex}")
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def write_with_metrics(df: DataFrame, table: str, **options) -> dict:
    watched, observation = observed(df)
    write_table(watched, table, **options)
    try:
        return {"table": table, **observation.get}
    except Py4JJavaError:  # the optimizer saw that there are no rows and took the count away with them
        return {"table": table, "rows": 0}


def write_checked(df: DataFrame, table: str, contract: TableContract, rejected: str | None = None, **options) -> dict:
    """Write the rows that pass the per-row checks of their contract, and those that don't to the table ``rejected``, with what they fail.

    The frame is computed once: it goes to the shared folder in two parts, passing and failing rows, and that write observes the
    count of each check. Each table is then written from its own part. Without ``rejected`` a failing row ends the job before the table is touched.
    ``options`` are those of ``write_table``. Returns ``rows``, ``rejected`` and ``checks`` (failing rows per 'check:column').
    """
    spark = df.sparkSession
    path, part = scratch_path(spark, "checked"), "__passes"
    marked = quality.mark_failures(df, contract)
    counts = quality.failure_counts(df, contract)
    observation = Observation(f"checked_{uuid.uuid4().hex}")
    passes = F.size(quality.FAILED) == 0
    numbered = [c.alias(f"c{i}") for i, c in enumerate(counts.values())]
    marked.observe(observation, F.count_if(passes).alias("rows"), F.count_if(~passes).alias("rejected"), *numbered).withColumn(part, passes.cast("int")).write.partitionBy(part).parquet(path)
    try:
        seen = observation.get
    except Py4JJavaError:  # the optimizer saw that there are no rows and took the counts away with them
        seen = {}
    told = {"table": table, "rows": seen.get("rows", 0), "rejected": seen.get("rejected", 0), "checks": {name: seen.get(f"c{i}", 0) for i, name in enumerate(counts)}}
    if told["rejected"] and rejected is None:
        raise ValueError(f"{told['rejected']} rows for {table} fail their checks: {told['checks']}")
    staged = spark.read.schema(T.StructType([*marked.schema.fields, T.StructField(part, T.IntegerType())])).parquet(path)
    write_table(staged.where(F.col(part) == 1).drop(part, quality.FAILED), table, contract, **options)
    if rejected is not None:
        write_table(staged.where(F.col(part) == 0).drop(part), rejected, mode="append", clustered=False)
    return told
