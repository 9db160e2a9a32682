"""Slowly changing tables: row hashes, type 2 and type 1 merges, repair, migration, append.

Type 2 rows carry a validity interval [start, end) and a current flag. An open row ends 9999-12-31.
When a key disappears from the source, its open row is closed and a tombstone - a current row with no
end - takes its place, so that a later return of the key is seen as a new start.

A merge is one full outer join between the current rows and the source. Closed history never enters
the join, and every key occurs once on each side, so no key can become a hot group.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions.bounds import DateLike, day
from daymark.functions.cleaning import clean_strings
from daymark.operators.dedup import first_per_key
from daymark.operators.joins import join_splitting
from daymark.operators.sequence import number_rows
from daymark.sources.versions import CURRENT, END, OPEN_END, START, current, versions_as_of

HASH = "row_hash_value"
CREATE_USER, CREATE_TS = "ctrl_create_user_id", "ctrl_create_ts"
UPDATE_USER, UPDATE_TS = "ctrl_last_update_user_id", "ctrl_last_update_ts"
VERSION_COLUMNS = (START, END, CURRENT)
CONTROL_COLUMNS = (CREATE_USER, CREATE_TS, UPDATE_USER, UPDATE_TS)

ACTION = "scd_action"
UNCHANGED, CLOSED, INSERTED, DELETED = "unchanged", "closed", "inserted", "deleted"
#: Column of ``scd1_changes``: partition values of the row that a change replaces.
LEFT = "scd_left"
#: Column of ``latest_state``: the highest id of a key's rows.
HIGHEST = "highest_id"

SEPARATOR, NULL_MARK = "\x1f", "__NULL__"


def data_columns(columns: Iterable[str], exclude: Iterable[str] = ()) -> list[str]:
    """Columns that describe the row itself, in a fixed order."""
    left_out = {HASH, *VERSION_COLUMNS, *CONTROL_COLUMNS, *exclude}
    return sorted(name for name in columns if name not in left_out)


def row_hash(columns: Sequence[str], separator: str = SEPARATOR, null_mark: str = NULL_MARK) -> Column:
    """md5 over the values in order; the separator keeps ('ab','c') and ('a','bc') apart.

    An empty separator gives the hashes of tables that were filled without one.
    """
    parts = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(null_mark)) for name in columns]
    return F.md5(F.concat_ws(separator, *parts))


def with_row_hash(df: DataFrame, partitions: Iterable[str] = (), separator: str = SEPARATOR) -> DataFrame:
    return df.withColumn(HASH, row_hash(data_columns(df.columns, partitions), separator))


def with_version_columns(df: DataFrame, run_date: DateLike) -> DataFrame:
    return df.withColumns(
        {START: day(run_date), END: F.lit(OPEN_END).cast("date"), CURRENT: F.lit("Y")}
    )


def with_control_columns(df: DataFrame, user: str, now: dt.datetime) -> DataFrame:
    stamp = F.lit(now).cast("timestamp")
    return df.withColumns(
        {CREATE_USER: F.lit(user), CREATE_TS: stamp, UPDATE_USER: F.lit(user), UPDATE_TS: stamp}
    )


def _has_control(df: DataFrame) -> bool:
    return set(CONTROL_COLUMNS) <= set(df.columns)


def _sides(target: DataFrame, source: DataFrame, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Both states of every key side by side, as structs ``old`` and ``new``.

    Rows without a complete key match nothing; each gets a place of its own instead of all meeting in the
    task of the NULL key. A complete key that the source holds more than once ends the job: its rows are
    counted in the shuffle that the join needs anyway.

    ``buckets`` says that the target is a table bucketed by the keys: the source is then dealt to as many buckets and joined by the keys alone, so
    that the target's rows stay where they are. Rows without a complete key go around the join.
    """
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])

    def side(df: DataFrame, name: str, alone: Column | None) -> DataFrame:
        place = [] if alone is None else [F.when(complete, F.lit(0).cast("long")).otherwise(alone).alias(f"{name}_place")]
        return df.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], *place, F.struct(*df.columns).alias(name))

    own = buckets is None
    left = side(target if own else target.where(complete), "old", F.xxhash64(*target.columns) if own else None)
    arriving = side(source if own else source.where(complete).repartition(buckets, *keys), "new", 1 + F.monotonically_increasing_id() if own else None)
    matching = [*keys, "place"] if own else list(keys)
    where = [f"new_{k}" for k in matching]
    right = arriving.groupBy(*where).agg(F.first("new").alias("new"), F.count(F.lit(1)).alias("__times"))
    shown = F.concat_ws(", ", *[F.col(f"new_{k}").cast("string") for k in keys])
    twice = F.raise_error(F.concat(F.lit("the source holds a key more than once: "), shown))
    right = right.withColumn("new", F.when(F.col("__times") > 1, twice).otherwise(F.col("new")))
    matched = [F.col(f"old_{k}") == F.col(f"new_{k}") for k in matching]
    sides = left.join(right, matched, "full_outer").select("old", "new")
    if own:
        return sides
    types = dict(sides.dtypes)
    none = lambda name: F.lit(None).cast(types[name]).alias(name)
    gone = target.where(~complete).select(F.struct(*target.columns).alias("old"), none("new"))
    came = source.where(~complete).select(none("old"), F.struct(*source.columns).alias("new"))
    return sides.unionByName(gone).unionByName(came)


def scd2_step(
    current_rows: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_date: DateLike,
    user: str = "daymark",
    now: dt.datetime | None = None,
    partitions: Iterable[str] = (),
    separator: str = SEPARATOR,
    buckets: int | None = None,
) -> DataFrame:
    """What becomes of the current rows when the source is applied, with an ``scd_action`` column.

    The output holds every row that is current afterwards and every row closed by this run. A row that
    was opened on the run date itself is replaced, not closed: it was never valid for a whole day. A run
    dated before the start of a row that it would close ends the job, since that row would have no day left.

    ``buckets``: the current rows come from a table with so many buckets by the keys (``tables.save_bucketed``), and only the source is shuffled.
    """
    control = _has_control(current_rows)
    if control and now is None:
        raise ValueError("the table has control columns: pass the time of the run as now")
    columns = [name for name in current_rows.columns if name not in {HASH, *VERSION_COLUMNS, *CONTROL_COLUMNS}]
    types = dict(current_rows.dtypes)
    # hashes are taken of what the table would hold, so a source of other types doesn't look changed
    hashed = with_row_hash(source.select(*[F.col(name).cast(types[name]).alias(name) for name in columns]), partitions, separator)

    old, new = F.col("old"), F.col("new")
    there, arrives = old.isNotNull(), new.isNotNull()
    tombstone = there & old[END].isNull()
    same = F.coalesce(old[HASH] == new[HASH], F.lit(False))
    kept = there & F.when(tombstone, ~arrives).otherwise(arrives & same)
    stamp = {}
    if control:
        stamp = {
            CREATE_USER: F.lit(user),
            CREATE_TS: F.lit(now).cast("timestamp"),
            UPDATE_USER: F.lit(user),
            UPDATE_TS: F.lit(now).cast("timestamp"),
        }

    def row(values: dict[str, Column], action: Column) -> Column:
        ordered = [values[name].cast(types[name]).alias(name) for name in current_rows.columns]
        return F.struct(*ordered, action.alias(ACTION))

    before = {name: old[name] for name in [*columns, HASH]}
    before[START] = old[START]
    before[END] = F.when(kept | tombstone, old[END]).otherwise(day(run_date))
    before[CURRENT] = F.when(kept, F.lit("Y")).otherwise(F.lit("N"))
    after = {name: F.when(arrives, new[name]).otherwise(old[name]) for name in [*columns, HASH]}
    after[START] = day(run_date)
    after[END] = F.when(arrives, F.lit(OPEN_END).cast("date"))
    after[CURRENT] = F.lit("Y")
    if control:
        before[CREATE_USER], before[CREATE_TS] = old[CREATE_USER], old[CREATE_TS]
        before[UPDATE_USER] = F.when(kept, old[UPDATE_USER]).otherwise(stamp[UPDATE_USER])
        before[UPDATE_TS] = F.when(kept, old[UPDATE_TS]).otherwise(stamp[UPDATE_TS])
        after |= stamp

    late = there & ~kept & F.coalesce(old[START] > day(run_date), F.lit(False))
    shown = F.concat_ws(", ", *[old[k].cast("string") for k in keys])
    refused = F.raise_error(F.concat(F.lit(f"the run date {run_date} is before the start of an open row: "), shown)).cast("boolean")
    keep_old = there & F.when(late, refused).otherwise(kept | (old[START] < day(run_date)))
    make_new = (arrives & ~kept) | (there & ~tombstone & ~arrives)
    versions = F.array(
        F.when(keep_old, row(before, F.when(kept, F.lit(UNCHANGED)).otherwise(F.lit(CLOSED)))),
        F.when(make_new, row(after, F.when(arrives, F.lit(INSERTED)).otherwise(F.lit(DELETED)))),
    )
    # a version that does not arise is a row of NULLs here
    return _sides(current_rows, hashed, keys, buckets).select(F.inline(versions)).where(F.col(ACTION).isNotNull())


def scd2_merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str], run_date: DateLike, repair: bool = False, **options
) -> DataFrame:
    """The whole table after the source is applied; ``repair`` first removes repeated versions.

    The keys are business keys: the source holds each of them once, else the job ends.
    """
    target = scd2_repair(target, keys) if repair else target
    step = scd2_step(current(target), source, keys, run_date, **options)
    history = target.where(~F.coalesce(F.col(CURRENT) == "Y", F.lit(False)))
    return history.unionByName(step.drop(ACTION))


def scd2_changes(target: DataFrame, source: DataFrame, keys: Sequence[str], run_date: DateLike, **options) -> DataFrame:
    """Only the rows the merge closes or opens, with what happened to them."""
    step = scd2_step(current(target), source, keys, run_date, **options)
    return step.where(F.col(ACTION) != UNCHANGED)


def scd1_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    user: str = "daymark",
    now: dt.datetime | None = None,
    partitions: Iterable[str] = (),
    separator: str = SEPARATOR,
) -> DataFrame:
    """New and changed keys take the source row, all others stay; creation stamps survive an update."""
    control = _has_control(target)
    if control and now is None:
        raise ValueError("the table has control columns: pass the time of the run as now")
    columns = [name for name in target.columns if name not in {HASH, *CONTROL_COLUMNS}]
    types = dict(target.dtypes)
    # hashes are taken of what the table would hold, so a source of other types doesn't look changed
    hashed = with_row_hash(source.select(*[F.col(name).cast(types[name]).alias(name) for name in columns]), partitions, separator)
    old, new = F.col("old"), F.col("new")
    same = F.coalesce(old[HASH] == new[HASH], F.lit(False))
    update = new.isNotNull() & ~same
    merged = {name: F.when(update, new[name]).otherwise(old[name]) for name in [*columns, HASH]}
    if control:
        stamp = F.lit(now).cast("timestamp")
        first_seen = old.isNull()
        merged[CREATE_USER] = F.when(first_seen, F.lit(user)).otherwise(old[CREATE_USER])
        merged[CREATE_TS] = F.when(first_seen, stamp).otherwise(old[CREATE_TS])
        merged[UPDATE_USER] = F.when(update, F.lit(user)).otherwise(old[UPDATE_USER])
        merged[UPDATE_TS] = F.when(update, stamp).otherwise(old[UPDATE_TS])
    return _sides(target, hashed, keys).select(
        *[merged[name].cast(types[name]).alias(name) for name in target.columns]
    )


def scd1_changes(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    table_partitions: Sequence[str] = (),
    user: str = "daymark",
    now: dt.datetime | None = None,
    partitions: Iterable[str] = (),
    separator: str = SEPARATOR,
) -> DataFrame:
    """The rows of an ``scd1_merge`` that are new or differ, with ``scd_left``: the partition values of the row that each replaces, null if there was none.

    ``table_partitions`` are the columns that the table is partitioned by; a key whose values of these differ counts as changed even where they
    are not part of the hash (``partitions``). Of the target keys, hashes, partition values and creation stamps are read, nothing else.
    """
    control = _has_control(target)
    if control and now is None:
        raise ValueError("the table has control columns: pass the time of the run as now")
    columns = [name for name in target.columns if name not in {HASH, *CONTROL_COLUMNS}]
    types = dict(target.dtypes)
    hashed = with_row_hash(source.select(*[F.col(name).cast(types[name]).alias(name) for name in columns]), partitions, separator)
    narrow = target.select(*dict.fromkeys([*keys, HASH, *table_partitions, *((CREATE_USER, CREATE_TS) if control else ())]))
    old, new = F.col("old"), F.col("new")
    same = F.coalesce(old[HASH] == new[HASH], F.lit(False))
    for name in table_partitions:
        same = same & old[name].eqNullSafe(new[name])
    merged = {name: new[name] for name in [*columns, HASH]}
    if control:
        stamp = F.lit(now).cast("timestamp")
        merged[CREATE_USER] = F.when(old.isNull(), F.lit(user)).otherwise(old[CREATE_USER])
        merged[CREATE_TS] = F.when(old.isNull(), stamp).otherwise(old[CREATE_TS])
        merged[UPDATE_USER], merged[UPDATE_TS] = F.lit(user), stamp
    left = [F.when(old.isNotNull(), F.struct(*[old[p].alias(p) for p in table_partitions])).alias(LEFT)] if table_partitions else [F.lit(None).cast("string").alias(LEFT)]
    changed = _sides(narrow, hashed, keys).where(new.isNotNull() & ~same)
    return changed.select(*[merged[name].cast(types[name]).alias(name) for name in target.columns], *left)


def scd2_repair(target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join versions of equal content whose intervals meet, and drop further current rows of a key.

    A chain of such versions becomes one row with the whole interval: its open row with the earliest start,
    else its first row with the latest end. Equal content that comes back after a gap is a version of its own and stays. Of several
    current rows of a key the open one stays, else the one with the earliest start, else the one created first.

    Damage is looked for on keys, hashes and dates alone. Only rows of damaged contents or keys are carried
    through the windows that repair them; all others pass by.
    """
    columns, group = target.columns, [*keys, HASH]
    dated = target.where(F.col(END).isNotNull() & F.col(HASH).isNotNull())
    starts = dated.select(*group, F.col(START).alias("__meets"))
    chained = dated.select(*group, F.col(END).alias("__meets")).join(starts, [*group, "__meets"], "left_semi").select(*group).distinct()
    marked = join_splitting(target, chained.withColumn("__chained", F.lit(True)), group)
    broken = F.coalesce(F.col("__chained"), F.lit(False)) & F.col(END).isNotNull()
    chains = _joined_chains(marked.where(broken).select(*columns), group)
    whole = marked.where(~broken).select(*columns).unionByName(chains)

    is_current = F.coalesce(F.col(CURRENT) == "Y", F.lit(False))
    crowded = whole.where(is_current).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select(*keys, F.lit(True).alias("__crowded"))
    judged = join_splitting(whole, crowded, keys)
    several = is_current & F.coalesce(F.col("__crowded"), F.lit(False))
    best = first_per_key(judged.where(several), keys, _preference(columns))
    return judged.where(~several).select(*columns).unionByName(best.select(*columns))


def _preference(columns: Sequence[str]) -> list[Column]:
    """Open rows first, then early starts, then early creation; the rest makes the choice repeatable."""
    is_open = F.coalesce(F.col(END) == F.lit(OPEN_END).cast("date"), F.lit(False))
    created = [F.col(CREATE_TS)] if CREATE_TS in columns else []
    rest = [F.col(f"`{name}`") for name in columns if name not in {START, CREATE_TS}]
    return [F.when(is_open, 0).otherwise(1), F.col(START), *created, *rest]


def _joined_chains(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """One row per run of versions whose intervals meet or overlap, with the run's whole interval."""
    in_order = Window.partitionBy(*group).orderBy(F.col(START), F.col(END))
    reached = F.max(END).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (F.col(START) > reached), 1).otherwise(0)
    numbered = rows.withColumn("__begins", begins).withColumn("__chain", F.sum("__begins").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    chain = Window.partitionBy(*group, "__chain")
    spanned = numbered.withColumns({"__from": F.min(START).over(chain), "__to": F.max(END).over(chain)})
    chosen = first_per_key(spanned, [*group, "__chain"], _preference(rows.columns))
    return chosen.withColumns({START: F.col("__from"), END: F.col("__to")}).select(*rows.columns)


def migrate_to_scd2(
    old: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_date: DateLike,
    user: str = "daymark",
    now: dt.datetime | None = None,
    partitions: Iterable[str] = (),
    initial_date: DateLike | None = None,
) -> DataFrame:
    """Give an unversioned table validity columns, its rows being current, then apply the source."""
    unversioned = old
    versioned = None
    if set(VERSION_COLUMNS) <= set(old.columns):
        bare = F.col(START).isNull() & F.col(END).isNull() & F.col(CURRENT).isNull()
        unversioned, versioned = old.where(bare), old.where(~bare)
    rows = with_row_hash(unversioned.drop(HASH, *VERSION_COLUMNS, *CONTROL_COLUMNS), partitions)
    rows = with_version_columns(rows, initial_date or run_date)
    if now is not None:
        rows = with_control_columns(rows, user, now)
    if versioned is not None:
        rows = versioned.unionByName(rows, allowMissingColumns=True).select(*rows.columns)
    return scd2_merge(rows, source, keys, run_date, user=user, now=now, partitions=partitions)


def scd2_append(
    history: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_date: DateLike,
    id_column: str | None = None,
    column: str = "actual_date",
    clean: bool = True,
    partitions: Iterable[str] = (),
) -> DataFrame:
    """Rows to append to an append-only version table: keys that are new or whose content differs from
    their latest row. With ``id_column`` they get surrogate ids that go on from the highest one. Rows without a complete key
    are compared by their whole content: they are appended when no row of the history has it."""
    incoming = clean_strings(source) if clean else source
    compared = data_columns(incoming.columns, [*partitions, column, *([id_column] if id_column else [])])
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    latest = versions_as_of(history.where(complete), keys, run_date, column).select(
        *keys, row_hash(compared).alias("__known")
    )
    hashed = incoming.withColumn("__hash", row_hash(compared))
    keyed = join_splitting(hashed.where(complete), latest, keys).where(
        F.col("__known").isNull() | (F.col("__known") != F.col("__hash"))
    )
    seen = history.where(~complete & (F.col(column) <= day(run_date))).select(row_hash(compared).alias("__hash")).distinct()
    keyless = hashed.where(~complete).join(seen, "__hash", "left_anti")
    fresh = keyed.drop("__known", "__hash").unionByName(keyless.drop("__hash")).withColumn(column, day(run_date))
    if id_column is None:
        return fresh.select(*history.columns)
    last_id = history.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("long").alias("last_id")).scalar()
    return number_rows(fresh, list(keys), last_id, id_column).select(*history.columns)


def latest_state(
    history: DataFrame, keys: Sequence[str], id_column: str | None = None, column: str = "actual_date", partitions: Iterable[str] = ()
) -> DataFrame:
    """What an append needs to know of an append-only version table: per key hash, date and id of its latest row and the highest id (``highest_id``).

    Rows without a complete key are told by their content: one row for each. Of several rows of a key and day the one with the highest id counts, of
    equal or no ids the one with the highest hash.
    """
    ids = [id_column] if id_column else []
    compared = data_columns(history.columns, [*partitions, column, *ids])
    hashed = history.select(*keys, column, *ids, row_hash(compared).alias(HASH), *[F.col(i).alias(HIGHEST) for i in ids])
    return _latest(hashed, keys, id_column, column)


def next_state(
    state: DataFrame, appended: DataFrame, keys: Sequence[str], id_column: str | None = None, column: str = "actual_date", partitions: Iterable[str] = ()
) -> DataFrame:
    """The state after rows were appended; to be stored with them."""
    fresh = latest_state(appended, keys, id_column, column, partitions)
    return _latest(state.unionByName(fresh), keys, id_column, column)


def _latest(rows: DataFrame, keys: Sequence[str], id_column: str | None, column: str) -> DataFrame:
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    ids = [id_column] if id_column else []
    highest = [F.max(HIGHEST).alias(HIGHEST)] if id_column else []
    latest = rows.groupBy(*keys, F.when(~complete, F.col(HASH)).alias("__content")).agg(F.max(F.struct(column, *ids, HASH)).alias("__latest"), *highest)
    return latest.select(*keys, *[F.col("__latest")[c].alias(c) for c in (HASH, column, *ids)], *([HIGHEST] if id_column else []))


def scd2_append_indexed(
    state: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_date: DateLike,
    id_column: str | None = None,
    column: str = "actual_date",
    clean: bool = True,
    partitions: Iterable[str] = (),
) -> DataFrame:
    """``scd2_append`` against a stored ``latest_state`` in place of the history, which isn't read.

    Returns the rows to append: the source's columns, then id and date. A run dated before the latest row of a key that it brings ends the job, because
    the state doesn't know what was valid before.
    """
    incoming = clean_strings(source) if clean else source
    compared = data_columns(incoming.columns, [*partitions, column, *([id_column] if id_column else [])])
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    hashed = incoming.withColumn("__hash", row_hash(compared))
    known = state.where(complete).select(*keys, F.col(HASH).alias("__known"), F.col(column).alias("__since"))
    joined = join_splitting(hashed.where(complete), known, keys)
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    late = F.raise_error(F.concat(F.lit(f"the run date {run_date} is before the latest row of: "), shown)).cast("boolean")
    keep = F.when(F.col("__since") > day(run_date), late).otherwise(F.col("__known").isNull() | (F.col("__known") != F.col("__hash")))
    seen = state.where(~complete).select(F.col(HASH).alias("__hash")).distinct()
    keyless = hashed.where(~complete).join(seen, "__hash", "left_anti")
    fresh = joined.where(keep).select(*incoming.columns).unionByName(keyless.select(*incoming.columns))
    columns = [c for c in incoming.columns if c not in (id_column, column)]
    fresh = fresh.select(*columns).withColumn(column, day(run_date))
    if id_column is None:
        return fresh
    last_id = state.agg(F.coalesce(F.max(HIGHEST), F.lit(0)).cast("long").alias("last_id")).scalar()
    return number_rows(fresh, list(keys), last_id, id_column).select(*columns, id_column, column)
