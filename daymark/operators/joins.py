"""Joins by what they are for.

Catalyst broadcasts a side only when its known size is under the session's threshold, and AQE splits hot
partitions of the others. The only hint is ``growing``, for sides whose size the lengths of files don't tell.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.bounds import DateLike, day
from daymark.functions.cleaning import is_blank
from daymark.operators.dedup import any_per_key


def joined_key(*columns: Column | str) -> Column:
    """Trimmed parts run together into one join key."""
    return F.concat(*[F.trim(F.col(c) if isinstance(c, str) else c) for c in columns])


FRESH = "__fresh"


def growing(df: DataFrame) -> DataFrame:
    """A side that grows with the customers: its join is a merge, so that no copy of it passes through the driver.

    Before a shuffle Catalyst knows lengths of compressed files only, not exploded rows, long texts or what a row takes
    in memory. A broadcast planned on them stays when AQE has measured the side, as a merge would cost more shuffles by then.
    """
    return df.hint("merge")


def _hash_alike(left: DataFrame, right: DataFrame, on: Sequence[str]) -> bool:
    """Whether equal keys of both sides surely have equal hashes: same types, and no floating point."""
    types, others = dict(left.dtypes), dict(right.dtypes)
    return all(types[k] == others[k] and types[k] not in ("float", "double") for k in on)


def join_splitting(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which AQE can split the tasks of a hot left key.

    AQE splits a join only when both sides come straight out of a shuffle. A right side that was just
    grouped by the key keeps its partitioning and would take the left rows of a hot key into one task.
    The hash of the keys as one more join column makes both sides shuffle anew. Keys whose types differ
    between the sides are joined plainly, as their hashes need not agree.
    """
    if not _hash_alike(left, right, on):
        return left.join(right, list(on), how)
    fresh = F.xxhash64(*on)
    return left.withColumn(FRESH, fresh).join(right.withColumn(FRESH, fresh), [*on, FRESH], how).drop(FRESH)


def enrich(left: DataFrame, right: DataFrame, on: Sequence[str], one_per_key: bool = True) -> DataFrame:
    """Left join that cannot multiply rows: the right side is reduced to one row per key first."""
    return join_splitting(left, any_per_key(right, on) if one_per_key else right, on)


def enrich_known(
    left: DataFrame, right: DataFrame, key: str, scatter: Sequence[str], splitting: bool = True, grows: bool = False
) -> DataFrame:
    """Left join on a text key that many left rows lack.

    Rows without a key would all meet in one task, so each gets a key of its own, made from the
    ``scatter`` columns, that matches nothing. Hot keys can be split as in ``join_splitting``; where keys are
    close to unique on the left, ``splitting=False`` leaves a right side that was just grouped where it is. ``grows``: the
    right side is ``growing``.
    """
    joint = "__joint"
    spread = F.concat(F.lit("\x00"), F.xxhash64(*scatter).cast("string"))
    keyed = left.withColumn(joint, F.when(is_blank(key), spread).otherwise(F.col(key).cast("string")))
    known = right.where(~is_blank(key)).withColumn(joint, F.col(key).cast("string")).drop(key)
    known = growing(known) if grows else known
    joined = join_splitting(keyed, known, [joint]) if splitting else keyed.join(known, joint, "left")
    return joined.drop(joint)


def require(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of the left side whose key occurs on the right."""
    return left.join(right, list(on), "left_semi")


def exclude(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of the left side whose key does not occur on the right; a NULL key is kept."""
    return left.join(right.select(*on), list(on), "left_anti")


def active_offers(
    offers: DataFrame,
    run_date: DateLike,
    include_run_date: bool,
    expiry: str = "expiry_date",
    issued: str = "actual_date",
) -> DataFrame:
    """Offers issued before (or on) the run date that have not expired on it."""
    started = F.col(issued) <= day(run_date) if include_run_date else F.col(issued) < day(run_date)
    return offers.where((F.col(expiry) > day(run_date)) & started)


def exclude_active(
    left: DataFrame, offers: DataFrame, run_date: DateLike, include_run_date: bool, key: str = "bbn"
) -> DataFrame:
    """Drop customers who still hold an unexpired offer."""
    return exclude(left, active_offers(offers, run_date, include_run_date), [key])


def fan_out(df: DataFrame, rows: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Every row once per entry of a small constant table, without a join.

    The table is an array literal exploded inside the projection, so nothing is shuffled.
    """
    entries = F.array(*[F.struct(*[F.lit(value).alias(name) for name, value in row.items()]) for row in rows])
    return df.select("*", F.inline(entries))
