"""Upserts on tables without MERGE.

One mergeable state covers the three kinds: per key it keeps the *first seen*
values of some columns and the *last seen* values of the others. Keeping only
first seen values is insert-or-ignore, only last seen values is primary-key
overwrite, and a mix updates the named columns and leaves the rest.

A state is a plain aggregate (``min`` / ``max`` over structs led by the order
columns), so a hot key shrinks to one row per map task before the shuffle, and
merging is idempotent and independent of arrival order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST, LAST = "first_seen", "last_seen"


def to_state(
    df: DataFrame, key: list[str], order: list[str], first: list[str], last: list[str], arrival: int = 0
) -> DataFrame:
    """One row per key. Rows with a NULL key part cannot be keyed and are left out.

    ``arrival`` ranks whole inputs: a lower one is older whatever its order columns say.
    Rows that tie on the order columns are told apart by their values.
    """
    return merge_states(_packed(df, key, order, first, last, arrival), key)


def _packed(
    df: DataFrame, key: list[str], order: list[str], first: list[str], last: list[str], arrival: int
) -> DataFrame:
    """Each row as a state of its own; rows with a NULL key part are left out."""
    lead = [F.lit(arrival).alias("arrival"), *[F.col(c).alias(f"order_{i}") for i, c in enumerate(order)]]
    packs = {FIRST: first, LAST: last}
    return df.dropna("any", subset=key).select(
        *key, *[F.struct(*lead, *[F.col(c) for c in columns]).alias(n) for n, columns in packs.items() if columns]
    )


def merge_states(states: list[DataFrame] | DataFrame, key: list[str]) -> DataFrame:
    """Fold several states, or the appended deltas of one table, into one."""
    rows = states if isinstance(states, DataFrame) else reduce(DataFrame.unionByName, states)
    picks = {FIRST: F.min, LAST: F.max}
    return rows.groupBy(*key).agg(*[pick(n).alias(n) for n, pick in picks.items() if n in rows.columns])


def from_state(state: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """The table a state stands for, columns in the order asked for."""
    picked = {}
    for packed in (n for n in (FIRST, LAST) if n in state.columns):
        for field in state.schema[packed].dataType.fieldNames():
            picked[field] = F.col(packed)[field].alias(field)
    return state.select(*[F.col(c) if c in key else picked[c] for c in columns])


def upsert(
    target: DataFrame, incoming: DataFrame, key: list[str], order: list[str], update: list[str] | None
) -> DataFrame:
    """Insert new keys and set the ``update`` columns of the known ones.

    ``update=None`` overwrites every column (last write wins); an empty list is
    insert-or-ignore. ``order`` are columns of ``incoming`` that date its rows;
    ``target`` needs none of them, all its rows count as older. An incoming NULL
    in an updated column overwrites. Incoming rows with a NULL key part cannot be matched and are
    left out (``rejected`` returns them); stored rows with one stay as they are.
    """
    columns = target.columns
    values = [c for c in columns if c not in key]
    last = values if update is None else [c for c in values if c in update]
    first = [c for c in values if c not in last]
    undated = target.withColumns({c: F.lit(None).cast(incoming.schema[c].dataType) for c in order if c not in columns})
    old = _packed(undated, key, order, first, last, arrival=0)
    new = _packed(incoming, key, order, first, last, arrival=1)
    stored = target.filter(~keyed(key))
    return from_state(merge_states([old, new], key), key, columns).unionByName(stored)


def keyed(key: list[str]) -> Column:
    """Whether a row has all parts of its key."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])


def rejected(incoming: DataFrame, key: list[str]) -> DataFrame:
    """Incoming rows that an upsert cannot key."""
    return incoming.filter(~keyed(key))


def rows_to_insert(target: DataFrame, incoming: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Insert-or-ignore as an append: only the incoming rows whose key is new.

    The target is read for its key columns alone and nothing of it is rewritten.
    """
    values = [c for c in target.columns if c not in key]
    fresh = from_state(to_state(incoming, key, order, values, []), key, target.columns)
    return fresh.join(target.select(*key), key, "left_anti")


def last_write_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One whole row per key: the latest by ``order``, ties by the other columns."""
    values = [c for c in df.columns if c not in key]
    return from_state(to_state(df, key, order, [], values), key, df.columns)


def first_write_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One whole row per key: the earliest by ``order``, ties by the other columns."""
    values = [c for c in df.columns if c not in key]
    return from_state(to_state(df, key, order, values, []), key, df.columns)
