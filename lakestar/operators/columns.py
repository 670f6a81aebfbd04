"""Whole-column operations: suffixing merge, duplicate columns, suffix removal."""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_with_suffixes(
    left: DataFrame, right: DataFrame, key: str, how: str = "left", suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    """Join on a key; other names that both sides have get a suffix each."""
    shared = (set(left.columns) & set(right.columns)) - {key}

    def mark(df: DataFrame, suffix: str) -> DataFrame:
        return df.withColumnsRenamed({c: f"{c}{suffix}" for c in df.columns if c in shared})

    return mark(left, suffixes[0]).join(mark(right, suffixes[1]), key, how)


def duplicate_columns(
    df: DataFrame, pairs: Iterable[tuple[str, str]] | None = None, keep: Iterable[str] = ()
) -> dict[str, str]:
    """Columns whose contents equal those of an earlier column: ``{later: earlier}``.

    ``pairs`` (earlier, later) says which columns to compare, by default all; columns in
    ``keep`` are never reported. A frame without rows says nothing about equality, so it
    has no duplicates.

    The first scan takes one fingerprint per column; the second compares, row by
    row and NULL-safe, only same-typed columns whose fingerprints agree. The driver
    sees one row of aggregates, as wide as the schema.
    """
    kinds = {c: kind for c, kind in df.dtypes if "map<" not in kind}  # maps have no equality
    # Mixing in the whole row's hash tells apart columns with the same values in
    # another order. Agreement is only a candidate: identical rows cancel out of an xor.
    row = F.xxhash64(*kinds)
    prints = df.agg(*[F.bit_xor(F.xxhash64(row, F.col(c))).alias(c) for c in kinds]).first()
    kept = set(keep)
    pairs = [
        (a, b) for a, b in (combinations(kinds, 2) if pairs is None else pairs)
        if a in kinds and b in kinds and b not in kept and kinds[a] == kinds[b] and prints[a] == prints[b]
    ]
    if not pairs:
        return {}
    checks = [F.bool_and(F.col(a).eqNullSafe(F.col(b))).alias(str(i)) for i, (a, b) in enumerate(pairs)]
    equal = df.agg(*checks).first()
    found: dict[str, str] = {}
    for i, (a, b) in enumerate(pairs):
        if equal[str(i)] is True and b not in found and a not in found:
            found[b] = a
    return found


def drop_duplicate_columns(
    df: DataFrame, pairs: Iterable[tuple[str, str]] | None = None, keep: Iterable[str] = ()
) -> DataFrame:
    """Keep the first of each set of compared columns with equal contents, and all of ``keep``."""
    return df.drop(*duplicate_columns(df, pairs, keep))


def strip_suffix(df: DataFrame, suffix: str = "_x") -> DataFrame:
    """Remove a join suffix from the end of every name that has it."""
    return df.withColumnsRenamed(
        {c: re.sub(f"{re.escape(suffix)}$", "", c) for c in df.columns if c.endswith(suffix)}
    )
