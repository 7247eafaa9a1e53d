"""Joins of a large table with a lookup table.

Spark chooses the join: it broadcasts what its own threshold allows, and adaptive
execution looks at the real size once the lookup's shuffle has run. Estimates do
not see what an explode makes of a table, nor that a side grows with the
positions. Such lookups are marked with ``grows``: they are joined by a shuffle in
any case. A key that holds a large part of all rows is one skewed partition of
that join, which adaptive execution splits, repeating only that key's lookup rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    condition: Column | None = None,
    grows: bool = False,
) -> DataFrame:
    """Equi-join ``large`` with ``lookup`` on the shared columns ``on``.

    ``how`` is inner, left, left_semi or left_anti. ``condition`` is an extra
    predicate over the columns of both sides (names must not clash). ``grows``
    rules a broadcast out.
    """
    on = list(on)
    right = lookup.hint("merge") if grows else lookup
    if condition is None:
        return large.join(right, on, how)
    renamed = lookup.select(*[F.col(c).alias(f"_r_{c}" if c in on else c) for c in lookup.columns])
    clause = condition
    for c in on:
        clause = clause & (F.col(c) == F.col(f"_r_{c}"))
    return large.join(renamed.hint("merge") if grows else renamed, clause, how).drop(*[f"_r_{c}" for c in on])
