"""Working under neutral column names, so that no column of the caller can clash with a helper column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def neutral(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Columns in ``keep`` come last under their own names, all others first as _c0, _c1, ..."""
    others = [c for c in documents.columns if c not in keep]
    return documents.select(*[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(others)], *[F.col(c) for c in keep])


def restored(rows: DataFrame, documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The columns of ``documents`` from rows of :func:`neutral`."""
    others = [c for c in documents.columns if c not in keep]
    names = {c: f"_c{k}" for k, c in enumerate(others)} | {c: c for c in keep}
    return rows.select(*[F.col(names[c]).alias(c) for c in documents.columns])
