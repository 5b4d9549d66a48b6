"""Ordered and last-k results, for reports: the queries themselves are order-free."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered(df: DataFrame, by: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    """``df`` sorted by ``by``; columns in ``descending`` from large to small. NULLs come last either way."""
    return df.orderBy(*[F.col(c).desc_nulls_last() if c in descending else F.col(c).asc_nulls_last() for c in by])


def last_k(df: DataFrame, by: Sequence[str], k: int = 5) -> DataFrame:
    """The last ``k`` rows in the order of ``by``, in that order (a top-k per task, merged: no full sort)."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in by]).limit(k).orderBy(*[F.col(c).asc_nulls_last() for c in by])
