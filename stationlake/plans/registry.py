"""Registered queries: one per operator of the inventory, each paired with a DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the operator on a binding of
the driver's tables; ``ORACLE[name]`` is the same computation in DuckDB SQL.
Floating results are rounded to 6 decimals on both sides, through 9 decimals
first: the engines sum in different orders, so the same value can differ in
its last bit, and a value lying exactly on a 7th-decimal half (common for means
of 2-decimal data) would otherwise round apart. Rounding to the 1-2 decimals
of the reference views is a ``digits`` option of the operators and is
exercised by unit tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.plans.bindings import with_bindings as W  # noqa: F401  (re-exported to the query modules)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(df: DataFrame) -> DataFrame:
    """Round every floating column to ``DIGITS`` decimals (and keep its name)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.round(F.col(f"`{f.name}`"), DIGITS + 3), DIGITS).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def R(expr: str) -> str:
    """The DuckDB side of ``r6`` for one expression."""
    return f"round(round({expr}, {DIGITS + 3}), {DIGITS})"


# Imported last: the modules below register their queries on import.
from stationlake.plans import q_quality, q_views  # noqa: E402,F401
from stationlake.plans import q_ingest, q_eda, q_series, q_models  # noqa: E402,F401
