"""Conform the parsed long rows: flags, sentinel, allow-list, first-arrival dedupe,
units, date key; then curate the wide daily fact from the audit table.

Order matters and follows the source pipeline: dedupe happens before the QA
filter, so a flagged first arrival hides a good second arrival of the same
grain (the grain then is absent from the curated table).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.functions import blank_to_null, date_key, scale_units
from stationlake.schema import ELEMENTS, MISSING, TENTHS

GRAIN = ("station_id", "obs_date", "element")
FLAGS = ("mflag", "qflag", "sflag")
# Arrival order, first to last: sorted file listing (a station's .csv sorts before
# its .dly), then position in the file; ``source_rank``/``arrival`` when rows do
# not come from files.
ORDER_COLS = ("file_name", "line_id", "source_rank", "arrival")
ELEMENT_CODES = [e for e, _, _ in ELEMENTS]


def blank_flags(df: DataFrame) -> DataFrame:
    """m/q/s flags: strip, empty -> NULL."""
    return df.select(*[blank_to_null(c).alias(c) if c in FLAGS else F.col(c) for c in df.columns])


def drop_missing(df: DataFrame, value_col: str = "value_raw") -> DataFrame:
    """Drop rows whose value is blank or the -9999 sentinel."""
    return df.where(F.col(value_col).isNotNull() & (F.col(value_col) != MISSING))


def element_filter(df: DataFrame, elements: Sequence[str] = ELEMENT_CODES) -> DataFrame:
    """Keep the allow-listed elements only."""
    return df.where(F.col("element").isin(list(elements)))


def dedupe_first(df: DataFrame, grain: Sequence[str] = GRAIN,
                 order: Sequence[str] = ORDER_COLS) -> DataFrame:
    """One row per grain: the first in (``order``...) wins.

    Expressed as ``min(struct(order..., payload...))`` per grain, an aggregate:
    each task reduces its own copies before the shuffle, so a grain repeated by
    a third of all rows sends one partial row per task, never a full group.
    """
    order = [c for c in order if c in df.columns]
    payload = [c for c in df.columns if c not in grain and c not in order]
    first = df.groupBy(*grain).agg(F.min(F.struct(*order, *payload)).alias("_first"))
    return first.select(*grain, *[F.col(f"_first.{c}").alias(c) for c in (*order, *payload)])


def unit_scale(df: DataFrame, tenths: Sequence[str] = TENTHS) -> DataFrame:
    """Add ``value`` in physical units (tenths elements / 10, once)."""
    return df.withColumn("value", scale_units("value_raw", "element", tenths))


def add_date_key(df: DataFrame) -> DataFrame:
    return df.withColumn("date_key", date_key("obs_date"))


def audit_table(raw: DataFrame, elements: Sequence[str] = ELEMENT_CODES,
                tenths: Sequence[str] = TENTHS) -> DataFrame:
    """Parsed rows -> the audit (bronze) fact: every grain once, flags kept."""
    conformed = blank_flags(drop_missing(element_filter(raw, elements)))
    first = dedupe_first(conformed, GRAIN, [c for c in conformed.columns if c in ORDER_COLS])
    return add_date_key(unit_scale(first, tenths)).select(
        "station_id", "date_key", "obs_date", "element", "value", "mflag", "qflag", "sflag")


def ingest_union(*parsed: DataFrame) -> DataFrame:
    """Concatenate parsed sources by column name (missing columns become NULL)."""
    out = parsed[0]
    for p in parsed[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def qa_filter(obs: DataFrame) -> DataFrame:
    """Curated population: values that passed QA (``qflag IS NULL``)."""
    return obs.where(F.col("qflag").isNull())


def pivot_daily(obs: DataFrame, elements: Sequence[str] = ELEMENT_CODES,
                range_of: tuple[str, str] = ("tmax", "tmin")) -> DataFrame:
    """Audit table -> curated wide daily fact.

    Failed values are removed first; a station-day whose every value failed
    has no row. The explicit element list fixes the column set (absent
    elements become NULL columns) and spares the distinct pass of ``pivot``.
    The grain is unique after the dedupe, so ``max`` returns the single value.
    ``temp_range`` is ``range_of[0] - range_of[1]`` (NULL if either is NULL).
    """
    passed = qa_filter(obs)
    wide = passed.groupBy("station_id", "date_key", "obs_date").pivot("element", list(elements)).agg(
        F.max("value"))
    wide = wide.select("station_id", "date_key", "obs_date",
                       *[F.col(f"`{e}`").alias(e.lower()) for e in elements])
    hi, lo = range_of
    if hi in wide.columns and lo in wide.columns:
        wide = wide.withColumn("temp_range", F.col(hi) - F.col(lo))
    return wide


def stage_summary(obs: DataFrame) -> DataFrame:
    """Staging report in one aggregate: rows, curated station-days, date span, flagged rows."""
    return obs.agg(
        F.count(F.lit(1)).alias("n_observations"),
        F.count_distinct(F.when(F.col("qflag").isNull(), F.col("station_id")), F.col("obs_date"))
        .alias("n_station_days"),
        F.min("obs_date").alias("first_date"),
        F.max("obs_date").alias("last_date"),
        F.count("qflag").alias("n_flagged"),
    )
