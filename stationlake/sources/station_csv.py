"""By-station CSV: ``ID,DATE,ELEMENT,DATA_VALUE,M_FLAG,Q_FLAG,S_FLAG,OBS_TIME``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.functions import blank_to_null
from stationlake.operators.conform import ELEMENT_CODES
from stationlake.schema import MISSING, STATION_CSV
from stationlake.sources.header_csv import read_by_header


def parse_station_csv(raw: DataFrame, elements: Sequence[str] = ELEMENT_CODES,
                      keep: Sequence[str] = ()) -> DataFrame:
    """All-text rows -> (station_id, obs_date, element, value_raw, mflag, qflag, sflag).

    Element allow-list first; ``yyyyMMdd`` date; integer value; blank flags
    -> NULL; the -9999 sentinel (and a blank value) produce no row.
    """
    rows = raw.where(F.col("ELEMENT").isin(list(elements)))
    out = rows.select(
        *keep,
        F.col("ID").alias("station_id"),
        F.to_date("DATE", "yyyyMMdd").alias("obs_date"),
        F.col("ELEMENT").alias("element"),
        F.trim("DATA_VALUE").cast("int").alias("value_raw"),
        blank_to_null("M_FLAG").alias("mflag"),
        blank_to_null("Q_FLAG").alias("qflag"),
        blank_to_null("S_FLAG").alias("sflag"),
    )
    return out.where(F.col("value_raw").isNotNull() & (F.col("value_raw") != MISSING))


def read_station_csv(spark: SparkSession, path: str | list[str], elements: Sequence[str] = ELEMENT_CODES,
                     stations: DataFrame | None = None, keep: Sequence[str] = (), glob: str = "*.csv") -> DataFrame:
    """Read the files ``glob`` under ``path``; columns are taken by header name.

    Header names are trimmed and upper-cased, their order is free, and a header
    without one of the needed columns fails. With ``stations`` given, only files
    whose stem is a known station id are kept (semi join on the file name).
    ``keep`` names further columns to carry.
    """
    names = STATION_CSV.fieldNames()
    needed = [n for n in names if n != "OBS_TIME"]
    stems = None
    if stations is not None:
        stems = stations.select(F.concat(F.col("station_id"), F.lit(".csv")).alias("file_name"))
    raw = read_by_header(spark, path, [*names, *keep], needed, glob, only=stems)
    return parse_station_csv(raw, elements, keep=("file_name", "line_id", *keep))
