"""Reanalysis responses: one JSON object per station whose ``daily`` member holds
parallel arrays (``time`` plus one array per variable)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.schema import REANALYSIS_JSON, REANALYSIS_VARS


def explode_daily_arrays(df: DataFrame, station_col: str = "station_id", daily_col: str = "daily") -> DataFrame:
    """Parallel arrays -> one row per day: (station_id, obs_date, <variables>, sunrise, sunset).

    ``arrays_zip`` aligns the i-th entries, ``inline`` turns them into rows;
    each input row expands within its own task.
    """
    names = ["time", *REANALYSIS_VARS, "sunrise", "sunset"]
    n_days = F.size(F.col(f"{daily_col}.time"))

    def arr(n: str):
        # arrays_zip returns NULL when any input is NULL: pad an absent variable with NULLs.
        c = F.col(f"{daily_col}.{n}")
        if n == "time":
            return c
        elem = "string" if n in ("sunrise", "sunset") else "double"
        return F.coalesce(c, F.array_repeat(F.lit(None).cast(elem), n_days))

    zipped = F.arrays_zip(*[arr(n).alias(n) for n in names])
    rows = df.select(F.col(station_col).alias("station_id"), F.inline(zipped))
    return rows.select("station_id", F.to_date("time").alias("obs_date"), *REANALYSIS_VARS, "sunrise", "sunset")


def read_reanalysis(spark: SparkSession, path: str) -> DataFrame:
    """Read landed ``<station_id>.json`` responses; the station key comes from the file name."""
    raw = (spark.read.schema(REANALYSIS_JSON).option("multiLine", True)
           .option("pathGlobFilter", "*.json").json(path)
           .select("daily", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1).alias("station_id")))
    return explode_daily_arrays(raw)
