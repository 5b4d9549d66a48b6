"""Leak-free supervised features for next-day tmax, per station.

Every feature on a row uses that day and earlier days only; the target is the
next *calendar* day's tmax. Densify, target, lags, rolling statistics and the
seasonal encoding share one partitioning on ``station_id`` (one exchange).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationlake.functions import cyclic_doy
from stationlake.operators.series import densify_daily, rolling
from stationlake.schema import FEATURE_COLUMNS, TARGET


def cyclic_encode(df: DataFrame, date_col: str = "obs_date") -> DataFrame:
    """Add sin/cos of 2*pi*day_of_year/365.25 and the calendar month."""
    s, c = cyclic_doy(date_col)
    return df.withColumn("doy_sin", s).withColumn("doy_cos", c).withColumn("month", F.month(date_col))


def features(daily: DataFrame, start: str | None = None, drop_incomplete: bool = True) -> DataFrame:
    """Daily rows -> (station_id, obs_date, target, 15 features).

    Missing days are inserted first, so lags and windows count calendar days.
    ``prcp`` is zero-filled *after* densify, so an inserted day counts as dry
    in ``prcp_roll7_sum`` (and its support is the row count). Rows with any
    missing feature or target (warm-up, gaps, the last day) are dropped when
    ``drop_incomplete``.
    """
    d = daily if start is None else daily.where(F.col("obs_date") >= F.to_date(F.lit(start)))
    # Measures are DECIMAL at rest; statistics and models work in DOUBLE.
    d = d.select("station_id", "obs_date",
                 *[F.col(c).cast("double").alias(c) for c in ("tmax", "tmin", "temp_range", "prcp")])
    dense = densify_daily(d, ["tmax", "tmin", "temp_range", "prcp"])
    w = Window.partitionBy("station_id").orderBy("obs_date")
    prcp0 = F.coalesce(F.col("prcp"), F.lit(0.0))
    dense = dense.withColumn("prcp0", prcp0)
    f = dense.select(
        "station_id", "obs_date",
        F.lead("tmax", 1).over(w).alias(TARGET),
        F.col("tmax").alias("tmax_lag1"),
        F.lag("tmax", 1).over(w).alias("tmax_lag2"),
        F.lag("tmax", 2).over(w).alias("tmax_lag3"),
        F.lag("tmax", 6).over(w).alias("tmax_lag7"),
        F.col("tmin").alias("tmin_today"),
        F.col("temp_range").alias("temp_range_today"),
        rolling("mean", "tmax", 7, 5).alias("tmax_roll7_mean"),
        rolling("mean", "tmax", 30, 20).alias("tmax_roll30_mean"),
        rolling("std", "tmax", 7, 5).alias("tmax_roll7_std"),
        (F.col("tmax") - F.lag("tmax", 1).over(w)).alias("tmax_delta_1d"),
        F.col("prcp0").alias("prcp_today"),
        rolling("sum", "prcp0", 7, 5, count_col=F.count(F.lit(1))).alias("prcp_roll7_sum"),
    )
    f = cyclic_encode(f)
    f = f.select("station_id", "obs_date", TARGET, *FEATURE_COLUMNS)
    return f.na.drop("any") if drop_incomplete else f


def split(feats: DataFrame, cutoff: str, date_col: str = "obs_date") -> tuple[DataFrame, DataFrame]:
    """Chronological split by feature date: train ``< cutoff``, test ``>= cutoff``."""
    c = F.to_date(F.lit(cutoff))
    return feats.where(F.col(date_col) < c), feats.where(F.col(date_col) >= c)


def feature_coverage(daily: DataFrame, start: str | None = None) -> DataFrame:
    """Per station: days on the densified calendar, days missing there, complete feature rows, dropped rows.

    The counts the feature step reports: missing days made explicit by the
    densify, and rows lost to warm-up windows, gaps and the final day. One
    pass over the feature rows before the incomplete ones are dropped.
    """
    f = features(daily, start, drop_incomplete=False)
    complete = F.lit(True)
    for c in [TARGET, *FEATURE_COLUMNS]:
        complete = complete & F.col(c).isNotNull()
    out = f.groupBy("station_id").agg(F.count(F.lit(1)).alias("dense_days"),
                                      F.count_if(F.col("tmax_lag1").isNull()).alias("missing_days"),
                                      F.count_if(complete).alias("complete_rows"))
    return out.withColumn("dropped_rows", F.col("dense_days") - F.col("complete_rows"))
