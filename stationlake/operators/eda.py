"""Exploratory tables per station: seasonality, trend, coverage, anomalies, correlations.

These are the data behind the reference's charts, generalised from one
station to all of them (the station is a grouping key, never a literal).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationlake.operators.joins import join_dim

MONTHS = list(range(1, 13))


def _names(stations: DataFrame) -> DataFrame:
    return stations.select("station_id", "station_name")


def monthly_climatology(daily: DataFrame, stations: DataFrame, value: str = "tmax") -> DataFrame:
    """Mean ``value`` by station and calendar month, months as columns m01..m12.

    The pivot runs on the bounded month axis with an explicit value list, so
    no distinct pass is needed.
    """
    wide = daily.withColumn("m", F.month("obs_date")).groupBy("station_id").pivot("m", MONTHS).agg(F.avg(value))
    wide = wide.select("station_id", *[F.col(f"`{m}`").alias(f"m{m:02d}") for m in MONTHS])
    return join_dim(wide, _names(stations), "station_id")


def unstack(df: DataFrame, index: str | Sequence[str], axis: str, value: str, max_columns: int = 500) -> DataFrame:
    """``value`` with one column for each value of ``axis`` (in order) and one row for each ``index``.

    The axis is found in the data: one distinct pass, of which the driver sees at most ``max_columns`` + 1 values; a
    longer axis is an error, as such a table belongs in long form. Several rows of one cell are averaged; a null axis
    value has no column.
    """
    index = [index] if isinstance(index, str) else list(index)
    found = df.select(axis).where(F.col(axis).isNotNull()).distinct().orderBy(axis).limit(max_columns + 1).collect()
    if len(found) > max_columns:
        raise ValueError(f"{axis} has more than {max_columns} values; keep the long form")
    if not found:
        return df.select(*index).distinct()
    return df.groupBy(*index).pivot(axis, [r[0] for r in found]).agg(F.avg(value))


def climatology_by_station(daily: DataFrame, stations: DataFrame, value: str = "tmax") -> DataFrame:
    """Mean ``value`` by calendar month, one column a station: the seasons of all stations side by side."""
    per = daily.groupBy("station_id", F.month("obs_date").alias("month")).agg(F.avg(value).alias("mean"))
    return unstack(join_dim(per, _names(stations), "station_id"), "month", "station_name", "mean")


def coverage_by_station(daily: DataFrame, stations: DataFrame, value: str = "tmax") -> DataFrame:
    """Days with ``value`` by year, one column a station (NULL where a station has no row in that year)."""
    return unstack(yearly_coverage(daily, stations, value), "year", "station_name", "days_with_value")


def seasonal_amplitude(daily: DataFrame, stations: DataFrame, value: str = "tmax") -> DataFrame:
    """Hottest minus coldest monthly-mean ``value`` per station."""
    per = daily.groupBy("station_id", F.month("obs_date").alias("m")).agg(F.avg(value).alias("mean"))
    amp = per.groupBy("station_id").agg((F.max("mean") - F.min("mean")).alias("amplitude"))
    return join_dim(amp, _names(stations), "station_id").select("station_id", "station_name", "amplitude")


def annual_means(daily: DataFrame, value: str = "tavg", drop_partial_last: bool = True) -> DataFrame:
    """Yearly mean of ``value`` per station; years without a value are absent.

    With ``drop_partial_last`` a station's final year is dropped unless its
    last observation is on 31 December.
    """
    a = daily.where(F.col(value).isNotNull()).groupBy("station_id", F.year("obs_date").alias("year")).agg(
        F.avg(value).alias("annual_mean"), F.max("obs_date").alias("_last"))
    if drop_partial_last:
        a = a.withColumn("_last_year", F.max("year").over(Window.partitionBy("station_id")))
        partial = (F.col("year") == F.col("_last_year")) & ~((F.month("_last") == 12) & (F.dayofmonth("_last") == 31))
        a = a.where(~partial).drop("_last_year")
    return a.drop("_last")


def annual_trend(daily: DataFrame, value: str = "tavg", k: int = 10) -> DataFrame:
    """Annual means with a trailing ``k``-year mean over present years (NULL before the k-th)."""
    a = annual_means(daily, value)
    w = Window.partitionBy("station_id").orderBy("year").rowsBetween(-(k - 1), 0)
    return a.withColumn("rolling_mean", F.when(F.count("annual_mean").over(w) >= k, F.avg("annual_mean").over(w)))


def warming_delta(daily: DataFrame, value: str = "tavg", k: int = 30) -> DataFrame:
    """Mean of the last ``k`` annual means minus the mean of the first ``k``, per station."""
    a = annual_means(daily, value)
    asc = F.row_number().over(Window.partitionBy("station_id").orderBy("year"))
    desc = F.row_number().over(Window.partitionBy("station_id").orderBy(F.col("year").desc()))
    r = a.select("station_id", "annual_mean", asc.alias("ra"), desc.alias("rd"))
    out = r.groupBy("station_id").agg(
        F.avg(F.when(F.col("ra") <= k, F.col("annual_mean"))).alias("first_mean"),
        F.avg(F.when(F.col("rd") <= k, F.col("annual_mean"))).alias("last_mean"))
    return out.withColumn("delta", F.col("last_mean") - F.col("first_mean"))


def yearly_coverage(daily: DataFrame, stations: DataFrame, value: str = "tmax") -> DataFrame:
    """Days with ``value`` per station and year (long form)."""
    per = daily.groupBy("station_id", F.year("obs_date").alias("year")).agg(F.count(value).alias("days_with_value"))
    return join_dim(per, _names(stations), "station_id").select("station_name", "year", "days_with_value")


def doy_normals(daily: DataFrame, value: str = "tmax") -> DataFrame:
    """Mean and sample standard deviation of ``value`` per station and day of year."""
    return daily.groupBy("station_id", F.dayofyear("obs_date").alias("doy")).agg(
        F.avg(value).alias("doy_mean"), F.stddev_samp(value).alias("doy_std"), F.count(value).alias("n"))


def with_z(daily: DataFrame, value: str = "tmax") -> DataFrame:
    """Each row with its day-of-year normal and standardised anomaly z.

    The normal is a window aggregate over (station, day of year): the same
    rows as aggregating the normals and left-joining them back. The rows are
    dealt by station once, which also serves what follows per station. A group of one row or zero spread gives z = NULL.
    """
    w = Window.partitionBy("station_id", F.dayofyear("obs_date"))
    mean = F.avg(value).over(w)
    std = F.stddev_samp(value).over(w)
    return daily.select("station_id", "obs_date", value).repartition("station_id").select(
        "station_id", "obs_date", value, mean.alias("doy_mean"), std.alias("doy_std")).withColumn(
        "z", F.try_divide(F.col(value) - F.col("doy_mean"), F.nullif(F.col("doy_std"), F.lit(0.0))))


def doy_anomalies(daily: DataFrame, threshold: float = 3.0, value: str = "tmax") -> DataFrame:
    """Rows with |z| > ``threshold``; ``z_rank`` orders them by z descending, earlier date first."""
    a = with_z(daily, value).where(F.abs("z") > threshold)
    w = Window.partitionBy("station_id").orderBy(F.col("z").desc(), F.col("obs_date").asc())
    return a.withColumn("z_rank", F.row_number().over(w))


def anomaly_counts(daily: DataFrame, threshold: float = 3.0, since_year: int = 2000, value: str = "tmax") -> DataFrame:
    """Number of |z| > ``threshold`` days per station, all time and since ``since_year``."""
    z = with_z(daily, value)
    hit = F.abs("z") > threshold
    return z.groupBy("station_id").agg(
        F.count_if(hit).alias("n_anomalies"),
        F.count_if(hit & (F.year("obs_date") >= since_year)).alias("n_anomalies_since"))


def pearson(a: str, b: str):
    """Pearson correlation over rows where both are present; NULL for fewer than two
    rows or zero spread (ANSI ``corr`` raises on a zero divisor)."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
    return F.try_divide(F.covar_pop(x, y), F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0)))


def correlations(daily: DataFrame, columns: Sequence[str] = ("tmax", "tmin", "tavg", "temp_range", "prcp")) -> DataFrame:
    """Pairwise-complete Pearson correlation of every column pair, per station, long form."""
    pairs = list(combinations(columns, 2))
    agg = daily.groupBy("station_id").agg(*[pearson(a, b).alias(f"{a}__{b}") for a, b in pairs])
    stacked = F.explode(F.array(*[F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"),
                                           F.col(f"{a}__{b}").alias("corr")) for a, b in pairs]))
    return agg.select("station_id", stacked.alias("p")).select("station_id", "p.*")
