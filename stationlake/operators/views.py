"""The analysis layer: six views and four ready-made questions, per station.

Windows partition by ``station_id`` and order by ``obs_date``. The curated grain
is one row per station-day, so a window partition holds at most one row per
calendar day of that station's history (about 93,000 rows for 255 years):
parallelism comes from the number of stations, and no partition can grow with
the total data volume. ``digits`` reproduces the rounding of the reference
views; ``None`` keeps full precision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationlake.functions import decade, round_opt, season_nh
from stationlake.operators.joins import join_dim

def _by_station():
    return Window.partitionBy("station_id").orderBy("obs_date")


def _only(df: DataFrame, station_ids: list[str] | None) -> DataFrame:
    return df if not station_ids else df.where(F.col("station_id").isin(station_ids))


def daily_enriched(daily: DataFrame, stations: DataFrame) -> DataFrame:
    """View 1: each station-day with station metadata and calendar attributes.

    Calendar attributes are derived from ``obs_date`` with the same expressions
    that build the date dimension, which equals the inner join on ``date_key``
    and saves the join.
    """
    d = F.col("obs_date")
    j = join_dim(daily, stations.select("station_id", "station_name", "country", "climate_zone",
                                        "latitude", "elevation_m"), "station_id")
    return j.select(
        "obs_date", F.year(d).alias("year"), F.month(d).alias("month"),
        F.date_format(d, "MMM").alias("month_name"), season_nh(F.month(d)).alias("season_nh"),
        F.dayofyear(d).alias("day_of_year"), F.weekofyear(d).alias("week_of_year"),
        "station_id", "station_name", "country", "climate_zone", "latitude", "elevation_m",
        "tmax", "tmin", "tavg", "temp_range", "prcp", "snow", "snwd", "awnd", "wsfg",
    )


def monthly_summary(daily: DataFrame, stations: DataFrame, digits: int | None = 1) -> DataFrame:
    """View 2: per station and calendar month: mean tmax/tmin, total prcp, extremes, support.

    Aggregated on (station_id, year, month) first; names join the small result.
    """
    d = F.col("obs_date")
    per = daily.groupBy("station_id", F.year(d).alias("year"), F.month(d).alias("month")).agg(
        F.avg("tmax").alias("avg_tmax"), F.avg("tmin").alias("avg_tmin"), F.sum("prcp").alias("total_prcp"),
        F.max("tmax").alias("hottest_day"), F.min("tmin").alias("coldest_day"),
        F.count("tmax").alias("days_reported"),
    )
    named = join_dim(per, stations.select("station_id", "station_name"), "station_id")
    return named.select(
        "station_id", "station_name", "year", "month",
        F.date_format(F.make_date("year", "month", F.lit(1)), "MMM").alias("month_name"),
        round_opt("avg_tmax", digits).alias("avg_tmax"), round_opt("avg_tmin", digits).alias("avg_tmin"),
        round_opt("total_prcp", digits).alias("total_prcp"), "hottest_day", "coldest_day", "days_reported",
    )


def rolling_climate(daily: DataFrame, digits: int | None = 1) -> DataFrame:
    """View 3: trailing 7- and 30-row means of tmax and 30-row prcp total.

    Row frames (not calendar frames), no minimum support: both frames share one
    partitioning and one sort.
    """
    w7 = _by_station().rowsBetween(-6, 0)
    w30 = _by_station().rowsBetween(-29, 0)
    return daily.select(
        "station_id", "obs_date", "tmax", "prcp",
        round_opt(F.avg("tmax").over(w7), digits).alias("tmax_7d_avg"),
        round_opt(F.avg("tmax").over(w30), digits).alias("tmax_30d_avg"),
        round_opt(F.sum("prcp").over(w30), digits).alias("prcp_30d_total"),
    )


def record_days(daily: DataFrame) -> DataFrame:
    """View 4: each day with tmax and the station's record over all prior days."""
    prior = _by_station().rowsBetween(Window.unboundedPreceding, -1)
    return daily.where(F.col("tmax").isNotNull()).select(
        "station_id", "obs_date", "tmax", F.max("tmax").over(prior).alias("prior_record"))


def rain_streaks(daily: DataFrame, threshold: float = 1.0) -> DataFrame:
    """View 5: runs of consecutive days with prcp >= threshold (gaps and islands)."""
    rainy = daily.where(F.col("prcp") >= threshold).select("station_id", "obs_date")
    grp = F.date_sub("obs_date", F.row_number().over(_by_station()))
    return rainy.withColumn("streak_grp", grp).groupBy("station_id", "streak_grp").agg(
        F.min("obs_date").alias("streak_start"), F.max("obs_date").alias("streak_end"),
        F.count(F.lit(1)).alias("streak_days"),
    ).drop("streak_grp")


def station_thresholds(daily: DataFrame) -> DataFrame:
    """View 6: exact interpolated percentiles per station (p95 tmax, p05 tmin, p95 of wet-day prcp).

    ``percentile`` keeps a value -> count map per group with partial
    aggregation; its size is bounded by the distinct values of one station.
    """
    return daily.groupBy("station_id").agg(
        F.percentile("tmax", 0.95).alias("p95_tmax"),
        F.percentile("tmin", 0.05).alias("p05_tmin"),
        F.percentile(F.when(F.col("prcp") > 0, F.col("prcp")), 0.95).alias("p95_wet_day_prcp"),
    )


def top_records(daily: DataFrame, k: int = 10, station_ids: list[str] | None = None,
                digits: int | None = 1) -> DataFrame:
    """Question 1 per station: the k record-breaking days with the largest margin.

    Ties on the margin are broken by the earlier date.
    """
    rec = record_days(_only(daily, station_ids)).where(F.col("tmax") > F.col("prior_record"))
    rec = rec.withColumn("beat_by", round_opt(F.col("tmax") - F.col("prior_record"), digits))
    w = Window.partitionBy("station_id").orderBy(F.col("beat_by").desc(), F.col("obs_date").asc())
    return rec.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def longest_streak(daily: DataFrame, stations: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Question 2: each station's longest rain streak(s), ties kept, with names.

    ``rank() == 1`` over the streaks replaces the tuple-IN subquery, so the
    streak view is computed once.
    """
    s = rain_streaks(daily, threshold)
    w = Window.partitionBy("station_id").orderBy(F.col("streak_days").desc())
    best = s.withColumn("r", F.rank().over(w)).where(F.col("r") == 1).drop("r")
    return join_dim(best, stations.select("station_id", "station_name"), "station_id").select(
        "station_name", "streak_start", "streak_end", "streak_days")


def decade_change(daily: DataFrame, station_ids: list[str] | None = None, digits: int | None = 2) -> DataFrame:
    """Question 3 per station: mean tavg per decade and the change from the previous present decade."""
    base = _only(daily, station_ids).where(F.col("tavg").isNotNull())
    by = base.groupBy("station_id", decade(F.year("obs_date")).alias("decade")).agg(
        round_opt(F.avg("tavg"), digits).alias("avg_temp"))
    w = Window.partitionBy("station_id").orderBy("decade")
    return by.withColumn("change_vs_prev", round_opt(F.col("avg_temp") - F.lag("avg_temp").over(w), digits))


def extreme_days(daily: DataFrame, stations: DataFrame, from_year: int = 1990) -> DataFrame:
    """Question 4: days per year above the station's own p95 tmax, from ``from_year``.

    The threshold is the station's aggregate over its whole history (before the
    year filter, as in the view it stands for): only counts of values are
    shuffled, and one number a station is joined back to the unshuffled rows.
    """
    p95 = daily.groupBy("station_id").agg(F.percentile("tmax", 0.95).alias("p95_tmax"))
    marked = join_dim(daily.select("station_id", "obs_date", "tmax"), p95, "station_id")
    hot = marked.where((F.year("obs_date") >= from_year) & (F.col("tmax") > F.col("p95_tmax")))
    per = hot.groupBy(F.year("obs_date").alias("year"), "station_id").agg(
        F.count(F.lit(1)).alias("extreme_heat_days"))
    named = join_dim(per, stations.select("station_id", "station_name"), "station_id")
    return named.groupBy("year", "station_name").agg(F.sum("extreme_heat_days").alias("extreme_heat_days"))
