"""Time-series helpers per station: calendar densify, rolling statistics with a
minimum support, limited linear interpolation, monthly series.

Two kinds of frames are kept apart on purpose: the SQL views count *rows*
(``rowsBetween``) over the observed days, the model step counts *days* after
the calendar is densified. Every window here is partitioned by the series key
and ordered by time; after densify, a partition holds at most one row per day
(or month) of one station's span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationlake.functions import round_opt


def densify_daily(daily: DataFrame, measures: Sequence[str], key: str = "station_id",
                  date_col: str = "obs_date") -> DataFrame:
    """Calendar-complete daily series: every day from a station's first to last date.

    Each observed row is expanded to itself plus the missing days up to the
    next observation (``lead`` + ``sequence``); measures stay on the observed
    day only, inserted days are NULL. Same rows as a calendar axis left-joined
    to the data, but one exchange on ``key`` and no join. Adds ``is_observed``.
    """
    w = Window.partitionBy(key).orderBy(date_col)
    nxt = F.lead(date_col).over(w)
    spans = daily.select(key, date_col, *measures, nxt.alias("_next"))
    last = F.coalesce(F.date_sub("_next", 1), F.col(date_col))
    rows = spans.select(key, date_col, *measures, F.explode(F.sequence(F.col(date_col), last)).alias("_d"))
    observed = F.col("_d") == F.col(date_col)
    return rows.select(
        key, F.col("_d").alias(date_col),
        *[F.when(observed, F.col(m)).alias(m) for m in measures],
        observed.alias("is_observed"),
    )


def densify_monthly(monthly: DataFrame, measures: Sequence[str], key: str = "station_id",
                    month_col: str = "month_start") -> DataFrame:
    """Month axis from first to last month per station, missing months NULL (``asfreq('MS')``)."""
    w = Window.partitionBy(key).orderBy(month_col)
    nxt = F.lead(month_col).over(w)
    spans = monthly.select(key, month_col, *measures, nxt.alias("_next"))
    last = F.coalesce(F.add_months("_next", -1), F.col(month_col))
    rows = spans.select(key, month_col, *measures,
                        F.explode(F.sequence(F.col(month_col), last, F.expr("INTERVAL 1 MONTH"))).alias("_m"))
    observed = F.col("_m") == F.col(month_col)
    return rows.select(key, F.col("_m").alias(month_col), *[F.when(observed, F.col(m)).alias(m) for m in measures])


def rolling(agg: str, col: str, window_rows: int, min_periods: int, key: str = "station_id",
            order: str = "obs_date", count_col: Column | None = None) -> Column:
    """Trailing ``window_rows``-row aggregate that is NULL below ``min_periods`` supporting values.

    ``agg`` is one of mean, sum, std (sample standard deviation). Support is
    the count of non-null values in the frame, or ``count_col`` when given.
    """
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-(window_rows - 1), 0)
    fn = {"mean": F.avg, "sum": F.sum, "std": F.stddev_samp}[agg]
    support = (count_col if count_col is not None else F.count(col)).over(w)
    return F.when(support >= min_periods, fn(col).over(w))


def interpolate_limited(df: DataFrame, value: str, pos: str, key: str = "station_id", limit: int = 2,
                        out: str | None = None) -> DataFrame:
    """Linear interpolation by position, at most ``limit`` consecutive fills per gap, forward only.

    Inside a gap the value is interpolated between the previous and the next
    known values; a trailing gap repeats the last known value; a leading gap
    stays NULL; fills beyond ``limit`` positions after the last known value
    stay NULL. ``pos`` must be consecutive integers on a dense axis.
    """
    out = out or value
    before = Window.partitionBy(key).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(key).orderBy(pos).rowsBetween(0, Window.unboundedFollowing)
    known_pos = F.when(F.col(value).isNotNull(), F.col(pos))
    p0 = F.max(known_pos).over(before)
    v0 = F.last(value, ignorenulls=True).over(before)
    p1 = F.min(known_pos).over(after)
    v1 = F.first(value, ignorenulls=True).over(after)
    t = df.select("*", p0.alias("_p0"), v0.alias("_v0"), p1.alias("_p1"), v1.alias("_v1"))
    filled = (F.when(F.col(value).isNotNull(), F.col(value))
              .when(F.col("_p0").isNull() | ((F.col(pos) - F.col("_p0")) > limit), F.lit(None))
              .when(F.col("_p1").isNull(), F.col("_v0"))
              .otherwise(F.col("_v0") + (F.col("_v1") - F.col("_v0")) * (F.col(pos) - F.col("_p0"))
                         / (F.col("_p1") - F.col("_p0"))))
    return t.withColumn(out, filled.cast("double")).drop("_p0", "_v0", "_p1", "_v1")


def month_index(month_start: str | Column) -> Column:
    c = F.col(month_start) if isinstance(month_start, str) else month_start
    return F.year(c) * 12 + F.month(c) - 1


def monthly_series(daily: DataFrame, value: str = "tmax", first_year: int | None = None,
                   last_year: int | None = None, min_days: int = 20, limit: int = 2,
                   digits: int | None = None) -> DataFrame:
    """Regular monthly mean series per station.

    Monthly mean of ``value`` with its support (days with a value); months
    with fewer than ``min_days`` are dropped, the month axis is densified and
    holes are filled by ``interpolate_limited``. Returns (station_id,
    month_start, avg_value, value) where ``value`` is the filled series.
    ``digits=1`` reads the mean rounded like the monthly summary view (the
    reference's seasonal model takes its input from that view).
    """
    d = daily
    if first_year is not None:
        d = d.where(F.year("obs_date") >= first_year)
    if last_year is not None:
        d = d.where(F.year("obs_date") <= last_year)
    m = d.groupBy("station_id", F.trunc("obs_date", "month").alias("month_start")).agg(
        # DECIMAL input averages exactly, so rounding matches NUMERIC HALF_UP; DOUBLE after.
        round_opt(F.avg(value), digits).cast("double").alias("avg_value"),
        F.count(value).alias("days_reported"))
    m = m.where(F.col("days_reported") >= min_days).select("station_id", "month_start", "avg_value")
    dense = densify_monthly(m, ["avg_value"]).withColumn("_pos", month_index("month_start"))
    return interpolate_limited(dense, "avg_value", "_pos", limit=limit, out="value").drop("_pos")


def holdout_split(series: DataFrame, horizon: int = 24, order: str = "month_start") -> DataFrame:
    """Label the last ``horizon`` points of each series ``test``, the rest ``train``."""
    w = Window.partitionBy("station_id").orderBy(F.col(order).desc())
    return series.withColumn("split", F.when(F.row_number().over(w) <= horizon, "test").otherwise("train"))
