"""Registered series and feature queries (binding F dense, D sparse)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationlake.operators import features as FT
from stationlake.operators import series as S
from stationlake.plans import bindings as B
from stationlake.plans.registry import R, W, r6, register
from stationlake.schema import FEATURE_COLUMNS, TARGET

# Binding F spans 1995-01 .. 2001-11; the chronological split (reference 2010-01-01) is 2000-01-01.
SPLIT = "2000-01-01"
HORIZON = 24


def dense_sql(src: str, cols: str) -> str:
    """Calendar-complete daily rows per station (generate_series + left join)."""
    return f"""(
  SELECT s.station_id, CAST(g.day AS DATE) AS obs_date, {cols}, x.station_id IS NOT NULL AS is_observed
  FROM (SELECT station_id, min(obs_date) AS lo, max(obs_date) AS hi FROM {src} GROUP BY 1) s
  CROSS JOIN LATERAL generate_series(s.lo, s.hi, INTERVAL 1 DAY) AS g(day)
  LEFT JOIN {src} x ON x.station_id = s.station_id AND x.obs_date = CAST(g.day AS DATE))"""


@register("densify_daily", W(f"""
SELECT station_id, obs_date, tmax, tmin, {R("prcp")} AS prcp, is_observed
FROM {dense_sql("d", "x.tmax, x.tmin, x.prcp")}""", "d"))
def densify_daily(spark, sf):
    return r6(S.densify_daily(B.daily_sparse(spark, sf), ["tmax", "tmin", "prcp"]))


@register("cyclic_encode", W(f"""
SELECT station_id, obs_date, {R("sin(2 * pi() * dayofyear(obs_date) / 365.25)")} AS doy_sin,
       {R("cos(2 * pi() * dayofyear(obs_date) / 365.25)")} AS doy_cos, CAST(month(obs_date) AS INTEGER) AS month
FROM f""", "f"))
def cyclic_encode(spark, sf):
    return r6(FT.cyclic_encode(B.daily_dense(spark, sf).select("station_id", "obs_date")))


FEATURES_SQL = f"""
SELECT * FROM (
  SELECT station_id, obs_date,
         lead(tmax) OVER w AS {TARGET},
         tmax AS tmax_lag1, lag(tmax, 1) OVER w AS tmax_lag2, lag(tmax, 2) OVER w AS tmax_lag3,
         lag(tmax, 6) OVER w AS tmax_lag7, tmin AS tmin_today, temp_range AS temp_range_today,
         CASE WHEN count(tmax) OVER w7 >= 5 THEN avg(tmax) OVER w7 END AS tmax_roll7_mean,
         CASE WHEN count(tmax) OVER w30 >= 20 THEN avg(tmax) OVER w30 END AS tmax_roll30_mean,
         CASE WHEN count(tmax) OVER w7 >= 5 THEN stddev_samp(tmax) OVER w7 END AS tmax_roll7_std,
         tmax - lag(tmax, 1) OVER w AS tmax_delta_1d,
         prcp0 AS prcp_today,
         CASE WHEN count(*) OVER w7 >= 5 THEN sum(prcp0) OVER w7 END AS prcp_roll7_sum,
         sin(2 * pi() * dayofyear(obs_date) / 365.25) AS doy_sin,
         cos(2 * pi() * dayofyear(obs_date) / 365.25) AS doy_cos,
         CAST(month(obs_date) AS INTEGER) AS month
  FROM (SELECT *, coalesce(prcp, 0.0) AS prcp0 FROM {dense_sql("f", "x.tmax, x.tmin, x.temp_range, x.prcp")})
  WINDOW w AS (PARTITION BY station_id ORDER BY obs_date),
         w7 AS (PARTITION BY station_id ORDER BY obs_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w30 AS (PARTITION BY station_id ORDER BY obs_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in [TARGET, *FEATURE_COLUMNS])}"""


@register("features", W(f"""
SELECT station_id, obs_date, {", ".join(R(c) + " AS " + c if c != "month" else c for c in [TARGET, *FEATURE_COLUMNS])}
FROM ({FEATURES_SQL})""", "f"))
def features(spark, sf):
    return r6(FT.features(B.daily_dense(spark, sf)))


def monthly_sql(src: str, min_days: int, lo: int, hi: int, limit: int = 2) -> str:
    """Monthly mean with support filter, dense month axis, limited linear interpolation."""
    before = "PARTITION BY station_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    after = "PARTITION BY station_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    return f"""(
  WITH m AS (SELECT station_id, CAST(date_trunc('month', obs_date) AS DATE) AS month_start,
                    avg(tmax) AS avg_value, count(tmax) AS n
             FROM {src} WHERE year(obs_date) BETWEEN {lo} AND {hi} GROUP BY 1, 2 HAVING count(tmax) >= {min_days}),
       span AS (SELECT station_id, min(month_start) AS lo, max(month_start) AS hi FROM m GROUP BY 1),
       dense AS (SELECT s.station_id, CAST(g.ms AS DATE) AS month_start, m.avg_value,
                        CAST(year(g.ms) * 12 + month(g.ms) - 1 AS INTEGER) AS pos
                 FROM span s CROSS JOIN LATERAL generate_series(s.lo, s.hi, INTERVAL 1 MONTH) AS g(ms)
                 LEFT JOIN m ON m.station_id = s.station_id AND m.month_start = CAST(g.ms AS DATE)),
       k AS (SELECT *, max(CASE WHEN avg_value IS NOT NULL THEN pos END) OVER ({before}) AS p0,
                       last_value(avg_value IGNORE NULLS) OVER ({before}) AS v0,
                       min(CASE WHEN avg_value IS NOT NULL THEN pos END) OVER ({after}) AS p1,
                       first_value(avg_value IGNORE NULLS) OVER ({after}) AS v1
             FROM dense)
  SELECT station_id, month_start, avg_value,
         CASE WHEN avg_value IS NOT NULL THEN avg_value
              WHEN p0 IS NULL OR pos - p0 > {limit} THEN NULL
              WHEN p1 IS NULL THEN v0
              ELSE v0 + (v1 - v0) * (pos - p0) / (p1 - p0) END AS value
  FROM k)"""


F_MONTHLY = dict(first_year=1995, last_year=2001, min_days=20)
D_MONTHLY = dict(first_year=1995, last_year=2001, min_days=6)


def f_monthly(spark, sf):
    return S.monthly_series(B.daily_dense(spark, sf), "tmax", **F_MONTHLY)


@register("monthly_series", W(f"""
SELECT station_id, month_start, {R("avg_value")} AS avg_value, {R("value")} AS value
FROM {monthly_sql("f", 20, 1995, 2001)}""", "f"))
def monthly_series(spark, sf):
    return r6(f_monthly(spark, sf))


@register("interpolate_limited", W(f"""
SELECT station_id, month_start, {R("avg_value")} AS avg_value, {R("value")} AS value
FROM {monthly_sql("d", 6, 1995, 2001)}""", "d"))
def interpolate_limited(spark, sf):
    return r6(S.monthly_series(B.daily_sparse(spark, sf), "tmax", **D_MONTHLY))


HOLDOUT_SQL = f"""
SELECT station_id, month_start, value,
       CASE WHEN row_number() OVER (PARTITION BY station_id ORDER BY month_start DESC) <= {HORIZON}
            THEN 'test' ELSE 'train' END AS split
FROM {monthly_sql("f", 20, 1995, 2001)}"""


@register("holdout_split", W(f"""
SELECT station_id, month_start, {R("value")} AS value, split FROM ({HOLDOUT_SQL})""", "f"))
def holdout_split(spark, sf):
    return r6(S.holdout_split(f_monthly(spark, sf).select("station_id", "month_start", "value"), HORIZON))


def seasonal_naive_df(series, horizon: int = HORIZON):
    """Seasonal-naive MAE on the last ``horizon`` months: prediction = value 12 months earlier.

    Months where the actual or the naive value is missing are excluded and counted.
    """
    w = Window.partitionBy("station_id").orderBy("month_start")
    s = S.holdout_split(series.select("station_id", "month_start", "value"), horizon)
    s = s.withColumn("naive", F.lag("value", 12).over(w)).where(F.col("split") == "test")
    ok = F.col("value").isNotNull() & F.col("naive").isNotNull()
    return s.groupBy("station_id").agg(
        F.avg(F.when(ok, F.abs(F.col("value") - F.col("naive")))).alias("naive_mae"),
        F.count_if(ok).alias("n_scored"), F.count_if(~ok).alias("n_excluded"))


@register("seasonal_naive", W(f"""
SELECT station_id, {R("avg(abs(value - naive)) FILTER (WHERE value IS NOT NULL AND naive IS NOT NULL)")} AS naive_mae,
       count(*) FILTER (WHERE value IS NOT NULL AND naive IS NOT NULL) AS n_scored,
       count(*) FILTER (WHERE value IS NULL OR naive IS NULL) AS n_excluded
FROM (SELECT *, lag(value, 12) OVER (PARTITION BY station_id ORDER BY month_start) AS naive FROM ({HOLDOUT_SQL}))
WHERE split = 'test' GROUP BY station_id""", "f"))
def seasonal_naive(spark, sf):
    return r6(seasonal_naive_df(f_monthly(spark, sf)))


@register("feature_coverage", W(f"""
SELECT c.station_id, c.dense_days, c.missing_days, coalesce(k.complete_rows, 0) AS complete_rows,
       c.dense_days - coalesce(k.complete_rows, 0) AS dropped_rows
FROM (SELECT station_id, count(*) AS dense_days, count(*) FILTER (WHERE tmax IS NULL) AS missing_days
      FROM {dense_sql("f", "x.tmax")} GROUP BY 1) c
LEFT JOIN (SELECT station_id, count(*) AS complete_rows FROM ({FEATURES_SQL}) GROUP BY 1) k USING (station_id)""", "f"))
def feature_coverage(spark, sf):
    return FT.feature_coverage(B.daily_dense(spark, sf))
