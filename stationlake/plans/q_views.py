"""Registered analysis views and questions (binding D with names from N)."""

from __future__ import annotations

from stationlake.operators import views as V
from stationlake.plans import bindings as B
from stationlake.plans.registry import R, W, r6, register

_SEASON = ("CASE WHEN month(d.obs_date) IN (12, 1, 2) THEN 'Winter' WHEN month(d.obs_date) IN (3, 4, 5) THEN 'Spring' "
           "WHEN month(d.obs_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END")


@register("daily_enriched", W(f"""
SELECT d.obs_date, CAST(year(d.obs_date) AS INTEGER) AS year, CAST(month(d.obs_date) AS INTEGER) AS month,
       strftime(d.obs_date, '%b') AS month_name, {_SEASON} AS season_nh,
       CAST(dayofyear(d.obs_date) AS INTEGER) AS day_of_year, CAST(weekofyear(d.obs_date) AS INTEGER) AS week_of_year,
       d.station_id, n.station_name, n.country, n.climate_zone, n.latitude, n.elevation_m,
       d.tmax, d.tmin, {R("d.tavg")} AS tavg, d.temp_range, {R("d.prcp")} AS prcp,
       d.snow, d.snwd, d.awnd, d.wsfg
FROM d JOIN n USING (station_id)""", "d", "n"))
def daily_enriched(spark, sf):
    return r6(V.daily_enriched(B.daily_sparse(spark, sf), B.dim_station(spark, sf)))


@register("monthly_summary", W(f"""
SELECT d.station_id, n.station_name, CAST(year(d.obs_date) AS INTEGER) AS year,
       CAST(month(d.obs_date) AS INTEGER) AS month, strftime(min(d.obs_date), '%b') AS month_name,
       {R("avg(d.tmax)")} AS avg_tmax, {R("avg(d.tmin)")} AS avg_tmin, {R("sum(d.prcp)")} AS total_prcp,
       max(d.tmax) AS hottest_day, min(d.tmin) AS coldest_day, count(d.tmax) AS days_reported
FROM d JOIN n USING (station_id) GROUP BY 1, 2, 3, 4""", "d", "n"))
def monthly_summary(spark, sf):
    return r6(V.monthly_summary(B.daily_sparse(spark, sf), B.dim_station(spark, sf), digits=None))


@register("rolling_climate", W(f"""
SELECT station_id, obs_date, tmax, {R("prcp")} AS prcp,
       {R("avg(tmax) OVER w7")} AS tmax_7d_avg, {R("avg(tmax) OVER w30")} AS tmax_30d_avg,
       {R("sum(prcp) OVER w30")} AS prcp_30d_total
FROM d
WINDOW w7 AS (PARTITION BY station_id ORDER BY obs_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w30 AS (PARTITION BY station_id ORDER BY obs_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""", "d"))
def rolling_climate(spark, sf):
    return r6(V.rolling_climate(B.daily_sparse(spark, sf), digits=None))


_RECORD_SQL = """
SELECT station_id, obs_date, tmax,
       max(tmax) OVER (PARTITION BY station_id ORDER BY obs_date
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_record
FROM d WHERE tmax IS NOT NULL"""


@register("record_days", W(_RECORD_SQL, "d"))
def record_days(spark, sf):
    return V.record_days(B.daily_sparse(spark, sf))


_STREAK_SQL = """
SELECT station_id, min(obs_date) AS streak_start, max(obs_date) AS streak_end, count(*) AS streak_days
FROM (SELECT station_id, obs_date,
             obs_date - CAST(row_number() OVER (PARTITION BY station_id ORDER BY obs_date) AS INTEGER) AS grp
      FROM d WHERE prcp >= 1.0)
GROUP BY station_id, grp"""


@register("rain_streaks", W(_STREAK_SQL, "d"))
def rain_streaks(spark, sf):
    return V.rain_streaks(B.daily_sparse(spark, sf), 1.0)


def pct_sql(src: str, col: str, p: float, where: str = "TRUE") -> str:
    """Exact interpolated percentile per station in plain SQL: position (n-1)*p between
    the values at floor and ceil, weighted as (ceil-pos)*lo + (pos-floor)*hi; an integer
    position or equal neighbours return the value itself."""
    return f"""(
  WITH s AS (SELECT station_id, {col} AS v,
                    row_number() OVER (PARTITION BY station_id ORDER BY {col}) - 1 AS i,
                    count(*) OVER (PARTITION BY station_id) AS n
             FROM {src} WHERE {col} IS NOT NULL AND ({where})),
       q AS (SELECT DISTINCT station_id, CAST(n - 1 AS DOUBLE) * {p} AS pos FROM s)
  SELECT q.station_id,
         CASE WHEN ceil(q.pos) = floor(q.pos) OR lo.v = hi.v THEN lo.v
              ELSE (ceil(q.pos) - q.pos) * lo.v + (q.pos - floor(q.pos)) * hi.v END AS v
  FROM q JOIN s lo ON lo.station_id = q.station_id AND lo.i = floor(q.pos)
         JOIN s hi ON hi.station_id = q.station_id AND hi.i = ceil(q.pos))"""


_THRESH_SQL = f"""
SELECT k.station_id, {R("a.v")} AS p95_tmax, {R("b.v")} AS p05_tmin, {R("c.v")} AS p95_wet_day_prcp
FROM (SELECT DISTINCT station_id FROM d) k
LEFT JOIN {pct_sql("d", "tmax", 0.95)} a ON a.station_id = k.station_id
LEFT JOIN {pct_sql("d", "tmin", 0.05)} b ON b.station_id = k.station_id
LEFT JOIN {pct_sql("d", "prcp", 0.95, "prcp > 0")} c ON c.station_id = k.station_id"""


@register("station_thresholds", W(_THRESH_SQL, "d"))
def station_thresholds(spark, sf):
    return r6(V.station_thresholds(B.daily_sparse(spark, sf)))


@register("top_records", W(f"""
SELECT station_id, obs_date, tmax, prior_record, beat_by, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY station_id ORDER BY beat_by DESC, obs_date) AS INTEGER) AS rank
  FROM (SELECT *, {R("tmax - prior_record")} AS beat_by FROM ({_RECORD_SQL}) WHERE tmax > prior_record))
WHERE rank <= 10""", "d"))
def top_records(spark, sf):
    return r6(V.top_records(B.daily_sparse(spark, sf), k=10, digits=None))


@register("longest_streak", W(f"""
SELECT n.station_name, s.streak_start, s.streak_end, s.streak_days
FROM ({_STREAK_SQL}) s JOIN n USING (station_id)
WHERE (s.station_id, s.streak_days) IN (SELECT station_id, max(streak_days) FROM ({_STREAK_SQL}) GROUP BY station_id)""",
                              "d", "n"))
def longest_streak(spark, sf):
    return V.longest_streak(B.daily_sparse(spark, sf), B.dim_station(spark, sf), 1.0)


@register("decade_change", W(f"""
SELECT station_id, decade, {R("avg_temp")} AS avg_temp,
       {R("avg_temp - lag(avg_temp) OVER (PARTITION BY station_id ORDER BY decade)")} AS change_vs_prev
FROM (SELECT station_id, CAST((year(obs_date) // 10) * 10 AS INTEGER) AS decade, avg(tavg) AS avg_temp
      FROM d WHERE tavg IS NOT NULL GROUP BY 1, 2)""", "d"))
def decade_change(spark, sf):
    return r6(V.decade_change(B.daily_sparse(spark, sf), digits=None))


EXTREME_FROM = 1996


@register("extreme_days", W(f"""
SELECT CAST(year(d.obs_date) AS INTEGER) AS year, n.station_name, count(*) AS extreme_heat_days
FROM d JOIN n USING (station_id)
JOIN {pct_sql("d", "tmax", 0.95)} t ON t.station_id = d.station_id
WHERE d.tmax > t.v AND year(d.obs_date) >= {EXTREME_FROM}
GROUP BY 1, 2""", "d", "n"))
def extreme_days(spark, sf):
    return V.extreme_days(B.daily_sparse(spark, sf), B.dim_station(spark, sf), from_year=EXTREME_FROM)
