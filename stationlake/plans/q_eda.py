"""Registered EDA tables (binding D with names from N)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationlake.operators import eda as E
from stationlake.plans import bindings as B
from stationlake.plans.registry import R, W, r6, register

# Binding D spans 1995-2001, so the trend window, the first/last period and the
# anomaly threshold are scaled down (reference: 10 years, 30 years, 3 sigma --
# the operator defaults). A row in its own group of n has |z| <= (n-1)/sqrt(n),
# so 3 sigma cannot fire on D's day-of-year groups of about 7 rows.
TREND_K = 3
DELTA_K = 2
Z_THRESHOLD = 1.5
SINCE_YEAR = 1998


@register("monthly_climatology", W(f"""
SELECT d.station_id, n.station_name,
       {", ".join(f"{R(f'avg(d.tmax) FILTER (WHERE month(d.obs_date) = {m})')} AS m{m:02d}" for m in range(1, 13))}
FROM d JOIN n USING (station_id) GROUP BY 1, 2""", "d", "n"))
def monthly_climatology(spark, sf):
    return r6(E.monthly_climatology(B.daily_sparse(spark, sf), B.dim_station(spark, sf)))


@register("station_columns", W(f"""
SELECT 'month' AS axis, m.k AS position, s.station_name, {R("avg(d.tmax)")} AS value
FROM (SELECT DISTINCT CAST(month(obs_date) AS INTEGER) AS k FROM d) m
CROSS JOIN (SELECT DISTINCT station_id, n.station_name FROM d JOIN n USING (station_id)) s
LEFT JOIN d ON d.station_id = s.station_id AND month(d.obs_date) = m.k GROUP BY ALL
UNION ALL
SELECT 'year', y.k, s.station_name, CASE WHEN count(d.station_id) > 0 THEN CAST(count(d.tmax) AS DOUBLE) END
FROM (SELECT DISTINCT CAST(year(obs_date) AS INTEGER) AS k FROM d) y
CROSS JOIN (SELECT DISTINCT station_id, n.station_name FROM d JOIN n USING (station_id)) s
LEFT JOIN d ON d.station_id = s.station_id AND year(d.obs_date) = y.k GROUP BY ALL""", "d", "n"))
def station_columns(spark, sf):
    """Both tables with a column a station (names found in the data), read back cell by cell."""
    d, n = B.daily_sparse(spark, sf), B.dim_station(spark, sf)
    out = None
    for axis, wide in (("month", E.climatology_by_station(d, n)), ("year", E.coverage_by_station(d, n))):
        names = [F.col(f"`{c}`").cast("double").alias(c) for c in wide.columns if c != axis]
        cells = wide.select(axis, *names).unpivot([axis], [F.col(f"`{c}`") for c in wide.columns if c != axis], "station_name", "value")
        part = cells.select(F.lit(axis).alias("axis"), F.col(axis).alias("position"), "station_name", "value")
        out = part if out is None else out.unionByName(part)
    return r6(out)


@register("seasonal_amplitude", W(f"""
SELECT p.station_id, n.station_name, {R("max(p.mean) - min(p.mean)")} AS amplitude
FROM (SELECT station_id, month(obs_date) AS m, avg(tmax) AS mean FROM d GROUP BY 1, 2) p JOIN n USING (station_id)
GROUP BY 1, 2""", "d", "n"))
def seasonal_amplitude(spark, sf):
    return r6(E.seasonal_amplitude(B.daily_sparse(spark, sf), B.dim_station(spark, sf)))


_ANNUAL = """
SELECT station_id, year, annual_mean FROM (
  SELECT station_id, CAST(year(obs_date) AS INTEGER) AS year, avg(tavg) AS annual_mean, max(obs_date) AS last_day
  FROM d WHERE tavg IS NOT NULL GROUP BY 1, 2)
QUALIFY NOT (year = max(year) OVER (PARTITION BY station_id)
             AND NOT (month(last_day) = 12 AND day(last_day) = 31))"""


@register("annual_trend", W(f"""
SELECT station_id, year, {R("annual_mean")} AS annual_mean,
       {R(f"CASE WHEN count(annual_mean) OVER w >= {TREND_K} THEN avg(annual_mean) OVER w END")} AS rolling_mean
FROM ({_ANNUAL})
WINDOW w AS (PARTITION BY station_id ORDER BY year ROWS BETWEEN {TREND_K - 1} PRECEDING AND CURRENT ROW)""", "d"))
def annual_trend(spark, sf):
    return r6(E.annual_trend(B.daily_sparse(spark, sf), k=TREND_K))


@register("warming_delta", W(f"""
SELECT station_id, {R("first_mean")} AS first_mean, {R("last_mean")} AS last_mean, {R("last_mean - first_mean")} AS delta
FROM (SELECT station_id,
             avg(annual_mean) FILTER (WHERE ra <= {DELTA_K}) AS first_mean,
             avg(annual_mean) FILTER (WHERE rd <= {DELTA_K}) AS last_mean
      FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY year) AS ra,
                      row_number() OVER (PARTITION BY station_id ORDER BY year DESC) AS rd FROM ({_ANNUAL}))
      GROUP BY 1)""", "d"))
def warming_delta(spark, sf):
    return r6(E.warming_delta(B.daily_sparse(spark, sf), k=DELTA_K))


@register("yearly_coverage", W("""
SELECT n.station_name, CAST(year(d.obs_date) AS INTEGER) AS year, count(d.tmax) AS days_with_value
FROM d JOIN n USING (station_id) GROUP BY 1, 2""", "d", "n"))
def yearly_coverage(spark, sf):
    return E.yearly_coverage(B.daily_sparse(spark, sf), B.dim_station(spark, sf))


@register("doy_normals", W(f"""
SELECT station_id, CAST(dayofyear(obs_date) AS INTEGER) AS doy, {R("avg(tmax)")} AS doy_mean,
       {R("stddev_samp(tmax)")} AS doy_std, count(tmax) AS n
FROM d GROUP BY 1, 2""", "d"))
def doy_normals(spark, sf):
    return r6(E.doy_normals(B.daily_sparse(spark, sf)))


_Z = """
SELECT station_id, obs_date, tmax, doy_mean, doy_std, (tmax - doy_mean) / nullif(doy_std, 0) AS z FROM (
  SELECT station_id, obs_date, tmax,
         avg(tmax) OVER (PARTITION BY station_id, dayofyear(obs_date)) AS doy_mean,
         stddev_samp(tmax) OVER (PARTITION BY station_id, dayofyear(obs_date)) AS doy_std
  FROM d)"""


@register("doy_anomalies", W(f"""
SELECT station_id, obs_date, tmax, {R("doy_mean")} AS doy_mean, {R("doy_std")} AS doy_std, {R("z")} AS z,
       CAST(row_number() OVER (PARTITION BY station_id ORDER BY z DESC, obs_date) AS INTEGER) AS z_rank
FROM ({_Z}) WHERE abs(z) > {Z_THRESHOLD}""", "d"))
def doy_anomalies(spark, sf):
    return r6(E.doy_anomalies(B.daily_sparse(spark, sf), threshold=Z_THRESHOLD))


@register("anomaly_counts", W(f"""
SELECT station_id, count(*) FILTER (WHERE abs(z) > {Z_THRESHOLD}) AS n_anomalies,
       count(*) FILTER (WHERE abs(z) > {Z_THRESHOLD} AND year(obs_date) >= {SINCE_YEAR}) AS n_anomalies_since
FROM ({_Z}) GROUP BY 1""", "d"))
def anomaly_counts(spark, sf):
    return E.anomaly_counts(B.daily_sparse(spark, sf), threshold=Z_THRESHOLD, since_year=SINCE_YEAR)


_CORR_COLS = ["tmax", "tmin", "tavg", "temp_range", "prcp"]


def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(_CORR_COLS):
        for b in _CORR_COLS[i + 1:]:
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            expr = (f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) FILTER (WHERE {both}) * "
                    f"stddev_pop({b}) FILTER (WHERE {both}), 0)")
            parts.append(f"SELECT station_id, '{a}' AS var_a, '{b}' AS var_b, {R(expr)} AS corr "
                         f"FROM d GROUP BY station_id")
    return "\nUNION ALL\n".join(parts)


@register("correlations", W(_corr_sql(), "d"))
def correlations(spark, sf):
    return r6(E.correlations(B.daily_sparse(spark, sf), _CORR_COLS))
