"""Audits, contract checks, views and questions on hand-written fixtures."""

import datetime as dt

from stationlake.operators import quality as Q
from stationlake.operators import views as V

DAILY = "station_id string, obs_date date, tmax double, tmin double, tavg double, prcp double"
STATIONS = [("A", "Alpha"), ("B", "Beta"), ("C", "Gamma")]


def d(y, m, day):
    return dt.date(y, m, day)


def daily(spark, rows):
    rows = [(r[0], r[1], *[None if v is None else float(v) for v in r[2:]]) for r in rows]
    return spark.createDataFrame(rows, DAILY)


def stations(spark):
    return spark.createDataFrame(STATIONS, "station_id string, station_name string")


def test_gaps_year_end_and_single_row(spark):
    rows = [("A", d(2000, 12, 30), 1.0, 0.0, 0.5, 0.0), ("A", d(2000, 12, 31), 1.0, 0.0, 0.5, 0.0),
            ("A", d(2001, 1, 2), 1.0, 0.0, 0.5, 0.0), ("A", d(2001, 1, 5), 1.0, 0.0, 0.5, 0.0),
            ("B", d(2001, 1, 1), 1.0, 0.0, 0.5, 0.0)]
    g = {(r.station_id, r.obs_date): r.days_since_prev for r in Q.gaps(daily(spark, rows)).collect()}
    assert g[("A", d(2000, 12, 30))] is None and g[("A", d(2000, 12, 31))] == 1
    assert g[("A", d(2001, 1, 2))] == 2 and g[("A", d(2001, 1, 5))] == 3 and g[("B", d(2001, 1, 1))] is None
    a = {r.station_id: r for r in Q.gap_analysis(daily(spark, rows), stations(spark)).collect()}
    assert (a["A"].gap_count, a["A"].longest_gap_days) == (2, 3)
    assert (a["B"].gap_count, a["B"].longest_gap_days) == (0, None)


def test_impossible_days_and_outliers(spark):
    rows = [("A", d(2001, 1, 1), 5.0, 7.0, 6.0, 0.0), ("A", d(2001, 1, 2), 60.0, 1.0, 6.0, 600.0),
            ("B", d(2001, 1, 1), -70.0, -80.0, -75.0, 0.0)]
    imp = Q.impossible_days(daily(spark, rows), stations(spark)).collect()
    assert [(r.station_name, r.obs_date) for r in imp] == [("Alpha", d(2001, 1, 1))]
    out = sorted((r.station_name, r.metric, r.value) for r in Q.outlier_scan(daily(spark, rows), stations(spark)).collect())
    assert out == [("Alpha", "prcp", 600.0), ("Alpha", "tmax", 60.0), ("Beta", "tmax", -70.0)]


def test_contract_overflow_orphan_and_null(spark):
    rows = [("A", d(2001, 1, 1), 12345.6, 1.0, 1.0, 1.0), ("ZZZZZZZZZZZZ", d(2001, 1, 2), None, 1.0, 1.0, 1.0)]
    df = daily(spark, rows)
    dec = {r.column_name: r for r in Q.decimal_contract(df, {"tmax": (5, 1)}, {"station_id": 11}).collect()}
    assert (dec["tmax"].n_checked, dec["tmax"].violations) == (1, 1)
    assert dec["station_id"].violations == 1
    fk = Q.fk_violations(df, "station_id", stations(spark), "station_id", "daily_station").collect()[0]
    assert fk.violations == 1
    nulls = {r.column_name: r.null_count for r in Q.null_violations(df, "daily", ["station_id", "tmax"]).collect()}
    assert nulls == {"station_id": 0, "tmax": 1}
    dup = Q.duplicate_grain(df.unionByName(df.limit(1)), ["station_id", "obs_date"]).collect()
    assert [(r.station_id, r.n_rows) for r in dup] == [("A", 2)]


def test_streaks_threshold_and_breaks(spark):
    rows = [("A", d(2001, 1, 1), 1, 0, 0, 1.0), ("A", d(2001, 1, 2), 1, 0, 0, 2.0),  # streak of 2 (1.0 is >=)
            ("A", d(2001, 1, 4), 1, 0, 0, 5.0),  # missing day 3 breaks it: streak of 1
            ("A", d(2001, 1, 5), 1, 0, 0, 0.99),  # below threshold
            ("B", d(2001, 1, 1), 1, 0, 0, 3.0), ("B", d(2001, 1, 2), 1, 0, 0, 3.0)]
    s = sorted((r.station_id, r.streak_start, r.streak_days) for r in V.rain_streaks(daily(spark, rows)).collect())
    assert s == [("A", d(2001, 1, 1), 2), ("A", d(2001, 1, 4), 1), ("B", d(2001, 1, 1), 2)]
    best = sorted((r.station_name, r.streak_days) for r in V.longest_streak(daily(spark, rows), stations(spark)).collect())
    assert best == [("Alpha", 2), ("Beta", 2)]


def test_records_first_row_and_ties(spark):
    rows = [("A", d(2001, 1, 1), 10.0, 0, 0, 0), ("A", d(2001, 1, 2), 10.0, 0, 0, 0),
            ("A", d(2001, 1, 3), 12.0, 0, 0, 0), ("A", d(2001, 1, 4), None, 0, 0, 0), ("A", d(2001, 1, 5), 11.0, 0, 0, 0)]
    rec = {r.obs_date: r.prior_record for r in V.record_days(daily(spark, rows)).collect()}
    assert rec[d(2001, 1, 1)] is None and rec[d(2001, 1, 2)] == 10.0 and d(2001, 1, 4) not in rec
    top = V.top_records(daily(spark, rows)).collect()
    assert [(r.obs_date, r.beat_by) for r in top] == [(d(2001, 1, 3), 2.0)]  # the tie is not a record


def test_view_rounding_is_half_up(spark):
    rows = [("A", d(2001, 1, 1), 0.25, 0, 0, 0), ("A", d(2001, 1, 2), 0.0, 0, 0, 0)]
    m = V.monthly_summary(daily(spark, rows), stations(spark), digits=1).collect()[0]
    assert m.avg_tmax == 0.1 and m.month_name == "Jan" and m.days_reported == 2  # 0.125 -> 0.1 (one decimal)
    r = V.rolling_climate(daily(spark, [("A", d(2001, 1, 1), 0.15, 0, 0, 0.05)]), digits=1).collect()[0]
    assert r.tmax_7d_avg == 0.2 and r.prcp_30d_total == 0.1


def test_thresholds_interpolate(spark):
    rows = [("A", d(2001, 1, i + 1), float(i), float(i), 0, float(i)) for i in range(21)]
    t = V.station_thresholds(daily(spark, rows)).collect()[0]
    assert t.p95_tmax == 19.0 and t.p05_tmin == 1.0
    assert abs(t.p95_wet_day_prcp - 19.05) < 1e-9  # 20 wet days 1..20: position 18.05


def test_model_ready_coverage(spark):
    rows = [("A", d(2001, 1, i), 1.0, 0, 0, 0) for i in range(1, 11)] + [("B", d(2001, 1, 1), 1.0, 0, 0, 0)]
    ready = Q.model_ready(daily(spark, rows), start="2001-01-01", coverage_start="2001-01-01",
                          coverage_end="2001-01-11", coverage=0.95)
    assert {r.station_id for r in ready.collect()} == {"A"}
