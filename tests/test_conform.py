"""Conform and curate: precedence, QA filter, pivot, units, skew-safe dedupe."""

import datetime as dt

from pyspark.sql import functions as F

from stationlake.operators import conform as C

RAW = ("station_id string, obs_date date, element string, value_raw int, mflag string, qflag string, "
       "sflag string, source_rank int, arrival long")
D1 = dt.date(2001, 1, 1)


def test_csv_wins_and_flagged_first_hides_good_second(spark):
    rows = [
        # same grain in CSV (rank 0) and fixed-width (rank 1): the CSV row wins
        ("S1", D1, "TMAX", 100, None, None, None, 1, 0), ("S1", D1, "TMAX", 111, None, None, None, 0, 5),
        # first arrival flagged, second good: the grain is absent from curated
        ("S1", D1, "TMIN", 50, None, "X", None, 0, 1), ("S1", D1, "TMIN", 40, None, None, None, 0, 2),
    ]
    audit = C.audit_table(spark.createDataFrame(rows, RAW))
    got = {r.element: r for r in audit.collect()}
    assert got["TMAX"].value == 11.1 and got["TMIN"].qflag == "X"
    wide = C.pivot_daily(audit).collect()
    assert len(wide) == 1 and wide[0].tmax == 11.1 and wide[0].tmin is None and wide[0].temp_range is None


def test_all_flagged_station_day_in_audit_not_curated(spark):
    rows = [("S2", D1, "TMAX", 100, None, "X", None, 0, 0), ("S2", D1, "PRCP", 3, None, "O", None, 0, 1)]
    audit = C.audit_table(spark.createDataFrame(rows, RAW))
    assert audit.count() == 2
    assert C.pivot_daily(audit).count() == 0


def test_pivot_fixed_columns_units_and_range(spark):
    rows = [("S3", D1, "TMAX", 215, None, None, None, 0, 0), ("S3", D1, "TMIN", -13, None, None, None, 0, 1),
            ("S3", D1, "SNWD", 40, None, None, None, 0, 2), ("S3", D1, "XXXX", 1, None, None, None, 0, 3)]
    wide = C.pivot_daily(C.audit_table(spark.createDataFrame(rows, RAW)))
    assert wide.columns[:3] == ["station_id", "date_key", "obs_date"]
    assert {"tsun", "awnd", "temp_range"} <= set(wide.columns)
    r = wide.collect()[0]
    assert (r.tmax, r.tmin, r.snwd, r.date_key) == (21.5, -1.3, 40.0, 20010101)
    assert abs(r.temp_range - 22.8) < 1e-9 and r.tsun is None


def test_sentinel_and_blank_flags(spark):
    rows = [("S4", D1, "PRCP", -9999, " ", "", " ", 0, 0), ("S4", dt.date(2001, 1, 2), "PRCP", 0, " ", "", "E", 0, 1)]
    audit = C.audit_table(spark.createDataFrame(rows, RAW)).collect()
    assert len(audit) == 1 and audit[0].mflag is None and audit[0].qflag is None and audit[0].sflag == "E"


def test_dedupe_hot_grain_keeps_first_arrival(spark):
    """One grain repeated by most rows: a single row survives, the earliest arrival."""
    n = 50_000
    hot = spark.range(n).select(F.lit("HOT").alias("station_id"), F.lit(D1).alias("obs_date"),
                                F.lit("TMAX").alias("element"), (F.col("id") % 97).cast("int").alias("value_raw"),
                                (n - F.col("id")).alias("arrival"))
    cold = spark.range(1000).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("station_id"),
                                    F.lit(D1).alias("obs_date"), F.lit("TMAX").alias("element"),
                                    F.lit(1).alias("value_raw"), F.col("id").alias("arrival"))
    out = C.dedupe_first(hot.unionByName(cold), C.GRAIN, ["arrival"])
    assert out.count() == 1001
    h = out.where("station_id = 'HOT'").collect()[0]
    assert h.arrival == 1 and h.value_raw == (n - 1) % 97


def test_stage_summary(spark):
    rows = [("S5", D1, "TMAX", 1, None, None, None, 0, 0), ("S5", D1, "TMIN", 1, None, "X", None, 0, 1),
            ("S5", dt.date(2001, 1, 2), "TMAX", 1, None, "X", None, 0, 2)]
    s = C.stage_summary(C.audit_table(spark.createDataFrame(rows, RAW))).collect()[0]
    assert (s.n_observations, s.n_station_days, s.n_flagged) == (3, 1, 2)
    assert (s.first_date, s.last_date) == (D1, dt.date(2001, 1, 2))
