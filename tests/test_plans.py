"""Plan shape: shuffles, broadcasts, pushdown and the absence of row-at-a-time Python."""

import datetime as dt
import re

from pyspark.sql import functions as F

from stationlake.operators import features as FT
from stationlake.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_one_exchange_on_station(spark):
    df = spark.createDataFrame(
        [("A", dt.date(2001, 1, 1) + dt.timedelta(i), float(i), 0.0, 1.0, 0.0) for i in range(60)],
        "station_id string, obs_date date, tmax double, tmin double, temp_range double, prcp double")
    p = plan(FT.features(df))
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)", p)
    assert len(exchanges) == 1 and "station_id" in exchanges[0][1]


def test_dimension_joins_are_broadcast(spark):
    p = plan(QUERIES["gap_analysis"](spark, SF))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_no_row_at_a_time_python(spark):
    for name in ["features", "daily_enriched", "pivot_daily", "parse_fixed_width", "doy_anomalies", "forecast_scores"]:
        p = plan(QUERIES[name](spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_filters_and_columns_reach_the_scan(spark):
    df = QUERIES["model_ready"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_custkey)" in p or "IsNotNull(o_custkey)" in p
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert scans and all("o_comment" not in s and "o_orderpriority" not in s for s in scans)


def _daily(spark, tmp_path):
    rows = [(s, dt.date(2001, 1, 1) + dt.timedelta(i), float(i % 40)) for s in "AB" for i in range(800)]
    df = spark.createDataFrame(rows, "station_id string, obs_date date, tmax double")
    df.write.parquet(str(tmp_path / "daily"))
    return spark.read.parquet(str(tmp_path / "daily"))


def test_model_ready_does_not_shuffle_the_fact(spark, tmp_path):
    from stationlake.operators import quality as Q

    p = plan(Q.model_ready(_daily(spark, tmp_path), "2001-06-01", "2001-01-01", "2002-01-01", 0.5))
    assert "LeftSemi" in p and "BroadcastHashJoin" in p
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)", p)
    assert len(keys) == 1 and "partial_count" in p  # the partial counts, inside the small side


def test_extreme_days_joins_a_threshold(spark, tmp_path):
    from stationlake.operators import views as V

    stations = spark.createDataFrame([("A", "Alpha"), ("B", "Beta")], "station_id string, station_name string")
    p = plan(V.extreme_days(_daily(spark, tmp_path), stations, 2001))
    assert "Window" not in p and "partial_percentile" in p and p.count("BroadcastHashJoin") >= 2


def test_anomalies_deal_the_fact_once(spark, tmp_path):
    from stationlake.operators import eda as E

    daily = _daily(spark, tmp_path)
    for df in (E.doy_anomalies(daily), E.anomaly_counts(daily)):
        assert len(re.findall(r"Exchange hashpartitioning", plan(df))) == 1


def test_grouped_forecast_is_the_only_python_node(spark):
    p = plan(QUERIES["seasonal_forecast"](spark, SF))
    assert "FlatMapGroupsInPandas" in p
