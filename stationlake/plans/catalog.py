"""SQL surface: register the warehouse tables and the analysis views as temp views.

Users who query the warehouse in SQL keep their table and view names; each view
is the DataFrame operator of the same meaning, so ``spark.sql`` over these
names gets the same plans (broadcast dimension joins, station-partitioned
windows) as the Python API.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationlake.operators import quality as Q
from stationlake.operators import views as V

# Table and view names of the warehouse's SQL surface (fixed values).
TABLE_NAMES = {
    "daily": "fact_daily_weather",
    "observations": "fact_weather_observations",
    "dim_station": "dim_station",
    "dim_date": "dim_date",
    "dim_element": "dim_element",
}
VIEW_NAMES = [
    "vw_daily_weather", "vw_monthly_summary", "vw_rolling_climate", "vw_record_days",
    "vw_rain_streaks", "vw_station_thresholds", "vw_model_ready",
]


def register_warehouse(spark: SparkSession, tables: dict[str, DataFrame], digits: int | None = 1,
                       rain_threshold: float = 1.0, **model_ready_args) -> list[str]:
    """Create or replace the temp views; returns the registered names.

    ``tables`` uses the keys of ``build_warehouse``: daily, observations,
    dim_station, dim_date, dim_element. ``digits`` is the rounding of the
    summary views (1 decimal, as the views they stand for).
    """
    names = []
    for key, name in TABLE_NAMES.items():
        if key in tables:
            tables[key].createOrReplaceTempView(name)
            names.append(name)
    daily, stations = tables["daily"], tables["dim_station"]
    views = {
        "vw_daily_weather": V.daily_enriched(daily, stations),
        "vw_monthly_summary": V.monthly_summary(daily, stations, digits=digits),
        "vw_rolling_climate": V.rolling_climate(daily, digits=digits),
        "vw_record_days": V.record_days(daily),
        "vw_rain_streaks": V.rain_streaks(daily, rain_threshold),
        "vw_station_thresholds": V.station_thresholds(daily),
        "vw_model_ready": Q.model_ready(daily, **model_ready_args),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
        names.append(name)
    return names
