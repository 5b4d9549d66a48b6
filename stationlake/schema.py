"""Data contracts: Spark schemas, keys, references and fixed reference values."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source format definition; stated as text).
# Element code, element name, unit -- in the order of the source format table.
ELEMENTS: list[tuple[str, str, str]] = [
    ("TMAX", "Maximum temperature", "deg C"),
    ("TMIN", "Minimum temperature", "deg C"),
    ("TAVG", "Average temperature", "deg C"),
    ("PRCP", "Precipitation", "mm"),
    ("SNOW", "Snowfall", "mm"),
    ("SNWD", "Snow depth", "mm"),
    ("AWND", "Average daily wind speed", "m/s"),
    ("WSFG", "Peak wind gust speed", "m/s"),
    ("WDFG", "Peak gust direction", "degrees"),
    ("TSUN", "Daily total sunshine", "minutes"),
]
# Elements stored in tenths of their unit; divided by 10 exactly once.
TENTHS: list[str] = ["TMAX", "TMIN", "TAVG", "PRCP", "AWND", "WSFG"]
# Missing-value sentinel of both raw formats.
MISSING = -9999
# Northern-hemisphere season of each calendar month 1..12.
SEASON_NH: list[str] = [
    "Winter", "Winter", "Spring", "Spring", "Spring", "Summer",
    "Summer", "Summer", "Autumn", "Autumn", "Autumn", "Winter",
]
# Reanalysis daily variables, in response order.
REANALYSIS_VARS: list[str] = [
    "temperature_2m_max", "temperature_2m_min", "temperature_2m_mean",
    "dew_point_2m_mean", "relative_humidity_2m_mean", "surface_pressure_mean",
    "cloud_cover_mean", "shortwave_radiation_sum",
    "wind_speed_10m_max", "wind_gusts_10m_max", "wind_direction_10m_dominant",
    "precipitation_sum", "rain_sum", "snowfall_sum",
]
# Default plausibility bounds of the outlier audit: (metric, low, high).
OUTLIER_BOUNDS: list[tuple[str, float | None, float | None]] = [
    ("tmax", -60.0, 50.0),
    ("prcp", None, 500.0),
]
# ---------------------------------------------------------------------------

MEASURES = ["tmax", "tmin", "tavg", "temp_range", "prcp", "snow", "snwd", "awnd", "wsfg", "wdfg", "tsun"]

# Raw long observation as produced by both parsers.
RAW_OBS = T.StructType([
    T.StructField("station_id", T.StringType(), False),
    T.StructField("obs_date", T.DateType(), False),
    T.StructField("element", T.StringType(), False),
    T.StructField("value_raw", T.IntegerType(), False),
    T.StructField("mflag", T.StringType(), True),
    T.StructField("qflag", T.StringType(), True),
    T.StructField("sflag", T.StringType(), True),
])

# By-station CSV as landed: every column read as text.
STATION_CSV = T.StructType([
    T.StructField(c, T.StringType(), True)
    for c in ["ID", "DATE", "ELEMENT", "DATA_VALUE", "M_FLAG", "Q_FLAG", "S_FLAG", "OBS_TIME"]
])

REANALYSIS_JSON = T.StructType([
    T.StructField("daily", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in REANALYSIS_VARS]
        + [T.StructField("sunrise", T.ArrayType(T.StringType())),
           T.StructField("sunset", T.ArrayType(T.StringType()))]
    ))
])


@dataclass(frozen=True)
class Contract:
    """Declared table: typed columns, primary key, NOT NULL set, references."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    references: dict[str, tuple[str, str]] = field(default_factory=dict)  # column -> (table, column)
    max_length: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    unique: tuple[str, ...] = ()

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


DIM_STATION = Contract(
    "dim_station",
    T.StructType([
        _f("station_id", T.StringType(), False), _f("station_name", T.StringType(), False),
        _f("country_code", T.StringType(), False), _f("country", T.StringType(), False),
        _f("latitude", T.DecimalType(8, 4), False), _f("longitude", T.DecimalType(9, 4), False),
        _f("elevation_m", T.DecimalType(7, 1)), _f("is_gsn", T.ShortType(), False),
        _f("wmo_id", T.StringType()), _f("climate_zone", T.StringType()),
    ]),
    key=("station_id",),
    max_length={"station_id": 11, "country_code": 2, "wmo_id": 5},
    defaults={"is_gsn": 0},
)

DIM_DATE = Contract(
    "dim_date",
    T.StructType([
        _f("date_key", T.IntegerType(), False), _f("date", T.DateType(), False),
        _f("year", T.IntegerType(), False), _f("quarter", T.IntegerType(), False),
        _f("month", T.IntegerType(), False), _f("month_name", T.StringType(), False),
        _f("day", T.IntegerType(), False), _f("day_of_week", T.IntegerType(), False),
        _f("day_name", T.StringType(), False), _f("day_of_year", T.IntegerType(), False),
        _f("week_of_year", T.IntegerType(), False), _f("is_weekend", T.IntegerType(), False),
        _f("season_nh", T.StringType(), False),
    ]),
    key=("date_key",),
    unique=("date",),
)

DIM_ELEMENT = Contract(
    "dim_element",
    T.StructType([_f("element", T.StringType(), False), _f("element_name", T.StringType(), False),
                  _f("unit", T.StringType(), False)]),
    key=("element",),
    max_length={"element": 4},
)

OBSERVATIONS = Contract(
    "observations",
    T.StructType([
        _f("station_id", T.StringType(), False), _f("date_key", T.IntegerType(), False),
        _f("element", T.StringType(), False), _f("value", T.DecimalType(8, 1), False),
        _f("mflag", T.StringType()), _f("qflag", T.StringType()), _f("sflag", T.StringType()),
    ]),
    key=("station_id", "date_key", "element"),
    references={"station_id": ("dim_station", "station_id"), "date_key": ("dim_date", "date_key"),
                "element": ("dim_element", "element")},
    max_length={"station_id": 11, "element": 4, "mflag": 1, "qflag": 1, "sflag": 1},
)

_DEC51, _DEC71, _DEC61 = T.DecimalType(5, 1), T.DecimalType(7, 1), T.DecimalType(6, 1)
DAILY = Contract(
    "daily",
    T.StructType([
        _f("station_id", T.StringType(), False), _f("date_key", T.IntegerType(), False),
        _f("obs_date", T.DateType(), False),
        _f("tmax", _DEC51), _f("tmin", _DEC51), _f("tavg", _DEC51), _f("temp_range", _DEC51),
        _f("prcp", _DEC71), _f("snow", _DEC71), _f("snwd", _DEC71),
        _f("awnd", _DEC51), _f("wsfg", _DEC51), _f("wdfg", _DEC51), _f("tsun", _DEC61),
    ]),
    key=("station_id", "date_key"),
    references={"station_id": ("dim_station", "station_id"), "date_key": ("dim_date", "date_key")},
    max_length={"station_id": 11},
)

CONTRACTS = {c.name: c for c in (DIM_STATION, DIM_DATE, DIM_ELEMENT, OBSERVATIONS, DAILY)}

FEATURE_COLUMNS = [
    "tmax_lag1", "tmax_lag2", "tmax_lag3", "tmax_lag7", "tmin_today", "temp_range_today",
    "tmax_roll7_mean", "tmax_roll30_mean", "tmax_roll7_std", "tmax_delta_1d",
    "prcp_today", "prcp_roll7_sum", "doy_sin", "doy_cos", "month",
]
TARGET = "target_tmax_next_day"
