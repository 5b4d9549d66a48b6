"""Dimension sources: station reference file, element table, generated calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.functions import date_key, iso_weekday, season_nh
from stationlake.schema import DIM_STATION, ELEMENTS
from stationlake.sources.header_csv import read_by_header


def read_dim_station(spark: SparkSession, path: str) -> DataFrame:
    """Station reference data (CSV with header) typed by the contract; ``is_gsn`` defaults to 0.

    A value that doesn't fit its type fails the job.
    """
    from stationlake.sources.sinks import project

    required = [c for c in DIM_STATION.not_null if c not in DIM_STATION.defaults]
    raw = read_by_header(spark, path, DIM_STATION.columns, required)
    for c, v in DIM_STATION.defaults.items():
        raw = raw.withColumn(c, F.coalesce(F.col(c), F.lit(str(v))))
    return project(raw, DIM_STATION.schema)


def dim_element(spark: SparkSession) -> DataFrame:
    """The element dimension (fixed reference values)."""
    return spark.createDataFrame(ELEMENTS, "element string, element_name string, unit string")


def calendar_columns(d: Column) -> list[Column]:
    """Every calendar attribute of the date dimension, derived from a DATE column."""
    return [
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        iso_weekday(d).alias("day_of_week"),
        F.date_format(d, "EEE").alias("day_name"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        (iso_weekday(d) >= 6).cast("int").alias("is_weekend"),
        season_nh(F.month(d)).alias("season_nh"),
    ]


def dim_date(dates: DataFrame, date_col: str = "obs_date") -> DataFrame:
    """One row per calendar day between the min and max of ``dates[date_col]``.

    The range is found with one global aggregate (partial per task, one row
    after the merge), then the day axis is generated with ``sequence``, year by
    year. A calendar holds at most 366 rows per year of history.
    """
    span = dates.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    years = span.select("lo", "hi", F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("y"))
    first = F.greatest(F.col("lo"), F.make_date("y", F.lit(1), F.lit(1)))
    last = F.least(F.col("hi"), F.make_date("y", F.lit(12), F.lit(31)))
    days = years.select(F.explode(F.sequence(first, last)).alias("d"))
    return days.select(*calendar_columns(F.col("d")))
