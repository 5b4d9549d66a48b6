"""Build the station warehouse from a raw archive folder, as Spark jobs.

raw folder (*.dly, <station>.csv) -> audit table -> curated daily table,
plus the station, element and date dimensions and a load report. The audit
table is written once and the curated table is derived from the written
table, so the raw records are parsed a single time. All five are one version of
the warehouse folder (``sources.snapshots``): they are written beside the version
in force, checked there, and published together by one manifest. The folder lies
under the shared folder (``spark.checkpoint.dir``) unless a location is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.operators import conform as C
from stationlake.schema import DAILY, DIM_DATE, DIM_ELEMENT, DIM_STATION, OBSERVATIONS, TENTHS
from stationlake.session import shared_dir
from stationlake.sources import dims, sinks, snapshots
from stationlake.sources.fixed_width import read_dly
from stationlake.sources.station_csv import read_station_csv


def build_warehouse(spark: SparkSession, raw_dir: str, station_file: str, out_dir: str | None = None,
                    elements: Sequence[str] = C.ELEMENT_CODES, tenths: Sequence[str] = TENTHS,
                    strict: bool = True, station_buckets: int | None = None,
                    table_prefix: str = "stationlake") -> tuple[dict[str, DataFrame], DataFrame]:
    """Parse, conform, curate and stage everything; returns (tables, load report).

    ``strict`` fails the load on a value that its type can't hold and on any row
    that breaks a contract (key, unique, NOT NULL, length, reference); nothing is
    published then and the version before stays as it is. With ``strict=False``
    overflow becomes NULL and the violations are left to ``contract_report``.
    The curated table is stored in ranges of station and day, so that a read of
    a few stations or days skips most of it. With ``station_buckets`` it is saved
    bucketed on ``station_id`` instead (external table ``<table_prefix>_daily_<id>``),
    so the per-station windows of the views and features read it without a shuffle.
    """
    out = (out_dir or f"{shared_dir(spark)}/warehouse").rstrip("/")
    with snapshots.Load(spark, out) as load:
        read = load.write("dim_station", dims.read_dim_station(spark, station_file), DIM_STATION if strict else None)
        raw = C.ingest_union(read_station_csv(spark, raw_dir, elements, stations=read.select("station_id")),
                             read_dly(spark, raw_dir, elements))
        audit = C.audit_table(raw, elements, tenths)
        # contract columns plus obs_date (kept so the curated build needs no date join)
        obs_schema = T.StructType([*OBSERVATIONS.schema.fields, T.StructField("obs_date", T.DateType(), False)])
        obs = load.write("observations", sinks.project(audit, obs_schema, strict), OBSERVATIONS if strict else None,
                         partition_by=["element"], sort_within=["station_id", "date_key"])
        wide = C.pivot_daily(obs.withColumn("value", F.col("value").cast("double")), elements)
        curated = sinks.project(wide, DAILY.schema, strict)
        how = ({"buckets": (table_prefix, "station_id", station_buckets), "sort_within": ["station_id", "obs_date"]}
               if station_buckets else {"range_by": ["station_id", "obs_date"]})
        load.write("daily", curated, DAILY if strict else None, **how)
        load.write("dim_date", dims.dim_date(obs), DIM_DATE if strict else None)
        load.write("dim_element", dims.dim_element(spark), DIM_ELEMENT if strict else None)
    return snapshots.read(spark, out, load.version), snapshots.load_counts(spark, out, load.version)
