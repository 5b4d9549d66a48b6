"""Test bindings: the driver's tables have no weather data, so each stored table of
the engine is stood in for by a derivation of the TPC-H-like tables.

D  daily (sparse)  orders x customer x nation, per nation x order day
F  daily (dense)   lineitem, per returnflag+linestatus x ship day
O  observations    events: user x day x event type, duplicates kept
N  dim_station     nation x region
K  duplicate grain lineitem (l_orderkey, l_linenumber)

Each binding is an ordinary lazy plan over the parquet tables, so its work
grows with the tables. ``ORACLE_*`` hold the same definitions in DuckDB SQL.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.functions import date_key
from stationlake.operators.joins import join_dim

NULL_MEASURES = ["snow", "snwd", "awnd", "wsfg", "wdfg", "tsun"]


_TABLES: dict[tuple, DataFrame] = {}


def _session_key(spark: SparkSession) -> tuple:
    """Identity of a live session: its application id (unique per context) and the session object."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        app = spark.conf.get("spark.app.id", None) or "remote"
    return (app, id(spark))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``sf_dir``.

    The resolved read (file listing, footer schema) is reused within a session
    while the file is unchanged; DataFrames are immutable, so sharing is safe.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    try:
        stamp = os.stat(path).st_mtime_ns
    except OSError:
        stamp = None
    key = (_session_key(spark), path, stamp)
    if stamp is None or key not in _TABLES:
        df = spark.read.parquet(path)
        if stamp is None:
            return df
        _TABLES[key] = df
    return _TABLES[key]


_BINDINGS: dict[tuple, DataFrame] = {}


def _stamp(sf_dir: str) -> tuple:
    d = sf_dir.rstrip("/")
    try:
        return tuple(sorted((n, os.stat(f"{d}/{n}").st_mtime_ns) for n in os.listdir(d)))
    except OSError:
        return ()


def binding(fn):
    """Reuse a binding's lazy plan within a session while its input files are unchanged.

    Only the plan object is shared (DataFrames are immutable); every query
    still executes it in full -- nothing is cached.
    """
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        stamp = _stamp(sf_dir)
        if not stamp:  # a path that only Spark can list: its files may change unseen
            return fn(spark, sf_dir)
        key = (fn.__name__, _session_key(spark), sf_dir.rstrip("/"), stamp)
        if key not in _BINDINGS:
            _BINDINGS[key] = fn(spark, sf_dir)
        return _BINDINGS[key]
    wrapped.__name__ = fn.__name__
    wrapped.__doc__ = fn.__doc__
    return wrapped


def station_key(prefix: str, col: str | Column) -> Column:
    """11-character station id: prefix + zero-padded number."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit(prefix), F.lpad(c.cast("string"), 11 - len(prefix), "0"))


def _daily_shape(df: DataFrame) -> DataFrame:
    return df.select(
        "station_id", date_key("obs_date").alias("date_key"), "obs_date",
        "tmax", "tmin", "tavg", (F.col("tmax") - F.col("tmin")).alias("temp_range"), "prcp",
        *[F.lit(None).cast("double").alias(c) for c in NULL_MEASURES],
    )


@binding
def daily_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding D: one row per (nation, order day); hundreds of gaps per station."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"))
    # customer grows with the data: the planner (AQE) picks the join strategy.
    oc = orders.join(customer, orders.o_custkey == customer.c_custkey)
    ocn = join_dim(oc, nation, "c_nationkey")
    g = ocn.groupBy(station_key("N", "c_nationkey").alias("station_id"),
                    F.to_date("o_orderdate").alias("obs_date")).agg(
        F.max("o_totalprice").alias("tmax"),
        F.min("o_totalprice").alias("tmin"),
        F.avg("o_totalprice").alias("tavg"),
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") / 1000).otherwise(0.0)).alias("prcp"),
    )
    return _daily_shape(g)


@binding
def daily_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding F: one row per (returnflag||linestatus, ship day); nearly gap-free."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice",
                                                "l_discount", "l_tax", "l_shipdate")
    g = li.groupBy(F.concat("l_returnflag", "l_linestatus").alias("station_id"),
                   F.to_date("l_shipdate").alias("obs_date")).agg(
        F.max("l_extendedprice").alias("tmax"),
        F.min("l_extendedprice").alias("tmin"),
        F.avg("l_extendedprice").alias("tavg"),
        F.sum(F.when(F.col("l_discount") > 0.05, F.col("l_tax") * 100).otherwise(0.0)).alias("prcp"),
    )
    return _daily_shape(g)


@binding
def daily_swapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D with tmax and tmin swapped on the 13th of each month (feeds the impossibility audit)."""
    d = daily_sparse(spark, sf_dir)
    swap = F.dayofmonth("obs_date") == 13
    return d.withColumn("tmax_", F.when(swap, F.col("tmin")).otherwise(F.col("tmax"))) \
            .withColumn("tmin", F.when(swap, F.col("tmax")).otherwise(F.col("tmin"))) \
            .drop("tmax").withColumnRenamed("tmax_", "tmax")


@binding
def observations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding O in the raw long shape of the parsers, arrival order kept in ``arrival``.

    value_raw is the event value in hundredths; qflag marks values above 200 (X)
    or below 0.1 (N); mflag is set for events before 06:00 and blank otherwise;
    sflag is set for error events and empty otherwise. Blank flags stay blank
    here: turning them into NULL is the conform step's job.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return ev.select(
        station_key("U", "user_id").alias("station_id"),
        F.to_date("ts").alias("obs_date"),
        F.col("event_type").alias("element"),
        F.round(F.col("value") * 100).cast("int").alias("value_raw"),
        F.when(F.hour("ts") < 6, F.lit("N")).otherwise(F.lit(" ")).alias("mflag"),
        F.when(F.col("value") > 200, F.lit("X")).when(F.col("value") < 0.1, F.lit("N")).alias("qflag"),
        F.when(F.col("event_type") == "error", F.lit("S")).otherwise(F.lit("")).alias("sflag"),
        F.col("event_id").alias("arrival"),
    )


@binding
def dim_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding N: the station dimension from nation x region (fixed 25 x 5 rows)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    nr = join_dim(nation, region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    return nr.select(
        station_key("N", "n_nationkey").alias("station_id"),
        F.col("n_name").alias("station_name"),
        F.upper(F.substring("n_name", 1, 2)).alias("country_code"),
        F.col("n_name").alias("country"),
        (F.col("n_nationkey") * 3.5 - 40).cast("decimal(8,4)").alias("latitude"),
        (F.col("n_regionkey") * 60 - 150 + F.col("n_nationkey")).cast("decimal(9,4)").alias("longitude"),
        (F.col("n_nationkey") * 100).cast("decimal(7,1)").alias("elevation_m"),
        F.when(F.col("n_regionkey") <= 1, 1).otherwise(0).cast("short").alias("is_gsn"),
        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("wmo_id"),
        F.col("r_name").alias("climate_zone"),
    )


@binding
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding K: lineitem keyed by (l_orderkey, l_linenumber)."""
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")


# ---------------------------------------------------------------------------
# The same bindings in DuckDB SQL (tables are pre-registered views).

ORACLE_D = """
SELECT station_id, CAST(strftime(obs_date, '%Y%m%d') AS INTEGER) AS date_key, obs_date,
       tmax, tmin, tavg, tmax - tmin AS temp_range, prcp,
       CAST(NULL AS DOUBLE) AS snow, CAST(NULL AS DOUBLE) AS snwd, CAST(NULL AS DOUBLE) AS awnd,
       CAST(NULL AS DOUBLE) AS wsfg, CAST(NULL AS DOUBLE) AS wdfg, CAST(NULL AS DOUBLE) AS tsun
FROM (
  SELECT 'N' || lpad(CAST(c.c_nationkey AS VARCHAR), 10, '0') AS station_id,
         CAST(o.o_orderdate AS DATE) AS obs_date,
         max(o.o_totalprice) AS tmax, min(o.o_totalprice) AS tmin, avg(o.o_totalprice) AS tavg,
         sum(CASE WHEN o.o_orderstatus = 'F' THEN o.o_totalprice / 1000 ELSE 0.0 END) AS prcp
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2)
"""

ORACLE_F = """
SELECT station_id, CAST(strftime(obs_date, '%Y%m%d') AS INTEGER) AS date_key, obs_date,
       tmax, tmin, tavg, tmax - tmin AS temp_range, prcp,
       CAST(NULL AS DOUBLE) AS snow, CAST(NULL AS DOUBLE) AS snwd, CAST(NULL AS DOUBLE) AS awnd,
       CAST(NULL AS DOUBLE) AS wsfg, CAST(NULL AS DOUBLE) AS wdfg, CAST(NULL AS DOUBLE) AS tsun
FROM (
  SELECT l_returnflag || l_linestatus AS station_id, CAST(l_shipdate AS DATE) AS obs_date,
         max(l_extendedprice) AS tmax, min(l_extendedprice) AS tmin, avg(l_extendedprice) AS tavg,
         sum(CASE WHEN l_discount > 0.05 THEN l_tax * 100 ELSE 0.0 END) AS prcp
  FROM lineitem GROUP BY 1, 2)
"""

ORACLE_D_SWAPPED = """
SELECT station_id, date_key, obs_date,
       CASE WHEN day(obs_date) = 13 THEN tmin ELSE tmax END AS tmax,
       CASE WHEN day(obs_date) = 13 THEN tmax ELSE tmin END AS tmin,
       tavg, temp_range, prcp
FROM d
"""

ORACLE_O_RAW = """
SELECT 'U' || lpad(CAST(user_id AS VARCHAR), 10, '0') AS station_id,
       CAST(ts AS DATE) AS obs_date, event_type AS element,
       CAST(round(value * 100) AS INTEGER) AS value_raw,
       CASE WHEN hour(ts) < 6 THEN 'N' ELSE ' ' END AS mflag,
       CASE WHEN value > 200 THEN 'X' WHEN value < 0.1 THEN 'N' END AS qflag,
       CASE WHEN event_type = 'error' THEN 'S' ELSE '' END AS sflag,
       event_id AS arrival
FROM events
"""

ORACLE_N = """
SELECT 'N' || lpad(CAST(n.n_nationkey AS VARCHAR), 10, '0') AS station_id,
       n.n_name AS station_name, upper(substr(n.n_name, 1, 2)) AS country_code, n.n_name AS country,
       CAST(n.n_nationkey * 3.5 - 40 AS DECIMAL(8,4)) AS latitude,
       CAST(n.n_regionkey * 60 - 150 + n.n_nationkey AS DECIMAL(9,4)) AS longitude,
       CAST(n.n_nationkey * 100 AS DECIMAL(7,1)) AS elevation_m,
       CAST(CASE WHEN n.n_regionkey <= 1 THEN 1 ELSE 0 END AS SMALLINT) AS is_gsn,
       lpad(CAST(n.n_nationkey AS VARCHAR), 5, '0') AS wmo_id,
       r.r_name AS climate_zone
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
"""


# Binding O after conform: allow-list, sentinel, blank flags, first arrival, units.
O_ELEMENTS = ["click", "purchase", "signup", "view"]
O_TENTHS = ["click", "view"]

ORACLE_O_AUDIT = f"""
SELECT station_id, CAST(strftime(obs_date, '%Y%m%d') AS INTEGER) AS date_key, obs_date, element,
       CASE WHEN element IN ({", ".join(repr(e) for e in O_TENTHS)}) THEN CAST(value_raw AS DOUBLE) / 10.0
            ELSE CAST(value_raw AS DOUBLE) END AS value,
       mflag, qflag, sflag
FROM (
  SELECT station_id, obs_date, element, value_raw,
         nullif(trim(mflag), '') AS mflag, nullif(trim(qflag), '') AS qflag, nullif(trim(sflag), '') AS sflag,
         row_number() OVER (PARTITION BY station_id, obs_date, element ORDER BY arrival) AS rn
  FROM o_raw
  WHERE element IN ({", ".join(repr(e) for e in O_ELEMENTS)}) AND value_raw IS NOT NULL AND value_raw <> -9999)
WHERE rn = 1
"""


@binding
def observations_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding O conformed into the audit table."""
    from stationlake.operators.conform import audit_table
    return audit_table(observations_raw(spark, sf_dir), O_ELEMENTS, O_TENTHS)


def with_bindings(body: str, *names: str) -> str:
    """Prefix a DuckDB query with the CTEs it uses: d, f, dsw, o_raw, o_aud, n."""
    defs = {"d": ORACLE_D, "f": ORACLE_F, "dsw": ORACLE_D_SWAPPED, "o_raw": ORACLE_O_RAW,
            "o_aud": ORACLE_O_AUDIT, "n": ORACLE_N}
    order = ["d", "f", "dsw", "o_raw", "o_aud", "n"]
    need = set(names)
    if "dsw" in need:
        need.add("d")
    if "o_aud" in need:
        need.add("o_raw")
    ctes = [f"{k} AS ({defs[k]})" for k in order if k in need]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
