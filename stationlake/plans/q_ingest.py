"""Registered ingest, conform, dimension and sink queries (bindings D, O, N).

The raw formats are exercised by landing binding rows in the format (the
writer side) inside the query and parsing them back with the readers.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.operators import conform as C
from stationlake.plans import bindings as B
from stationlake.plans.registry import R, W, r6, register
from stationlake.plans.landing import land_named, pack_daily_arrays, render_dly_lines, render_station_csv
from stationlake.operators.quality import ContractError
from stationlake.schema import DIM_STATION, ELEMENTS, Contract
from stationlake.session import table_path
from stationlake.sources import dims, sinks, snapshots
from stationlake.sources.fixed_width import read_dly
from stationlake.sources.reanalysis_json import read_reanalysis
from stationlake.sources.station_csv import read_station_csv

O_EL = ", ".join(repr(e) for e in B.O_ELEMENTS)
O_TEN = ", ".join(repr(e) for e in B.O_TENTHS)


# --- fixed-width month records (binding L: D landed as TMAX, TMIN and an unlisted WT01) ---

def _l_long(spark, sf):
    """D as long rows: one scan of D, the three elements unpivoted with ``explode``."""
    d = B.daily_sparse(spark, sf)
    q = F.when(F.col("prcp") == 0, F.lit("N"))
    parts = [("TMAX", F.floor(F.col("tmax") / 10)), ("TMIN", F.floor(F.col("tmin") / 10)),
             ("WT01", F.floor(F.col("prcp")))]
    el = F.explode(F.array(*[F.struct(F.lit(e).alias("element"), v.cast("int").alias("value_raw"))
                             for e, v in parts])).alias("e")
    return d.select("station_id", "obs_date", q.alias("qflag"), el).select(
        "station_id", "obs_date", "e.element", "e.value_raw", F.lit(None).cast("string").alias("mflag"),
        "qflag", F.lit("E").alias("sflag"))


def _l_parsed(spark, sf):
    """Binding L landed as month-record text files in the shared folder, then read by the file reader."""
    path = table_path(spark, "dly_lines")
    render_dly_lines(_l_long(spark, sf)).write.mode("overwrite").text(path)
    return read_dly(spark, path, glob="*.txt").drop("file_name", "line_id")


_L_SQL = """
SELECT station_id, obs_date, 'TMAX' AS element, CAST(floor(tmax / 10) AS INTEGER) AS value_raw,
       CAST(NULL AS VARCHAR) AS mflag, CASE WHEN prcp = 0 THEN 'N' END AS qflag, 'E' AS sflag FROM d
UNION ALL
SELECT station_id, obs_date, 'TMIN', CAST(floor(tmin / 10) AS INTEGER), NULL, CASE WHEN prcp = 0 THEN 'N' END, 'E'
FROM d"""


@register("parse_fixed_width", W(_L_SQL, "d"))
def parse_fixed_width(spark, sf):
    return _l_parsed(spark, sf)


# --- by-station CSV (binding O landed as CSV files; values below 0.10 written as -9999) ---

def _o_csv_parsed(spark, sf):
    """Binding O landed in two folders whose headers differ in order, case and padding, then read by header name."""
    o = B.observations_raw(spark, sf)
    o = o.withColumn("value_raw", F.when(F.col("value_raw") < 10, F.lit(-9999)).otherwise(F.col("value_raw")))
    text = render_station_csv(o, keep=("arrival",))
    path = table_path(spark, "station_csv")
    even = F.col("arrival") % 2 == 0
    text.where(even).write.csv(f"{path}/a", header=True)
    names = ["Q_FLAG", "ELEMENT", "ID", "M_FLAG", "arrival", "DATA_VALUE", "S_FLAG", "DATE", "OBS_TIME"]
    text.where(~even).select(*[F.col(n).alias(f" {n.lower()} ") for n in names]).write.csv(f"{path}/b", header=True)
    rows = read_station_csv(spark, [f"{path}/a", f"{path}/b"], B.O_ELEMENTS, keep=("arrival",))
    return rows.drop("file_name", "line_id").withColumn("arrival", F.col("arrival").cast("bigint"))


_CSV_SQL = f"""
SELECT station_id, obs_date, element, value_raw, nullif(trim(mflag), '') AS mflag,
       nullif(trim(qflag), '') AS qflag, nullif(trim(sflag), '') AS sflag, arrival
FROM o_raw WHERE element IN ({O_EL}) AND value_raw >= 10"""


@register("parse_station_csv", W(_CSV_SQL, "o_raw"))
def parse_station_csv_q(spark, sf):
    return _o_csv_parsed(spark, sf)


# --- both formats in one folder: L as month records, and part of its grains again, one higher, as station files ---

@register("ingest_union", W(f"""
SELECT l.station_id, l.obs_date, l.element,
       CASE WHEN l.element = 'TMAX' AND day(l.obs_date) % 2 = 0 THEN l.value_raw + 1 ELSE l.value_raw END AS value_raw,
       l.mflag, CASE WHEN l.element = 'TMAX' AND day(l.obs_date) % 2 = 0 THEN NULL ELSE l.qflag END AS qflag, l.sflag,
       CASE WHEN l.element = 'TMAX' AND day(l.obs_date) % 2 = 0 THEN 0 ELSE 1 END AS source_rank
FROM ({_L_SQL}) l""", "d"))
def ingest_union(spark, sf):
    """CSV wins where both formats hold a grain; a file of an unknown station is skipped."""
    long = _l_long(spark, sf)
    path = f"{table_path(spark, 'mixed_archive')}/raw"  # <station>.dly and <station>.csv side by side
    lines = render_dly_lines(long).withColumn("stem", F.trim(F.substring("value", 1, 11)))
    land_named(spark, lines, "stem", path, "text", ".dly")
    again = long.where((F.col("element") == "TMAX") & (F.dayofmonth("obs_date") % 2 == 0)).withColumns(
        {"value_raw": F.col("value_raw") + 1, "qflag": F.lit(None).cast("string")})
    unknown = again.withColumn("stem", F.concat(F.lit("no-station-"), F.col("station_id")))
    named = again.withColumn("stem", F.col("station_id")).unionByName(unknown.withColumn("value_raw", F.lit(7)))
    land_named(spark, render_station_csv(named, keep=("stem",)), "stem", path, "csv", ".csv", header=True)
    stations = B.daily_sparse(spark, sf).select("station_id").distinct()
    first = C.dedupe_first(C.ingest_union(read_station_csv(spark, path, stations=stations), read_dly(spark, path)))
    return first.select("station_id", "obs_date", "element", "value_raw", "mflag", "qflag", "sflag",
                        F.when(F.col("file_name").endswith(".csv"), 0).otherwise(1).alias("source_rank"))


# --- conform steps on binding O ---

@register("element_filter", W(f"""
SELECT station_id, obs_date, element, value_raw, arrival FROM o_raw WHERE element IN ({O_EL})""", "o_raw"))
def element_filter(spark, sf):
    o = B.observations_raw(spark, sf).select("station_id", "obs_date", "element", "value_raw", "arrival")
    return C.element_filter(o, B.O_ELEMENTS)


@register("drop_missing", W("""
SELECT station_id, obs_date, element, value_raw, arrival
FROM (SELECT station_id, obs_date, element, CASE WHEN value_raw < 100 THEN -9999 ELSE value_raw END AS value_raw,
             arrival FROM o_raw)
WHERE value_raw IS NOT NULL AND value_raw <> -9999""", "o_raw"))
def drop_missing(spark, sf):
    o = B.observations_raw(spark, sf).select(
        "station_id", "obs_date", "element",
        F.when(F.col("value_raw") < 100, F.lit(-9999)).otherwise(F.col("value_raw")).alias("value_raw"), "arrival")
    return C.drop_missing(o)


@register("blank_flags", W("""
SELECT arrival, nullif(trim(mflag), '') AS mflag, nullif(trim(qflag), '') AS qflag,
       nullif(trim(sflag), '') AS sflag FROM o_raw""", "o_raw"))
def blank_flags(spark, sf):
    return C.blank_flags(B.observations_raw(spark, sf).select("arrival", "mflag", "qflag", "sflag"))


@register("unit_scale", W(f"""
SELECT station_id, obs_date, element, arrival,
       CASE WHEN element IN ({O_TEN}) THEN CAST(value_raw AS DOUBLE) / 10.0 ELSE CAST(value_raw AS DOUBLE) END AS value
FROM o_raw""", "o_raw"))
def unit_scale(spark, sf):
    o = B.observations_raw(spark, sf).select("station_id", "obs_date", "element", "arrival", "value_raw")
    return C.unit_scale(o, B.O_TENTHS).drop("value_raw")


@register("date_key", W("""
SELECT station_id, obs_date, CAST(strftime(obs_date, '%Y%m%d') AS INTEGER) AS date_key FROM d""", "d"))
def date_key_q(spark, sf):
    return C.add_date_key(B.daily_sparse(spark, sf).select("station_id", "obs_date"))


@register("dedupe_first", W("""
SELECT station_id, obs_date, element, arrival, value_raw, mflag, qflag, sflag FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id, obs_date, element ORDER BY arrival) AS rn FROM o_raw)
WHERE rn = 1""", "o_raw"))
def dedupe_first(spark, sf):
    return C.dedupe_first(B.observations_raw(spark, sf), C.GRAIN, ["arrival"])


@register("qa_filter", W("SELECT * FROM o_aud WHERE qflag IS NULL", "o_aud"))
def qa_filter(spark, sf):
    return C.qa_filter(B.observations_audit(spark, sf))


_PIVOT_SQL = f"""
SELECT *, "view" - click AS temp_range FROM (
  SELECT station_id, date_key, obs_date,
         {", ".join(f"max(value) FILTER (WHERE element = '{e}') AS {e}" for e in B.O_ELEMENTS)}
  FROM o_aud WHERE qflag IS NULL GROUP BY 1, 2, 3)"""


@register("pivot_daily", W(_PIVOT_SQL, "o_aud"))
def pivot_daily(spark, sf):
    return C.pivot_daily(B.observations_audit(spark, sf), B.O_ELEMENTS, range_of=("view", "click"))


@register("stage_summary", W("""
SELECT count(*) AS n_observations,
       count(DISTINCT CASE WHEN qflag IS NULL THEN station_id || '|' || CAST(obs_date AS VARCHAR) END) AS n_station_days,
       min(obs_date) AS first_date, max(obs_date) AS last_date, count(qflag) AS n_flagged
FROM o_aud""", "o_aud"))
def stage_summary(spark, sf):
    return C.stage_summary(B.observations_audit(spark, sf))


# --- reanalysis JSON (binding D packed per station-year into parallel arrays) ---

_JSON_MAP = {"temperature_2m_max": "tmax", "temperature_2m_min": "tmin",
             "temperature_2m_mean": "tavg", "precipitation_sum": "prcp"}


@register("json_parallel_arrays", W(f"""
SELECT station_id, obs_date, tmax AS temperature_2m_max, tmin AS temperature_2m_min,
       {R("tavg")} AS temperature_2m_mean, {R("prcp")} AS precipitation_sum FROM d""", "d"))
def json_parallel_arrays(spark, sf):
    """One response file a station, landed and read by the file reader."""
    packed = pack_daily_arrays(B.daily_sparse(spark, sf), _JSON_MAP)
    path = table_path(spark, "reanalysis")
    whole = packed.groupBy("station_id").agg(F.struct(*[
        F.flatten(F.collect_list(F.col(f"daily.{n}"))).alias(n) for n in ("time", *_JSON_MAP)]).alias("daily"))
    land_named(spark, whole.select(F.col("station_id").alias("stem"), "daily"), "stem", path, "json", ".json")
    return r6(read_reanalysis(spark, path).select("station_id", "obs_date", *_JSON_MAP))


# --- dimensions ---

@register("dim_station", W("SELECT * FROM n", "n"))
def dim_station(spark, sf):
    """The station file, landed as CSV and read by the file reader."""
    path = table_path(spark, "dim_station_file")
    sinks.write_table(B.dim_station(spark, sf), path, fmt="csv")
    return dims.read_dim_station(spark, path)


@register("dim_element", W("""
SELECT o.element, e.element_name, e.unit, count(*) AS n_observations
FROM o_aud o LEFT JOIN (VALUES """ + ", ".join(f"('{c}', '{n}', '{u}')" for c, n, u in ELEMENTS) + """)
  e(element, element_name, unit)
  ON e.element = upper(o.element)
GROUP BY 1, 2, 3""", "o_aud"))
def dim_element(spark, sf):
    obs = B.observations_audit(spark, sf).groupBy("element").agg(F.count(F.lit(1)).alias("n_observations"))
    el = dims.dim_element(spark).withColumnRenamed("element", "code")
    j = obs.join(F.broadcast(el), F.upper(obs.element) == el.code, "left")
    return j.select("element", "element_name", "unit", "n_observations")


@register("dim_date", W("""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       strftime(d, '%b') AS month_name, CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week,
       strftime(d, '%a') AS day_name, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend,
       CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
            WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season_nh
FROM (SELECT unnest(generate_series(min(obs_date), max(obs_date), INTERVAL 1 DAY)) AS d FROM d)""", "d"))
def dim_date(spark, sf):
    return dims.dim_date(B.daily_sparse(spark, sf))


# --- sinks and loads ---

_D_COLS = ["station_id", "date_key", "obs_date", "tmax", "tmin", "tavg", "temp_range", "prcp"]
_D_SQL = W(f"""SELECT station_id, date_key, obs_date, tmax, tmin, {R("tavg")} AS tavg, temp_range,
       {R("prcp")} AS prcp FROM d""", "d")


@register("write_roundtrip", _D_SQL)
def write_roundtrip(spark, sf):
    d = B.daily_sparse(spark, sf).select(*_D_COLS).withColumn("year", F.year("obs_date"))
    path = table_path(spark, "daily")
    sinks.write_table(d, path, partition_by=["year"], sort_within=["station_id", "obs_date"])
    back = sinks.read_table(spark, path, d.schema)
    return r6(back.select(*_D_COLS))


@register("bulk_load", _D_SQL)
def bulk_load(spark, sf):
    d = B.daily_sparse(spark, sf).select(*_D_COLS)
    path = table_path(spark, "daily_csv")
    sinks.write_table(d, path, fmt="csv")
    return r6(sinks.bulk_load(spark, path, d.schema))


@register("load_counts", W("""
SELECT 'dim_station' AS table_name, count(*) AS row_count FROM n
UNION ALL SELECT 'dim_date', date_diff('day', min(obs_date), max(obs_date)) + 1 FROM d
UNION ALL SELECT 'dim_element', 10
UNION ALL SELECT 'observations', count(*) FROM o_aud
UNION ALL SELECT 'daily', count(*) FROM d""", "d", "o_aud", "n"))
def load_counts(spark, sf):
    d = B.daily_sparse(spark, sf)
    station_csv = table_path(spark, "dim_station_csv")
    sinks.write_table(B.dim_station(spark, sf), station_csv, fmt="csv")
    return sinks.load_counts({
        "dim_station": sinks.bulk_load(spark, station_csv, DIM_STATION),
        "dim_date": dims.dim_date(d),
        "dim_element": dims.dim_element(spark),
        "observations": B.observations_audit(spark, sf),
        "daily": d,
    })


# --- several tables in one commit: N and D as staged CSV files; the rows of even days come in a later load ---

def _kept(f: T.StructField, required: set[str]) -> T.StructField:
    return T.StructField(f.name, f.dataType, f.name not in required)


@register("snapshot_load", W("""
SELECT v.version, t.table_name, t.row_count, t.tmax_sum, CAST(1 AS BIGINT) AS rejected
FROM (VALUES (CAST(1 AS BIGINT)), (2)) v(version), LATERAL (
  SELECT 'dim_station' AS table_name, count(*) AS row_count, CAST(NULL AS DOUBLE) AS tmax_sum FROM n
  UNION ALL SELECT 'daily', count(*), round(sum(tmax), 3) FROM d WHERE v.version = 2 OR day(obs_date) % 2 = 1) t""", "d", "n"))
def snapshot_load(spark, sf):
    """A first load, a load rejected as its station file repeats a key (its daily rows don't appear either), an append."""
    d = B.daily_sparse(spark, sf).select(*_D_COLS)
    stations = B.dim_station(spark, sf)
    contracts = {
        "dim_station": Contract("dim_station", T.StructType([_kept(f, {"station_id"}) for f in stations.schema.fields]), key=("station_id",)),
        "daily": Contract("daily", T.StructType([_kept(f, {"station_id", "date_key"}) for f in d.schema.fields]),
                          key=("station_id", "date_key"), references={"station_id": ("dim_station", "station_id")})}
    staged, root = table_path(spark, "staged"), table_path(spark, "snapshots")
    odd = F.dayofmonth("obs_date") % 2 == 1
    for name, df in (("stations", stations), ("odd", d.where(odd)), ("even", d.where(~odd))):
        sinks.write_table(df, f"{staged}/{name}", fmt="csv")
    snapshots.load_staged(spark, root, {"dim_station": f"{staged}/stations", "daily": f"{staged}/odd"}, contracts)
    rejected = 0
    try:
        snapshots.load_staged(spark, root, {"daily": f"{staged}/even", "dim_station": f"{staged}/stations"}, contracts)
    except ContractError:
        rejected = 1
    snapshots.load_staged(spark, root, {"daily": f"{staged}/even"}, contracts)
    sums = None
    for v in snapshots.versions(spark, root):
        one = snapshots.read(spark, root, v)["daily"].agg(F.round(F.sum("tmax"), 3).alias("tmax_sum")).select(
            F.lit(v).cast("bigint").alias("version"), F.lit("daily").alias("table_name"), "tmax_sum")
        sums = one if sums is None else sums.unionByName(one)
    return (snapshots.history(spark, root).join(sums, ["version", "table_name"], "left")
            .select("version", "table_name", "row_count", "tmax_sum", F.lit(rejected).cast("bigint").alias("rejected")))
