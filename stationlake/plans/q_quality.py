"""Registered quality audits and contract checks (bindings D, O, N, K)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.operators import quality as Q
from stationlake.plans import bindings as B
from stationlake.plans.registry import R, W, r6, register
from stationlake.schema import ELEMENTS, Contract
from stationlake.sources import dims

# Bounds for binding D, whose "temperatures" are order prices and "precipitation" is F-order
# value / 1000; the reference bounds (50 / -60 / 500) are the operator default.
D_BOUNDS = [("tmax", 2000.0, 450000.0), ("prcp", None, 900.0)]


@register("qa_failures", W("""
SELECT qflag, count(*) AS failed_records FROM o_aud WHERE qflag IS NOT NULL GROUP BY qflag""", "o_aud"))
def qa_failures(spark, sf):
    return Q.qa_failures(B.observations_audit(spark, sf))


@register("impossible_days", W("""
SELECT n.station_name, s.obs_date, s.tmax, s.tmin FROM dsw s JOIN n USING (station_id) WHERE s.tmin > s.tmax""",
                               "dsw", "n"))
def impossible_days(spark, sf):
    return Q.impossible_days(B.daily_swapped(spark, sf), B.dim_station(spark, sf))


@register("decade_completeness", W(f"""
SELECT n.station_name, CAST((year(d.obs_date) // 10) * 10 AS INTEGER) AS decade,
       count(d.tmax) AS days_with_tmax, {R("count(d.tmax) * 100.0 / 3652.5")} AS pct_complete
FROM d JOIN n USING (station_id) GROUP BY 1, 2""", "d", "n"))
def decade_completeness(spark, sf):
    df = Q.decade_completeness(B.daily_sparse(spark, sf), B.dim_station(spark, sf), digits=None)
    return r6(df.withColumn("pct_complete", F.col("pct_complete").cast("double")))


@register("gap_analysis", W("""
, g AS (SELECT station_id, date_diff('day', lag(obs_date) OVER (PARTITION BY station_id ORDER BY obs_date), obs_date)
               AS days_since_prev FROM d)
SELECT g.station_id, n.station_name, count(*) FILTER (WHERE days_since_prev > 1) AS gap_count,
       max(days_since_prev) AS longest_gap_days
FROM g JOIN n USING (station_id) GROUP BY g.station_id, n.station_name""", "d", "n"))
def gap_analysis(spark, sf):
    return Q.gap_analysis(B.daily_sparse(spark, sf), B.dim_station(spark, sf))


@register("outlier_scan", W(f"""
SELECT n.station_name, x.obs_date, x.metric, {R("x.value")} AS value FROM (
  SELECT station_id, obs_date, 'tmax' AS metric, tmax AS value FROM d
  WHERE tmax > {D_BOUNDS[0][2]} OR tmax < {D_BOUNDS[0][1]}
  UNION ALL
  SELECT station_id, obs_date, 'prcp', prcp FROM d WHERE prcp > {D_BOUNDS[1][2]}) x
JOIN n USING (station_id)""", "d", "n"))
def outlier_scan(spark, sf):
    return r6(Q.outlier_scan(B.daily_sparse(spark, sf), B.dim_station(spark, sf), D_BOUNDS))


@register("duplicate_grain", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_grain(spark, sf):
    return Q.duplicate_grain(B.duplicate_keys(spark, sf), ["l_orderkey", "l_linenumber"])


_NULL_COLS = {
    "daily": ["station_id", "date_key", "obs_date"],
    "observations": ["station_id", "date_key", "element", "value"],
    "dim_station": ["station_id", "station_name", "country_code", "country", "latitude", "longitude", "is_gsn"],
}


def _null_sql() -> str:
    parts = []
    for table, src in [("daily", "d"), ("observations", "o_aud"), ("dim_station", "n")]:
        for c in _NULL_COLS[table]:
            parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {src}")
    return "\nUNION ALL\n".join(parts)


@register("null_violations", W(_null_sql(), "d", "o_aud", "n"))
def null_violations(spark, sf):
    out = None
    for table, df in [("daily", B.daily_sparse(spark, sf)), ("observations", B.observations_audit(spark, sf)),
                      ("dim_station", B.dim_station(spark, sf))]:
        part = Q.null_violations(df, table, _NULL_COLS[table])
        out = part if out is None else out.unionByName(part)
    return out


_FKS = [
    ("lineitem_orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem_part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem_supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders_customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("customer_nation", "customer", "c_nationkey", "nation", "n_nationkey"),
]


@register("fk_violations", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS constraint_name, count(*) AS violations FROM {ct} c "
    f"WHERE c.{cc} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {pt} p WHERE p.{pc} = c.{cc})"
    for name, ct, cc, pt, pc in _FKS))
def fk_violations(spark, sf):
    out = None
    for name, ct, cc, pt, pc in _FKS:
        part = Q.fk_violations(B.table(spark, sf, ct), cc, B.table(spark, sf, pt), pc, name)
        out = part if out is None else out.unionByName(part)
    return out


# Precision contract used for binding D (price-scale values): DECIMAL(6,1) overflows above 99999.9.
D_PRECISION = {"tmax": (6, 1), "tmin": (6, 1), "tavg": (6, 1), "prcp": (5, 1)}


def _decimal_sql() -> str:
    parts = []
    for c, (p, s) in D_PRECISION.items():
        parts.append(f"SELECT '{c}' AS column_name, 'decimal({p},{s})' AS rule, count({c}) AS n_checked, "
                     f"count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL({p},{s})) IS NULL) "
                     f"AS violations FROM d")
    parts.append("SELECT 'station_id' AS column_name, 'length<=11' AS rule, count(station_id) AS n_checked, "
                 "count(*) FILTER (WHERE length(station_id) > 11) AS violations FROM d")
    return "\nUNION ALL\n".join(parts)


@register("decimal_contract", W(_decimal_sql(), "d"))
def decimal_contract(spark, sf):
    return Q.decimal_contract(B.daily_sparse(spark, sf), D_PRECISION, {"station_id": 11})


# The contracts on the bindings: DECIMAL and length limits that some of the rows break.
_SMALL = T.DecimalType(6, 1)
_C_TABLES = {
    "daily": Contract("daily", T.StructType([T.StructField("station_id", T.StringType(), False),
                                             T.StructField("date_key", T.IntegerType(), False),
                                             T.StructField("tmax", _SMALL), T.StructField("prcp", T.DecimalType(5, 1))]),
                      key=("station_id", "date_key"), references={"station_id": ("dim_station", "station_id"),
                                                                  "date_key": ("dim_date", "date_key")},
                      max_length={"station_id": 11}),
    "observations": Contract("observations", T.StructType([T.StructField("station_id", T.StringType(), False),
                                                           T.StructField("element", T.StringType(), False),
                                                           T.StructField("qflag", T.StringType())]),
                             key=("station_id", "date_key", "element"), references={"element": ("dim_element", "element")},
                             max_length={"element": 5, "qflag": 1}),
    "dim_station": Contract("dim_station", T.StructType([T.StructField("station_id", T.StringType(), False),
                                                         T.StructField("is_gsn", T.ShortType(), False)]),
                            key=("station_id",), unique=("station_name",), max_length={"station_id": 11, "country": 9}),
    "dim_date": Contract("dim_date", T.StructType([T.StructField("date", T.DateType(), False)]), key=("date_key",),
                         unique=("date",)),
    "dim_element": Contract("dim_element", T.StructType([T.StructField("element_name", T.StringType(), False)]),
                            key=("element",), max_length={"element": 4}),
}


def _contract_sql() -> str:
    days = "(SELECT unnest(generate_series(min(obs_date), max(obs_date), INTERVAL 1 DAY)) AS d FROM d)"
    tables = {"daily": "SELECT * FROM d", "observations": "SELECT * FROM o_aud", "dim_station": "SELECT * FROM n",
              "dim_date": f"SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date FROM {days}",
              "dim_element": "SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{n}', '{u}')" for c, n, u in ELEMENTS)
                             + ") e(element, element_name, unit)"}
    casts = {"decimal(6,1)": "DECIMAL(6,1)", "decimal(5,1)": "DECIMAL(5,1)", "string": "VARCHAR", "int": "INTEGER",
             "smallint": "SMALLINT", "date": "DATE"}
    parts = []

    def add(t, rule, col, count):
        parts.append(f"SELECT '{t}' AS table_name, '{rule}' AS rule, '{col}' AS column_name, CAST(({count}) AS BIGINT) AS violations")

    for t, c in _C_TABLES.items():
        src = f"({tables[t]})"
        for f in c.schema.fields:
            if not f.nullable:
                add(t, "not_null", f.name, f"SELECT count(*) FROM {src} WHERE {f.name} IS NULL")
            add(t, "type", f.name, f"SELECT count(*) FROM {src} WHERE {f.name} IS NOT NULL AND "
                                   f"TRY_CAST({f.name} AS {casts[f.dataType.simpleString()]}) IS NULL")
        for col, n in c.max_length.items():
            add(t, "length", col, f"SELECT count(*) FROM {src} WHERE length({col}) > {n}")
        for rule, key in [("key", c.key), *[("unique", (u,)) for u in c.unique]]:
            add(t, rule, ",".join(key), f"SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {src} GROUP BY {', '.join(key)})")
        for col, (parent, pcol) in c.references.items():
            add(t, "fk", col, f"SELECT count(*) FROM {src} x WHERE x.{col} IS NOT NULL AND "
                              f"x.{col} NOT IN (SELECT {pcol} FROM ({tables[parent]}))")
    return "\nUNION ALL\n".join(parts)


@register("contract_report", W(_contract_sql(), "d", "o_aud", "n"))
def contract_report(spark, sf):
    """Every rule of the five tables' contracts, with its number of violations."""
    daily = B.daily_sparse(spark, sf)
    tables = {"daily": daily, "observations": B.observations_audit(spark, sf), "dim_station": B.dim_station(spark, sf),
              "dim_date": dims.dim_date(daily), "dim_element": dims.dim_element(spark)}
    out = None
    for name, df in tables.items():
        part = Q.contract_report(df, _C_TABLES[name], tables)
        out = part if out is None else out.unionByName(part)
    return out


# model_ready on D: stations with tmax on at least 22 % of the days from 1996-01-01 to 2001-08-01.
READY = dict(start="1995-06-01", coverage_start="1996-01-01", coverage_end="2001-08-01", coverage=0.22)

_READY_SQL = f"""
SELECT d.station_id, d.date_key, d.obs_date, d.tmax, d.tmin, {R("d.tavg")} AS tavg, d.temp_range, {R("d.prcp")} AS prcp
FROM d
WHERE d.obs_date >= DATE '{READY["start"]}'
  AND d.station_id IN (
    SELECT station_id FROM d WHERE obs_date >= DATE '{READY["coverage_start"]}'
    GROUP BY station_id
    HAVING count(tmax) >= {READY["coverage"]} * (DATE '{READY["coverage_end"]}' - DATE '{READY["coverage_start"]}'))"""


@register("model_ready", W(_READY_SQL, "d"))
def model_ready(spark, sf):
    df = Q.model_ready(B.daily_sparse(spark, sf), **READY)
    return r6(df.select("station_id", "date_key", "obs_date", "tmax", "tmin", "tavg", "temp_range", "prcp"))


@register("qualified_stations", W(f"""
SELECT DISTINCT n.station_name FROM ({_READY_SQL}) v JOIN n USING (station_id)""", "d", "n"))
def qualified_stations(spark, sf):
    return Q.qualified_stations(Q.model_ready(B.daily_sparse(spark, sf), **READY), B.dim_station(spark, sf))
