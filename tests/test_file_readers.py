"""Batch readers on landed files: mixed formats, station filter, first arrival, dimension file."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import types as T

from stationlake.operators import conform as C
from stationlake.operators.quality import ContractError, enforce
from stationlake.schema import Contract
from stationlake.sources import sinks
from stationlake.sources.dims import read_dim_station
from stationlake.sources.fixed_width import read_dly
from stationlake.sources.station_csv import read_station_csv

from test_sources import line


def test_mixed_folder_csv_wins_and_unknown_csv_skipped(spark):
    folder = tempfile.mkdtemp(prefix="stationlake-raw-")
    with open(os.path.join(folder, "AB000000001.dly"), "w") as f:
        f.write(line("AB000000001", 2001, 1, "TMAX", {1: (100, " ", " ", " "), 2: (120, " ", " ", " ")}) + "\n")
    with open(os.path.join(folder, "AB000000001.csv"), "w") as f:
        f.write("id,date,element,data_value,m_flag,q_flag,s_flag,obs_time\n")
        f.write("AB000000001,20010101,TMAX,111,,,,\n")
    with open(os.path.join(folder, "notes.csv"), "w") as f:
        f.write("ID,DATE,ELEMENT,DATA_VALUE,M_FLAG,Q_FLAG,S_FLAG,OBS_TIME\nZZ000000009,20010101,TMAX,5,,,,\n")
    stations = spark.createDataFrame([("AB000000001",)], "station_id string")
    raw = C.ingest_union(read_station_csv(spark, folder, stations=stations), read_dly(spark, folder))
    audit = {(r.obs_date.day, r.element): r.value for r in C.audit_table(raw).collect()}
    assert audit == {(1, "TMAX"): 11.1, (2, "TMAX"): 12.0}


def test_station_dimension_file_defaults(spark):
    folder = tempfile.mkdtemp(prefix="stationlake-dim-")
    with open(os.path.join(folder, "dim_station.csv"), "w") as f:
        f.write("station_id,station_name,country_code,country,latitude,longitude,elevation_m,is_gsn,wmo_id,climate_zone\n")
        f.write("AB000000001,Alpha,AB,Alphaland,-7.125,101.5,43.0,,,Mild\n")
    r = read_dim_station(spark, folder).collect()[0]
    assert r.is_gsn == 0 and r.wmo_id is None and float(r.latitude) == -7.125


def _land_raw(root):
    raw = os.path.join(root, "raw")
    os.makedirs(raw)
    with open(os.path.join(raw, "AB000000001.dly"), "w") as f:
        f.write(line("AB000000001", 2000, 2, "TMAX", {28: (215, " ", " ", "E"), 29: (220, " ", " ", "E"),
                                                     30: (999, " ", " ", " ")}) + "\n")
        f.write(line("AB000000001", 2000, 2, "TMIN", {28: (15, " ", " ", "E"), 29: (-9999, " ", " ", " ")}) + "\n")
        f.write(line("AB000000001", 2000, 3, "PRCP", {1: (33, " ", "X", "E")}) + "\n")
    with open(os.path.join(raw, "AB000000001.csv"), "w") as f:
        f.write("ID,DATE,ELEMENT,DATA_VALUE,M_FLAG,Q_FLAG,S_FLAG,OBS_TIME\nAB000000001,20000228,TMAX,210,,,,\n")
    stations = os.path.join(root, "dim_station.csv")
    with open(stations, "w") as f:
        f.write("station_id,station_name,country_code,country,latitude,longitude,elevation_m,is_gsn,wmo_id,climate_zone\n")
        f.write("AB000000001,Alpha,AB,Alphaland,-7.125,101.5,43.0,0,55501,Mild\n")
    return raw, stations


def test_build_warehouse_end_to_end(spark):
    from stationlake.plans.warehouse import build_warehouse

    root = tempfile.mkdtemp(prefix="stationlake-wh-")
    raw, stations = _land_raw(root)
    tables, counts = build_warehouse(spark, raw, stations, out_dir=os.path.join(root, "wh"))
    c = {r.table_name: r.row_count for r in counts.collect()}
    # audit: TMAX 28 (csv wins), TMAX 29, TMIN 28, PRCP Mar 1 (flagged); curated: Feb 28, Feb 29
    assert c == {"dim_station": 1, "dim_date": 3, "dim_element": 10, "observations": 4, "daily": 2}
    d = {r.obs_date.day: r for r in tables["daily"].collect()}
    assert float(d[28].tmax) == 21.0 and float(d[28].temp_range) == 19.5 and d[29].tmin is None
    assert str(tables["daily"].schema["tmax"].dataType) == "DecimalType(5,1)"


def test_features_and_linear_fit_on_decimal_warehouse_table(spark):
    """The curated table stores DECIMAL measures; features and the solver work in DOUBLE."""
    import datetime as dt
    import math

    from pyspark.sql import functions as F

    from stationlake.operators import features as FT
    from stationlake.operators import models as M
    from stationlake.schema import DAILY
    from stationlake.sources.sinks import project

    rows = [("AB000000001", dt.date(2001, 1, 1) + dt.timedelta(i), round(10 + 5 * math.sin(i / 9.0), 1),
             round(2 + 5 * math.sin(i / 9.0) - (i % 3) * 0.1, 1), round((i % 7) * 0.3, 1)) for i in range(120)]
    df = spark.createDataFrame(rows, "station_id string, obs_date date, tmax double, tmin double, prcp double")
    df = df.withColumn("temp_range", F.col("tmax") - F.col("tmin")).withColumn("date_key", F.lit(0))
    daily = project(df, DAILY.schema)
    assert str(daily.schema["tmax"].dataType) == "DecimalType(5,1)"
    feats = FT.features(daily)
    assert all(str(feats.schema[c].dataType) in ("DoubleType()", "IntegerType()") for c in feats.columns[2:])
    coefs = M.fit_linear(feats).collect()
    assert len(coefs) == 1 and all(math.isfinite(c) for c in coefs[0].coefficients)


def test_bucketed_curated_table_needs_no_shuffle_for_station_windows(spark):
    from stationlake.operators import views as V
    from stationlake.plans.warehouse import build_warehouse

    root = tempfile.mkdtemp(prefix="stationlake-whb-")
    raw, stations = _land_raw(root)
    tables, counts = build_warehouse(spark, raw, stations, out_dir=os.path.join(root, "wh"), station_buckets=4,
                                     table_prefix="t_bucketed")
    assert {r.table_name: r.row_count for r in counts.collect()}["daily"] == 2
    plan = V.rolling_climate(tables["daily"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_sql_surface_over_registered_views(spark):
    from stationlake.plans.catalog import VIEW_NAMES, register_warehouse
    from stationlake.plans.warehouse import build_warehouse

    root = tempfile.mkdtemp(prefix="stationlake-sql-")
    raw, stations = _land_raw(root)
    tables, _ = build_warehouse(spark, raw, stations, out_dir=os.path.join(root, "wh"))
    names = register_warehouse(spark, tables, start="2000-01-01", coverage_start="2000-02-01",
                               coverage_end="2000-03-01", coverage=0.05)
    assert set(VIEW_NAMES) <= set(names)
    monthly = spark.sql("SELECT station_name, year, month, avg_tmax, days_reported FROM vw_monthly_summary").collect()
    assert [(r.station_name, r.year, r.month, float(r.avg_tmax), r.days_reported) for r in monthly] == \
        [("Alpha", 2000, 2, 21.5, 2)]
    rec = spark.sql("""
        SELECT d.obs_date, d.tmax, r.prior_record, d.month_name, d.season_nh
        FROM vw_daily_weather d JOIN vw_record_days r USING (station_id, obs_date)
        ORDER BY d.obs_date""").collect()
    assert [(r.obs_date.day, float(r.tmax), r.prior_record, r.month_name, r.season_nh) for r in rec] == \
        [(28, 21.0, None, "Feb", "Winter"), (29, 22.0, 21.0, "Feb", "Winter")]
    ready = spark.sql("SELECT count(*) AS n FROM vw_model_ready").first().n
    assert ready == 2


def test_columns_are_found_by_header_name(spark, tmp_path):
    (tmp_path / "AB000000001.csv").write_text("ID,DATE,ELEMENT,DATA_VALUE,Q_FLAG,M_FLAG,S_FLAG,OBS_TIME\n"
                                              "AB000000001,20010101,TMAX,111,X,,,\n")
    (tmp_path / "AB000000002.csv").write_text(" s_flag ,element,extra,id,m_flag,q_flag,date,data_value\n"
                                              "E,TMIN,zzz,AB000000002,B,,20010102,-5\n")
    (tmp_path / "notes.csv").write_text("just,some,words\n1,2,3\n")
    stations = spark.createDataFrame([("AB000000001",), ("AB000000002",)], "station_id string")
    rows = {r.station_id: r for r in read_station_csv(spark, str(tmp_path), stations=stations).collect()}
    assert (rows["AB000000001"].mflag, rows["AB000000001"].qflag) == (None, "X")
    b = rows["AB000000002"]
    assert (b.element, b.value_raw, b.mflag, b.qflag, b.sflag) == ("TMIN", -5, "B", None, "E")


def test_missing_column_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,DATE,ELEMENT,M_FLAG,Q_FLAG,S_FLAG\nAB000000001,20010101,TMAX,,,\n")
    with pytest.raises(ValueError, match="DATA_VALUE"):
        read_station_csv(spark, str(tmp_path))


def test_reanalysis_files(spark, tmp_path):
    from stationlake.sources.reanalysis_json import read_reanalysis

    (tmp_path / "AB000000006.json").write_text('{"daily": {"time": ["2020-01-01", "2020-01-02"],\n'
                                               ' "temperature_2m_max": [1.5, null]}}')
    rows = read_reanalysis(spark, str(tmp_path)).orderBy("obs_date").collect()
    assert [(r.station_id, r.temperature_2m_max) for r in rows] == [("AB000000006", 1.5), ("AB000000006", None)]


DAY = T.StructType([T.StructField("station_id", T.StringType(), False), T.StructField("tmax", T.DecimalType(5, 1)),
                    T.StructField("tmin", T.DecimalType(5, 1))])


def test_bulk_load_maps_each_files_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("station_id,tmax,tmin\nA,9.0,1.0\n")
    (tmp_path / "b.csv").write_text("tmin,station_id,tmax\n2.0,B,8.0\n")
    rows = {r.station_id: (float(r.tmax), float(r.tmin)) for r in sinks.bulk_load(spark, str(tmp_path), DAY).collect()}
    assert rows == {"A": (9.0, 1.0), "B": (8.0, 2.0)}


def test_strict_cast_fails_whatever_the_ansi_setting(spark):
    df = spark.createDataFrame([("A", 123456.7, 1.0)], "station_id string, tmax double, tmin double")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="does not fit"):
                sinks.project(df, DAY, strict=True).collect()
            assert sinks.project(df, DAY, strict=False).first().tmax is None
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
    with pytest.raises(ValueError, match="station_id"):
        sinks.project(df.drop("station_id"), DAY, strict=False)


TOY = Contract("toy", T.StructType([T.StructField("k", T.IntegerType(), False), T.StructField("u", T.IntegerType()),
                                    T.StructField("s", T.StringType()), T.StructField("p", T.StringType()),
                                    T.StructField("d", T.DecimalType(3, 1))]),
               key=("k",), references={"p": ("parent", "p")}, max_length={"s": 2}, unique=("u",))


@pytest.mark.parametrize("row,rule", [
    ((1, 5, "ab", "x", 1.0), "key"), ((2, 1, "ab", "x", 1.0), "unique"), ((None, 5, "ab", "x", 1.0), "not_null"),
    ((2, 5, "abc", "x", 1.0), "length"), ((2, 5, "ab", "nobody", 1.0), "fk"), ((2, 5, "ab", "x", 1000.0), "type")])
def test_each_contract_rule_fails_a_strict_load(spark, row, rule):
    good = (1, 1, "ab", "x", 1.0)
    schema = "k int, u int, s string, p string, d double"
    refs = {"parent": spark.createDataFrame([("x",)], "p string")}
    assert enforce(spark.createDataFrame([good], schema), TOY, refs).count() == 1
    with pytest.raises(ContractError, match=rf"1 rows break {rule}\("):
        enforce(spark.createDataFrame([good, row], schema), TOY, refs)


def test_stored_scoreboard_is_replaced_and_ordered(spark, tmp_path):
    path = str(tmp_path / "board")
    cols = "station_id string, model string, mae double"
    assert sinks.read_scoreboard(spark, path) is None
    sinks.update_scoreboard(spark, path, spark.createDataFrame([("A", "x", 3.0), ("A", "y", 2.0)], cols))
    out = sinks.update_scoreboard(spark, path, spark.createDataFrame([("A", "x", 1.0), ("B", "x", 2.5)], cols))
    want = [("B", "x", 2.5), ("A", "y", 2.0), ("A", "x", 1.0)]  # largest MAE first
    assert [tuple(r) for r in out.collect()] == want
    assert sorted(map(tuple, sinks.read_scoreboard(spark, path).collect())) == sorted(want)


def test_the_first_line_is_the_header_and_no_other(spark, tmp_path):
    """A data row made of column names stays one; blank lines before the header, a byte order mark, an empty file."""
    kind = T.StructType([T.StructField("element", T.StringType(), False), T.StructField("unit", T.StringType()),
                         T.StructField("element_name", T.StringType())])
    (tmp_path / "a.csv").write_text("element,element_name,unit\nTMAX,Maximum,deg C\nUNIT,,\n")
    (tmp_path / "b.csv").write_text("\n \ufeffUNIT,Element,element_name\nelement,unit,ELEMENT_NAME\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("")
    rows = sorted(tuple(r) for r in sinks.bulk_load(spark, str(tmp_path), kind).collect())
    assert rows == [("TMAX", "deg C", "Maximum"), ("UNIT", None, None), ("unit", "element", "ELEMENT_NAME")]
    (tmp_path / "d.csv").write_text("TMIN,Minimum,deg C\nelement,element_name,unit\n")
    with pytest.raises(ValueError, match="lacks element"):
        sinks.bulk_load(spark, str(tmp_path), kind)


def test_headers_cost_the_head_of_each_file(spark, tmp_path):
    """One scan of the data in the plan; a header task leaves its split after the first lines."""
    from stationlake.sources import header_csv

    (tmp_path / "AB000000001.csv").write_text("ID,DATE,ELEMENT,DATA_VALUE,M_FLAG,Q_FLAG,S_FLAG\n"
                                              + "AB000000001,20010101,TMAX,1,,,\n" * 400_000)
    heads = header_csv.first_lines(spark, str(tmp_path))
    assert [(r.file_name, r.header.split(",")[0]) for r in heads.collect()] == [("AB000000001.csv", "ID")]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = read_station_csv(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and rows.count() == 400_000
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


@pytest.mark.parametrize("fmt", ["csv", "dly"])
def test_first_arrival_over_many_splits_in_several_tasks(spark, tmp_path, fmt):
    """The first line of a grain wins however a file's splits are packed into tasks."""
    n = 3000
    if fmt == "csv":
        body = "ID,DATE,ELEMENT,DATA_VALUE,M_FLAG,Q_FLAG,S_FLAG\n" + "".join(
            f"AB000000001,200101{1 + i % 28:02d},TMAX,{i},,,\n" for i in range(n))
    else:
        body = "".join(line("AB000000001", 2001, 1, "TMAX", {1 + i % 28: (i, " ", " ", " ")}) + "\n" for i in range(n))
    (tmp_path / f"AB000000001.{fmt}").write_text(body)
    for size, cost in (("4096", "0"), ("9000", "0"), ("4096", "100000000")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        try:
            raw = read_station_csv(spark, str(tmp_path)) if fmt == "csv" else read_dly(spark, str(tmp_path))
            assert raw.rdd.getNumPartitions() > 4
            got = {r.obs_date.day: r.value_raw for r in C.dedupe_first(raw).collect()}
            assert got == {d: d - 1 for d in range(1, 29)}
            order = [r.value_raw for r in raw.orderBy("line_id").collect()]
            assert order == list(range(n))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
