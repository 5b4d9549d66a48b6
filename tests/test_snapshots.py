"""Several tables in one commit: all or nothing, conflicts, appends, history; the warehouse and the scoreboard on top."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.operators.quality import ContractError
from stationlake.schema import CONTRACTS, Contract
from stationlake.sources import sinks, snapshots

from test_file_readers import _land_raw

PARENT = Contract("parent", T.StructType([T.StructField("p", T.StringType(), False)]), key=("p",))
CHILD = Contract("child", T.StructType([T.StructField("k", T.IntegerType(), False), T.StructField("p", T.StringType())]),
                 key=("k",), references={"p": ("parent", "p")})
BOTH = {"parent": PARENT, "child": CHILD}


def land(folder, **files):
    os.makedirs(folder)
    for name, text in files.items():
        with open(os.path.join(folder, f"{name}.csv"), "w") as f:
            f.write(text)
    return {name: os.path.join(folder, f"{name}.csv") for name in files}


def rows(spark, root, version=None):
    return {n: sorted(tuple(r) for r in df.collect()) for n, df in snapshots.read(spark, root, version).items()}


def test_staged_files_load_together_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "wh")
    assert snapshots.read(spark, root) == {} and snapshots.versions(spark, root) == []
    one = land(tmp_path / "one", parent="p\nx\ny\n", child="k,p\n1,x\n2,\n")
    assert snapshots.load_staged(spark, root, one, BOTH) == 1
    first = {"parent": [("x",), ("y",)], "child": [(1, "x"), (2, None)]}
    assert rows(spark, root) == first
    # the parent's rows are good, the child's aren't: neither is loaded, and nothing is left behind
    for text, rule in (("k,p\n3,z\n1,x\n", "key"), ("k,p\n4,nobody\n", "fk"), ("k,p\nfour,x\n", "does not fit")):
        bad = land(tmp_path / rule.replace(" ", "-"), parent="p\nz\n", child=text)
        with pytest.raises(Exception, match=rule):
            snapshots.load_staged(spark, root, bad, BOTH)
        assert rows(spark, root) == first and snapshots.versions(spark, root) == [1]
    assert len(os.listdir(os.path.join(root, "versions"))) == 1
    # a reference may go to a row of the same load; old rows stay, in their own files
    two = land(tmp_path / "two", parent="p\nz\n", child="p,k\nz,3\n")
    assert snapshots.load_staged(spark, root, two, BOTH) == 2
    assert rows(spark, root) == {"parent": [("x",), ("y",), ("z",)], "child": [(1, "x"), (2, None), (3, "z")]}
    assert rows(spark, root, 1) == first
    report = {(r.version, r.table_name): (r.row_count, r.n_folders) for r in snapshots.history(spark, root).collect()}
    assert report == {(1, "parent"): (2, 1), (1, "child"): (2, 1), (2, "parent"): (3, 2), (2, "child"): (3, 2)}
    assert {r.table_name: r.row_count for r in snapshots.load_counts(spark, root).collect()} == {"parent": 3, "child": 3}


def test_of_two_loads_from_one_version_one_publishes(spark, tmp_path):
    root = str(tmp_path / "wh")
    df = spark.createDataFrame([("x",)], "p string")
    a, b = snapshots.Load(spark, root), snapshots.Load(spark, root)
    a.write("parent", df, PARENT)
    b.write("parent", df.union(df), None)
    assert a.publish() == 1
    with pytest.raises(snapshots.Conflict):
        with b:
            pass
    assert rows(spark, root) == {"parent": [("x",)]} and len(os.listdir(os.path.join(root, "versions"))) == 1


def test_replaced_tables_and_vacuum(spark, tmp_path):
    root = str(tmp_path / "wh")
    for k in range(4):
        with snapshots.Load(spark, root) as load:
            load.write("parent", spark.createDataFrame([(f"p{k}",)], "p string"), PARENT)
            if k == 0:
                load.write("child", spark.createDataFrame([(1, "p0")], "k int, p string"))
    assert rows(spark, root) == {"parent": [("p3",)], "child": [(1, "p0")]}
    assert snapshots.vacuum(spark, root, keep=2) == 1  # p1's; version 1's folder still holds the child
    assert snapshots.versions(spark, root) == [3, 4] and rows(spark, root, 3)["parent"] == [("p2",)]
    with pytest.raises(ValueError, match="appended columns"):
        with snapshots.Load(spark, root) as load:
            load.write("child", spark.createDataFrame([(1,)], "other int"), append=True)


@pytest.mark.parametrize("buckets", [None, 4])
def test_a_rejected_warehouse_load_leaves_the_old_five_tables(spark, tmp_path, buckets):
    from stationlake.plans.warehouse import build_warehouse

    raw, stations = _land_raw(str(tmp_path))
    root, name = str(tmp_path / "wh"), f"t_reject_{buckets}"
    how = {"out_dir": root, "station_buckets": buckets, "table_prefix": name}
    build_warehouse(spark, raw, stations, **how)
    before = rows(spark, root)
    assert {n: len(r) for n, r in before.items()} == {"dim_station": 1, "dim_date": 3, "dim_element": 10,
                                                      "observations": 4, "daily": 2}
    with open(stations, "a") as f:
        f.write("AB000000001,Again,AB,Alphaland,-7.125,101.5,43.0,0,55501,Mild\n")
    with pytest.raises(ContractError, match=r"dim_station: 1 rows break key\(station_id\)"):
        build_warehouse(spark, raw, stations, **how)
    assert rows(spark, root) == before and snapshots.versions(spark, root) == [1]
    assert len(spark.catalog.listTables(pattern=f"{name}*")) == (1 if buckets else 0)
    tables, _ = build_warehouse(spark, raw, stations, strict=False, **how)
    assert tables["dim_station"].count() == 2 and snapshots.versions(spark, root) == [1, 2]
    assert set(tables) == set(CONTRACTS)


def test_ranges_of_station_and_day_let_a_read_skip_files(spark, tmp_path):
    """Min and max of station and day in the Parquet footers: one station's year lies in few of the files."""
    import pyarrow.parquet as pq

    days = (spark.range(40 * 2000).selectExpr("concat('S', lpad(id % 40, 3, '0')) AS station_id",
                                              "date_add(date '2000-01-01', CAST(id div 40 AS INT)) AS obs_date", "rand(1) AS tmax")
            .repartition(7))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_table(days, str(tmp_path / "d"), range_by=["station_id", "obs_date"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hit, files = 0, [f for f in os.listdir(tmp_path / "d") if f.endswith(".parquet")]
    for f in files:
        meta = pq.ParquetFile(tmp_path / "d" / f).metadata
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(0).statistics
            hit += s.min <= "S007" <= s.max
    assert len(files) == 8 and hit <= 2
    one = spark.read.parquet(str(tmp_path / "d")).where("station_id = 'S007'")
    assert one.count() == 2000
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(station_id), EqualTo(station_id,S007)]" in plan


def test_a_failed_update_leaves_the_old_board(spark, tmp_path):
    path, cols = str(tmp_path / "board"), "station_id string, model string, mae double"
    sinks.update_scoreboard(spark, path, spark.createDataFrame([("A", "x", 3.0), ("A", "y", 4.0)], cols))
    broken = spark.createDataFrame([("A", "x", 1.0)], cols).withColumn(
        "mae", F.when(F.col("mae") > 0, F.raise_error(F.lit("lost")).cast("double")))
    with pytest.raises(Exception, match="lost"):
        sinks.update_scoreboard(spark, path, broken)
    assert sorted(map(tuple, sinks.read_scoreboard(spark, path).collect())) == [("A", "x", 3.0), ("A", "y", 4.0)]
    out = sinks.update_scoreboard(spark, path, spark.createDataFrame([("A", "x", 5.0)], cols))
    assert [tuple(r) for r in out.collect()] == [("A", "x", 5.0), ("A", "y", 4.0)]  # largest MAE first
    assert sinks.read_scoreboard(spark, path, 1).count() == 2 and snapshots.versions(spark, path) == [1, 2]


def test_an_update_that_lost_the_race_starts_again(spark, tmp_path, monkeypatch):
    path, cols = str(tmp_path / "board"), "station_id string, model string, mae double"
    other = [spark.createDataFrame([("B", "x", 9.0)], cols)]
    check = snapshots.Load.check

    def publish_first(load):
        check(load)
        if other:
            rival = snapshots.Load(spark, path)
            rival.write("scoreboard", other.pop())
            rival.publish()

    monkeypatch.setattr(snapshots.Load, "check", publish_first)
    out = sinks.update_scoreboard(spark, path, spark.createDataFrame([("A", "x", 1.0)], cols))
    assert [tuple(r) for r in out.collect()] == [("B", "x", 9.0), ("A", "x", 1.0)]


def test_contract_report_scans_the_child_once(spark, tmp_path):
    """Key, unique, NOT NULL, type, length and two references in one pass over the checked table."""
    from stationlake.operators.quality import contract_report

    kind = T.StructType([T.StructField("k", T.IntegerType(), False), T.StructField("j", T.StringType()), T.StructField("u", T.StringType()),
                         T.StructField("p", T.LongType()), T.StructField("q", T.StringType()), T.StructField("d", T.DecimalType(3, 1))])
    rule = Contract("child", kind, key=("k", "j"), references={"p": ("pp", "p"), "q": ("qq", "q")}, max_length={"j": 1}, unique=("u",))
    rows = [(1, None, "a", 1, "x", 1.0), (None, "1", "b", 2, "x", 1.0), (None, None, "b", 9, None, 100.0), (1, None, None, None, "z", None),
            (None, "1", None, 9, "zz", 5.0), (2, "long", "c", 1, "x", 2.0)]
    spark.createDataFrame(rows, "k int, j string, u string, p int, q string, d double").write.parquet(str(tmp_path / "c"))
    refs = {"pp": spark.createDataFrame([(1,), (2,), (2,), (None,)], "p bigint"), "qq": spark.createDataFrame([("x",)], "q string")}
    out = contract_report(spark.read.parquet(str(tmp_path / "c")), rule, refs)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {(r.rule, r.column_name): r.violations for r in out.collect()}
    assert len(got) == 12
    assert {k: v for k, v in got.items() if v} == {("not_null", "k"): 3, ("type", "d"): 1, ("length", "j"): 1, ("key", "k,j"): 2,
                                                   ("unique", "u"): 2, ("fk", "p"): 2, ("fk", "q"): 2}
