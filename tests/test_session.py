"""Written tables go to the shared folder and come back whole; lineage restarts at the files."""

import os

from stationlake.session import drop_tables, materialize, shared_dir


def test_materialize_writes_under_the_shared_folder(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS k", "cast(id AS double) / 3 AS x")
    out = materialize(df, "probe")
    root = shared_dir(spark)
    files = out.inputFiles()
    assert files and all(f.replace("file://", "").replace("file:", "").startswith(f"{root}/tables/probe-")
                         for f in files)
    # names and types kept (file reads always come back nullable)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in df.schema]
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Range" not in plan


def test_written_tables_are_dropped(spark):
    out = materialize(spark.range(10).selectExpr("id"), "dropped")
    root = f"{shared_dir(spark)}/tables"
    assert out.count() == 10 and any(n.startswith("dropped-") for n in os.listdir(root))
    assert drop_tables(spark) >= 1 and drop_tables(spark) == 0
    assert not any(n.startswith("dropped-") for n in os.listdir(root))
