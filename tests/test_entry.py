"""Driver contract and the Spark-vs-DuckDB oracle on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["station_id", "station_name", "gap_count", "longest_gap_days"]


def test_registry_consistent():
    from __spark_entry__ import oracle_sql, queries

    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


#: Two fits of 600 trees: minutes each, whatever the table size. tools/oracle_check.py runs them.
LONG = {"fit_gbt", "feature_importance"}


@pytest.mark.parametrize("name", sorted(set(__import__("__spark_entry__").oracle_sql()) - LONG))
def test_oracle_matches(spark, name):
    import oracle_check

    from __spark_entry__ import oracle_sql, queries

    con = oracle_check.duck(SF)
    msg, ok = oracle_check.compare(spark, con, name, queries()[name], oracle_sql()[name], SF)
    assert ok, msg


_FOREIGN_CWD_SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry_by_path", sys.argv[1])
m = importlib.util.module_from_spec(spec)
spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "America/Los_Angeles").getOrCreate())
q = m.queries()
print("ROWS", m.entry(spark).count(), q["seasonal_forecast"](spark, sys.argv[2]).count(),
      q["fit_linear"](spark, sys.argv[2]).count())
spark.stop()
"""


def test_entry_loaded_by_path_from_another_folder(tmp_path):
    """A driver that loads the entry file by path, from another working folder, with its own plain
    session: the package is found, and Python-worker queries run without it on the workers' path."""
    import subprocess

    entry_file = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    sf = "/root/testdata/sf0.01"  # long enough monthly series for the forecast to emit rows
    out = subprocess.run([sys.executable, "-c", _FOREIGN_CWD_SCRIPT, entry_file, sf], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    rows = [line for line in out.stdout.splitlines() if line.startswith("ROWS")]
    assert rows, out.stderr[-2000:]
    entry_rows, forecast_rows, linear_rows = map(int, rows[0].split()[1:])
    assert entry_rows > 0 and forecast_rows > 0 and linear_rows > 0


def test_other_queries_stay_where_a_package_of_the_extras_is_missing(monkeypatch):
    import __spark_entry__ as entry
    from stationlake.plans.registry import QUERIES

    pytest.importorskip("corpus_pipeline")
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("stationlake.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    with pytest.warns(UserWarning, match="public_tokenizers"):
        assert set(entry.queries()) == set(QUERIES)
