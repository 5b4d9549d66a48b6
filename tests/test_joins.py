"""Checked broadcast: a dimension is broadcast only below its bound; beyond it the planner shuffles."""

from stationlake.operators.joins import fits_broadcast, join_dim


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _with_auto_broadcast_off(spark, fn):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return fn()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_small_dimension_is_broadcast(spark):
    fact = spark.range(1000).selectExpr("id % 7 AS k", "id AS v")
    dim = spark.range(7).selectExpr("id AS k", "concat('s', id) AS name")
    joined = _with_auto_broadcast_off(spark, lambda: join_dim(fact, dim, "k"))
    assert "BroadcastHashJoin" in _with_auto_broadcast_off(spark, lambda: _plan(joined))
    assert joined.count() == 1000


def test_dimension_over_the_bound_is_not_broadcast(spark):
    fact = spark.range(1000).selectExpr("id % 50 AS k", "id AS v")
    dim = spark.range(50).selectExpr("id AS k", "concat('s', id) AS name")
    assert fits_broadcast(dim, max_rows=50) and not fits_broadcast(dim, max_rows=49)
    joined = join_dim(fact, dim, "k", max_rows=10)
    plan = _with_auto_broadcast_off(spark, lambda: _plan(joined))
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert joined.count() == 1000


def test_rewritten_dimension_is_counted_again(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = str(tmp_path / "dim.parquet")  # one file, rewritten in place under the same name
    pq.write_table(pa.table({"k": list(range(5))}), path)
    assert fits_broadcast(spark.read.parquet(path), max_rows=10)
    pq.write_table(pa.table({"k": list(range(500))}), path)
    assert not fits_broadcast(spark.read.parquet(path), max_rows=10)


def test_wide_rows_are_measured_not_guessed(spark):
    wide = spark.range(3000).selectExpr("id AS k", "repeat('x', 200000) AS body")
    nested = spark.range(3000).selectExpr("id AS k", "array_repeat('xxxxxxxxxx', 20000) AS body")
    assert not fits_broadcast(wide) and not fits_broadcast(nested)
    assert fits_broadcast(spark.range(3000).selectExpr("id AS k", "'x' AS body"))
