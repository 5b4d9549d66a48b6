"""Registered model and forecast-evaluation queries (binding F).

Split at 2000-01-01 (the data spans 1995-2001; the reference splits at
2010-01-01 on 1960-2018). Baselines, the scoreboard, the gate, the one-feature
trend, the two-feature linear fit and the top coefficients of the 15-feature fit
have DuckDB oracles for their values. The 15-feature fit itself, the boosted trees and the seasonal forecast are compared in
what SQL can state of them (counts, residuals, bounds, widths, sums); the tree
and forecast values themselves are held by unit tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationlake.operators import display as D
from stationlake.operators import features as FT
from stationlake.operators import forecast as FC
from stationlake.operators import models as M
from stationlake.plans import bindings as B
from stationlake.plans.q_series import FEATURES_SQL, HOLDOUT_SQL, HORIZON, SPLIT, f_monthly, monthly_sql, seasonal_naive_df
from stationlake.plans.registry import R, W, r6, register
from stationlake.schema import FEATURE_COLUMNS, TARGET
from stationlake.session import materialize, table_path
from stationlake.sources import sinks

RESPLIT = "2001-01-01"   # second scoring run for the upsert


def _features(spark, sf):
    return FT.features(B.daily_dense(spark, sf))


def _feats(spark, sf):
    """Features written once to the shared folder, where several branches (train, test, baselines)
    read them instead of re-running the raw scan and the feature windows."""
    return materialize(_features(spark, sf), "features")


def _baseline_preds(feats, cutoff):
    train, test = FT.split(feats, cutoff)
    return M.persistence(test).unionByName(M.climatology_forecast(train, test))


def _sql(body: str) -> str:
    return W(f""", feat AS ({FEATURES_SQL}),
train AS (SELECT * FROM feat WHERE obs_date < DATE '{SPLIT}'),
test AS (SELECT * FROM feat WHERE obs_date >= DATE '{SPLIT}'),
clim AS (SELECT station_id, dayofyear(obs_date) AS doy, avg({TARGET}) AS clim_mean, count(*) AS n_train
         FROM train GROUP BY 1, 2),
preds AS (
  SELECT station_id, obs_date, month, 'persistence' AS model, {TARGET} AS actual, tmax_lag1 AS predicted FROM test
  UNION ALL
  SELECT t.station_id, t.obs_date, t.month, 'climatology', t.{TARGET}, c.clim_mean
  FROM test t LEFT JOIN clim c ON c.station_id = t.station_id AND c.doy = dayofyear(t.obs_date)),
board AS (
  SELECT station_id, model, avg(abs(actual - predicted)) AS mae,
         sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
         count(predicted) AS n_scored, count(*) FILTER (WHERE predicted IS NULL) AS n_excluded
  FROM preds GROUP BY 1, 2)
{body}""", "f")


@register("climatology", _sql(f"SELECT station_id, CAST(doy AS INTEGER) AS doy, {R('clim_mean')} AS clim_mean, n_train FROM clim"))
def climatology_q(spark, sf):
    train, _ = FT.split(_features(spark, sf), SPLIT)
    return r6(M.climatology(train))


@register("forecast_scores", _sql(f"""
SELECT station_id, model, {R("mae")} AS mae, {R("rmse")} AS rmse, n_scored, n_excluded,
       {R("(1 - mae / nullif(max(CASE WHEN model = 'persistence' THEN mae END) OVER (PARTITION BY station_id), 0)) * 100")}
         AS skill_vs_persistence
FROM board"""))
def forecast_scores(spark, sf):
    return r6(M.with_skill(M.scores(_baseline_preds(_feats(spark, sf), SPLIT))))


@register("error_by_month", _sql(f"""
SELECT station_id, model, month, {R("avg(abs(actual - predicted))")} AS mae
FROM preds WHERE model = 'persistence' AND predicted IS NOT NULL GROUP BY 1, 2, 3"""))
def error_by_month(spark, sf):
    _, test = FT.split(_features(spark, sf), SPLIT)
    return r6(M.error_by_month(M.persistence(test)))


@register("model_gate", _sql(f"""
SELECT b.station_id, b.model, {R("b.mae")} AS mae, 'persistence' AS baseline, {R("p.mae")} AS baseline_mae,
       b.mae < p.mae AS beats_baseline
FROM board b LEFT JOIN (SELECT station_id, mae FROM board WHERE model = 'persistence') p USING (station_id)
WHERE b.model <> 'persistence'"""))
def model_gate(spark, sf):
    return r6(M.model_gate(M.scores(_baseline_preds(_feats(spark, sf), SPLIT))))


@register("trend_slope", _sql(f"""
SELECT station_id, {R(f"regr_slope({TARGET}, tmax_lag1)")} AS slope, {R(f"regr_intercept({TARGET}, tmax_lag1)")} AS intercept,
       CAST(regr_count({TARGET}, tmax_lag1) AS BIGINT) AS n
FROM train GROUP BY 1"""))
def trend_slope(spark, sf):
    train, _ = FT.split(_features(spark, sf), SPLIT)
    return r6(M.trend_slope(train))


@register("score_upsert", W(f""", feat AS ({FEATURES_SQL}),
old AS (
  SELECT t.station_id, 'climatology' AS model, avg(abs(t.{TARGET} - c.clim_mean)) AS mae,
         sqrt(avg((t.{TARGET} - c.clim_mean) * (t.{TARGET} - c.clim_mean))) AS rmse, count(c.clim_mean) AS n_scored
  FROM (SELECT * FROM feat WHERE obs_date >= DATE '{SPLIT}') t
  LEFT JOIN (SELECT station_id, dayofyear(obs_date) AS doy, avg({TARGET}) AS clim_mean
             FROM feat WHERE obs_date < DATE '{SPLIT}' GROUP BY 1, 2) c
    ON c.station_id = t.station_id AND c.doy = dayofyear(t.obs_date)
  GROUP BY 1),
new AS (
  SELECT station_id, 'persistence' AS model, avg(abs({TARGET} - tmax_lag1)) AS mae,
         sqrt(avg(({TARGET} - tmax_lag1) * ({TARGET} - tmax_lag1))) AS rmse, count(tmax_lag1) AS n_scored
  FROM feat WHERE obs_date >= DATE '{RESPLIT}' GROUP BY 1)
SELECT station_id, model, {R("mae")} AS mae, {R("rmse")} AS rmse, n_scored FROM (SELECT * FROM old UNION ALL SELECT * FROM new)""", "f"))
def score_upsert(spark, sf):
    feats = _feats(spark, sf)
    cols = ["station_id", "model", "mae", "rmse", "n_scored"]
    _, test2 = FT.split(feats, RESPLIT)
    path = table_path(spark, "scoreboard")  # stored twice: a first board, then one model's new scores
    sinks.update_scoreboard(spark, path, M.scores(_baseline_preds(feats, SPLIT)).select(*cols))
    return r6(sinks.update_scoreboard(spark, path, M.scores(M.persistence(test2)).select(*cols)))


# --- fitted models ---

def _linear(spark, sf, feats):
    train, test = FT.split(_feats(spark, sf), SPLIT)
    return materialize(M.fit_linear(train, feats), "linear_coefficients"), train, test


_FEATURE_ROWS = ", ".join(f"('{f}')" for f in FEATURE_COLUMNS)


@register("fit_linear", _sql(f"""
SELECT station_id, n_train, feature, true AS solves_normal_equations
FROM (SELECT station_id, count(*) AS n_train FROM train GROUP BY 1), (VALUES {_FEATURE_ROWS}) v(feature)"""))
def fit_linear(spark, sf):
    """All 15 features: the fitted error is uncorrelated with each (scaled residual below 1e-6)."""
    coefs, train, _ = _linear(spark, sf, FEATURE_COLUMNS)
    r = M.linear_residuals(train, coefs)
    return r.select("station_id", "n_train", "feature", (F.col("residual") < 1e-6).alias("solves_normal_equations"))


@register("linear_scores", _sql("""
SELECT station_id, 'linear' AS model, n_scored, n_excluded FROM board WHERE model = 'persistence'
UNION ALL SELECT station_id, model, n_scored, n_excluded FROM board WHERE model = 'persistence'"""))
def linear_scores(spark, sf):
    """The 15-feature fit scored beside persistence: every test row has a prediction."""
    coefs, _, test = _linear(spark, sf, FEATURE_COLUMNS)
    board = M.with_skill(M.scores(M.predict_linear(test, coefs).unionByName(M.persistence(test))))
    return board.select("station_id", "model", "n_scored", "n_excluded")


TWO = ["tmax_lag1", "tmin_today"]

_TWO_SQL = f"""
  SELECT station_id, count(*) AS n_train, avg({TARGET}) AS my, avg(tmax_lag1) AS m1, avg(tmin_today) AS m2,
         covar_pop(tmax_lag1, tmax_lag1) AS c11, covar_pop(tmin_today, tmin_today) AS c22, covar_pop(tmax_lag1, tmin_today) AS c12,
         covar_pop(tmax_lag1, {TARGET}) AS y1, covar_pop(tmin_today, {TARGET}) AS y2
  FROM train GROUP BY 1"""


@register("linear_two_features", _sql(f"""
SELECT station_id, n_train, {R("b1")} AS tmax_lag1, {R("b2")} AS tmin_today, {R("my - m1 * b1 - m2 * b2")} AS intercept
FROM (SELECT *, coalesce((c22 * y1 - c12 * y2) / nullif(c11 * c22 - c12 * c12, 0), 0) AS b1,
             coalesce((c11 * y2 - c12 * y1) / nullif(c11 * c22 - c12 * c12, 0), 0) AS b2 FROM ({_TWO_SQL}))"""))
def linear_two_features(spark, sf):
    """The same operator on two features, against the closed form."""
    train, _ = FT.split(_features(spark, sf), SPLIT)
    coefs = M.fit_linear(train, TWO)
    return r6(coefs.select("station_id", "n_train", F.col("coefficients")[0].alias(TWO[0]),
                           F.col("coefficients")[1].alias(TWO[1]), "intercept"))


_N = len(FEATURE_COLUMNS) + 1  # the features, then the target

_FIT_COLUMNS = [*FEATURE_COLUMNS, TARGET]

# Least squares by Gauss-Jordan steps on the station's correlation matrix (a list, row by row): step k clears column k with row
# k, unless the features before leave feature k a share of its variance that is nothing; the last column ends as the solution.
LINEAR_SQL = f"""
moments AS (
  SELECT station_id, [{", ".join(f"avg({c})" for c in _FIT_COLUMNS)}] AS m,
         [{", ".join(f"covar_pop({a}, {b})" for a in _FIT_COLUMNS for b in _FIT_COLUMNS)}] AS c
  FROM train GROUP BY 1),
spreads AS (
  SELECT *, list_transform(range({_N}), lambda i: CASE WHEN sqrt(greatest(c[i * {_N + 1} + 1], 0)) > 1e-12 * greatest(1, abs(m[i + 1]))
                                                       THEN sqrt(c[i * {_N + 1} + 1]) END) AS s FROM moments),
steps AS (
  SELECT station_id, s, 0 AS k, CAST([] AS BOOLEAN[]) AS free,
         list_transform(range({_N * _N}), lambda x: coalesce(c[x + 1] / (s[x // {_N} + 1] * s[x % {_N} + 1]), 0)) AS a
  FROM spreads
  UNION ALL
  SELECT station_id, s, k + 1, list_append(free, a[k * {_N + 1} + 1] > {M.DEPENDENT_SHARE}),
         CASE WHEN a[k * {_N + 1} + 1] > {M.DEPENDENT_SHARE} THEN list_transform(range({_N * _N}), lambda x:
           CASE WHEN x // {_N} = k THEN a[x + 1] / a[k * {_N + 1} + 1]
                ELSE a[x + 1] - a[x // {_N} * {_N} + k + 1] * a[k * {_N} + x % {_N} + 1] / a[k * {_N + 1} + 1] END) ELSE a END
  FROM steps WHERE k < {_N - 1}),
solved AS (
  SELECT station_id, feature, a[i * {_N} + {_N}] * coalesce(s[{_N}], 0) / s[i + 1] AS coefficient
  FROM steps, (VALUES {", ".join(f"({i}, '{f}')" for i, f in enumerate(FEATURE_COLUMNS))}) v(i, feature)
  WHERE k = {_N - 1} AND free[i + 1]),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY abs(coefficient) DESC, feature) AS rank FROM solved)"""


@register("linear_coefficients", _sql(f""", {LINEAR_SQL.strip()}
SELECT station_id, CAST(rank AS INTEGER) AS rank, feature, {R("coefficient")} AS coefficient,
       feature NOT IN ('temp_range_today', 'tmax_delta_1d') AS among_independent, true AS new_feature, true AS not_larger
FROM ranked WHERE rank <= 6""").replace("WITH ", "WITH RECURSIVE ", 1))
def linear_coefficients(spark, sf):
    """The top 6 of the 15-feature fit, by absolute value: ranks, features and coefficients; none of the two dependent features,
    no feature twice, falling size."""
    train, _ = FT.split(_features(spark, sf), SPLIT)
    top = M.linear_coefficients(M.fit_linear(train))
    w = Window.partitionBy("station_id").orderBy("rank")
    size = F.abs("coefficient")
    return r6(top.select("station_id", "rank", "feature", "coefficient",
                         (~F.col("feature").isin("temp_range_today", "tmax_delta_1d")).alias("among_independent"),
                         (F.count(F.lit(1)).over(Window.partitionBy("station_id", "feature")) == 1).alias("new_feature"),
                         F.coalesce(size <= F.lag(size).over(w), F.lit(True)).alias("not_larger")))


def _gbt(spark, sf):
    """The fit with the operator's defaults, on the written features."""
    train, test = FT.split(_feats(spark, sf), SPLIT)
    model, names = M.fit_gbt(train)
    return model, names, test


@register("fit_gbt", _sql("""
SELECT station_id, 'gbt' AS model, n_scored + n_excluded AS n_scored, CAST(0 AS BIGINT) AS n_excluded
FROM board WHERE model = 'persistence'
UNION ALL SELECT station_id, model, n_scored, n_excluded FROM board WHERE model = 'persistence'"""))
def fit_gbt(spark, sf):
    model, _, test = _gbt(spark, sf)
    board = M.with_skill(M.scores(M.predict_gbt(model, test).unionByName(M.persistence(test))))
    return board.select("station_id", "model", "n_scored", "n_excluded")


_CANDIDATE_ROWS = " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v, {TARGET} AS y FROM train" for f in FEATURE_COLUMNS)


@register("tree_root", _sql(f"""
SELECT feature, {R("(v + next_v) / 2")} AS threshold, {R("ty / tn")} AS root_mean, CAST(cn AS BIGINT) AS n_left, CAST(tn - cn AS BIGINT) AS n_right,
       {R("cy / cn")} AS left_mean, {R("(ty - cy) / (tn - cn)")} AS right_mean
FROM (SELECT feature, v, lead(v) OVER w AS next_v, sum(n) OVER w AS cn, sum(sy) OVER w AS cy,
             sum(n) OVER (PARTITION BY feature) AS tn, sum(sy) OVER (PARTITION BY feature) AS ty
      FROM (SELECT feature, v, count(*) AS n, sum(y) AS sy FROM ({_CANDIDATE_ROWS}) GROUP BY 1, 2)
      WINDOW w AS (PARTITION BY feature ORDER BY v))
WHERE next_v IS NOT NULL
ORDER BY cy * cy / cn + (ty - cy) * (ty - cy) / (tn - cn) DESC, feature LIMIT 1"""))
def tree_root(spark, sf):
    """The first tree's first split without sampling, every midpoint a candidate: the one of largest variance reduction."""
    train, _ = FT.split(_feats(spark, sf), SPLIT)
    most = max(train.agg(*[F.count_distinct(f).alias(f) for f in FEATURE_COLUMNS]).first())
    model, names = M.fit_gbt(train, max_iter=1, max_depth=1, subsampling_rate=1.0, feature_subset="all", max_bins=max(2, most))
    nodes = M.tree_nodes(model, names)
    row = []  # no split where all targets are equal
    if len(nodes) == 3:
        root, left, right = nodes
        row = [(root[1], root[2], root[3], left[4], right[4], left[3], right[3])]
    return r6(spark.createDataFrame(row, "feature string, threshold double, root_mean double, n_left bigint, n_right bigint, "
                                         "left_mean double, right_mean double"))


@register("feature_importance", f"""
SELECT feature, true AS in_range, CAST(1.0 AS DOUBLE) AS total FROM (VALUES {_FEATURE_ROWS}) v(feature)""")
def feature_importance(spark, sf):
    model, names, test = _gbt(spark, sf)
    rows = spark.createDataFrame(M.feature_importance(model, names), "feature string, importance double")
    total = F.round(F.sum("importance").over(Window.partitionBy()), 6)
    return rows.select("feature", ((F.col("importance") >= 0) & (F.col("importance") <= 1)).alias("in_range"),
                       total.alias("total"))


_FORECAST_SQL = f"""
SELECT station_id, month_start, value AS actual,
       CAST(row_number() OVER (PARTITION BY station_id ORDER BY month_start) AS INTEGER) AS step
FROM (SELECT station_id, month_start, value, row_number() OVER (PARTITION BY station_id ORDER BY month_start DESC) AS back
      FROM {monthly_sql("f", 20, 1995, 2001)})
WHERE back <= {HORIZON}"""


@register("prediction_sink", _sql(f"""
SELECT station_id, obs_date, model, {R("actual")} AS actual, {R("predicted")} AS predicted FROM preds WHERE model = 'persistence'
UNION ALL
SELECT t.station_id, t.obs_date, 'linear', {R("t." + TARGET)}, {R("b.my + b.b1 * (t.tmax_lag1 - b.m1) + b.b2 * (t.tmin_today - b.m2)")}
FROM test t JOIN (
  SELECT *, coalesce((c22 * y1 - c12 * y2) / nullif(c11 * c22 - c12 * c12, 0), 0) AS b1,
         coalesce((c11 * y2 - c12 * y1) / nullif(c11 * c22 - c12 * c12, 0), 0) AS b2 FROM ({_TWO_SQL})) b USING (station_id)"""))
def prediction_sink(spark, sf):
    """A fitted model's predictions beside persistence, written to a caller's path, one folder a model, and read back."""
    train, test = FT.split(_feats(spark, sf), SPLIT)
    path = table_path(spark, "predictions")
    preds = M.persistence(test).unionByName(M.predict_linear(test, M.fit_linear(train, TWO), TWO))
    sinks.write_table(preds, path, partition_by=["model"], sort_within=["station_id", "obs_date"])
    return r6(sinks.read_table(spark, path, preds.schema).select("station_id", "obs_date", "model", "actual", "predicted"))


@register("last_rows", _sql(f"""
SELECT station_id, obs_date, {R(TARGET)} AS {TARGET} FROM feat ORDER BY obs_date DESC, station_id DESC LIMIT 5"""))
def last_rows(spark, sf):
    """The last five feature rows, as a preview."""
    f = _features(spark, sf).select("station_id", "obs_date", TARGET)
    return r6(D.last_k(f, ["obs_date", "station_id"], 5))


@register("seasonal_forecast", W(f"""
SELECT station_id, month_start, step, {R("actual")} AS actual, true AS in_bounds, true AS widens FROM ({_FORECAST_SQL})""", "f"))
def seasonal_forecast(spark, sf):
    f = FC.seasonal_forecast(f_monthly(spark, sf), horizon=HORIZON)
    width = F.col("upper") - F.col("lower")
    w = Window.partitionBy("station_id").orderBy("step")
    return r6(f.select("station_id", "month_start", "step", "actual",
                       ((F.col("lower") <= F.col("forecast")) & (F.col("forecast") <= F.col("upper"))).alias("in_bounds"),
                       F.coalesce(width >= F.lag(width).over(w) - 1e-9, F.lit(True)).alias("widens")))


@register("seasonal_gate", W(f"""
SELECT f.station_id, 'seasonal_arima' AS model, count(f.actual) AS n_scored, CAST(0 AS BIGINT) AS n_unforecast,
       'seasonal_naive' AS baseline, {R("max(b.naive_mae)")} AS baseline_mae, count(f.actual) > 0 AS decided
FROM ({_FORECAST_SQL}) f
LEFT JOIN (SELECT station_id, avg(abs(value - naive)) AS naive_mae
           FROM (SELECT *, lag(value, 12) OVER (PARTITION BY station_id ORDER BY month_start) AS naive FROM ({HOLDOUT_SQL}))
           WHERE split = 'test' GROUP BY 1) b USING (station_id)
GROUP BY f.station_id""", "f"))
def seasonal_gate(spark, sf):
    series = materialize(f_monthly(spark, sf), "monthly_series")  # read by the forecast and the baseline
    gate = FC.forecast_gate(FC.seasonal_forecast(series, horizon=HORIZON), seasonal_naive_df(series))
    return r6(gate.select("station_id", "model", "n_scored", "n_unforecast", "baseline", "baseline_mae",
                          F.col("beats_baseline").isNotNull().alias("decided")))
