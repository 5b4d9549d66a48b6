"""Forecast baselines, per-station linear regression, boosted trees and the scoreboard.

Everything is keyed by ``station_id``: one model (or baseline) per station,
scored on the chronological test split. A model counts as useful only if it
beats the baseline (``model_gate``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stationlake.operators.joins import join_dim
from stationlake.schema import FEATURE_COLUMNS, TARGET

#: A feature is dependent if the features before it leave less than this share of its variance.
DEPENDENT_SHARE = 1e-9


def persistence(test: DataFrame) -> DataFrame:
    """Tomorrow = today: the prediction is ``tmax_lag1``."""
    return test.select("station_id", "obs_date", "month", F.lit("persistence").alias("model"),
                       F.col(TARGET).alias("actual"), F.col("tmax_lag1").alias("predicted"))


def climatology(train: DataFrame) -> DataFrame:
    """Mean target per station and day of year, learned on the training split only."""
    return train.groupBy("station_id", F.dayofyear("obs_date").alias("doy")).agg(
        F.avg(TARGET).alias("clim_mean"), F.count(F.lit(1)).alias("n_train"))


def climatology_forecast(train: DataFrame, test: DataFrame) -> DataFrame:
    """Test rows with the train climatology of their day of year.

    A day of year never seen in training gets a NULL prediction; the scores
    exclude and count such rows instead of failing.
    """
    clim = climatology(train).select("station_id", "doy", "clim_mean")
    t = test.withColumn("doy", F.dayofyear("obs_date"))
    j = t.join(clim, ["station_id", "doy"], "left")
    return j.select("station_id", "obs_date", "month", F.lit("climatology").alias("model"),
                    F.col(TARGET).alias("actual"), F.col("clim_mean").alias("predicted"))


def scores(preds: DataFrame) -> DataFrame:
    """MAE, RMSE and counts per (station, model), all models in one aggregate."""
    e = F.col("actual") - F.col("predicted")
    return preds.groupBy("station_id", "model").agg(
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.count("predicted").alias("n_scored"),
        F.count_if(F.col("predicted").isNull()).alias("n_excluded"),
    )


def with_skill(board: DataFrame, baseline: str = "persistence") -> DataFrame:
    """Add ``skill_vs_<baseline>`` = (1 - MAE / baseline MAE) * 100 per station."""
    base = F.max(F.when(F.col("model") == baseline, F.col("mae"))).over(Window.partitionBy("station_id"))
    return board.withColumn(f"skill_vs_{baseline}", (F.lit(1.0) - F.try_divide(F.col("mae"), F.nullif(base, F.lit(0.0))))
                            * 100)


def model_gate(board: DataFrame, baseline: str = "persistence") -> DataFrame:
    """Each non-baseline model with its baseline MAE and whether it beats it."""
    base = board.where(F.col("model") == baseline).select("station_id", F.col("mae").alias("baseline_mae"))
    others = board.where(F.col("model") != baseline)
    return others.join(base, "station_id", "left").select(
        "station_id", "model", "mae", F.lit(baseline).alias("baseline"), "baseline_mae",
        (F.col("mae") < F.col("baseline_mae")).alias("beats_baseline"))


def error_by_month(preds: DataFrame) -> DataFrame:
    """Mean absolute error per station, model and calendar month of the feature date."""
    return preds.where(F.col("predicted").isNotNull()).groupBy("station_id", "model", "month").agg(
        F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("mae"))


def trend_slope(train: DataFrame, y: str = TARGET, x: str = "tmax_lag1") -> DataFrame:
    """One-feature least squares per station: slope and intercept of ``y`` on ``x``."""
    return train.groupBy("station_id").agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_count(y, x).alias("n"))


# --- linear regression per station from sufficient statistics -------------

def _moments(train: DataFrame, feats: Sequence[str]) -> DataFrame:
    """Per station: n, means and centred second moments (``covar_pop``) of every pair, in one aggregate.

    ``covar_pop`` merges partial, centred sums, so the rows of one station never
    meet in one task and a mean far from zero costs no precision.
    """
    p = len(feats)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(TARGET).alias("my")]
    aggs += [F.avg(f).alias(f"mx{i}") for i, f in enumerate(feats)]
    aggs += [F.covar_pop(feats[i], feats[j]).alias(f"c{i}_{j}") for i in range(p) for j in range(i, p)]
    aggs += [F.covar_pop(f, TARGET).alias(f"cy{i}") for i, f in enumerate(feats)]
    return train.groupBy("station_id").agg(*aggs)


def independent_columns(corr: np.ndarray, share: float = DEPENDENT_SHARE) -> np.ndarray:
    """Which columns are no linear combination of the columns before them.

    Cholesky elimination of a correlation matrix in column order: the pivot is the share of a column's variance that the
    independent columns before it leave. A column whose pivot vanishes is dependent and takes no part from there on, so of
    columns that determine each other the later ones are dropped, the same ones for every station.
    """
    p = len(corr)
    left, ok = corr.astype(float).copy(), np.zeros(p, bool)
    for j in range(p):
        if left[j, j] > share:
            ok[j] = True
            left -= np.outer(left[:, j], left[j, :]) / left[j, j]
    return ok


def _solver(p: int, dependent: str):
    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                d = r._asdict()
                mx = np.array([d[f"mx{i}"] for i in range(p)], float)
                cov = np.empty((p, p))
                for i in range(p):
                    for j in range(i, p):
                        cov[i, j] = cov[j, i] = d[f"c{i}_{j}"]
                cxy = np.array([d[f"cy{i}"] for i in range(p)])
                scale = np.sqrt(np.clip(np.diag(cov), 0.0, None))
                live = np.flatnonzero(scale > 1e-12 * np.maximum(1.0, np.abs(mx)))
                beta, free = np.zeros(p), np.zeros(p, bool)
                if len(live):
                    corr = cov[np.ix_(live, live)] / np.outer(scale[live], scale[live])
                    free[live] = independent_columns(corr)
                    f = np.flatnonzero(free)
                    s = scale[f]
                    beta[f] = np.linalg.solve(cov[np.ix_(f, f)] / np.outer(s, s), cxy[f] / s) / s
                    if dependent == "share" and len(f) < len(live):
                        # the shortest of the coefficient vectors that predict the same: without its part along the
                        # combinations of live features that are constant
                        rest = np.flatnonzero(~free[live])
                        null = np.zeros((len(live), len(rest)))
                        null[rest, np.arange(len(rest))] = 1
                        at = np.flatnonzero(free[live])
                        null[at] = -np.linalg.solve(corr[np.ix_(at, at)], corr[np.ix_(at, rest)])
                        null *= (1 / scale[live])[:, None]
                        q, _ = np.linalg.qr(null)
                        beta[live] -= q @ (q.T @ beta[live])
                out.append((d["station_id"], int(d["n"]), float(d["my"] - mx @ beta), beta.tolist(), free.tolist()))
            yield pd.DataFrame(out, columns=["station_id", "n_train", "intercept", "coefficients", "independent"])
    return solve


LINEAR_SCHEMA = T.StructType([
    T.StructField("station_id", T.StringType()), T.StructField("n_train", T.LongType()),
    T.StructField("intercept", T.DoubleType()), T.StructField("coefficients", T.ArrayType(T.DoubleType())),
    T.StructField("independent", T.ArrayType(T.BooleanType())),
])


def fit_linear(train: DataFrame, feats: Sequence[str] = FEATURE_COLUMNS, dependent: str = "drop") -> DataFrame:
    """Ordinary least squares with intercept, one model per station.

    The normal equations are built by a Spark aggregate (sufficient
    statistics per station, O(p^2) numbers each); only those small rows reach
    Python, where ``mapInPandas`` solves each p x p system. ``independent``
    says which features are no linear combination of the ones before them in
    the station's own data (range = today - tmin, delta = lag1 - lag2). With
    ``dependent="drop"`` the others have coefficient 0, which makes the rest
    unique; with ``"share"`` the coefficients are the shortest vector of all
    that predict the same, as solvers by singular values give. The predictions
    are those of every least-squares solution either way.
    """
    if dependent not in ("drop", "share"):
        raise ValueError("dependent is 'drop' or 'share'")
    return _moments(train, list(feats)).mapInPandas(_solver(len(feats), dependent), LINEAR_SCHEMA)


def predict_linear(test: DataFrame, coefs: DataFrame, feats: Sequence[str] = FEATURE_COLUMNS,
                   model: str = "linear") -> DataFrame:
    """intercept + coefficients . features, evaluated JVM-side (``zip_with`` + ``aggregate``)."""
    x = F.array(*[F.col(f).cast("double") for f in feats])
    dot = F.aggregate(F.zip_with("coefficients", x, lambda c, v: c * v), F.lit(0.0), lambda acc, v: acc + v)
    j = join_dim(test, coefs.select("station_id", "intercept", "coefficients"), "station_id")
    return j.select("station_id", "obs_date", "month", F.lit(model).alias("model"),
                    F.col(TARGET).alias("actual"), (F.col("intercept") + dot).alias("predicted"))


def linear_coefficients(coefs: DataFrame, feats: Sequence[str] = FEATURE_COLUMNS, top: int = 6,
                        all_features: bool = False) -> DataFrame:
    """Coefficients per station ranked by absolute value (top ``top``): of the independent features, or of all."""
    names = F.array(*[F.lit(f) for f in feats])
    z = coefs.select("station_id", F.inline(F.arrays_zip(names.alias("feature"), F.col("coefficients").alias("coefficient"),
                                                          F.col("independent").alias("independent"))))
    if not all_features:
        z = z.where("independent")
    w = Window.partitionBy("station_id").orderBy(F.abs("coefficient").desc(), F.col("feature"))
    return z.drop("independent").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def linear_residuals(train: DataFrame, coefs: DataFrame, feats: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Per station and feature: n_train and the correlation-scaled normal-equation residual.

    A least-squares fit leaves an error uncorrelated with every feature; the
    residual is |covariance(feature, error)| over the spreads of feature and
    target, 0 for a feature or target without spread.
    """
    x = F.array(*[F.col(f).cast("double") for f in feats])
    dot = F.aggregate(F.zip_with("coefficients", x, lambda c, v: c * v), F.lit(0.0), lambda acc, v: acc + v)
    j = join_dim(train, coefs.select("station_id", "intercept", "coefficients"), "station_id")
    e = j.withColumn("_e", F.col(TARGET) - F.col("intercept") - dot)
    per = e.groupBy("station_id").agg(F.count(F.lit(1)).alias("n_train"), *[
        F.coalesce(F.try_divide(F.abs(F.covar_pop(f, "_e")),
                                F.nullif(F.stddev_pop(f) * F.stddev_pop(TARGET), F.lit(0.0))), F.lit(0.0)).alias(f)
        for f in feats])
    return per.unpivot(["station_id", "n_train"], list(feats), "feature", "residual")


# --- gradient-boosted trees (MLlib) ----------------------------------------

def fit_gbt(train: DataFrame, feats: Sequence[str] = FEATURE_COLUMNS, max_iter: int = 600, max_depth: int = 4,
            step_size: float = 0.05, subsampling_rate: float = 0.8, feature_subset: str = "0.8", seed: int = 42,
            max_bins: int = 32):
    """Boosted regression trees over all stations at once (one distributed MLlib fit).

    A per-station loop would run one training job per station from the
    driver; instead one model is trained on every station's rows, on the same
    features whatever the number of stations. Defaults: 600 trees, depth 4,
    rate 0.05, 0.8 row and column sampling, seed 42. A split's threshold is one of
    ``max_bins`` - 1 quantiles of its feature, or any midpoint of neighbouring
    values where the feature has at most ``max_bins`` of them.
    Returns (pipeline_model, input_feature_names).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    from stationlake.session import shared_dir

    shared_dir(train.sparkSession)  # checkpoint folder for the tree ensemble's lineage
    names = list(feats)
    stages = [VectorAssembler(inputCols=names, outputCol="features"),
              GBTRegressor(featuresCol="features", labelCol=TARGET, maxIter=max_iter, maxDepth=max_depth,
                           stepSize=step_size, subsamplingRate=subsampling_rate,
                           featureSubsetStrategy=feature_subset, seed=seed, lossType="squared",
                           checkpointInterval=10, maxBins=max_bins)]
    return Pipeline(stages=stages).fit(train), names


def predict_gbt(model, test: DataFrame) -> DataFrame:
    out = model.transform(test)
    return out.select("station_id", "obs_date", "month", F.lit("gbt").alias("model"),
                      F.col(TARGET).alias("actual"), F.col("prediction").alias("predicted"))


def tree_nodes(model, names: Sequence[str], tree: int = 0) -> list[tuple[int, str | None, float | None, float, int]]:
    """(node, feature, threshold, prediction, rows) of one tree; node n's children are 2n (feature <= threshold) and
    2n + 1, a leaf has no feature. A tree has at most 2 ** (depth + 1) - 1 nodes."""
    out, todo = [], [(1, model.stages[-1].trees[tree]._call_java("rootNode"))]
    while todo:
        n, node = todo.pop()
        rows = int(node.impurityStats().count())
        if node.getClass().getSimpleName() == "LeafNode":
            out.append((n, None, None, float(node.prediction()), rows))
            continue
        split = node.split()
        out.append((n, names[split.featureIndex()], float(split.threshold()), float(node.prediction()), rows))
        todo += [(2 * n, node.leftChild()), (2 * n + 1, node.rightChild())]
    return sorted(out)


def feature_importance(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """Impurity-based importances of the fitted ensemble (one number per input feature), largest first."""
    imp = model.stages[-1].featureImportances.toArray()
    return sorted(zip(names, map(float, imp)), key=lambda t: (-t[1], t[0]))
