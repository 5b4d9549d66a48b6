"""Series helpers, EDA, features, baselines and models: fixtures and invariants."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationlake.operators import eda as E
from stationlake.operators import features as FT
from stationlake.operators import forecast as FC
from stationlake.operators import models as M
from stationlake.operators import series as S
from stationlake.schema import FEATURE_COLUMNS, TARGET


def test_interpolation_fixture(spark):
    vals = [None, 1, None, None, None, 5, None, None, None]
    df = spark.createDataFrame([("A", i, None if v is None else float(v)) for i, v in enumerate(vals)],
                               "station_id string, pos int, v double")
    out = [r.v for r in S.interpolate_limited(df, "v", "pos", limit=2).orderBy("pos").collect()]
    assert out == [None, 1.0, 2.0, 3.0, None, 5.0, 5.0, 5.0, None]


def test_rolling_minimum_support(spark):
    # 7 rows, values missing at positions 2 and 5 -> 5 of 7 supported; at row 5 only 4 of 6
    vals = [1.0, 2.0, None, 4.0, 5.0, None, 7.0]
    df = spark.createDataFrame([("A", dt.date(2001, 1, i + 1), v) for i, v in enumerate(vals)],
                               "station_id string, obs_date date, x double")
    out = df.select("obs_date", S.rolling("mean", "x", 7, 5).alias("m"),
                    S.rolling("std", "x", 7, 5).alias("s")).orderBy("obs_date").collect()
    assert [r.m for r in out[:6]] == [None] * 6
    assert out[6].m == pytest.approx(np.mean([1, 2, 4, 5, 7]))
    assert out[6].s == pytest.approx(np.std([1, 2, 4, 5, 7], ddof=1))
    df30 = spark.createDataFrame([("A", dt.date(2001, 1, 1) + dt.timedelta(i), 1.0 if i >= 10 else None)
                                  for i in range(30)], "station_id string, obs_date date, x double")
    r30 = [r.m for r in df30.select("obs_date", S.rolling("mean", "x", 30, 20).alias("m")).orderBy("obs_date").collect()]
    assert r30[28] is None and r30[29] == 1.0  # 19 then 20 supporting values


def test_densify_rows_equal_span(spark):
    rows = [("A", dt.date(2001, 1, 1), 1.0), ("A", dt.date(2001, 1, 4), 2.0), ("A", dt.date(2001, 1, 5), 3.0),
            ("B", dt.date(2001, 2, 27), 1.0)]
    df = spark.createDataFrame(rows, "station_id string, obs_date date, tmax double")
    dense = S.densify_daily(df, ["tmax"]).collect()
    assert len([r for r in dense if r.station_id == "A"]) == 5 and len([r for r in dense if r.station_id == "B"]) == 1
    assert sum(1 for r in dense if r.tmax is None) == 2


def test_z_null_for_single_row_or_zero_spread(spark):
    rows = [("A", dt.date(2001, 1, 1), 5.0), ("A", dt.date(2002, 1, 1), 5.0), ("A", dt.date(2001, 1, 2), 3.0)]
    z = {r.obs_date: r.z for r in E.with_z(spark.createDataFrame(rows, "station_id string, obs_date date, tmax double"))
         .collect()}
    assert all(v is None for v in z.values())


def _dense_daily(spark, days=400, start=dt.date(2000, 1, 1), seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for sid in ("A", "B"):
        for i in range(days):
            t = 10 + 8 * math.sin(2 * math.pi * i / 365.25) + rng.normal()
            rows.append((sid, start + dt.timedelta(i), float(t), float(t - 5 - rng.random()), float(rng.random() * 3)))
    df = spark.createDataFrame(rows, "station_id string, obs_date date, tmax double, tmin double, prcp double")
    return df.withColumn("temp_range", F.col("tmax") - F.col("tmin"))


def test_features_are_leak_free_and_complete(spark):
    base = _dense_daily(spark)
    f1 = FT.features(base)
    cut = dt.date(2000, 6, 1)
    # perturb everything after the cut: features on days before the cut must not change
    pert = base.withColumn("tmax", F.when(F.col("obs_date") > cut, F.col("tmax") + 100).otherwise(F.col("tmax")))
    f2 = FT.features(pert)
    cols = ["station_id", "obs_date", *FEATURE_COLUMNS]
    a = {tuple(r) for r in f1.where(F.col("obs_date") <= cut).select(*cols).collect()}
    b = {tuple(r) for r in f2.where(F.col("obs_date") <= cut).select(*cols).collect()}
    assert a == b
    rows = f1.collect()
    assert all(all(getattr(r, c) is not None for c in [TARGET, *FEATURE_COLUMNS]) for r in rows)
    r0 = f1.where("station_id = 'A'").orderBy("obs_date").first()
    assert r0.obs_date == dt.date(2000, 1, 20)  # the 30-day mean needs 20 values (lag7 needs only 6 days back)


def test_split_and_climatology_unseen_day(spark):
    base = _dense_daily(spark, days=800, start=dt.date(1999, 1, 1))
    f = FT.features(base)
    train, test = FT.split(f, "2000-06-01")
    assert train.agg(F.max("obs_date")).first()[0] < dt.date(2000, 6, 1) <= test.agg(F.min("obs_date")).first()[0]
    # day 366 appears in test (2000 is a leap year) but not in train (1999 is not)
    train_1999 = f.where(F.col("obs_date") < dt.date(2000, 1, 1))
    test_2000 = f.where(F.year("obs_date") == 2000)
    preds = M.climatology_forecast(train_1999, test_2000)
    sc = {r.station_id: r for r in M.scores(preds).collect()}
    assert sc["A"].n_excluded >= 1 and sc["A"].mae is not None


def test_linear_matches_least_squares(spark):
    base = _dense_daily(spark)
    f = FT.features(base)
    feats = [c for c in FEATURE_COLUMNS if c not in ("temp_range_today", "tmax_delta_1d")]
    coefs = M.fit_linear(f, feats)
    preds = M.predict_linear(f, coefs, feats).where("station_id = 'A'").orderBy("obs_date")
    got = np.array([r.predicted for r in preds.collect()])
    pdf = f.where("station_id = 'A'").orderBy("obs_date").toPandas()
    X = np.column_stack([np.ones(len(pdf)), pdf[feats].to_numpy(float)])
    beta, *_ = np.linalg.lstsq(X, pdf[TARGET].to_numpy(float), rcond=None)
    assert np.allclose(got, X @ beta, atol=1e-6)
    # with the dependent features kept, the predictions are the same least-squares fit
    coefs_all = M.fit_linear(f)
    got_all = np.array([r.predicted for r in M.predict_linear(f, coefs_all).where("station_id = 'A'")
                        .orderBy("obs_date").collect()])
    assert np.allclose(got_all, got, atol=1e-5)


def test_scores_gate_and_skill(spark):
    preds = spark.createDataFrame(
        [("A", dt.date(2001, 1, 1), 1, "persistence", 10.0, 12.0), ("A", dt.date(2001, 1, 1), 1, "m", 10.0, 11.0),
         ("A", dt.date(2001, 1, 2), 1, "persistence", 10.0, 8.0), ("A", dt.date(2001, 1, 2), 1, "m", 10.0, None)],
        "station_id string, obs_date date, month int, model string, actual double, predicted double")
    board = M.with_skill(M.scores(preds))
    s = {r.model: r for r in board.collect()}
    assert s["persistence"].mae == 2.0 and s["persistence"].rmse == 2.0
    assert (s["m"].mae, s["m"].n_scored, s["m"].n_excluded) == (1.0, 1, 1)
    assert s["m"].skill_vs_persistence == 50.0
    gate = M.model_gate(M.scores(preds)).collect()
    assert [(r.model, r.beats_baseline) for r in gate] == [("m", True)]


def test_seasonal_forecast_invariants(spark):
    months = [dt.date(1990 + i // 12, i % 12 + 1, 1) for i in range(120)]
    rng = np.random.default_rng(3)
    rows = [("A", m, float(10 + 8 * math.sin(2 * math.pi * i / 12) + rng.normal(scale=0.5))) for i, m in enumerate(months)]
    df = spark.createDataFrame(rows, "station_id string, month_start date, value double")
    fc = FC.seasonal_forecast(df, horizon=24).orderBy("step").collect()
    assert len(fc) == 24
    assert all(r.lower <= r.forecast <= r.upper for r in fc)
    widths = [r.upper - r.lower for r in fc]
    assert all(b >= a - 1e-9 for a, b in zip(widths, widths[1:]))
    mae = np.mean([abs(r.actual - r.forecast) for r in fc])
    assert mae < 2.0  # a clean seasonal signal is followed


def test_monthly_series_support_and_holdout(spark):
    rows = [("A", dt.date(2001, m, day), float(m)) for m in range(1, 7) for day in range(1, 22 if m != 3 else 5)]
    df = spark.createDataFrame(rows, "station_id string, obs_date date, tmax double")
    ser = S.monthly_series(df, "tmax", min_days=20).orderBy("month_start").collect()
    assert [r.avg_value for r in ser][2] is None and ser[2].value == pytest.approx(3.0)  # interpolated hole
    split = S.holdout_split(S.monthly_series(df, "tmax", min_days=20), horizon=2).orderBy("month_start").collect()
    assert [r.split for r in split] == ["train"] * 4 + ["test"] * 2


def test_seasonal_forecast_keeps_every_station(spark):
    months = [dt.date(2000 + i // 12, i % 12 + 1, 1) for i in range(120)]
    rows = [("LONG", m, float(10 + 8 * math.sin(2 * math.pi * i / 12))) for i, m in enumerate(months)]
    rows += [("SHORT", m, 5.0) for m in months[:36]] + [("TINY", m, 5.0) for m in months[:3]]
    rows += [("HOLEY", m, None if i % 5 == 0 or i in (90, 91) else 3.0 + i % 12) for i, m in enumerate(months)]
    df = spark.createDataFrame(rows, "station_id string, month_start date, value double")
    out = FC.seasonal_forecast(df, horizon=24)
    got = {}
    for r in out.collect():
        got.setdefault(r.station_id, []).append(r)
    assert {k: len(v) for k, v in got.items()} == {"LONG": 24, "HOLEY": 24, "SHORT": 24, "TINY": 3}
    assert all(r.forecast is None and r.lower is None and r.reason for k in ("SHORT", "TINY") for r in got[k])
    assert all(r.forecast is not None and r.reason is None and r.n_filled == 0 for r in got["LONG"])
    assert all(r.forecast is not None and r.n_filled > 0 for r in got["HOLEY"])
    naive = spark.createDataFrame([("LONG", 9.0), ("SHORT", 1.0)], "station_id string, naive_mae double")
    gate = {r.station_id: r for r in FC.forecast_gate(out, naive).collect()}
    assert set(gate) == {"LONG", "HOLEY", "SHORT", "TINY"}
    assert gate["SHORT"].n_unforecast == 24 and gate["SHORT"].mae is None and gate["LONG"].beats_baseline


@pytest.mark.parametrize("mean", [0.0, 1e6, 1e8])
def test_linear_fit_far_from_zero(spark, mean):
    rng = np.random.default_rng(4)
    x = rng.normal(size=400)
    rows = [("A", float(mean + v), float(3 * v + 1)) for v in x]
    df = spark.createDataFrame(rows, f"station_id string, x double, {TARGET} double").repartition(5)
    c = M.fit_linear(df, ["x"]).first()
    assert c.coefficients[0] == pytest.approx(3.0, abs=1e-6)
    r = M.linear_residuals(df, M.fit_linear(df, ["x"]), ["x"]).first()
    assert r.residual < 1e-6 and r.n_train == 400


def test_boosted_trees_use_the_same_features_for_any_number_of_stations(spark):
    for n in (2, 129):
        rows = [(f"S{i % n:03d}", float(i % 17), float(2 * (i % 17))) for i in range(600)]
        df = spark.createDataFrame(rows, f"station_id string, x double, {TARGET} double")
        model, names = M.fit_gbt(df, ["x"], max_iter=3, step_size=0.5, subsampling_rate=1.0, feature_subset="all")
        assert names == ["x"] and M.feature_importance(model, names) == [("x", 1.0)]


def test_last_rows_and_order(spark):
    from stationlake.operators import display as D

    df = spark.range(50).selectExpr("id", "id % 7 AS g").repartition(4)
    assert [r.id for r in D.last_k(df, ["id"], 3).collect()] == [47, 48, 49]
    assert [r.g for r in D.ordered(df, ["g", "id"], descending=["g"]).limit(7).collect()] == [6] * 7


def test_dependent_features_are_found_in_the_data(spark):
    """range = today - tmin and delta = lag1 - lag2 are dropped, the other 13 coefficients are the least squares' own;
    shared out, all 15 are the shortest solution, as by singular values."""
    f = FT.features(_dense_daily(spark))
    free = [c for c in FEATURE_COLUMNS if c not in ("temp_range_today", "tmax_delta_1d")]
    pdf = f.where("station_id = 'A'").toPandas()
    y = pdf[TARGET].to_numpy(float)

    def by_svd(cols):
        x = pdf[cols].to_numpy(float)
        beta, *_ = np.linalg.lstsq(x - x.mean(axis=0), y - y.mean(), rcond=1e-10)
        return dict(zip(cols, beta))

    fit = M.fit_linear(f)
    a = fit.where("station_id = 'A'").first()
    assert [c for c, ok in zip(FEATURE_COLUMNS, a.independent) if ok] == free
    got = {c: v for c, v in zip(FEATURE_COLUMNS, a.coefficients)}
    assert got["temp_range_today"] == got["tmax_delta_1d"] == 0.0
    want = by_svd(free)
    assert all(got[c] == pytest.approx(want[c], abs=1e-6) for c in free)
    shared = M.fit_linear(f, dependent="share").where("station_id = 'A'").first().coefficients
    every = by_svd(list(FEATURE_COLUMNS))
    assert np.allclose(shared, [every[c] for c in FEATURE_COLUMNS], atol=1e-6)
    top = M.linear_coefficients(fit).where("station_id = 'A'").orderBy("rank").collect()
    ranked = sorted(free, key=lambda c: (-abs(got[c]), c))[:6]
    assert [(r.rank, r.feature) for r in top] == list(enumerate(ranked, 1))
    every_top = M.linear_coefficients(M.fit_linear(f, dependent="share"), all_features=True)
    assert [r.feature for r in every_top.where("station_id = 'A'").orderBy("rank").collect()] == sorted(
        FEATURE_COLUMNS, key=lambda c: (-abs(every[c]), c))[:6]


def test_the_coefficients_query_gives_the_top_six_with_their_values(spark, monkeypatch):
    """Feature and coefficient of every rank, against numpy and its own SQL; a station of 5 rows has 4 ranks, one without spread none."""
    import duckdb

    from stationlake.plans import q_models

    f = FT.features(_dense_daily(spark, start=dt.date(1998, 6, 1)))
    few = f.where("station_id = 'A'").orderBy("obs_date").limit(5).withColumn("station_id", F.lit("C"))
    one = f.where("station_id = 'A'").orderBy("obs_date").limit(1).withColumn("station_id", F.lit("D"))
    f = spark.createDataFrame(f.unionByName(few).unionByName(one).toPandas(), f.schema)
    monkeypatch.setattr(q_models, "_features", lambda spark, sf: f)
    out = q_models.linear_coefficients(spark, "").orderBy("station_id", "rank").collect()
    train = f.where("obs_date < '2000-01-01'").toPandas()
    free = [c for c in FEATURE_COLUMNS if c not in ("temp_range_today", "tmax_delta_1d")]
    for sid in "AB":
        part = train[train.station_id == sid]
        x, y = part[free].to_numpy(float), part[TARGET].to_numpy(float)
        beta = dict(zip(free, np.linalg.lstsq(x - x.mean(axis=0), y - y.mean(), rcond=1e-10)[0]))
        got = [(r["rank"], r.feature) for r in out if r.station_id == sid]
        assert got == list(enumerate(sorted(free, key=lambda c: (-abs(beta[c]), c))[:6], 1))
        assert all(r.coefficient == pytest.approx(beta[r.feature], abs=2e-6) for r in out if r.station_id == sid)
    assert [r["rank"] for r in out if r.station_id == "C"] == [1, 2, 3, 4] and not [r for r in out if r.station_id == "D"]
    con = duckdb.connect()
    con.register("train", train)
    sql = con.execute(f"WITH RECURSIVE {q_models.LINEAR_SQL} SELECT station_id, rank, feature, coefficient FROM ranked "
                      "WHERE rank <= 6 ORDER BY station_id, rank").fetchall()
    assert [r[:3] for r in sql] == [(r.station_id, r["rank"], r.feature) for r in out]
    assert all(r[3] == pytest.approx(o.coefficient, abs=2e-6) for r, o in zip(sql, out))


def test_independent_columns_by_order():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 4))
    cols = np.column_stack([x[:, 0], x[:, 1], x[:, 0] - 3 * x[:, 1], x[:, 2], x[:, 2] * 2, x[:, 0] + 1e-3 * x[:, 3]])
    assert M.independent_columns(np.corrcoef(cols.T)).tolist() == [True, True, False, True, False, True]


def test_every_split_of_a_tree_reduces_the_variance_most(spark):
    """All nodes of one tree without sampling against an exhaustive search over all midpoints."""
    rng = np.random.default_rng(8)
    rows = [(float(a), float(b), float(3 * (a > 4) + (b > 7) * (a < 2) + rng.normal(scale=0.2)))
            for a, b in zip(rng.integers(0, 10, 500), rng.integers(0, 20, 500))]
    df = spark.createDataFrame([("S", *r) for r in rows], f"station_id string, a double, b double, {TARGET} double")
    model, names = M.fit_gbt(df, ["a", "b"], max_iter=1, max_depth=3, subsampling_rate=1.0, feature_subset="all", max_bins=64)
    nodes = {n[0]: n for n in M.tree_nodes(model, names)}
    data = np.array(rows)

    def check(n, part):
        _, feature, threshold, prediction, count = nodes[n]
        y = part[:, 2]
        assert count == len(part) and prediction == pytest.approx(y.mean())
        if feature is None:
            return
        best = max(((y[part[:, k] <= t].sum() ** 2 / (part[:, k] <= t).sum() + y[part[:, k] > t].sum() ** 2 / (part[:, k] > t).sum(), -k, t)
                    for k in (0, 1) for v in [np.unique(part[:, k])] for t in (v[1:] + v[:-1]) / 2))
        assert names[-best[1]] == feature
        k = names.index(feature)
        assert set(part[:, k] <= threshold) == {True, False}
        assert (part[:, k] <= threshold).tolist() == (part[:, k] <= best[2]).tolist()
        check(2 * n, part[part[:, k] <= threshold])
        check(2 * n + 1, part[part[:, k] > threshold])

    check(1, data)
    assert len(nodes) == 15


def _simulated(rng, n, phi, cap_phi, theta, cap_theta, sigma=1.0, s=12):
    """y whose seasonal difference follows the multiplicative model."""
    e = rng.normal(scale=sigma, size=n + 200)
    w = np.zeros(n + 200)
    for t in range(13, n + 200):
        w[t] = (phi * w[t - 1] + cap_phi * w[t - 12] - phi * cap_phi * w[t - 13]
                + e[t] + theta * e[t - 1] + cap_theta * e[t - 12] + theta * cap_theta * e[t - 13])
    w = w[200:]
    y = np.zeros(n)
    y[:s] = 10 * np.sin(np.arange(s))
    for t in range(s, n):
        y[t] = y[t - s] + w[t]
    return y


@pytest.mark.parametrize("true", [(0.6, 0.3, 0.3, -0.5), (-0.4, 0.2, -0.3, -0.7), (0.8, 0.5, -0.2, 0.4)])
def test_seasonal_fit_recovers_known_parameters(true):
    """2,400 months: every parameter within 0.1 of the truth, sigma within 5 %; with every 17th month empty within 0.15.

    (No case has phi near -theta or Phi near -Theta, where the two factors cancel and no estimator tells them apart.)"""
    y = _simulated(np.random.default_rng(11), 2400, *true)
    p, _, _, sigma2 = FC.fit_seasonal(y[12:] - y[:-12])
    assert np.abs(p - np.array(true)).max() < 0.1 and abs(sigma2 ** 0.5 - 1) < 0.05
    y[::17] = np.nan
    p, _, _, _ = FC.fit_seasonal(y[12:] - y[:-12])
    assert np.abs(p - np.array(true)).max() < 0.15


def test_seasonal_innovations_and_slopes():
    """The filters against the recursion, the derivatives against differences."""
    rng, p = np.random.default_rng(3), np.array([0.5, -0.3, 0.4, 0.2])
    w = rng.normal(size=90)
    e, slope = FC.innovations(p, w)
    want = np.zeros(90)
    at = lambda x, t: x[t] if t >= 0 else 0.0
    for t in range(90):
        want[t] = (w[t] - p[0] * at(w, t - 1) - p[1] * at(w, t - 12) + p[0] * p[1] * at(w, t - 13)
                   - p[2] * at(want, t - 1) - p[3] * at(want, t - 12) - p[2] * p[3] * at(want, t - 13))
    assert np.allclose(e, want)
    for k in range(4):
        h = np.zeros(4)
        h[k] = 1e-6
        assert np.allclose(slope[:, k], (FC.innovations(p + h, w)[0] - FC.innovations(p - h, w)[0]) / 2e-6, atol=1e-5)


def test_seasonal_interval_holds_its_share():
    """Simulated futures fall inside the 95 % band as often as it says."""
    inside = []
    for seed in range(40):
        y = _simulated(np.random.default_rng(seed), 624, 0.6, 0.3, 0.3, -0.5)
        mean, se, _ = FC.fit_forecast_series(y[:600], 24)
        inside.extend(np.abs(y[600:] - mean) <= FC.Z95 * se)
    assert 0.88 < np.mean(inside) < 0.99


def test_unstack_finds_its_columns_and_checks_their_number(spark):
    df = spark.createDataFrame([(1, "b.x", 2.0), (1, "a", 1.0), (2, "a", 5.0), (2, "a", 7.0), (3, None, 9.0)], "m int, s string, v double")
    out = E.unstack(df, "m", "s", "v").orderBy("m")
    assert out.columns == ["m", "a", "b.x"]
    assert [tuple(r) for r in out.collect()] == [(1, 1.0, 2.0), (2, 6.0, None), (3, None, None)]
    with pytest.raises(ValueError, match="more than 1"):
        E.unstack(df, "m", "s", "v", max_columns=1)
    assert E.unstack(df.where("m = 3"), "m", "s", "v").collect() == [(3,)]
