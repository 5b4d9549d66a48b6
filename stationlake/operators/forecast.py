"""Seasonal ARIMA(1,0,1)(1,1,1)_12 forecasts for many monthly series in parallel.

One series per station goes to one ``applyInPandas`` group: a monthly series
holds at most 12 rows per year of history (about 3,000 rows for 255 years), so
a group is small and bounded whatever the total data size; parallelism comes
from the number of stations. The model is multiplicative,
  (1 - phi B)(1 - Phi B^12) w_t = (1 + theta B)(1 + Theta B^12) e_t,   w_t = y_t - y_{t-12},
so its lag-13 terms are the products of the others: four parameters. They minimise the
conditional sum of squares of e (Box and Jenkins) by damped Gauss-Newton steps. The
innovations and their derivatives are filters of w, one for each factor; the first season
and a month, which have no full past, are conditioned on. The search starts from
two-stage least squares (Hannan and Rissanen, 1982, Biometrika 69(1)) and from zero and
keeps the better end. Months that the limited interpolation left empty stay empty: they
have no innovation, and their difference counts as what the model expects there, found
in turns with the fit. A forecast whose month has no value last year starts from the
latest earlier year that has one (``n_filled`` counts such steps). The 95 % interval uses
the psi-weights of the fitted model integrated over the seasonal difference.

Every station returns rows: one whose history is too short has NULL forecasts
and the reason.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEASON = 12
Z95 = 1.959963984540054

FORECAST_SCHEMA = T.StructType([
    T.StructField("station_id", T.StringType()), T.StructField("month_start", T.DateType()),
    T.StructField("step", T.IntegerType()), T.StructField("actual", T.DoubleType()),
    T.StructField("forecast", T.DoubleType()), T.StructField("lower", T.DoubleType()),
    T.StructField("upper", T.DoubleType()), T.StructField("n_filled", T.IntegerType()),
    T.StructField("reason", T.StringType()),
])


#: Parameters stay this far inside the stationary and invertible region.
LIMIT = 0.995


def _lagged(x: np.ndarray, lags: list[int]) -> np.ndarray:
    n = len(x)
    out = np.full((n, len(lags)), np.nan)
    for k, lag in enumerate(lags):
        out[lag:, k] = x[: n - lag]
    return out


def _ols(X: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ok = np.isfinite(y) & np.isfinite(X).all(axis=1)
    if ok.sum() <= X.shape[1]:
        return np.zeros(X.shape[1]), ok
    beta, *_ = np.linalg.lstsq(X[ok], y[ok], rcond=None)
    return beta, ok


def _two_stage(w: np.ndarray, s: int) -> np.ndarray:
    """phi, Phi, theta, Theta to start from: a long autoregression gives innovations, then one regression."""
    long_p = max(1, min(s + 1, len(w) // 3))
    x = _lagged(w, list(range(1, long_p + 1)))
    b_long, _ = _ols(x, w)
    e = w - x @ b_long
    beta, _ = _ols(np.hstack([_lagged(w, [1, s]), _lagged(e, [1, s])]), w)
    return np.clip(beta, -0.9, 0.9)


def _back(x: np.ndarray, k: int) -> np.ndarray:
    """x shifted k steps, with zeros before its start."""
    out = np.zeros_like(x)
    out[k:] = x[:len(x) - k]
    return out


def _undo(x: np.ndarray, c: float, k: int) -> np.ndarray:
    """z with z_t + c z_{t-k} = x_t and zeros before the start: the inverse of a moving-average factor."""
    rows = np.zeros(-(-len(x) // k) * k)
    rows[:len(x)] = x
    rows = rows.reshape(-1, k)
    if k == 1:
        out, last = rows[:, 0].tolist(), 0.0
        for t, v in enumerate(out):
            last = v - c * last
            out[t] = last
        return np.array(out)
    for t in range(1, len(rows)):
        rows[t] -= c * rows[t - 1]
    return rows.reshape(-1)[:len(x)]


def innovations(p: np.ndarray, w: np.ndarray, s: int = SEASON) -> tuple[np.ndarray, np.ndarray]:
    """e of the model with parameters (phi, Phi, theta, Theta), and its derivatives, one column a parameter."""
    phi, cap_phi, theta, cap_theta = p
    inverse = lambda x: _undo(_undo(x, cap_theta, s), theta, 1)
    seasonal, plain = w - cap_phi * _back(w, s), w - phi * _back(w, 1)
    e = inverse(seasonal - phi * _back(seasonal, 1))
    slopes = [-inverse(_back(seasonal, 1)), -inverse(_back(plain, s)), -_undo(_back(e, 1), theta, 1), -_undo(_back(e, s), cap_theta, s)]
    return e, np.column_stack(slopes)


def _descend(p: np.ndarray, w: np.ndarray, used: np.ndarray, s: int, steps: int = 60) -> tuple[np.ndarray, float]:
    """Gauss-Newton with a growing or shrinking damping, from ``p``: parameters and sum of squares."""
    damping = 1e-3
    e, slope = innovations(p, w, s)
    cost = float(e[used] @ e[used])
    for _ in range(steps):
        x = slope[used]
        normal = x.T @ x
        move = np.linalg.lstsq(normal + damping * np.diag(np.maximum(np.diag(normal), 1e-12)), -x.T @ e[used], rcond=None)[0]
        q = np.clip(p + move, -LIMIT, LIMIT)
        e2, slope2 = innovations(q, w, s)
        cost2 = float(e2[used] @ e2[used])
        if cost2 < cost:
            done = cost - cost2 <= 1e-10 * cost and np.abs(q - p).max() < 1e-6
            p, e, slope, cost, damping = q, e2, slope2, cost2, max(damping / 5, 1e-9)
            if done:
                break
        else:
            damping *= 10
            if damping > 1e8:
                break
    return p, cost


def fit_seasonal(w: np.ndarray, s: int = SEASON, rounds: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(phi, Phi, theta, Theta), the differences with empty months filled, the innovations, and their variance."""
    there = np.isfinite(w)
    used = there & (np.arange(len(w)) > s)
    filled = np.where(there, w, 0.0)
    if used.sum() < 8:  # too little to tell four parameters
        return np.zeros(4), filled, filled, float(np.mean(w[there] ** 2)) if there.any() else 0.0
    p = None
    for _ in range(rounds if not there.all() else 1):
        starts = [_two_stage(w, s), np.zeros(4)] if p is None else [p]
        p, cost = min((_descend(q, filled, used, s) for q in starts), key=lambda r: r[1])
        e, _ = innovations(p, filled, s)
        filled = np.where(there, w, filled - e)  # an empty month is as expected: no innovation
    e, _ = innovations(p, filled, s)
    return p, filled, np.where(there, e, 0.0), cost / int(used.sum())


def fit_forecast_series(y: np.ndarray, horizon: int, s: int = SEASON) -> tuple[np.ndarray, np.ndarray, int]:
    """Forecast ``horizon`` steps after ``y`` (NaN: no value); returns (mean, standard error, steps that
    start from an earlier year than the last). A month that no year has is NaN."""
    y = y.astype(float)
    p, w, e, sigma2 = fit_seasonal(y[s:] - y[:-s], s)
    ar_lags = ma_lags = [1, s, s + 1]
    a, b = [p[0], p[1], -p[0] * p[1]], [p[2], p[3], p[2] * p[3]]
    # Recursive forecast with future innovations at zero.
    w_ext, e_ext = list(w), list(e)
    y_ext = list(y)
    n_filled = 0
    for _ in range(horizon):
        t = len(w_ext)
        w_hat = sum(a[k] * (w_ext[t - lag] if t - lag >= 0 else 0.0) for k, lag in enumerate(ar_lags))
        w_hat += sum(b[k] * (e_ext[t - lag] if t - lag >= 0 else 0.0) for k, lag in enumerate(ma_lags))
        w_ext.append(w_hat)
        e_ext.append(0.0)
        past = y_ext[len(y_ext) - s::-s]
        base = next((v for v in past if np.isfinite(v)), np.nan)
        n_filled += int(np.isfinite(base) and not np.isfinite(past[0]))
        y_ext.append(w_hat + base)
    mean = np.array(y_ext[len(y):])
    # psi-weights of w (ARMA), then of y (integrate the seasonal difference).
    psi_w = np.zeros(horizon)
    psi_w[0] = 1.0
    for j in range(1, horizon):
        v = sum(a[k] * psi_w[j - lag] for k, lag in enumerate(ar_lags) if j - lag >= 0)
        v += sum(b[k] for k, lag in enumerate(ma_lags) if j == lag)
        psi_w[j] = v
    psi_y = np.array([psi_w[j::-s].sum() for j in range(horizon)])
    se = np.sqrt(sigma2 * np.cumsum(psi_y ** 2))
    return mean, se, n_filled


def _forecast_group(horizon: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("month_start")
        y = pdf["value"].to_numpy(dtype=float)
        n = min(horizon, len(y))
        train, test = y[:len(y) - n], y[len(y) - n:]
        if len(train) > SEASON:
            mean, se, n_filled = fit_forecast_series(train, n)
            reason = [None if np.isfinite(m) else "month without history" for m in mean]
        else:
            mean = se = np.full(n, np.nan)
            n_filled, reason = 0, ["history of a season or less"] * n
        out = pd.DataFrame({
            "station_id": pdf["station_id"].iloc[0], "month_start": pdf["month_start"].iloc[len(y) - n:].to_numpy(),
            "step": np.arange(1, n + 1, dtype="int32"), "actual": test,
            "forecast": mean, "lower": mean - Z95 * se, "upper": mean + Z95 * se,
            "n_filled": np.int32(n_filled), "reason": reason,
        })
        numbers = ["actual", "forecast", "lower", "upper"]
        out[numbers] = out[numbers].astype(object).where(out[numbers].notna(), None)
        return out
    return run


def seasonal_forecast(series: DataFrame, horizon: int = 24) -> DataFrame:
    """Per station: hold out the last ``horizon`` months, fit on the rest, forecast with 95 % bounds.

    A station without more than a season before the holdout returns its months
    with NULL forecasts and a ``reason``.
    """
    return (series.select("station_id", "month_start", "value")
            .groupBy("station_id").applyInPandas(_forecast_group(horizon), FORECAST_SCHEMA))


def forecast_gate(forecasts: DataFrame, naive: DataFrame) -> DataFrame:
    """Per station: holdout MAE of the seasonal forecast vs the seasonal-naive MAE, and the verdict.

    ``naive`` carries (station_id, naive_mae) as produced by the seasonal-naive
    baseline; months without an actual value or a forecast are not scored, and
    ``n_unforecast`` counts the months without a forecast.
    """
    error = F.abs(F.col("actual") - F.col("forecast"))
    mae = forecasts.groupBy("station_id").agg(
        F.avg(error).alias("mae"), F.count(error).alias("n_scored"),
        F.count_if(F.col("forecast").isNull()).alias("n_unforecast"))
    j = mae.join(naive.select("station_id", "naive_mae"), "station_id", "left")
    return j.select("station_id", F.lit("seasonal_arima").alias("model"), "mae", "n_scored", "n_unforecast",
                    F.lit("seasonal_naive").alias("baseline"), F.col("naive_mae").alias("baseline_mae"),
                    (F.col("mae") < F.col("naive_mae")).alias("beats_baseline"))
