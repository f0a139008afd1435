"""Per-series forecasters and the ensemble, as DataFrame plans.

* Baselines (naive, seasonal naive, 4-week moving average) are window columns.
* ``seasonal_ar_forecast``: seasonal differencing at lag 52 plus an AR(1) on the
  differenced series, fitted per entity with a grouped aggregate (closed-form
  least squares) and applied with windows + a join of the per-entity parameters.
* ``trend_seasonal_forecast``: per-entity regression of log(y) on trend, yearly
  Fourier terms, holiday indicators and regressors, one ``applyInPandas`` group
  per entity (the only Python step; each group is one series).
* Ensemble weights: least absolute error on the simplex, one small aggregate per step.
"""
from __future__ import annotations

import itertools
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.calendar import DEFAULT_CALENDAR, HolidayCalendar, near_holiday
from ..session import materialize, ship_package
from .history import series_window
from .panel import exact_mean, with_split

BASELINES = {"naive": "sales_lag_1", "seasonal_naive": "sales_lag_52",
             "moving_average_4w": "rolling_mean_4w"}


# ------------------------------------------------------------- seasonal AR
def seasonal_ar_forecast(panel: DataFrame, val_start: str = C.VALIDATION_START,
                         season: int = 52, entity: str = C.ENTITY, time: str = C.TIME,
                         target: str = C.TARGET) -> DataFrame:
    """h-step forecasts for every validation row of each entity.

    z_t = y_t - y_{t-season}; phi = sum z_t z_{t-1} / sum z_{t-1}^2 over training
    rows; yhat(T+h) = y(T+h-season) + phi^h * z_T, with T the last training row.
    Without AR information the AR term is 0 (seasonal naive); rows without a
    seasonal lag fall back to the entity's training mean.
    Output: entity, time, actual, pred.
    """
    w = series_window(entity, time)
    y = F.col(target)
    df = with_split(panel, val_start, time).withColumn("y_season", F.lag(y, season).over(w))
    df = df.withColumn("z", y - F.col("y_season"))
    df = df.withColumn("z_prev", F.lag("z", 1).over(w))
    train = df.filter(F.col("split") == "train")
    params = train.groupBy(entity).agg(
        F.try_divide(F.sum(F.col("z") * F.col("z_prev")),
                     F.sum(F.col("z_prev") * F.col("z_prev"))).alias("phi"),
        F.max_by("z", time).alias("z_last"),
        exact_mean(y).alias("train_mean"))
    val = df.filter(F.col("split") == "validation")
    h = F.row_number().over(Window.partitionBy(entity).orderBy(time))
    val = val.withColumn("h", h).join(params, entity, "left")
    # no AR information (e.g. a purely seasonal history: phi = 0/0) -> AR term 0
    ar_term = F.coalesce(F.pow(F.col("phi"), F.col("h")) * F.col("z_last"), F.lit(0.0))
    pred = F.coalesce(F.col("y_season") + ar_term, F.col("train_mean"))
    return val.select(entity, time, y.alias("actual"), pred.alias("pred"))


# ------------------------------------------------- trend + seasonal regression
def _design(t: np.ndarray, doy: np.ndarray, hol: np.ndarray, reg: np.ndarray,
            order: int) -> np.ndarray:
    cols = [np.ones_like(t), t]
    for k in range(1, order + 1):
        ang = 2 * np.pi * k * doy / 365.25
        cols += [np.sin(ang), np.cos(ang)]
    return np.column_stack(cols + [hol, reg])


def _fit_predict_group(pdf: pd.DataFrame, order: int, ridge: float, fallback: float) -> pd.DataFrame:
    pdf = pdf.sort_values("ds")
    tr = pdf[pdf["is_train"]]
    te = pdf[~pdf["is_train"]]
    out = te[["entity", "ds", "y"]].copy()
    if te.empty:
        return out.assign(pred=np.array([], dtype=float))
    t0 = pdf["ds"].min()
    span = max((pdf["ds"].max() - t0).days, 1)

    def feats(frame):
        t = ((frame["ds"] - t0).dt.days / span).to_numpy(float)
        doy = frame["ds"].dt.dayofyear.to_numpy(float)
        hol = frame[[c for c in frame.columns if c.startswith("hol_")]].to_numpy(float)
        reg = frame[["r0", "r1", "r2", "r3"]].to_numpy(float)
        return t, doy, hol, reg

    # a multiplicative model learns from the positive rows; the ridge carries short series
    mean = tr["y"].mean()
    tr = tr[tr["y"] > 0]
    if len(tr):
        t, doy, hol, reg = feats(tr)
        known = ~np.isnan(reg)
        count = np.maximum(known.sum(0), 1)
        mu = np.where(known, reg, 0).sum(0) / count
        sd = np.sqrt((np.where(known, reg - mu, 0) ** 2).sum(0) / count)
        sd[sd == 0] = 1.0
        reg = np.where(known, reg, mu)  # an unknown regressor has no effect
        X = _design(t, doy, hol, (reg - mu) / sd, order)
        ly = np.log(tr["y"].to_numpy(float))
        pen = ridge * np.eye(X.shape[1])
        pen[0, 0] = 0.0
        beta = np.linalg.solve(X.T @ X + pen, X.T @ ly)
        t2, doy2, hol2, reg2 = feats(te)
        X2 = _design(t2, doy2, hol2, (np.where(np.isnan(reg2), mu, reg2) - mu) / sd, order)
        out["pred"] = np.exp(X2 @ beta)
    else:
        out["pred"] = float(mean) if mean == mean else fallback
    return out


def trend_seasonal_forecast(panel: DataFrame, val_start: str = C.VALIDATION_START,
                            fourier_order: int = 10, ridge: float = 1.0,
                            fallback: float = 1_000_000.0,
                            calendar: HolidayCalendar = DEFAULT_CALENDAR,
                            entity: str = C.ENTITY, time: str = C.TIME,
                            target: str = C.TARGET) -> DataFrame:
    """Multiplicative trend + yearly seasonality + holidays (+-1 day) + the four
    regressors, fitted per entity on training rows with a positive target; predictions for
    validation rows. A missing regressor has no effect. Without a positive row the
    prediction is the training mean, without training rows ``fallback``. Rows without a
    date are left out. Output: entity, time, actual, pred."""
    ship_package(panel.sparkSession)
    d = F.col(time)
    hol_cols = {f"hol_{i}": near_holiday(d, calendar, n, half_width=1)
                for i, n in enumerate(calendar.names)}
    regs = [F.col(r).cast("double").alias(f"r{i}") for i, r in enumerate(C.REGRESSORS)]
    base = panel.select(F.col(entity).alias("entity"), d.alias("ds"),
                        F.col(target).cast("double").alias("y"),
                        (d < F.lit(val_start).cast("date")).alias("is_train"),
                        *regs, *[c.alias(k) for k, c in hol_cols.items()])
    schema = f"entity {panel.schema[entity].dataType.simpleString()}, ds date, y double, pred double"

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.copy()
        pdf["ds"] = pd.to_datetime(pdf["ds"])
        out = _fit_predict_group(pdf, fourier_order, ridge, fallback)
        out["ds"] = out["ds"].dt.date
        return out[["entity", "ds", "y", "pred"]]

    res = base.filter(F.col("ds").isNotNull()).groupBy("entity").applyInPandas(fn, schema)
    return res.select(F.col("entity").alias(entity), F.col("ds").alias(time),
                      F.col("y").alias("actual"), "pred")


# ----------------------------------------------------------------- ensemble
def ensemble_gate(metrics: DataFrame, max_wmape: float = C.ENSEMBLE_MAX_WMAPE,
                  min_models: int = C.ENSEMBLE_MIN_MODELS) -> DataFrame:
    """Models eligible for blending: WMAPE < max_wmape; ``blend`` is false for all
    when fewer than ``min_models`` qualify."""
    ok = F.col("WMAPE") < max_wmape
    n_ok = metrics.select(F.count(F.when(ok, 1))).scalar()
    return metrics.select("model", "WMAPE", ok.alias("eligible"),
                          (ok & (n_ok >= min_models)).alias("blend"))


def _blend(cols: list[str], weights):
    """Weighted sum of columns, in order."""
    return reduce(lambda x, y: x + y, [F.lit(float(w)) * F.col(c) for c, w in zip(cols, weights)])


def _on_simplex(v: np.ndarray) -> np.ndarray:
    """Nearest point with non-negative entries that sum to one."""
    u = np.sort(v)[::-1]
    level = (np.cumsum(u) - 1) / np.arange(1, len(v) + 1)
    return np.maximum(v - level[np.flatnonzero(u > level)[-1]], 0)


def _least_squares_on_simplex(g: np.ndarray, c: np.ndarray, w: np.ndarray) -> np.ndarray:
    """argmin w'Gw/2 - c'w over the simplex, by accelerated projected gradient (k x k)."""
    step = 1.0 / max(np.linalg.eigvalsh(g)[-1], 1e-300)
    x, y, t = w, w, 1.0
    for _ in range(20_000):
        new = _on_simplex(y - step * (g @ y - c))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if np.abs(new - x).max() < 1e-12:
            return new
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def _absolute_error_weights(wide: DataFrame, cols: list[str], rounds: int = 14) -> np.ndarray:
    """Weights on the simplex with the least sum of absolute errors, by iteratively
    reweighted least squares: a round is one aggregate of k(k+3)/2 + 1 sums, for any number
    of rows and models. Errors below a floor that shrinks every round weigh alike."""
    k = len(cols)
    w, best, best_error = np.full(k, 1 / k), np.full(k, 1 / k), np.inf
    a = F.col("actual")
    floor = (wide.agg(F.avg(F.abs(a))).first()[0] or 1.0) / 10
    for _ in range(rounds):
        r = F.abs(a - _blend(cols, w))
        q = 1.0 / F.greatest(r, F.lit(floor))
        sums = [F.sum(r)] + [F.sum(q * F.col(c) * a) for c in cols]
        sums += [F.sum(q * F.col(cols[i]) * F.col(cols[j])) for i in range(k) for j in range(i, k)]
        got = wide.agg(*sums).first()
        if got[0] is None:
            return best
        if got[0] < best_error:
            best, best_error = w, got[0]
        g = np.zeros((k, k))
        g[np.triu_indices(k)] = got[1 + k:]
        g = g + np.triu(g, 1).T
        new = _least_squares_on_simplex(g, np.array(got[1:1 + k]), w)
        if np.abs(new - w).max() < 1e-6 and floor < 1e-6:
            break
        w, floor = new, floor / 4
    return best


def _on_lattice(w: np.ndarray, steps: int) -> tuple[int, ...]:
    """Multiples of 1/steps that sum to one, by largest remainders."""
    low = np.floor(w * steps + 1e-9).astype(int)
    for i in np.argsort(-(w * steps - low), kind="stable")[:steps - low.sum()]:
        low[i] += 1
    return tuple(int(x) for x in low)


def ensemble_weights(wide: DataFrame, models: list[str], steps: int = 100) -> DataFrame:
    """Simplex weights, in multiples of 1/steps, minimising WMAPE of the blend (the sum of
    actuals is constant, so the sum of absolute errors is minimised). The exact optimum on
    the whole simplex comes first; its lattice point is then improved by moving weight
    between pairs of models while that lowers the error (ties: smaller weights first).
    There is no candidate grid, so any number of models has the same resolution.
    ``wide`` has ``actual`` and one ``<model>_Pred`` column per model; rows with a null
    among them do not count."""
    spark = wide.sparkSession
    if not models:
        return spark.createDataFrame([], "model string, weight double")
    if len(models) == 1:
        return spark.createDataFrame([(models[0], 1.0)], "model string, weight double")
    cols = [f"{m}_Pred" for m in models]
    wide = materialize(wide.select("actual", *cols).dropna())  # read once a round
    best = _on_lattice(_absolute_error_weights(wide, cols), steps)
    total = wide.agg(F.sum(F.abs(F.col("actual")))).first()[0] or 0.0
    # a single model that is as good as the blend is preferred
    alone = {tuple(steps * (i == j) for j in range(len(cols))) for i in range(len(cols))}
    size, done = 4, None  # furthest move
    seen: dict[tuple[int, ...], float] = {}
    while best != done:
        done, near = best, {best} | alone
        for i, j in itertools.permutations(range(len(cols)), 2):
            for n in range(1, size + 1):
                if best[j] >= n:
                    move = list(best)
                    move[i] += n
                    move[j] -= n
                    near.add(tuple(move))
        new = sorted(near - seen.keys())
        for at in range(0, len(new), 64):  # sums of a bounded number of points a job
            part = new[at:at + 64]
            errors = wide.agg(*[F.sum(F.abs(F.col("actual") - _blend(cols, [x / steps for x in g])))
                                for g in part]).first()
            seen.update(zip(part, errors))
        if seen[best] is None:  # no rows
            break
        # errors that differ by rounding only are equal; then smaller weights come first
        best = min(near, key=lambda g: (float(f"{max(seen[g], 1e-12 * total):.12g}"), g))
    return spark.createDataFrame([(m, w / steps) for m, w in zip(models, best)],
                                 "model string, weight double")


def ensemble_predict(wide: DataFrame, models: list[str], weights: dict[str, float] | None = None,
                     entity: str = C.ENTITY, time: str = C.TIME) -> DataFrame:
    """Weighted sum of the model columns in a fixed order; equal weights when
    unset, weight 0 for models without a weight."""
    if weights is None:
        weights = {m: 1.0 / len(models) for m in models}
    blend = None
    for m in models:
        term = F.lit(float(weights.get(m, 0.0))) * F.col(f"{m}_Pred")
        blend = term if blend is None else blend + term
    return wide.select(entity, time, "actual", blend.alias("pred"))
