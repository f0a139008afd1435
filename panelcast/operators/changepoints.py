"""Trend with changepoints, yearly seasonality, holidays and regressors, for each entity.

log(y) is linear in an intercept, the time, hinges that start at KNOTS evenly spaced points of
the first RANGE of the training time, Fourier terms, holiday indicators (one day around) and
the standardised regressors. Slope changes at the hinges have an absolute penalty (scale
CHANGE), so most are zero; the other coefficients a squared one.

Every row becomes an array; the sums of its products (the Gram matrix) are added up by Spark
per entity, with partial sums, so a long series is not one task. Only one matrix an entity
reaches Python, where coordinate descent solves a batch of entities at once, in turn with the
residual variance. Predictions are sums over arrays again.

Training rows need a positive target; a missing regressor has no effect. Entities without such
rows are predicted by their training mean, without training rows by ``fallback``. Rows without
a date are left out.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.calendar import DEFAULT_CALENDAR, HolidayCalendar, near_holiday
from ..session import ship_package
from .panel import exact_mean

KNOTS, RANGE, CHANGE = 25, 0.8, 0.05
#: Scales of the squared penalties: slope, all other terms.
SLOPE, SCALE = 5.0, 10.0
ORDER = 10
ROUNDS, SWEEPS = 5, 300


def knots(n: int = KNOTS) -> list[float]:
    return [RANGE * j / n for j in range(1, n + 1)]


def trend_rows(panel: DataFrame, val_start: str, entity: str = C.ENTITY, time: str = C.TIME,
               target: str = C.TARGET) -> DataFrame:
    """The dated rows with ``is_train`` (training rows with a positive target), ``ly``, the
    entity's statistics of them and ``t``: 0 at the first, 1 at the last of them."""
    y = F.col(target).cast("double")
    before = F.col(time) < F.lit(val_start).cast("date")
    rows = (panel.filter(F.col(time).isNotNull()).withColumn("before", before)
            .withColumn("is_train", F.coalesce(before & (y > 0), F.lit(False))))
    fit = F.col("is_train")
    regs = [F.when(fit, F.col(r).cast("double")) for r in C.REGRESSORS]
    stats = rows.groupBy(entity).agg(
        F.min(F.when(fit, F.col(time))).alias("d0"), F.max(F.when(fit, F.col(time))).alias("d1"),
        exact_mean(F.when(F.col("before"), F.col(target))).alias("train_mean"),
        *[f(r).alias(f"{n}{i}") for i, r in enumerate(regs) for n, f in (("mu", F.avg), ("sd", F.stddev_pop))])
    span = F.greatest(F.datediff("d1", "d0"), F.lit(1))
    return (rows.join(stats, entity).withColumn("t", F.datediff(time, "d0") / span)
            .withColumn("ly", F.when(fit, F.ln(y))))


def trend_terms(n: int = KNOTS) -> list[Column]:
    return [F.lit(1.0), F.col("t"), *[F.greatest(F.col("t") - F.lit(k), F.lit(0.0)) for k in knots(n)]]


def other_terms(calendar: HolidayCalendar, time: str = C.TIME, order: int = ORDER) -> list[Column]:
    angle = F.dayofyear(time) * F.lit(2 * math.pi / 365.25)
    waves = [f(angle * F.lit(float(k))) for k in range(1, order + 1) for f in (F.sin, F.cos)]
    days = [near_holiday(F.col(time), calendar, name, half_width=1).cast("double") for name in calendar.names]
    regs = [F.coalesce(F.try_divide(F.col(r).cast("double") - F.col(f"mu{i}"), F.col(f"sd{i}")), F.lit(0.0))
            for i, r in enumerate(C.REGRESSORS)]
    return [*waves, *days, *regs]


def gram(rows: DataFrame, terms: list[Column], entity: str = C.ENTITY) -> DataFrame:
    """(entity, n, gram): rows summed and the upper triangle, row by row, of the sums of
    products of the terms and, last, ``ly``."""
    z = F.array(*terms, F.col("ly"))
    products = F.transform(F.array(z), lambda a: F.flatten(F.transform(a, lambda v, i: F.transform(
        F.slice(a, i + 1, F.size(a) - i), lambda w: v * w))))[0]
    summed = (rows.filter("is_train").select(entity, array_to_vector(products).alias("z"))
              .groupBy(entity).agg(F.count("*").alias("n"), Summarizer.sum(F.col("z")).alias("z")))
    return summed.select(entity, "n", vector_to_array("z").alias("gram"))


def solve(packed: np.ndarray, n: np.ndarray, changes: int = KNOTS) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, residual variances) of a batch of Gram triangles."""
    size = int((math.isqrt(8 * packed.shape[1] + 1) - 1) // 2)
    p = size - 1
    full = np.zeros((len(packed), size, size))
    at = np.triu_indices(size)
    full[:, at[0], at[1]] = packed
    full[:, at[1], at[0]] = packed
    a, c, yy = full[:, :p, :p], full[:, :p, p], full[:, p, p]
    weight = np.full(p, 1 / SCALE ** 2)
    weight[:2] = 0, 1 / SLOPE ** 2
    sparse = np.zeros(p, bool)
    sparse[2:2 + changes] = True
    weight[sparse] = 0
    variance = np.maximum(yy / n - (c[:, 0] / n) ** 2, 1e-8)
    start = np.where(sparse, 1 / CHANGE ** 2, weight) * variance[:, None]
    b = np.linalg.solve(a + (start + 1e-9)[:, :, None] * np.eye(p), c[:, :, None])[:, :, 0]
    for _ in range(ROUNDS):
        for _ in range(SWEEPS):
            old = b.copy()
            for j in range(p):
                own = a[:, j, j]
                r = c[:, j] - (a[:, j] * b).sum(1) + own * b[:, j]
                if sparse[j]:
                    r = np.sign(r) * np.maximum(np.abs(r) - variance / CHANGE, 0)
                whole = own + weight[j] * variance
                b[:, j] = np.where(whole > 0, r / np.where(whole > 0, whole, 1), 0)
            if np.abs(b - old).max() < 1e-7:
                break
        left = yy - 2 * (b * c).sum(1) + np.einsum("bi,bij,bj->b", b, a, b)
        variance = np.maximum(left / n, 1e-8)
    return b, variance


def coefficients(grams: DataFrame, entity: str = C.ENTITY, changes: int = KNOTS) -> DataFrame:
    """(entity, beta, variance)."""
    ship_package(grams.sparkSession)

    @F.pandas_udf("beta array<double>, variance double")
    def fit(packed: pd.Series, n: pd.Series) -> pd.DataFrame:
        b, variance = solve(np.stack(packed.to_numpy()), n.to_numpy(float), changes)
        return pd.DataFrame({"beta": list(b), "variance": variance})
    return grams.select(entity, fit("gram", "n").alias("fit")).select(entity, "fit.beta", "fit.variance")


def trend_changepoint_forecast(panel: DataFrame, val_start: str = C.VALIDATION_START, fallback: float = 1_000_000.0,
                               calendar: HolidayCalendar = DEFAULT_CALENDAR, entity: str = C.ENTITY,
                               time: str = C.TIME, target: str = C.TARGET) -> DataFrame:
    """Predictions of the validation rows. Output: entity, time, actual, pred."""
    rows = trend_rows(panel, val_start, entity, time, target)
    terms = [*trend_terms(), *other_terms(calendar, time)]
    fits = coefficients(gram(rows, terms, entity), entity)
    ahead = rows.filter(~F.col("before")).select(entity, time, F.col(target).alias("actual"), "train_mean", F.array(*terms).alias("x"))
    value = F.exp(F.aggregate(F.zip_with("x", "beta", lambda v, w: v * w), F.lit(0.0), lambda s, v: s + v))
    return ahead.join(fits, entity, "left").select(
        entity, time, "actual", F.coalesce(F.when(F.col("beta").isNotNull(), value), F.col("train_mean"), F.lit(fallback)).alias("pred"))
