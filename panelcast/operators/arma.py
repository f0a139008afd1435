"""Seasonal ARMA(1, 1) forecasts: seasonal differences with one autoregressive and one
moving-average term, fitted by conditional least squares without Python.

z_t = y_t - y_(t - season) follows z_t = phi z_(t-1) + theta e_(t-1) + e_t. A series' ordered
differences are one array (a series has a bounded number of periods); the innovations e_t and
their derivatives come from one fold over it, which also adds up the sums of a damped
Gauss-Newton step. A step that lowers the squared errors is taken and the damping eased, any
other is tried again shorter; steps stay inside the stationary, invertible square.

A missing difference has no innovation and stands for its forecast. Series without two
differences that follow each other have phi = theta = 0.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .history import series_window
from .panel import exact_mean, with_split

STEPS, LIMIT = 40, 0.98


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _fold(z: Column, phi: Column, theta: Column) -> Column:
    """Last difference and innovation, and the sums of a step, at (phi, theta)."""
    zero = F.lit(0.0)
    start = F.struct(F.lit(None).cast("double").alias("z"), *[zero.alias(c) for c in ("e", "a", "b", "ee", "aa", "ab", "bb", "ae", "be")])

    def step(s, x):
        forecast = phi * s["z"] + theta * s["e"]
        # derivatives of the innovation by phi and theta
        known = x.isNotNull() & s["z"].isNotNull()
        now = F.struct(F.coalesce(x, forecast).alias("z"), F.when(known, x - forecast).otherwise(zero).alias("e"),
                       F.when(known, -s["z"] - theta * s["a"]).otherwise(zero).alias("a"),
                       F.when(known, -s["e"] - theta * s["b"]).otherwise(zero).alias("b"))
        return _bind(now, lambda n: F.struct(
            n["z"].alias("z"), n["e"].alias("e"), n["a"].alias("a"), n["b"].alias("b"),
            (s["ee"] + n["e"] * n["e"]).alias("ee"), (s["aa"] + n["a"] * n["a"]).alias("aa"),
            (s["ab"] + n["a"] * n["b"]).alias("ab"), (s["bb"] + n["b"] * n["b"]).alias("bb"),
            (s["ae"] + n["a"] * n["e"]).alias("ae"), (s["be"] + n["b"] * n["e"]).alias("be")))
    return F.aggregate(z, start, step)


def _inside(x: Column) -> Column:
    return F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), x))


def _next(s: Column, z: Column) -> Column:
    """One step: s holds the best point with its sums, the point to try and the damping."""
    sums = ("z", "e", "ee", "aa", "ab", "bb", "ae", "be")

    def judged(f):
        better = s["ee"].isNull() | (f["ee"] < s["ee"])
        kept = F.struct(F.when(better, s["try_phi"]).otherwise(s["phi"]).alias("phi"),
                        F.when(better, s["try_theta"]).otherwise(s["theta"]).alias("theta"),
                        F.when(better, s["damp"] / 4).otherwise(s["damp"] * 4).alias("damp"),
                        *[F.when(better, f[c]).otherwise(s[c]).alias(c) for c in sums])

        def stepped(k):
            aa, bb = k["aa"] * (1 + k["damp"]), k["bb"] * (1 + k["damp"])
            det = aa * bb - k["ab"] * k["ab"]
            flat = det <= 1e-12 * aa * bb
            by_phi = F.when(flat, F.try_divide(k["ae"], aa)).otherwise((bb * k["ae"] - k["ab"] * k["be"]) / det)
            by_theta = F.when(flat, F.lit(0.0)).otherwise((aa * k["be"] - k["ab"] * k["ae"]) / det)
            return F.struct(k["phi"].alias("phi"), k["theta"].alias("theta"),
                            _inside(k["phi"] - F.coalesce(by_phi, F.lit(0.0))).alias("try_phi"),
                            _inside(k["theta"] - F.coalesce(by_theta, F.lit(0.0))).alias("try_theta"),
                            k["damp"].alias("damp"), *[k[c].alias(c) for c in sums])
        return _bind(kept, stepped)
    return _bind(_fold(z, s["try_phi"], s["try_theta"]), judged)


def fitted(z: Column, steps: int = STEPS) -> Column:
    """struct<phi, theta, z, e, ee, ...> of an array of ordered differences: the parameters,
    the last difference and innovation, the sum of squared innovations."""
    none = F.lit(None).cast("double")
    start = F.struct(F.lit(0.0).alias("phi"), F.lit(0.0).alias("theta"), F.lit(0.0).alias("try_phi"), F.lit(0.0).alias("try_theta"),
                     F.lit(1e-2).alias("damp"), *[none.alias(c) for c in ("z", "e", "ee", "aa", "ab", "bb", "ae", "be")])
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, lambda s, _: _next(s, z))


def differences(panel: DataFrame, val_start: str, season: int, entity: str, time: str, target: str) -> DataFrame:
    w = series_window(entity, time)
    y = F.col(target).cast("double")
    return (with_split(panel, val_start, time).withColumn("y_season", F.lag(y, season).over(w))
            .withColumn("z", y - F.col("y_season")))


def arma_parameters(panel: DataFrame, val_start: str = C.VALIDATION_START, season: int = 52, entity: str = C.ENTITY,
                    time: str = C.TIME, target: str = C.TARGET) -> DataFrame:
    """(entity, phi, theta, z_last, e_last, sse, train_mean) of each entity's training rows."""
    train = differences(panel, val_start, season, entity, time, target).filter(F.col("split") == "train")
    series = train.groupBy(entity).agg(
        F.sort_array(F.collect_list(F.struct(F.col(time).alias("t"), F.col("z").alias("z")))).alias("series"),
        exact_mean(F.col(target)).alias("train_mean"))
    # differences start behind the first season; gaps later on stay
    z = F.transform("series", lambda s: s["z"])
    first = F.array_position(F.transform(z, lambda v: v.isNotNull()), True)
    z = F.when(first > 0, F.slice(z, first.cast("int"), F.size(z))).otherwise(F.array().cast("array<double>"))
    fit = series.select(entity, "train_mean", z.alias("z")).withColumn("fit", fitted(F.col("z")))
    return fit.select(entity, F.col("fit.phi").alias("phi"), F.col("fit.theta").alias("theta"), F.col("fit.z").alias("z_last"),
                      F.col("fit.e").alias("e_last"), F.col("fit.ee").alias("sse"), "train_mean")


def seasonal_arma_forecast(panel: DataFrame, val_start: str = C.VALIDATION_START, season: int = 52, entity: str = C.ENTITY,
                           time: str = C.TIME, target: str = C.TARGET) -> DataFrame:
    """h-step forecasts of every validation row: y(T+h-season) + phi^(h-1) (phi z_T + theta e_T),
    T the last training row. Without differences the seasonal value, without that the
    entity's training mean. Output: entity, time, actual, pred."""
    params = arma_parameters(panel, val_start, season, entity, time, target)
    rows = differences(panel, val_start, season, entity, time, target).filter(F.col("split") == "validation")
    h = F.row_number().over(Window.partitionBy(entity).orderBy(time))
    rows = rows.withColumn("h", h).join(params, entity, "left")
    step = F.pow(F.col("phi"), F.col("h") - 1) * (F.col("phi") * F.col("z_last") + F.col("theta") * F.col("e_last"))
    pred = F.coalesce(F.col("y_season") + F.coalesce(step, F.lit(0.0)), F.col("train_mean"))
    return rows.select(entity, time, F.col(target).alias("actual"), pred.alias("pred"))
