"""Rolling-origin evaluation: several train / test cuts in time order in one pass.

Fold k of K tests on ``horizon`` periods; the last fold's window ends with the table, each
earlier one's where the next begins, and a fold trains on all periods before its window. A row
is handed to its folds with its role, and all training statistics are one aggregate by
(fold, entity).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .evaluation import all_metrics
from .history import series_window
from .panel import exact_mean


def rolling_folds(df: DataFrame, folds: int = 4, horizon: int = 10, time: str = C.TIME) -> DataFrame:
    """``df`` with ``fold`` (from 1) and ``role`` ("train" or "test"): a row once a fold that it
    has a role in. Rows without a date have none."""
    # periods are few: one row each
    back = F.row_number().over(Window.orderBy(F.desc("_t"))) - 1
    periods = df.select(F.col(time).alias("_t")).filter("_t is not null").distinct().select("_t", back.alias("_back"))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("fold"), F.lit((folds - k) * horizon).alias("end")) for k in range(1, folds + 1)]))
    roles = periods.select("_t", "_back", each.alias("_f")).select(
        "_t", "_f.fold", F.when(F.col("_back") >= F.col("_f.end") + horizon, "train")
        .when(F.col("_back") >= F.col("_f.end"), "test").alias("role")).filter("role is not null")
    return df.join(roles, F.col(time) == F.col("_t")).drop("_t")


def rolling_origin_forecasts(panel: DataFrame, folds: int = 4, horizon: int = 10, season: int = 52, entity: str = C.ENTITY,
                             time: str = C.TIME, target: str = C.TARGET) -> DataFrame:
    """(fold, entity, time, actual, model, pred): of every test row the last training value, the
    training mean and the value a season before. ``horizon`` may not pass the season, so that this is a
    training value too."""
    if horizon > season:
        raise ValueError("the horizon may not be longer than the season")
    y = F.col(target)
    rows = rolling_folds(panel.select(entity, time, y, F.lag(y, season).over(series_window(entity, time)).alias("seasonal_naive")),
                         folds, horizon, time)
    train = (rows.filter("role = 'train'").groupBy("fold", entity)
             .agg(F.max_by(y, time).alias("naive"), exact_mean(y).alias("train_mean")))
    test = rows.filter("role = 'test'").join(train, ["fold", entity], "left")
    return (test.select("fold", entity, time, y.alias("actual"), "naive", "seasonal_naive", "train_mean")
            .unpivot(["fold", entity, time, "actual"], ["naive", "seasonal_naive", "train_mean"], "model", "pred")
            .filter("pred is not null and actual is not null"))


def rolling_origin_metrics(forecasts: DataFrame, digits: int | None = 6) -> DataFrame:
    """The metrics of every model in every fold."""
    return all_metrics(forecasts, by=("fold", "model"), digits=digits)
