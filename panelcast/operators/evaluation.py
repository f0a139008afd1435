"""Forecast evaluation over the long predictions table.

Long form: (Store, Date, actual, model, pred[, Holiday_Flag]). Every metric is one
grouped aggregation (partial + final), so per-model, per-store or per-period
evaluation is a single shuffle of partial aggregates regardless of skew.
"""
from __future__ import annotations

import os
import uuid
from functools import reduce
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import metrics as M
from .order import quantiles


def predictions_long(frame: DataFrame, pred_cols: dict[str, str], entity: str = C.ENTITY,
                     time: str = C.TIME, target: str = C.TARGET,
                     keep=(C.HOLIDAY_FLAG,)) -> DataFrame:
    """Wide prediction columns -> long (entity, time, actual, model, pred, ...)
    via ``unpivot`` (one pass, no self-union)."""
    extra = [k for k in keep if k in frame.columns]
    base = frame.select(entity, time, F.col(target).alias("actual"), *extra,
                        *[F.col(c).cast("double").alias(m) for m, c in pred_cols.items()])
    return base.unpivot([entity, time, "actual", *extra], list(pred_cols), "model", "pred")


def union_model_results(*frames: DataFrame) -> DataFrame:
    """Merge long prediction sets of several model families (by column name)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def all_metrics(long: DataFrame, by=("model",), digits: int | None = 6) -> DataFrame:
    """The eight metrics per group. Median_AE is exact; a group may hold any share of the
    rows, so it comes from distributed positions (``order.quantiles``)."""
    by = list(by)
    plain = long.groupBy(*by).agg(*M.metric_columns("actual", "pred", digits))
    error = long.select(*by, F.abs(F.col("actual") - F.col("pred")).alias("_error"))
    median = quantiles(error, "_error", {"_m": 0.5}, by)
    rounded = M.rounded_metric("Median_AE", F.col("_m"), digits).alias("Median_AE")
    if not by:
        return plain.withColumn("_m", median.scalar()).select(*plain.columns, rounded)
    median = median.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], "_m")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)])
    return plain.join(median, same, "left").select(*plain.columns, rounded)


def metric_by(long: DataFrame, name: str, by=("model",), digits: int = 6) -> DataFrame:
    builder = {"WMAPE": M.wmape, "MAPE": M.mape, "SMAPE": M.smape}[name]
    return long.groupBy(*by).agg(F.round(builder("actual", "pred"), digits).alias(name))


def wmape_per_store(long: DataFrame, entity: str = C.ENTITY, digits: int = 6) -> DataFrame:
    """WMAPE per (model, entity); NULL where the entity's actuals sum to zero."""
    return (long.groupBy("model", entity)
            .agg(F.round(M.wmape("actual", "pred"), digits).alias("WMAPE")))


def wmape_per_period(long: DataFrame, period: str = C.HOLIDAY_FLAG, digits: int = 6) -> DataFrame:
    return (long.groupBy("model", period)
            .agg(F.round(M.wmape("actual", "pred"), digits).alias("WMAPE"),
                 F.count(F.lit(1)).alias("Count")))


def wmape_store_model(long: DataFrame, models: list[str], entity: str = C.ENTITY,
                      digits: int = 6) -> DataFrame:
    """Entity x model WMAPE matrix plus the model with the lowest mean WMAPE over
    entities (ties -> model name) as ``best_model``."""
    per = long.groupBy(entity, "model").agg(M.wmape("actual", "pred").alias("w"))
    best = (per.groupBy("model").agg(F.avg("w").alias("avg_w"))
            .agg(F.min_by("model", F.struct("avg_w", "model")).alias("best_model")))
    matrix = (per.groupBy(entity).pivot("model", models)
              .agg(F.round(F.first("w"), digits)))
    return matrix.withColumn("best_model", best.scalar())


def model_rank(metrics: DataFrame, primary: str = "WMAPE", higher_is_better: bool = False) -> DataFrame:
    """Rank 1..n by the primary metric (ascending unless higher_is_better); the
    window is over the metrics table, one row per model."""
    order = F.col(primary).desc() if higher_is_better else F.col(primary).asc()
    w = Window.orderBy(order, F.col("model"))
    rest = [c for c in metrics.columns if c not in ("model", primary)]
    return metrics.select(F.row_number().over(w).alias("Rank"), "model", primary, *rest)


def best_model(metrics: DataFrame, primary: str = "WMAPE") -> DataFrame:
    return metrics.agg(F.min_by("model", F.struct(primary, "model")).alias("best_model"),
                       F.min(primary).alias(f"best_{primary}"))


def align_predictions(actuals: DataFrame, long: DataFrame, models: list[str],
                      entity: str = C.ENTITY, time: str = C.TIME,
                      target: str = C.TARGET) -> DataFrame:
    """Actual rows with one ``<model>_Pred`` column per model, joined on the keys
    (never by position)."""
    wide = (long.groupBy(entity, time).pivot("model", models).agg(F.first("pred")))
    wide = wide.select(entity, time, *[F.col(m).alias(f"{m}_Pred") for m in models])
    return actuals.select(entity, time, target).join(wide, [entity, time], "inner")


def unmatched_predictions(actuals: DataFrame, long: DataFrame, entity: str = C.ENTITY,
                          time: str = C.TIME) -> DataFrame:
    """Prediction rows without an actual row (the keyed length check)."""
    return long.join(actuals.select(entity, time), [entity, time], "left_anti")


REPORT = ("WMAPE", "MAE", "RMSE", "R2")


def format_metrics(metrics: DataFrame, names=M.METRIC_NAMES) -> DataFrame:
    """Any of the eight metrics as text, sorted by WMAPE. Formats from unrounded values."""
    return metrics.orderBy("WMAPE", "model").select(
        F.col("model").alias("Model"), *[M.format_metric(n, F.col(n)).alias(n) for n in names])


def metrics_report(metrics: DataFrame) -> DataFrame:
    """Model, WMAPE 'x.xx%', MAE/RMSE '$x,xxx', R2 '0.xxxx', sorted by WMAPE."""
    return format_metrics(metrics, REPORT)


def select_model(long: DataFrame, model: str | None = None) -> DataFrame:
    return long if model in (None, "All Models") else long.filter(F.col("model") == model)


def history_table(long: DataFrame, time: str = C.TIME, digits: int = 6) -> DataFrame:
    """Backtest history: one entry per (model, epoch = k-th evaluation period) with
    val_WMAPE of that period and train_WMAPE over all earlier periods."""
    periods = long.select(time).distinct()
    w = Window.orderBy(time)
    epochs = periods.select(time, (F.row_number().over(w) - 1).alias("epoch"))
    per = (long.join(epochs, time).groupBy("model", "epoch")
           .agg(F.sum(F.abs(F.col("actual") - F.col("pred"))).alias("abs_err"),
                F.sum("actual").alias("act")))
    cum = Window.partitionBy("model").orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    return per.select(
        "model", "epoch",
        F.round(F.try_divide(F.sum("abs_err").over(cum), F.sum("act").over(cum)) * 100,
                digits).alias("train_WMAPE"),
        F.round(F.try_divide(F.col("abs_err"), F.col("act")) * 100, digits).alias("val_WMAPE"))


def _committed(spark, path: str) -> dict[str, str]:
    """run -> attempt that counts: of several the smallest, so that all readers agree."""
    try:
        rows = spark.read.schema("run string, attempt string").parquet(os.path.join(path, "manifest")).collect()
    except AnalysisException:  # nothing was committed yet
        return {}
    out: dict[str, str] = {}
    for r in rows:  # one row a run
        out[r["run"]] = min(r["attempt"], out.get(r["run"], r["attempt"]))
    return out


def read_history(spark, path: str, schema) -> DataFrame:
    """The entries of all committed runs of a history table."""
    parts = [os.path.join(path, "data", f"{r}-{a}") for r, a in sorted(_committed(spark, path).items())]
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*parts)


def append_history(entries: DataFrame, path: str, run: str | None = None) -> DataFrame:
    """Append history entries (model, epoch, train_*/val_* metrics) to the history table at
    ``path`` and read the whole table back.

    An attempt writes its entries as files of their own, then one row to the manifest; only
    attempts in the manifest are read. So a run that failed on the way left nothing, and one
    that is repeated under its ``run`` name adds its entries once. Nothing is rewritten."""
    spark = entries.sparkSession
    run = quote(run if run is not None else uuid.uuid4().hex, safe="")
    if run not in _committed(spark, path):
        attempt = uuid.uuid4().hex
        entries.write.parquet(os.path.join(path, "data", f"{run}-{attempt}"))
        (spark.createDataFrame([(run, attempt)], "run string, attempt string").coalesce(1)
         .write.mode("append").parquet(os.path.join(path, "manifest")))
    return read_history(spark, path, entries.schema)


def best_epoch(history: DataFrame, metric: str = "val_WMAPE") -> DataFrame:
    """Epoch with the lowest metric per model (-1 when the metric is missing)."""
    if metric not in history.columns:
        return history.select("model").distinct().withColumn("best_epoch", F.lit(-1))
    return history.groupBy("model").agg(
        F.min_by("epoch", F.struct(metric, "epoch")).alias("best_epoch"))
