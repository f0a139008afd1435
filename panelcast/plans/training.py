"""End-to-end batch training job (spark-submit style).

load panel -> validate -> split -> features (leak-safe by default) -> drop nulls
-> tree models (optionally tuned on a separate tuning window) -> per-series
forecasters -> gate + blend -> metrics -> write predictions, metrics, models.

The feature frame is written once to the shared checkpoint folder (reliable
checkpoint) before the models read it many times, so an executor loss never
recomputes the panel join, and the lineage stays short.
"""
from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import evaluation as ev
from ..operators import forecast as fc
from ..operators import ml
from ..operators.arma import seasonal_arma_forecast
from ..operators.panel import validate_panel, with_split
from ..session import checkpoint_dir, materialize
from ..sources import files
from ..sources.star import build_panel
from .features import engineer_features_split, feature_columns

KEYS = [C.ENTITY, C.TIME]


def prepare_ml_data(panel: DataFrame, val_start: str = C.VALIDATION_START,
                    leak_safe: bool = True) -> tuple[DataFrame, DataFrame, list[str]]:
    """(train rows, validation rows, feature columns) after dropping null rows.

    ``leak_safe`` builds trend columns from the previous week (no column is a
    function of the current target); ``False`` reproduces the parity set."""
    feat = engineer_features_split(panel, val_start, leak_safe=leak_safe)
    # Partitions stay sized by bytes (AQE coalescing): tree learners ship one set
    # of node statistics per partition, so more, smaller partitions only add
    # aggregation volume; large inputs still get one partition per ~64 MB.
    feat = materialize(feat.dropna(how="any"))
    cols = feature_columns(feat)
    train = feat.filter(F.col("split") == "train")
    val = feat.filter(F.col("split") == "validation")
    return train, val, cols


def tuning_split(train: DataFrame, weeks: int = 10) -> tuple[DataFrame, DataFrame]:
    """Last ``weeks`` distinct periods of the training rows become the tuning
    window (train / tune / test in time order)."""
    cutoff = (train.select(C.TIME).distinct()
              .orderBy(F.col(C.TIME).desc()).limit(weeks).agg(F.min(C.TIME)).scalar())
    return train.filter(F.col(C.TIME) < cutoff), train.filter(F.col(C.TIME) >= cutoff)


def train_and_evaluate(names: list[str], train: DataFrame, val: DataFrame, feature_cols: list[str],
                       params: dict[str, dict] | None = None, tune: bool = False, n_trials: int = C.TUNING_TRIALS) -> dict:
    """name -> (fitted model, long validation predictions, metrics) of tree models that are
    tuned and grown at once."""
    params = dict(params or {})
    if tune:
        fit_rows, tune_rows = tuning_split(train)
        params |= {n: rows[0][1] for n, rows in ml.random_search_all(names, fit_rows, tune_rows, feature_cols, n_trials).items()}
    out = {}
    for name, model in ml.fit_all(names, train, feature_cols, params).items():
        pred = ml.predict(model, val, KEYS + [C.TARGET]).select(
            *KEYS, F.col(C.TARGET).alias("actual"), F.lit(name).alias("model"), "pred")
        out[name] = model, pred, ev.all_metrics(pred)
    return out


def _long(frame: DataFrame, name: str) -> DataFrame:
    return frame.withColumn("model", F.lit(name)).select(*KEYS, "actual", "model", "pred")


def blend_of(long: DataFrame) -> dict[str, float]:
    """Gate and blend weights learned from ``long``: models with a low enough WMAPE, and
    the weights that minimise the blend's. Empty if too few models pass."""
    gate = fc.ensemble_gate(ev.all_metrics(long))
    names = sorted(r["model"] for r in gate.filter("blend").select("model").collect())
    if not names:
        return {}
    wide = files.predictions_wide(long, names).withColumnRenamed(C.TARGET, "actual")
    return {r["model"]: r["weight"] for r in fc.ensemble_weights(wide, names).collect()}


def _series_models(panel: DataFrame, start: str, keys: DataFrame) -> list[DataFrame]:
    """Per-series forecasts from ``start`` on, on the same rows as the tree models (keyed
    join, not position)."""
    return [_long(frame.join(keys, KEYS), name) for name, frame in (
        ("SeasonalARMA", seasonal_arma_forecast(panel, start)),
        ("TrendSeasonal", fc.trend_seasonal_forecast(panel, start)))]


def training_job(spark: SparkSession, sf_dir: str, out_dir: str | None = None,
                 val_start: str = C.VALIDATION_START, tune: bool = True,
                 skip_time_series: bool = False, leak_safe: bool = True,
                 models=("RandomForest", "GBTDepthwise", "GBTShallow"),
                 data=None, sampler: str = "random") -> DataFrame:
    """Runs the whole pipeline and returns the per-model metrics table.

    The last ten training weeks are the tuning window: parameters (with ``tune``), the gate
    and the blend weights are learned on it, from models of the same settings fitted on the
    weeks before, and the validation rows that are reported stay untouched.
    ``sampler``: "random" or "parzen" candidates.
    ``data`` lets a caller pass an already prepared feature split, e.g. from a session
    cache."""
    out_dir = out_dir or os.path.join(checkpoint_dir(spark), f"training-{uuid.uuid4().hex[:8]}")
    panel = materialize(build_panel(spark, sf_dir))
    validate_panel(panel).write.mode("overwrite").json(os.path.join(out_dir, "validation"))
    train, val, cols = data if data is not None else prepare_ml_data(panel, val_start, leak_safe)
    fit_rows, tune_rows = tuning_split(train)
    reported, learned = [], []
    search = {"random": ml.random_search_all, "parzen": ml.parzen_search_all}[sampler]
    best = search(list(models), fit_rows, tune_rows, cols) if tune else {}
    params = {name: rows[0][1] for name, rows in best.items()}
    for name, (model, pred, _) in train_and_evaluate(list(models), train, val, cols, params).items():
        ml.save_model(model, os.path.join(out_dir, "models", name))
        reported.append(pred)
    for name, early in ml.fit_all(list(models), fit_rows, cols, params).items():
        learned.append(_long(ml.predict(early, tune_rows, KEYS + [C.TARGET])
                             .withColumnRenamed(C.TARGET, "actual"), name))
    if not skip_time_series:
        reported += _series_models(panel, val_start, val.select(*KEYS))
        start = tune_rows.agg(F.min(C.TIME)).first()[0]
        if start is not None:
            before = panel.filter(F.col(C.TIME) < F.lit(val_start).cast("date"))
            learned += _series_models(before, start.isoformat(), tune_rows.select(*KEYS))
    long = materialize(ev.union_model_results(*reported))
    weights = blend_of(materialize(ev.union_model_results(*learned)))
    metrics = ev.all_metrics(long)
    names = sorted(r["model"] for r in metrics.select("model").collect())
    if weights:
        blend = sorted(weights)
        wide = files.predictions_wide(long, names).withColumnRenamed(C.TARGET, "actual")
        ens = _long(fc.ensemble_predict(wide, blend, weights), "Ensemble")
        long = long.unionByName(ens)
        metrics = ev.all_metrics(long)
        names = names + ["Ensemble"]
    files.write_predictions(long, os.path.join(out_dir, "predictions"), names)
    files.write_metrics(metrics, os.path.join(out_dir, "metrics"))
    return metrics.withColumn("out_dir", F.lit(out_dir))


__all__ = ["prepare_ml_data", "train_and_evaluate", "training_job", "tuning_split", "with_split"]


def main(argv=None) -> None:
    """spark-submit entry point:
    ``spark-submit panelcast/plans/training.py --sf-dir DIR [--out DIR] [--no-tune] [--skip-ts]``."""
    import argparse

    from ..session import build_session
    ap = argparse.ArgumentParser(description="Train, blend and evaluate the weekly-panel models")
    ap.add_argument("--sf-dir", required=True, help="folder with the star-schema parquet tables")
    ap.add_argument("--out", default=None, help="output folder (default: under spark.checkpoint.dir)")
    ap.add_argument("--no-tune", action="store_true", help="no random search before each tree model")
    ap.add_argument("--skip-ts", action="store_true", help="skip the per-series forecasters")
    ap.add_argument("--parity-features", action="store_true",
                    help="use the parity feature set (trend columns from the current target)")
    args = ap.parse_args(argv)
    spark = build_session()
    metrics = training_job(spark, args.sf_dir, args.out, tune=not args.no_tune,
                           skip_time_series=args.skip_ts, leak_safe=not args.parity_features)
    metrics.orderBy("WMAPE").show(truncate=False)


if __name__ == "__main__":
    import sys as _sys
    _pkg_root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    _sys.path.insert(0, _pkg_root)
    from panelcast.plans.training import main as _main
    _main()
