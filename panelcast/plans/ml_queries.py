"""Named queries of the model, persistence and scoring operators.

Tree models are fitted once per (tables, model) in a process-level cache and
shared by the queries that need them (predictions, importances, persistence).
Queries without an oracle get the driver's rows-only check.
"""
from __future__ import annotations

import json
import os
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import changepoints as cp
from ..operators import evaluation as ev
from ..operators import forecast as fc
from ..operators import ml
from ..operators import scoring as sc
from ..session import checkpoint_dir
from ..sources import files
from . import queries as Q
from .queries import query
from .training import KEYS, prepare_ml_data, train_and_evaluate, training_job

_LOCK = threading.Lock()
_CACHE: dict = {}


def _ml_data(spark: SparkSession, sf: str):
    key = ("data", sf, id(spark))
    with _LOCK:
        if key not in _CACHE:
            _CACHE[key] = prepare_ml_data(Q.panel(spark, sf))
        return _CACHE[key]


def _fitted_all(spark: SparkSession, sf: str, names=tuple(ml.SPACES)) -> dict:
    """name -> (model, predictions, metrics); models that are not known yet are grown at once."""
    train, val, cols = _ml_data(spark, sf)
    with _LOCK:
        missing = [n for n in names if ("model", sf, n, id(spark)) not in _CACHE]
        for name, out in train_and_evaluate(missing, train, val, cols).items() if missing else ():
            _CACHE["model", sf, name, id(spark)] = out
        return {n: _CACHE["model", sf, n, id(spark)] for n in names}


def _fitted(spark: SparkSession, sf: str, name: str):
    return _fitted_all(spark, sf, (name,))[name]


def _scratch(spark: SparkSession, what: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{what}-{uuid.uuid4().hex[:10]}")


# ------------------------------------------------------------------ sources
@query("read_predictions")
def q_read_predictions(spark, sf):
    path = _scratch(spark, "predictions")
    files.write_predictions(Q.baseline_long(spark, sf), path, Q.MODELS)
    return files.read_predictions(spark, path)


@query("read_metrics")
def q_read_metrics(spark, sf):
    path = _scratch(spark, "metrics")
    files.write_metrics(Q.baseline_metrics(spark, sf), path)
    return files.read_metrics(spark, path)


# ----------------------------------------------------------- model frames
@query("prepare_ml_data")
def q_prepare_ml_data(spark, sf):
    train, val, cols = _ml_data(spark, sf)
    both = train.unionByName(val)
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.lit(len(cols)).alias("n_features"))


@query("assemble_features")
def q_assemble(spark, sf):
    train, val, cols = _ml_data(spark, sf)
    out = ml.assemble_features(train.unionByName(val), cols)
    return ml.vector_column_as_array(out.select(*KEYS, "split", C.TARGET, ml.FEATURES))


def _pred_query(name):
    def fn(spark, sf):
        _, pred, _ = _fitted(spark, sf, name)
        return pred
    return fn


query("random_forest")(_pred_query("RandomForest"))
query("gbt_depthwise")(_pred_query("GBTDepthwise"))
query("gbt_shallow")(_pred_query("GBTShallow"))


@query("train_and_evaluate")
def q_train_and_evaluate(spark, sf):
    """fit -> predict -> all metrics of the three tree models."""
    return ev.union_model_results(*[out[2] for out in _fitted_all(spark, sf).values()])


@query("feature_importance")
def q_feature_importance(spark, sf):
    """Importances of every feature in each of the three tree models."""
    return ev.union_model_results(*[ml.importance_frame(spark, out[0], name) for name, out in _fitted_all(spark, sf).items()])


@query("top_features")
def q_top_features(spark, sf):
    # depth-wise boosted model first, as in the reference's selection order
    model = _fitted(spark, sf, "GBTDepthwise")[0]
    return ml.top_features(ml.importance_frame(spark, model, "GBTDepthwise"))


def _saved_models(spark, sf) -> dict[str, str]:
    key = ("saved", sf, id(spark))
    fitted = _fitted_all(spark, sf)
    with _LOCK:
        if key not in _CACHE:
            path = _scratch(spark, "models")
            for name, (model, _, _) in fitted.items():
                ml.save_model(model, os.path.join(path, name))
            _CACHE[key] = {name: os.path.join(path, name) for name in fitted}
        return _CACHE[key]


@query("save_model")
def q_save_model(spark, sf):
    """Persist the three fitted models with their ordered feature lists; returns the
    persisted lists in order."""
    return spark.createDataFrame(
        [(name, i, c) for name, path in _saved_models(spark, sf).items()
         for i, c in enumerate(ml.model_feature_columns(ml.load_model(path)))], "model string, position int, feature string")


@query("load_model")
def q_load_model(spark, sf):
    """Load the three persisted models and score the validation rows with each."""
    _, val, _ = _ml_data(spark, sf)
    return ev.union_model_results(*[
        ml.predict(ml.load_model(path), val, KEYS).withColumn("model", F.lit(name))
        for name, path in _saved_models(spark, sf).items()])


@query("write_metrics")
def q_write_metrics(spark, sf):
    """The nested metrics JSON document as written by the sink (one row)."""
    path = _scratch(spark, "metrics-doc")
    files.write_metrics(Q.baseline_metrics(spark, sf), path)
    return spark.read.text(path, wholetext=True)


@query("random_search")
def q_random_search(spark, sf):
    """Seeded random search over the spaces of all three tree models at once; fits on the
    earlier training weeks, scores WMAPE on the last ten training weeks."""
    from .training import tuning_split
    train, _, cols = _ml_data(spark, sf)
    fit_rows, tune_rows = tuning_split(train)
    found = ml.random_search_all(list(ml.SPACES), fit_rows, tune_rows, cols)
    rows = [(name, i, json.dumps(p, sort_keys=True), w) for name in ml.SPACES for i, p, w in found[name]]
    return spark.createDataFrame(rows, "model string, trial int, params string, WMAPE double")


@query("parzen_search")
def q_parzen_search(spark, sf):
    """The search of all three models with candidates proposed from the trials so far."""
    from .training import tuning_split
    train, _, cols = _ml_data(spark, sf)
    found = ml.parzen_search_all(list(ml.SPACES), *tuning_split(train), cols, study=_scratch(spark, "study"))
    rows = [(name, i, json.dumps(p, sort_keys=True), w) for name in ml.SPACES for i, p, w in found[name]]
    return spark.createDataFrame(rows, "model string, trial int, params string, WMAPE double")


# ------------------------------------------------------- series forecasters
@query("trend_seasonal_forecast")
def q_trend_seasonal(spark, sf):
    return fc.trend_seasonal_forecast(Q.panel(spark, sf))


@query("trend_changepoint_forecast")
def q_trend_changepoint(spark, sf):
    return cp.trend_changepoint_forecast(Q.panel(spark, sf))


# ------------------------------------------------------------------ scoring
def _requests(spark, sf) -> DataFrame:
    return sc.requests_from_panel(Q.panel(spark, sf))


@query("request_features")
def q_request_features(spark, sf):
    out = sc.request_features(_requests(spark, sf))
    return Q.rounded(out.drop("store_id", "date_str"),
                     {c: 6 for c in ("month_sin", "month_cos", "week_sin", "week_cos")})


@query("request_history")
def q_request_history(spark, sf):
    req = _requests(spark, sf).withColumn(C.ENTITY, F.col("store_id").cast("int"))
    return sc.request_history(req, Q.panel(spark, sf))


@query("deviation_trend")
def q_deviation_trend(spark, sf):
    """Validation forecasts of the moving-average baseline against the entity's
    historical mean: difference, % difference, Above/Below/Near label."""
    long = ev.select_model(Q.baseline_long(spark, sf), "moving_average_4w")
    hist = sc.store_history(Q.panel(spark, sf))
    out = sc.deviation_trend(long.join(hist, C.ENTITY, "left").withColumnRenamed("pred", "prediction"))
    return out.select(C.ENTITY, C.TIME, "prediction", "store_avg", "diff_from_avg",
                      F.round("pct_diff", 6).alias("pct_diff"), "trend")


def scoring_model(spark, sf):
    """Forest on the 16 request features (trained on training weeks)."""
    key = ("scoring", sf, id(spark))
    with _LOCK:
        if key not in _CACHE:
            p = Q.panel(spark, sf)
            train = sc.request_features(sc.requests_from_panel(p, "1900-01-01")
                                        .filter(F.to_date("date_str", "dd-MM-yyyy")
                                                < F.lit(C.VALIDATION_START).cast("date")))
            train = train.join(p.select(F.col(C.ENTITY), F.col(C.TIME).alias("date"), C.TARGET),
                               [C.ENTITY, "date"])
            _CACHE[key] = ml.fit("RandomForest", train, list(C.SCORING_FEATURES))
        return _CACHE[key]


@query("score_requests")
def q_score_requests(spark, sf):
    return sc.score_requests(_requests(spark, sf), Q.panel(spark, sf), scoring_model(spark, sf))


@query("training_job")
def q_training_job(spark, sf):
    return training_job(spark, sf, data=_ml_data(spark, sf))
