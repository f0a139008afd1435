"""Model operators: assembly, tree ensembles, importances, random search, persistence,
training/evaluation. The ensembles are grown by ``trees``."""
from __future__ import annotations

import math

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from . import parzen, trees
from .evaluation import all_metrics

FEATURES = "features"


def assembler(feature_cols: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(feature_cols), outputCol=FEATURES, handleInvalid="error")


def assemble_features(df: DataFrame, feature_cols: list[str]) -> DataFrame:
    return assembler(feature_cols).transform(df)


def random_forest(params: dict | None = None, seed: int = C.SEED) -> trees.Spec:
    """Trees on Poisson(1) copies of the rows, all features at every split, means as values."""
    p = {**C.RF_DEFAULTS, **(params or {})}
    return trees.Spec(forest=True, trees=int(p["n_estimators"]), depth=int(p["max_depth"]), rows=0.0,
                      least=float(p["min_samples_leaf"]), split=float(p["min_samples_split"]), seed=seed)


def gbt_depthwise(params: dict | None = None, seed: int = C.SEED) -> trees.Spec:
    """Boosting level by level with second-order gains: rows and columns are sampled once a
    tree, a child needs ``min_child_weight`` of curvature (one a row for squared errors)."""
    p = {**C.XGB_DEFAULTS, **(params or {})}
    return trees.Spec(forest=False, trees=int(p["n_estimators"]), depth=int(p["max_depth"]),
                      rate=float(p["learning_rate"]), rows=float(p["subsample"]), cols=float(p["colsample_bytree"]),
                      least=float(p["min_child_weight"]), l2=C.DEPTHWISE_L2, seed=seed)


def gbt_shallow(params: dict | None = None, seed: int = C.SEED) -> trees.Spec:
    """Boosting best-first up to ``num_leaves`` leaves. ``subsample`` has an effect only with
    a ``subsample_freq`` above 0, which the specification leaves at 0."""
    p = {**C.LGB_DEFAULTS, **(params or {})}
    return trees.Spec(forest=False, trees=int(p["n_estimators"]), depth=int(p["max_depth"]), leaves=int(p["num_leaves"]),
                      rate=float(p["learning_rate"]), rows=float(p["subsample"]) if p.get("subsample_freq") else 1.0,
                      cols=float(p["colsample_bytree"]), least=float(p.get("min_child_samples", C.BEST_FIRST_MIN_ROWS)), seed=seed)


ESTIMATORS = {"RandomForest": random_forest, "GBTDepthwise": gbt_depthwise,
              "GBTShallow": gbt_shallow}
SPACES = {"RandomForest": C.RF_SPACE, "GBTDepthwise": C.XGB_SPACE, "GBTShallow": C.LGB_SPACE}


def fit(name: str, train: DataFrame, feature_cols: list[str], params: dict | None = None,
        label: str = C.TARGET) -> trees.TreeModel:
    return trees.fit(train, list(feature_cols), label, ESTIMATORS[name](params))


def fit_all(names: list[str], train: DataFrame, feature_cols: list[str], params: dict[str, dict] | None = None,
            label: str = C.TARGET) -> dict[str, trees.TreeModel]:
    """Several models grown at once."""
    specs = [ESTIMATORS[n]((params or {}).get(n)) for n in names]
    return dict(zip(names, trees.fit_all(train, list(feature_cols), label, specs)))


def predict(model: trees.TreeModel, df: DataFrame, keep: list[str]) -> DataFrame:
    return model.transform(df).select(*keep, "pred")


def feature_importance(model: trees.TreeModel) -> list[tuple[str, float]]:
    """(feature, importance) in the order of the model's features (one value each: bounded)."""
    return list(zip(model.features, [float(v) for v in model.importances()]))


def importance_frame(spark, model: trees.TreeModel, model_name: str) -> DataFrame:
    rows = [(model_name, f, v) for f, v in feature_importance(model)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def top_features(importances: DataFrame, k: int = C.TOP_FEATURES) -> DataFrame:
    return importances.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)


def evaluate(pred: DataFrame, label: str = C.TARGET, model_name: str = "model") -> DataFrame:
    return all_metrics(pred.select(F.col(label).alias("actual"), "pred", F.lit(model_name).alias("model")))


def sample_params(space: dict, n: int, seed: int = C.SEED) -> list[dict]:
    """Seeded random candidates: ints uniform (inclusive), learning rates
    log-uniform, other floats uniform."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        cand = {}
        for k, (lo, hi) in space.items():
            if isinstance(lo, int) and isinstance(hi, int):
                cand[k] = int(rng.integers(lo, hi + 1))
            elif k == "learning_rate":
                cand[k] = float(math.exp(rng.uniform(math.log(lo), math.log(hi))))
            else:
                cand[k] = float(rng.uniform(lo, hi))
        out.append(cand)
    return out


def random_search_all(names: list[str], train: DataFrame, tune: DataFrame, feature_cols: list[str],
                      n_trials: int = C.TUNING_TRIALS, seed: int = C.SEED,
                      label: str = C.TARGET) -> dict[str, list[tuple[int, dict, float]]]:
    """Random search over several models at once: every candidate is fitted on ``train`` with
    all the trees it names and scored by WMAPE on ``tune`` (a later time window than
    ``train``); one search grows the trees of all candidates. For each model (trial, params,
    wmape), best first."""
    cands = [(name, t, p) for name in names for t, p in enumerate(sample_params(SPACES[name], n_trials, seed))]
    scores = trees.search(train, tune, list(feature_cols), label, [ESTIMATORS[name](p) for name, _, p in cands])
    out: dict[str, list] = {name: [] for name in names}
    for (name, t, p), score in zip(cands, scores):
        out[name].append((t, p, float(score) if score is not None else float("inf")))
    return {name: sorted(rows, key=lambda r: (r[2], r[0])) for name, rows in out.items()}


def random_search(name: str, train: DataFrame, tune: DataFrame, feature_cols: list[str],
                  n_trials: int = C.TUNING_TRIALS, seed: int = C.SEED,
                  label: str = C.TARGET) -> list[tuple[int, dict, float]]:
    """Random search of one model: (trial, params, wmape), best first."""
    return random_search_all([name], train, tune, feature_cols, n_trials, seed, label)[name]


def parzen_search_all(names: list[str], train: DataFrame, tune: DataFrame, feature_cols: list[str],
                      n_trials: int = C.TUNING_TRIALS, seed: int = C.SEED, label: str = C.TARGET,
                      study: str | None = None) -> dict[str, list[tuple[int, dict, float]]]:
    """The same search with candidates proposed by ``parzen``; the candidates that all models
    propose in a round are grown together. ``study`` names a folder that keeps the trials: a
    search that is started again on it goes on where it ended."""
    def score(cands: list[tuple[str, dict]]) -> list[float]:
        found = trees.search(train, tune, list(feature_cols), label, [ESTIMATORS[n](p) for n, p in cands])
        return [float("inf") if x is None else float(x) for x in found]
    trials = parzen.minimise(train.sparkSession, {n: SPACES[n] for n in names}, score, n_trials, seed, study)
    return {n: sorted(rows, key=lambda r: (r[2], r[0])) for n, rows in trials.items()}


def save_model(model: trees.TreeModel, path: str) -> None:
    model.save(path)


def load_model(path: str) -> trees.TreeModel:
    return trees.TreeModel.load(SparkSession.getActiveSession(), path)


def model_feature_columns(model: trees.TreeModel) -> list[str]:
    return list(model.features)


def vector_column_as_array(df: DataFrame, col: str = FEATURES) -> DataFrame:
    return df.withColumn(col, vector_to_array(F.col(col)))
