"""Search by tree-structured Parzen estimators over bounded spaces.

A round's candidates come from two densities of the trials so far: one of the best share,
one of the rest. Each is a mixture over its trials of normal densities cut to the bounds
(and one flat part), a parameter at a time; of some draws from the first the one with the
highest ratio of the densities is tried. Whole numbers are rounded, learning rates are
taken on the log scale. The first trials are drawn without a model, from the same seeded
sampler as the random search.

Trials are rows of a table in a folder (one file a round), so that a search that ended
early goes on from there. Draws depend on the seed and the trials so far only.
"""
from __future__ import annotations

import json
import math
from collections.abc import Callable

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

STARTUP, DRAWS, GOOD = 10, 24, 0.25
#: Candidates a model proposes in a round.
ROUND = 5
TRIALS = "model string, trial int, params string, score double"


def _is_log(name: str) -> bool:
    return name == "learning_rate"


def _scaled(name: str, value, bounds) -> float:
    lo, hi = (math.log(b) if _is_log(name) else float(b) for b in bounds)
    v = math.log(value) if _is_log(name) else float(value)
    return (v - lo) / (hi - lo) if hi > lo else 0.5


def _plain(name: str, u: float, bounds):
    lo, hi = (math.log(b) if _is_log(name) else float(b) for b in bounds)
    v = lo + min(1.0, max(0.0, u)) * (hi - lo)
    if _is_log(name):
        return float(min(bounds[1], max(bounds[0], math.exp(v))))
    return int(round(v)) if all(isinstance(b, int) for b in bounds) else float(v)


def _cdf(z: np.ndarray) -> np.ndarray:
    return np.array([0.5 * (1 + math.erf(x / math.sqrt(2))) for x in np.ravel(z)]).reshape(np.shape(z))


def widths(centres: np.ndarray) -> np.ndarray:
    """Width of the density at each centre: the further of its neighbours, within limits."""
    if not len(centres):
        return centres
    order = np.argsort(centres, kind="stable")
    edge = np.concatenate([[0.0], centres[order], [1.0]])
    gap = np.maximum(edge[1:-1] - edge[:-2], edge[2:] - edge[1:-1])
    out = np.empty(len(centres))
    out[order] = np.clip(gap, 1.0 / min(100, 1 + len(centres)), 1.0)
    return out


def density(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Mixture at x in [0, 1] of cut normals at the centres and a flat part."""
    if not len(centres):
        return np.ones(len(x))
    s = widths(centres)
    inside = _cdf((1 - centres) / s) - _cdf(-centres / s)
    normal = np.exp(-0.5 * ((x[:, None] - centres) / s) ** 2) / (s * math.sqrt(2 * math.pi) * inside)
    return (normal.sum(axis=1) + 1.0) / (len(centres) + 1)


def draw(centres: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    s = widths(centres)
    out = rng.uniform(size=n)
    for i, k in enumerate(rng.integers(0, len(centres) + 1, n)):
        if k < len(centres):
            while not 0 <= (v := rng.normal(centres[k], s[k])) <= 1:
                pass
            out[i] = v
    return out


def propose(space: dict, trials: list[tuple[dict, float]], rng: np.random.Generator) -> dict:
    """The next candidate after ``trials`` (params, score), lower scores being better."""
    ranked = sorted(range(len(trials)), key=lambda i: (trials[i][1], i))
    good = set(ranked[:max(1, math.ceil(GOOD * len(ranked)))])
    out = {}
    for name, bounds in space.items():
        at = np.array([_scaled(name, p[name], bounds) for p, _ in trials])
        best, rest = (np.array([at[i] for i in range(len(at)) if (i in good) == side]) for side in (True, False))
        x = draw(best, DRAWS, rng)
        out[name] = _plain(name, float(x[np.argmax(density(x, best) / density(x, rest))]), bounds)
    return out


def _known(spark: SparkSession, study: str | None) -> list:
    if not study:
        return []
    try:
        return spark.read.schema(TRIALS).parquet(study).collect()  # one row a trial
    except AnalysisException:  # no such folder yet
        return []


def minimise(spark: SparkSession, spaces: dict[str, dict], score: Callable[[list[tuple[str, dict]]], list[float]], n_trials: int,
             seed: int, study: str | None = None) -> dict[str, list[tuple[int, dict, float]]]:
    """(trial, params, score) of ``n_trials`` candidates of each space. ``score`` takes the
    candidates of a round, of all spaces, and gives their scores."""
    from .ml import sample_params
    trials: dict[str, list[tuple[int, dict, float]]] = {n: [] for n in spaces}
    for r in sorted(_known(spark, study), key=lambda r: (r["model"], r["trial"])):
        rows = trials.get(r["model"])
        if rows is not None and r["trial"] == len(rows):  # a row that was written twice counts once
            rows.append((r["trial"], json.loads(r["params"]), r["score"]))
    first = {n: sample_params(space, min(STARTUP, n_trials), seed) for n, space in spaces.items()}
    while any(len(t) < n_trials for t in trials.values()):
        cands = []
        for k, (n, space) in enumerate(spaces.items()):
            have = len(trials[n])
            last = min(STARTUP, n_trials) if have < STARTUP else min(n_trials, have - have % ROUND + ROUND)
            guess = [(p, s) for _, p, s in trials[n]]
            for t in range(have, last):
                p = first[n][t] if t < STARTUP else propose(space, guess, np.random.default_rng([seed, k, t]))
                cands.append((n, t, p))
                if t >= STARTUP:  # the round's other candidates keep off from this one
                    guess = guess + [(p, float("inf"))]
        rows = [(n, t, json.dumps(p, sort_keys=True), float(s)) for (n, t, p), s in zip(cands, score([(n, p) for n, _, p in cands]))]
        if study:
            spark.createDataFrame(rows, TRIALS).coalesce(1).write.mode("append").parquet(study)
        for (n, t, p), row in zip(cands, rows):
            trials[n].append((t, p, row[3]))
    return trials
