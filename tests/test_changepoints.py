import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from panelcast.operators import changepoints as cp
from conftest import make_panel


def _broken(spark, weeks=180, at=60):
    """Entity 1 turns after ``at`` weeks, entity 2 never, entity 3 has no positive sale."""
    d0, rng = dt.date(2010, 1, 1), np.random.default_rng(4)
    rows = []
    for s in (1, 2, 3):
        for w in range(weeks):
            slope = .01 * w - (.02 * max(w - at, 0) if s == 1 else 0)
            y = 0.0 if s == 3 else math.exp(10 + slope + rng.normal(0, .02))
            rows.append((s, (d0 + dt.timedelta(days=7 * w)).isoformat(), y))
    return make_panel(spark, rows), (d0 + dt.timedelta(days=7 * 160)).isoformat()


def test_gram_is_the_sum_of_products(spark):
    panel, start = _broken(spark)
    rows = cp.trend_rows(panel, start)
    got = {r.Store: (r.n, r.gram) for r in cp.gram(rows, cp.trend_terms()).collect()}
    x = rows.filter("is_train").select("Store", F.array(*cp.trend_terms(), F.col("ly")).alias("z")).collect()
    assert set(got) == {1, 2}
    for s in got:
        z = np.array([r.z for r in x if r.Store == s])
        assert got[s][0] == len(z) == 160
        np.testing.assert_allclose(got[s][1], (z.T @ z)[np.triu_indices(z.shape[1])], rtol=1e-9)


def test_solution_is_optimal():
    """Conditions of the penalised minimum at the variance that the last round used."""
    rng = np.random.default_rng(1)
    t = np.linspace(0, 1, 200)
    x = np.column_stack([np.ones(200), t, *[np.maximum(t - k, 0) for k in cp.knots(5)], rng.normal(size=200)])
    y = 3 + 2 * t - 4 * np.maximum(t - cp.knots(5)[2], 0) + .3 * x[:, -1] + rng.normal(0, .05, 200)
    z = np.column_stack([x, y])
    b, variance = cp.solve((z.T @ z)[np.triu_indices(z.shape[1])][None], np.array([200.]), changes=5)
    pull = x.T @ (y - x @ b[0]) / variance[0]
    assert abs(pull[0]) < .5 and abs(pull[1] - b[0, 1] / 25) < .5 and abs(pull[-1] - b[0, -1] / 100) < .5
    assert (np.abs(pull[2:7]) <= 1 / cp.CHANGE + .5).all()
    assert np.argmax(np.abs(b[0, 2:7])) == 2 and variance[0] < .004


def test_planted_break_is_found(spark):
    panel, start = _broken(spark)
    rows = cp.trend_rows(panel, start)
    beta = {r.Store: np.array(r.beta[2:27]) for r in cp.coefficients(cp.gram(rows, cp.trend_terms())).collect()}
    where = np.array(cp.knots())
    assert abs((where * beta[1]).sum() / beta[1].sum() - 60 / 159) < .05 and beta[1].sum() < -2
    assert abs(beta[2].sum()) < .3
    out = cp.trend_changepoint_forecast(panel, start).collect()
    assert len(out) == 60
    for r in out:
        assert r.pred == 0 if r.Store == 3 else abs(math.log(r.pred / r.actual)) < .3


def test_odd_rows(spark):
    panel, start = _broken(spark, 170)
    odd = panel.withColumn("CPI", F.lit(None).cast("double")).withColumn("Date", F.when(F.col("Store") == 2, F.col("Date")))
    assert {r.Store for r in cp.trend_changepoint_forecast(odd, start).collect()} == {2}
    assert cp.trend_changepoint_forecast(panel.limit(0), start).collect() == []
    late = cp.trend_changepoint_forecast(panel.filter(F.col("Date") >= start), start, fallback=7.0).collect()
    assert len(late) == 30 and {r.pred for r in late} == {7.0}
