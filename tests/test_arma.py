"""Seasonal ARMA against numpy."""
from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from panelcast.operators import arma

D0 = dt.date(2000, 1, 7)


def simulate(phi, theta, n, season, seed, noise=1.0):
    rng = np.random.default_rng(seed)
    e = rng.normal(scale=noise, size=n)
    z = np.zeros(n)
    for t in range(1, n):
        z[t] = phi * z[t - 1] + theta * e[t - 1] + e[t]
    y = np.zeros(n)
    for t in range(n):
        y[t] = (y[t - season] if t >= season else 100.0 + 10 * t) + z[t]
    return y


def frame(spark, series):
    rows = [(s, D0 + dt.timedelta(days=7 * t), None if v is None or np.isnan(v) else float(v)) for s, y in series.items() for t, v in enumerate(y)]
    return spark.createDataFrame(rows, "Store int, Date date, Weekly_Sales double")


def sse(z, phi, theta):
    e, before, total = 0.0, None, 0.0
    for x in z:
        if before is None or np.isnan(x) or np.isnan(before):
            e, x = 0.0, (x if not np.isnan(x) else np.nan if before is None else phi * before + theta * e)
        else:
            e = x - phi * before - theta * e
            total += e * e
        before = x
    return total, before, e


CASES = {1: (0.7, 0.3), 2: (-0.5, -0.3), 3: (0.4, -0.7), 4: (0.0, 0.5), 5: (0.9, 0.0)}


def test_known_coefficients_are_recovered(spark):
    df = frame(spark, {s: simulate(p, q, 1200, 4, s) for s, (p, q) in CASES.items()})
    got = {r.Store: (r.phi, r.theta) for r in arma.arma_parameters(df, "2100-01-01", season=4).collect()}
    for s, (p, q) in CASES.items():
        assert got[s] == (pytest.approx(p, abs=0.1), pytest.approx(q, abs=0.1))


def test_least_squares_and_forecasts_against_numpy(spark):
    """No point of a fine grid is better, and h steps ahead equal the recursion."""
    n, cut, season = 160, 150, 6
    series = {s: simulate(p, q, n, season, 10 + s, 3.0) for s, (p, q) in CASES.items()}
    series[6] = series[1].copy()
    series[6][[40, 41, 77]] = np.nan
    df, start = frame(spark, series), (D0 + dt.timedelta(days=7 * cut)).isoformat()
    params = {r.Store: r for r in arma.arma_parameters(df, start, season).collect()}
    out = {(r.Store, (r.Date - D0).days // 7): r.pred for r in arma.seasonal_arma_forecast(df, start, season).collect()}
    grid = np.linspace(-0.98, 0.98, 50)
    for s, y in series.items():
        z = (y[season:] - y[:-season])[:cut - season]
        r = params[s]
        total, last, e = sse(z, r.phi, r.theta)
        assert total == pytest.approx(r.sse) and (last, e) == (pytest.approx(r.z_last), pytest.approx(r.e_last))
        if not np.isnan(z).any():
            assert r.sse <= min(sse(z, p, q)[0] for p in grid for q in grid) * 1.0005
        ahead = r.phi * last + r.theta * e
        for t in range(cut, n):
            want = y[t - season] + ahead if not np.isnan(y[t - season]) else None
            if want is not None:
                assert out[s, t] == pytest.approx(want)
            ahead *= r.phi


def test_short_empty_and_constant_series(spark):
    df = frame(spark, {1: [5.0] * 3, 2: np.arange(30.0), 3: [None] * 30, 4: [7.0] * 30})
    start = (D0 + dt.timedelta(days=7 * 2)).isoformat()
    got = {(r.Store, r.Date): r.pred for r in arma.seasonal_arma_forecast(df, start, 4).collect()}
    assert got[1, D0 + dt.timedelta(days=14)] == 5.0  # the training mean
    late = (D0 + dt.timedelta(days=7 * 25)).isoformat()
    rows = arma.arma_parameters(df, late, 4).collect()
    assert len(rows) == 4 and all(abs(r.phi) <= arma.LIMIT and abs(r.theta) <= arma.LIMIT for r in rows)
    got = {(r.Store, (r.Date - D0).days // 7): r.pred for r in arma.seasonal_arma_forecast(df, late, 4).collect()}
    assert got[4, 27] == 7.0 and got[3, 27] is None
    assert arma.seasonal_arma_forecast(df.limit(0), late, 4).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    arma.seasonal_arma_forecast(frame(spark, {1: np.arange(30.0)}), "2000-06-01", 4).explain()
    assert "Python" not in capsys.readouterr().out
