import pytest
from pyspark.sql import functions as F

from panelcast.operators import forecast as fc
from conftest import make_panel, weekly_panel


def _wide(spark, actual, preds):
    names = sorted(preds)
    rows = []
    for i, a in enumerate(actual):
        rows.append((1, i, float(a), *[float(preds[m][i]) for m in names]))
    schema = "Store int, Date int, actual double, " + ", ".join(f"{m}_Pred double" for m in names)
    return spark.createDataFrame(rows, schema), names


def test_equal_weights(spark):
    wide, names = _wide(spark, [0, 0], {"a": [100, 200], "b": [200, 300]})
    out = [r["pred"] for r in fc.ensemble_predict(wide, names).orderBy("Date").collect()]
    assert out == pytest.approx([150, 250])


def test_custom_weights_and_unknown_model(spark):
    wide, names = _wide(spark, [0, 0], {"a": [100, 200], "b": [200, 300]})
    out = [r["pred"] for r in fc.ensemble_predict(wide, names, {"a": 0.75, "b": 0.25, "zz": 1.0})
           .orderBy("Date").collect()]
    assert out == pytest.approx([125, 225])


def test_weights_sum_to_one_and_beat_single_models(spark):
    actual = [105, 195, 305]
    preds = {"a": [100, 200, 300], "b": [110, 190, 310]}
    wide, names = _wide(spark, actual, preds)
    w = {r["model"]: r["weight"] for r in fc.ensemble_weights(wide, names).collect()}
    assert sum(w.values()) == pytest.approx(1.0)
    assert all(0 <= v <= 1 for v in w.values())
    blend = [sum(w[m] * preds[m][i] for m in names) for i in range(3)]
    err = sum(abs(a - b) for a, b in zip(actual, blend))
    assert err <= min(sum(abs(a - p) for a, p in zip(actual, preds[m])) for m in names) + 1e-9


def test_gate(spark):
    m = spark.createDataFrame([("a", 10.0), ("b", 60.0), ("c", 20.0)], "model string, WMAPE double")
    out = {r["model"]: r["blend"] for r in fc.ensemble_gate(m).collect()}
    assert out == {"a": True, "b": False, "c": True}
    one = spark.createDataFrame([("a", 10.0), ("b", 60.0)], "model string, WMAPE double")
    assert not any(r["blend"] for r in fc.ensemble_gate(one).collect())


def test_seasonal_ar_forecasts_every_validation_row(spark):
    p = weekly_panel(spark, 2, 120)
    out = fc.seasonal_ar_forecast(p, "2012-01-01").toPandas()
    n_val = p.filter(F.col("Date") >= "2012-01-01").count()
    assert len(out) == n_val and out["pred"].notna().all()


def test_seasonal_ar_recovers_pure_seasonal_series(spark):
    import datetime as dt
    rows = []
    d0 = dt.date(2010, 1, 1)
    for w in range(140):
        rows.append((1, (d0 + dt.timedelta(days=7 * w)).isoformat(), 1000.0 + (w % 52) * 10))
    from conftest import make_panel
    p = make_panel(spark, rows)
    out = fc.seasonal_ar_forecast(p, (d0 + dt.timedelta(days=7 * 130)).isoformat()).toPandas()
    assert (out["pred"] - out["actual"]).abs().max() < 1e-6


def test_trend_seasonal_forecast(spark):
    p = weekly_panel(spark, 2, 120)
    out = fc.trend_seasonal_forecast(p, "2012-01-01").toPandas()
    assert len(out) == p.filter(F.col("Date") >= "2012-01-01").count()
    assert (out["pred"] > 0).all()


def test_weights_on_empty_input(spark):
    wide, names = _wide(spark, [], {"a": [], "b": []})
    w = {r["model"]: r["weight"] for r in fc.ensemble_weights(wide, names).collect()}
    assert sum(w.values()) == pytest.approx(1.0)


def test_five_model_blend(spark):
    actual = [100, 200, 300, 400]
    preds = {m: [a * (1 + 0.05 * (i - 2)) for a in actual] for i, m in enumerate("abcde")}
    wide, names = _wide(spark, actual, preds)
    w = {r["model"]: r["weight"] for r in fc.ensemble_weights(wide, names).collect()}
    assert sum(w.values()) == pytest.approx(1.0) and w["c"] == pytest.approx(1.0)


def test_blend_recovers_any_number_of_models(spark):
    """Exact blends of five and six models, within 0.01, and of two."""
    import numpy as np
    rng = np.random.default_rng(11)
    for true in ((.15, .25, .25, .15, .20), (.12, .23, .17, .05, .13, .30), (.4, .6), (0., 1., 0., 0.)):
        x = rng.uniform(50, 150, (200, len(true)))
        names = [f"m{i}" for i in range(len(true))]
        wide = spark.createDataFrame(
            [(float(r @ np.array(true)), *map(float, r)) for r in x] + [(None, *[1.0] * len(true)), (5.0, *[None] * len(true))],
            "actual double, " + ", ".join(f"{n}_Pred double" for n in names))
        got = {r["model"]: r["weight"] for r in fc.ensemble_weights(wide, names).collect()}
        assert sum(got.values()) == pytest.approx(1.0)
        assert [got[n] for n in names] == pytest.approx(list(true), abs=0.0101)


def test_blend_is_least_absolute_error_on_the_lattice(spark):
    import itertools
    import numpy as np
    rng = np.random.default_rng(5)
    x = rng.uniform(50, 150, (60, 3))
    a = x @ np.array([.3, .3, .4]) + rng.normal(0, 30, 60)
    wide = spark.createDataFrame([(float(y), *map(float, r)) for y, r in zip(a, x)],
                                 "actual double, p_Pred double, q_Pred double, r_Pred double")
    got = [r["weight"] for r in fc.ensemble_weights(wide, ["p", "q", "r"]).collect()]
    grid = [(i, j, 100 - i - j) for i, j in itertools.product(range(101), repeat=2) if i + j <= 100]
    want = min(np.abs(a - x @ (np.array(g) / 100)).sum() for g in grid)
    assert np.abs(a - x @ np.array(got)).sum() == pytest.approx(want, rel=1e-6)


def test_short_series_and_zero_weeks_keep_the_model(spark):
    """Neither seven training rows nor one zero week turn the regression into a mean."""
    rows = [(s, f"2012-0{1 + i // 4}-{1 + 7 * (i % 4):02d}", 0.0 if (s, i) == (2, 3) else 100.0 * 1.1 ** i)
            for s in (1, 2) for i in range(12)]
    p = make_panel(spark, rows)
    out = fc.trend_seasonal_forecast(p, "2012-02-22").collect()
    for s in (1, 2):
        preds = [r["pred"] for r in out if r["Store"] == s]
        assert len(preds) == 5 and len({round(v, 6) for v in preds}) > 1
    nulls = p.withColumn("CPI", F.when(F.col("Date") == "2012-01-08", None).otherwise(F.col("CPI")))
    assert all(r["pred"] == r["pred"] for r in fc.trend_seasonal_forecast(nulls, "2012-02-22").collect())


def test_gate_and_blend_are_learned_together(spark):
    from panelcast.plans.training import blend_of
    rows = [(1, f"2012-01-{d:02d}", 100.0 + d, m, (100.0 + d) * f)
            for d in range(1, 20) for m, f in (("good", 1.1), ("low", 0.9), ("bad", 3.0))]
    long = spark.createDataFrame(rows, "Store int, Date string, actual double, model string, pred double") \
        .withColumn("Date", F.to_date("Date"))
    assert blend_of(long) == pytest.approx({"good": 0.5, "low": 0.5})
    assert blend_of(long.filter("model != 'low'")) == {}
