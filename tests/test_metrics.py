import pytest
from pyspark.sql import functions as F

from panelcast.functions import metrics as M
from panelcast.operators import evaluation as ev


def _agg(spark, actual, pred, builder):
    df = spark.createDataFrame(list(zip(map(float, actual), map(float, pred))), "actual double, pred double")
    return df.agg(builder("actual", "pred").alias("m")).first()["m"]


def test_wmape_known_value(spark):
    assert _agg(spark, [100, 200], [110, 190], M.wmape) == pytest.approx(6.6667, abs=1e-4)


def test_wmape_zero_sum_is_null(spark):
    assert _agg(spark, [0, 0, 0], [1, 2, 3], M.wmape) is None


def test_wmape_uses_signed_denominator(spark):
    assert _agg(spark, [100, -50], [110, -40], M.wmape) == pytest.approx(40.0)


def test_mape_known_value(spark):
    assert _agg(spark, [100, 200], [110, 220], M.mape) == pytest.approx(10.0)


def test_mape_skips_zero_actuals(spark):
    assert _agg(spark, [0, 100, 200], [10, 100, 200], M.mape) == pytest.approx(0.0)


def test_mape_all_zero_is_null(spark):
    assert _agg(spark, [0, 0, 0], [1, 2, 3], M.mape) is None


def test_smape_zero_denominators(spark):
    assert _agg(spark, [0, 100], [0, 100], M.smape) == pytest.approx(0.0)
    assert _agg(spark, [0, 0], [0, 0], M.smape) == pytest.approx(0.0)


def test_perfect_predictions(spark):
    vals = [100.0, 250.0, 300.0, 410.0]
    df = spark.createDataFrame([(v, v) for v in vals], "actual double, pred double")
    row = ev.all_metrics(df, by=()).first()
    for k in ("WMAPE", "MAPE", "SMAPE", "MAE", "RMSE", "Mean_Error", "Median_AE"):
        assert row[k] == pytest.approx(0.0)
    assert row["R2"] == pytest.approx(1.0)


def test_all_metrics_match_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(42)
    a = rng.uniform(5e5, 2e6, 100)
    p = a * rng.uniform(0.9, 1.1, 100)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, p)], "actual double, pred double")
    row = ev.all_metrics(df, by=(), digits=None).first()
    assert row["WMAPE"] == pytest.approx(np.abs(a - p).sum() / a.sum() * 100)
    assert row["MAE"] == pytest.approx(np.abs(a - p).mean())
    assert row["RMSE"] == pytest.approx(np.sqrt(((a - p) ** 2).mean()))
    assert row["R2"] == pytest.approx(1 - ((a - p) ** 2).sum() / ((a - a.mean()) ** 2).sum())
    assert row["Mean_Error"] == pytest.approx((p - a).mean())
    assert row["Median_AE"] == pytest.approx(np.median(np.abs(a - p)))


def test_per_store_and_period(spark):
    rows = [(1, 0, 100.0, 110.0), (1, 1, 200.0, 190.0), (2, 0, 0.0, 5.0), (2, 1, 0.0, 5.0)]
    long = spark.createDataFrame(rows, "Store int, Holiday_Flag int, actual double, pred double") \
        .withColumn("model", F.lit("m"))
    per = {r["Store"]: r["WMAPE"] for r in ev.wmape_per_store(long).collect()}
    assert per[1] == pytest.approx(6.666667, abs=1e-6)
    assert per[2] is None          # zero actual sum -> NULL, not an error
    period = {r["Holiday_Flag"]: (r["WMAPE"], r["Count"]) for r in ev.wmape_per_period(long).collect()}
    assert period[0][1] == 2 and period[1][1] == 2


def test_model_rank_and_best(spark):
    m = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 4.0)], "model string, WMAPE double")
    ranked = ev.model_rank(m).collect()
    assert ranked[0]["model"] == "b" and ranked[0]["Rank"] == 1
    assert ev.best_model(m).first()["best_model"] == "b"


def test_best_epoch(spark):
    h = spark.createDataFrame([("m", 0, 15.0), ("m", 1, 12.0), ("m", 2, 14.0)],
                              "model string, epoch int, val_WMAPE double")
    assert ev.best_epoch(h).first()["best_epoch"] == 1
    assert ev.best_epoch(h, "val_missing").first()["best_epoch"] == -1


def test_metrics_report_format(spark):
    m = spark.createDataFrame([("x", 1.23456, 12345.6, 17000.4, 0.99891)],
                              "model string, WMAPE double, MAE double, RMSE double, R2 double")
    r = ev.metrics_report(m).first()
    assert (r["WMAPE"], r["MAE"], r["RMSE"], r["R2"]) == ("1.23%", "$12,346", "$17,000", "0.9989")


def test_rows_without_a_prediction_do_not_count(spark):
    rows = [(100.0, 150.0, "m"), (400.0, None, "m"), (None, 5.0, "m"), (10.0, None, "empty")]
    long = spark.createDataFrame(rows, "actual double, pred double, model string")
    got = {r["model"]: r for r in ev.all_metrics(long).collect()}
    assert got["m"]["WMAPE"] == pytest.approx(50.0) and got["m"]["Median_AE"] == 50.0
    assert all(got["empty"][n] is None for n in M.METRIC_NAMES)


def test_format_metrics(spark):
    m = spark.createDataFrame([("m", 12.345, 1.0, 2.0, 1234.5, 99.9, 0.5, -1500.0, 7.0)],
                              "model string, " + ", ".join(f"{n} double" for n in M.METRIC_NAMES))
    row = ev.format_metrics(m).first()
    assert (row["WMAPE"], row["MAE"], row["R2"], row["Mean_Error"]) == ("12.35%", "$1,234", "0.5000", "-$1,500")
