import pytest
from pyspark.sql import functions as F

from panelcast.operators import evaluation as ev
from panelcast.operators import scoring as sc
from panelcast.sources import files
from conftest import weekly_panel


def test_panel_csv_round_trip(spark, tmp_dir):
    p = weekly_panel(spark, 2, 10)
    files.write_panel_csv(p, f"{tmp_dir}/panel")
    back = files.load_panel_csv(spark, f"{tmp_dir}/panel")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, p.collect()))


def test_bad_date_strict_and_lenient(spark, tmp_dir):
    path = f"{tmp_dir}/bad.csv"
    with open(path, "w") as fh:
        fh.write("Store,Date,Weekly_Sales,Holiday_Flag,Temperature,Fuel_Price,CPI,Unemployment\n")
        fh.write("1,05-02-2010,1643690.9,0,42.31,2.572,211.0963582,8.106\n")
        fh.write("1,2010/02/12,1641957.44,1,38.51,2.548,211.2421698,8.106\n")
    lenient = files.load_panel_csv(spark, path, strict=False).orderBy("Weekly_Sales").collect()
    assert lenient[0]["Date"] is None and lenient[1]["Date"].isoformat() == "2010-02-05"
    with pytest.raises(Exception):
        files.load_panel_csv(spark, path, strict=True).collect()


def test_predictions_round_trip(spark, tmp_dir):
    long = spark.createDataFrame(
        [(1, "2012-09-14", 10.0, "A", 11.0), (1, "2012-09-14", 10.0, "B", 9.5),
         (2, "2012-09-14", 20.0, "A", 19.0), (2, "2012-09-14", 20.0, "B", 21.0)],
        "Store int, Date string, actual double, model string, pred double").withColumn("Date", F.to_date("Date"))
    files.write_predictions(long, f"{tmp_dir}/pred", ["A", "B"])
    back = files.read_predictions(spark, f"{tmp_dir}/pred")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect()))


def test_metrics_json_reference_format(spark, tmp_dir):
    path = f"{tmp_dir}/metrics.json"
    with open(path, "w") as fh:
        fh.write('{\n  "RandomForest": {"WMAPE": 1.6275, "R2": 0.9975},\n  "XGBoost": {"WMAPE": 1.214}\n}\n')
    rows = {(r["model"], r["metric"]): r["value"] for r in files.read_metrics(spark, path).collect()}
    assert rows == {("RandomForest", "WMAPE"): 1.6275, ("RandomForest", "R2"): 0.9975,
                    ("XGBoost", "WMAPE"): 1.214}


def test_metrics_write_read(spark, tmp_dir):
    m = spark.createDataFrame([("a", 1.5, 2.5)], "model string, WMAPE double, MAE double")
    files.write_metrics(m, f"{tmp_dir}/m")
    rows = {(r["model"], r["metric"]): r["value"] for r in files.read_metrics(spark, f"{tmp_dir}/m").collect()}
    assert rows == {("a", "WMAPE"): 1.5, ("a", "MAE"): 2.5}


def _requests(spark):
    return spark.createDataFrame(
        [("1", "15-10-2010", 60.0, 3.0, 210.0, 8.0, True), ("2", "invalid-date", 60.0, 3.0, 210.0, 8.0, False)],
        sc.REQUEST_SCHEMA)


def test_request_features(spark):
    r = sc.request_features(_requests(spark)).orderBy("store_id").collect()
    assert r[0]["year"] == 2010 and r[0]["month"] == 10 and r[0]["week_of_year"] == 41
    assert r[0]["quarter"] == 4 and r[0]["temp_squared"] == 3600.0 and r[0]["cpi_unemployment"] == 1680.0
    assert r[1]["date"] is None


def test_score_requests_statuses(spark):
    panel = weekly_panel(spark, 2, 10)
    no_model = {r["store_id"]: r for r in sc.score_requests(_requests(spark), panel).collect()}
    assert no_model["1"]["status"] == sc.NO_MODEL
    assert no_model["2"]["status"] == sc.INVALID_DATE
    assert no_model["1"]["holiday_week"] == "Yes" and no_model["2"]["holiday_week"] == "No"


def test_score_requests_with_model(spark):
    from panelcast import config as C
    from panelcast.operators import ml
    panel = weekly_panel(spark, 2, 30)
    req = sc.requests_from_panel(panel, "1900-01-01")
    train = sc.request_features(req).join(
        panel.select("Store", F.col("Date").alias("date"), "Weekly_Sales"), ["Store", "date"])
    model = ml.fit("RandomForest", train, list(C.SCORING_FEATURES), {"n_estimators": 5, "max_depth": 3})
    out = {r["store_id"]: r for r in sc.score_requests(_requests(spark), panel, model).collect()}
    assert out["1"]["status"] == "ok" and out["1"]["prediction"] > 0
    assert out["1"]["trend"] in ("Above Average", "Below Average", "Near Average")
    assert out["2"]["status"] == sc.INVALID_DATE and out["2"]["prediction"] is None


def test_model_save_load_round_trip(spark, tmp_dir):
    from panelcast.operators import ml
    panel = weekly_panel(spark, 2, 30)
    cols = ["Temperature", "Fuel_Price", "CPI", "Unemployment"]
    model = ml.fit("RandomForest", panel, cols, {"n_estimators": 5, "max_depth": 3})
    ml.save_model(model, f"{tmp_dir}/m")
    loaded = ml.load_model(f"{tmp_dir}/m")
    a = [r["pred"] for r in ml.predict(model, panel, ["Store", "Date"]).orderBy("Store", "Date").collect()]
    b = [r["pred"] for r in ml.predict(loaded, panel, ["Store", "Date"]).orderBy("Store", "Date").collect()]
    assert a == b and ml.model_feature_columns(loaded) == cols
    imp = ml.importance_frame(spark, loaded, "rf")
    assert imp.count() == 4 and abs(sum(r["importance"] for r in imp.collect()) - 1) < 1e-9


def test_random_search_is_seeded(spark):
    from panelcast import config as C
    from panelcast.operators import ml
    a = ml.sample_params(C.XGB_SPACE, 5)
    b = ml.sample_params(C.XGB_SPACE, 5)
    assert a == b
    for p in a:
        assert 100 <= p["n_estimators"] <= 300 and 0.01 <= p["learning_rate"] <= 0.2


class _Flat:
    """Stands for a fitted model: the same prediction for every row."""

    def transform(self, df):
        return df.withColumn("pred", F.lit(100.0))


def _recorded_fits(monkeypatch):
    from panelcast.operators import ml
    fits = []

    def fit_all(names, train, cols, params=None):
        fits.extend((n, (params or {}).get(n, {})) for n in names)
        return {n: _Flat() for n in names}
    monkeypatch.setattr(ml, "fit_all", fit_all)
    return fits


def test_random_search_fits_every_candidate_in_full(spark, monkeypatch):
    """All 20 candidates of each of the three models, with the trees that they name, in one search."""
    from panelcast.operators import ml, trees
    from panelcast.plans import ml_queries
    asked = []
    monkeypatch.setattr(trees, "search", lambda train, tune, cols, label, specs: asked.append(specs) or [1.0] * len(specs))
    rows = weekly_panel(spark, 1, 30)
    monkeypatch.setattr(ml_queries, "_ml_data", lambda *_: (rows, rows, ["Store"]))
    got = ml_queries.q_random_search(spark, "").collect()
    assert len(asked) == 1 and len(asked[0]) == 60
    for name, space in ml.SPACES.items():
        want = sorted(p["n_estimators"] for p in ml.sample_params(space, 20))
        assert sorted(s.trees for s in asked[0] if s in [ml.ESTIMATORS[name](p) for p in ml.sample_params(space, 20)]) == want
        assert sorted(r.trial for r in got if r.model == name) == list(range(20))


def test_training_job_learns_from_full_models(spark, monkeypatch, tmp_dir):
    """The models behind gate and blend have the same trees as those that are blended."""
    from panelcast.operators import ml
    from panelcast.plans import ml_queries, training
    fits = _recorded_fits(monkeypatch)
    rows = weekly_panel(spark, 2, 30)
    monkeypatch.setattr(ml, "save_model", lambda *_: None)
    monkeypatch.setattr(training, "build_panel", lambda *_: rows)
    training.training_job(spark, "", tmp_dir, tune=False, skip_time_series=True, data=(rows, rows, ["Store"])).collect()
    full = {n: p for n, p in fits if not p}
    assert len(fits) == 6 and len(full) == 3 and all(not p for _, p in fits)

    seen = {}
    monkeypatch.setattr(ml_queries, "_ml_data", lambda *_: (rows, rows, ["Store"]))
    monkeypatch.setattr(ml_queries, "training_job", lambda *a, **k: seen.update(k))
    ml_queries.q_training_job(spark, "")
    assert seen.get("tune", True) and "fitted" not in seen
