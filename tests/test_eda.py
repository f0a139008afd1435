import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators import eda
from panelcast.operators import evaluation as ev
from panelcast.operators import panel as P
from conftest import weekly_panel


@pytest.fixture(scope="module")
def panel_pdf(spark):
    p = weekly_panel(spark, 3, 80, seed=7)
    p = p.withColumn("Holiday_Flag", (F.dayofmonth("Date") <= 7).cast("int"))
    return p, p.toPandas()


def test_sales_by_store_and_date(panel_pdf):
    p, pdf = panel_pdf
    got = {r["Store"]: r["Weekly_Sales"] for r in eda.sales_by_store(p).collect()}
    exp = pdf.groupby("Store")["Weekly_Sales"].mean()
    for s, v in exp.items():
        assert got[s] == pytest.approx(v, rel=1e-12)
    by_date = eda.sales_by_date(p).toPandas()
    assert len(by_date) == pdf["Date"].nunique()


def test_seasonality_month_names(panel_pdf):
    p, pdf = panel_pdf
    out = eda.seasonality(p).toPandas()
    pdf = pdf.assign(m=pd.to_datetime(pdf["Date"]).dt.month,
                     n=pd.to_datetime(pdf["Date"]).dt.month_name())
    exp = pdf.groupby(["m", "n"])["Weekly_Sales"].mean().reset_index()
    assert out["Month"].tolist() == exp["m"].tolist()
    assert out["Month_Name"].tolist() == exp["n"].tolist()
    np.testing.assert_allclose(out["Weekly_Sales"], exp["Weekly_Sales"], rtol=1e-12)


def test_store_month_pivot_matches_pandas(panel_pdf):
    p, pdf = panel_pdf
    out = eda.store_month_pivot(p).toPandas().set_index("Store").sort_index()
    pdf = pdf.assign(Month=pd.to_datetime(pdf["Date"]).dt.month)
    exp = pdf.pivot_table(values="Weekly_Sales", index="Store", columns="Month", aggfunc="mean")
    for m in exp.columns:
        np.testing.assert_allclose(out[f"month_{m}"], exp[m], rtol=1e-12)


def test_correlation_matrix_matches_pandas(panel_pdf):
    p, pdf = panel_pdf
    out = eda.correlation_matrix(p, digits=12).toPandas()
    cols = list(eda.CORR_COLUMNS)
    exp = pdf[cols].astype(float).corr()
    for _, r in out.iterrows():
        assert r["corr"] == pytest.approx(exp.loc[r["var1"], r["var2"]], abs=1e-9)
    assert len(out) == len(cols) ** 2


def test_histogram_counts_cover_all_rows(panel_pdf):
    p, pdf = panel_pdf
    h = eda.sales_histogram(p).toPandas()
    assert h["count"].sum() == len(pdf)
    assert h["bin"].between(0, 49).all()
    assert h["bin_start"].min() == pytest.approx(pdf["Weekly_Sales"].min())
    assert h["bin_end"].max() == pytest.approx(pdf["Weekly_Sales"].max())


def test_holiday_box_quartiles(panel_pdf):
    p, pdf = panel_pdf
    out = {r["Holiday"]: r for r in eda.holiday_box(p, digits=12).collect()}
    for flag, label in ((1, "Holiday"), (0, "Non-Holiday")):
        s = pdf.loc[pdf["Holiday_Flag"] == flag, "Weekly_Sales"]
        assert out[label]["q1"] == pytest.approx(s.quantile(0.25))
        assert out[label]["median"] == pytest.approx(s.median())
        assert out[label]["q3"] == pytest.approx(s.quantile(0.75))
        assert out[label]["count"] == len(s)


def test_residual_histogram_and_actual_vs_predicted(spark):
    rows = [(1, f"2012-09-{d:02d}", float(100 + d), m, float(100 + d + (3 if m == "a" else -5)))
            for d in range(1, 29) for m in ("a", "b")]
    long = spark.createDataFrame(rows, "Store int, Date string, actual double, model string, pred double")
    rh = eda.residual_histogram(long).toPandas()
    assert rh.groupby("model")["count"].sum().tolist() == [28, 28]
    assert sorted(rh["mean_residual"].unique().tolist()) == [-3.0, 5.0]
    avp = eda.actual_vs_predicted(long).toPandas()
    assert len(avp) == 56


def test_align_predictions_and_unmatched(spark):
    actuals = spark.createDataFrame([(1, "d1", 10.0), (1, "d2", 20.0)],
                                    "Store int, Date string, Weekly_Sales double")
    long = spark.createDataFrame([(1, "d1", 10.0, "a", 11.0), (1, "d2", 20.0, "a", 19.0),
                                  (1, "d3", 30.0, "a", 31.0)],
                                 "Store int, Date string, actual double, model string, pred double")
    wide = ev.align_predictions(actuals, long, ["a"]).orderBy("Date").collect()
    assert [r["a_Pred"] for r in wide] == [11.0, 19.0]
    assert ev.unmatched_predictions(actuals, long).count() == 1


def test_panel_summary_matches_pandas(panel_pdf):
    p, pdf = panel_pdf
    r = P.panel_summary(p).first()
    assert r["n_rows"] == len(pdf) and r["n_stores"] == 3
    assert r["sales_mean"] == pytest.approx(pdf["Weekly_Sales"].mean(), rel=1e-12)
    assert r["sales_median"] == pytest.approx(pdf["Weekly_Sales"].median())
    assert r["holiday_pct"] == pytest.approx(pdf["Holiday_Flag"].mean() * 100, abs=1e-6)
    assert [x[0] for x in P.store_list(p).collect()] == [1, 2, 3]


def test_history_table(spark):
    rows = [(1, "2012-09-07", 100.0, "m", 110.0), (1, "2012-09-14", 100.0, "m", 90.0),
            (1, "2012-09-21", 100.0, "m", 100.0)]
    long = spark.createDataFrame(rows, "Store int, Date string, actual double, model string, pred double")
    h = ev.history_table(long).orderBy("epoch").collect()
    assert [r["val_WMAPE"] for r in h] == [10.0, 10.0, 0.0]
    assert h[0]["train_WMAPE"] is None and h[2]["train_WMAPE"] == pytest.approx(10.0)
    assert ev.best_epoch(ev.history_table(long)).first()["best_epoch"] == 2


def test_append_history_accumulates(spark, tmp_dir):
    rows = [("m", 0, None, 12.0), ("m", 1, 12.0, 10.0)]
    h = spark.createDataFrame(rows, "model string, epoch int, train_WMAPE double, val_WMAPE double")
    ev.append_history(h, f"{tmp_dir}/hist")
    both = ev.append_history(h.withColumn("model", F.lit("n")), f"{tmp_dir}/hist")
    assert both.count() == 4
    assert {r["model"]: r["best_epoch"] for r in ev.best_epoch(both).collect()} == {"m": 1, "n": 1}


def test_histogram_nulls_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (None,), (None,)], "x double")
    got = eda.equal_width_histogram(df, "x", bins=5).orderBy("bin").collect()
    assert [r["count"] for r in got] == [1, 0, 0, 0, 1]
    assert eda.equal_width_histogram(df.filter("false"), "x", bins=5).count() == 0


def test_append_history_commits_once(spark, tmp_dir, monkeypatch):
    """A failed run leaves nothing, its retry and its repeat add each entry once."""
    from pyspark.sql import DataFrameWriter
    path = f"{tmp_dir}/committed"
    h = spark.createDataFrame([("m", 0, 5.0), ("m", 1, 4.0)], "model string, epoch int, val_WMAPE double")
    assert ev.append_history(h, path, "a/1").count() == 2
    write = DataFrameWriter.parquet

    def lost(self, at, *args, **kwargs):
        if "manifest" in at:
            raise RuntimeError("lost before the commit")
        return write(self, at, *args, **kwargs)
    monkeypatch.setattr(DataFrameWriter, "parquet", lost)
    with pytest.raises(RuntimeError):
        ev.append_history(h.withColumn("model", F.lit("n")), path, "a/2")
    monkeypatch.undo()
    assert ev.read_history(spark, path, h.schema).count() == 2
    for _ in range(2):
        got = ev.append_history(h.withColumn("model", F.lit("n")), path, "a/2")
        assert sorted(map(tuple, got.collect())) == [("m", 0, 5.0), ("m", 1, 4.0), ("n", 0, 5.0), ("n", 1, 4.0)]
    # two attempts that both got through count as one
    other = spark.createDataFrame([("b", "x"), ("b", "w")], "run string, attempt string")
    for a in "xw":
        h.withColumn("model", F.lit(a)).write.parquet(f"{path}/data/b-{a}")
    other.write.mode("append").parquet(f"{path}/manifest")
    assert {r.model for r in ev.read_history(spark, path, h.schema).collect()} == {"m", "n", "w"}
    assert ev.read_history(spark, f"{path}/none", h.schema).count() == 0
