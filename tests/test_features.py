import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators import calendar_features as cf
from panelcast.operators import economic as eco
from panelcast.operators import entity as ent
from panelcast.operators import history as hist
from panelcast.operators import panel as P
from panelcast.plans.features import engineer_features, engineer_features_split, feature_columns
from conftest import make_panel, weekly_panel


def _pdf(df):
    return df.toPandas().sort_values(["Store", "Date"]).reset_index(drop=True)


def test_lag_equals_previous_row(spark):
    p = weekly_panel(spark, 2, 20)
    out = _pdf(hist.lag_features(p, lags=(1, 4)))
    for _, g in out.groupby("Store"):
        assert g["sales_lag_1"].iloc[1:].tolist() == g["Weekly_Sales"].iloc[:-1].tolist()
        assert g["sales_lag_1"].isna().iloc[0]
        assert g["sales_lag_4"].iloc[4:].tolist() == g["Weekly_Sales"].iloc[:-4].tolist()


def test_rolling_matches_pandas(spark):
    p = weekly_panel(spark, 2, 40)
    out = _pdf(hist.rolling_features(p))
    for _, g in out.groupby("Store"):
        s = g["Weekly_Sales"].shift(1)
        for w in (4, 8, 12, 26):
            np.testing.assert_allclose(g[f"rolling_mean_{w}w"], s.rolling(w, min_periods=1).mean(), rtol=1e-12)
            np.testing.assert_allclose(g[f"rolling_std_{w}w"], s.rolling(w, min_periods=2).std(), rtol=1e-9)
        np.testing.assert_allclose(g["rolling_min_4w"], s.rolling(4, min_periods=1).min())
        np.testing.assert_allclose(g["rolling_max_8w"], s.rolling(8, min_periods=1).max())


def test_ewma_matches_pandas(spark):
    p = weekly_panel(spark, 2, 300)
    out = _pdf(hist.ewma_features(p))
    for _, g in out.groupby("Store"):
        s = g["Weekly_Sales"].shift(1)
        for span in (4, 8, 12):
            np.testing.assert_allclose(g[f"ewma_{span}w"], s.ewm(span=span, min_periods=1).mean(), rtol=1e-12)


def test_sin_cos_identity(spark):
    out = cf.cyclical_features(cf.temporal_features(weekly_panel(spark, 1, 60))).toPandas()
    for p in ("month", "week", "day_of_year", "quarter"):
        np.testing.assert_allclose(out[f"{p}_sin"] ** 2 + out[f"{p}_cos"] ** 2, 1.0)


def test_iso_week(spark):
    r = cf.temporal_features(make_panel(spark, [(1, "2010-01-01", 1.0)])).first()
    assert r["week_of_year"] == 53 and r["is_year_start"] == 1 and r["week_of_month"] == 1


def test_store_rank_average_ties_and_percentile(spark):
    stats = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 20.0), (4, 5.0)], "Store int, store_mean_sales double")
    out = ent.store_rank(stats).toPandas().sort_values("Store")
    exp_rank = out["store_mean_sales"].rank(ascending=False)
    exp_pct = out["store_mean_sales"].rank(pct=True)
    np.testing.assert_allclose(out["store_rank"], exp_rank)
    np.testing.assert_allclose(out["store_percentile"], exp_pct)


def test_store_size_matches_pandas_cut(spark):
    means = [5.0, 7.0, 9.5, 12.0, 15.0, 15.0, 6.3]
    stats = spark.createDataFrame([(i, m) for i, m in enumerate(means)], "Store int, store_mean_sales double")
    out = ent.store_size_bins(stats).toPandas().sort_values("Store")
    exp = pd.cut(pd.Series(means), bins=3, labels=["small", "medium", "large"]).astype(str)
    assert out["store_size"].tolist() == exp.tolist()
    same = spark.createDataFrame([(1, 3.0), (2, 3.0)], "Store int, store_mean_sales double")
    assert {r["store_size"] for r in ent.store_size_bins(same).collect()} == {"medium"}


def test_temp_category_right_closed(spark):
    rows = [(1, f"2010-0{1 + i}-01", 1.0, 0, t) for i, t in enumerate([32.0, 32.01, 50.0, 70.0, 85.0, 85.5])]
    out = eco.temperature_features(make_panel(spark, rows)).orderBy("Date").toPandas()
    assert out["temp_category"].tolist() == ["freezing", "cold", "cold", "mild", "warm", "hot"]


def test_train_statistics_reused_for_validation(spark):
    p = weekly_panel(spark, 2, 60)
    f = engineer_features_split(p, "2011-01-01").toPandas()
    train = f[f["split"] == "train"]
    val = f[f["split"] == "validation"]
    for s, g in train.groupby("Store"):
        assert val[val["Store"] == s]["store_mean_sales"].nunique() == 1
        assert val[val["Store"] == s]["store_mean_sales"].iloc[0] == pytest.approx(g["Weekly_Sales"].mean())
    # economic changes restart at the split boundary
    first_val = val.sort_values("Date").groupby("Store").head(1)
    assert first_val["fuel_change"].isna().all()


def test_leak_safe_features_ignore_current_target(spark):
    p = weekly_panel(spark, 1, 60)
    t = sorted(r["Date"] for r in p.select("Date").collect())[50]
    bumped = p.withColumn("Weekly_Sales", F.when(F.col("Date") >= t, F.col("Weekly_Sales") * 3)
                          .otherwise(F.col("Weekly_Sales")))
    a = engineer_features(p, leak_safe=True, train=p.filter(F.col("Date") < t))
    b = engineer_features(bumped, leak_safe=True, train=bumped.filter(F.col("Date") < t))
    cols = [c for c in feature_columns(a) if c not in ("Weekly_Sales",)]
    ra = a.filter(F.col("Date") == t).select(cols).first().asDict()
    rb = b.filter(F.col("Date") == t).select(cols).first().asDict()
    assert ra == rb


def test_feature_count(spark):
    f = engineer_features_split(weekly_panel(spark, 2, 60), "2011-01-01")
    assert len(feature_columns(f)) == 83


def test_fill_missing_store_mean(spark):
    p = make_panel(spark, [(1, "2010-01-01", 1.0, 0, -999.0), (1, "2010-01-08", 2.0, 0, 40.0),
                           (1, "2010-01-15", 3.0, 0, 60.0), (2, "2010-01-01", 5.0, 0, -999.0)])
    p = p.withColumn("Temperature", F.when(F.col("Temperature") != -999.0, F.col("Temperature")))
    out = {(r["Store"], r["Date"].isoformat()): r["Temperature"]
           for r in P.fill_missing_store_mean(p).collect()}
    assert out[(1, "2010-01-01")] == pytest.approx(50.0)
    assert out[(2, "2010-01-01")] is None


def test_validate_panel(spark):
    rows = [(1, "2010-01-01", -100.0), (1, "2010-01-08", -200.0), (1, "2010-01-08", -200.0),
            (2, "2010-01-01", 5.0)]
    r = P.validate_panel(make_panel(spark, rows)).first()
    assert r["total_rows"] == 4 and r["duplicates"] == 1 and r["negative_sales"] == 3
    assert r["n_stores"] == 2 and r["n_weeks"] == 2 and r["complete_coverage"] is True


def test_time_split_disjoint_and_complete(spark):
    p = weekly_panel(spark, 2, 30)
    tr, va = P.time_split(p, "2010-06-01")
    assert tr.count() + va.count() == p.count()
    assert tr.join(va, ["Store", "Date"]).count() == 0


def test_store_rank_leaves_out_entities_without_a_mean(spark):
    stats = spark.createDataFrame([(1, 10.0), (2, None), (3, 30.0), (4, 10.0)], "Store int, store_mean_sales double")
    got = {r["Store"]: (r["store_rank"], r["store_percentile"]) for r in ent.store_rank(stats).collect()}
    assert got[1] == got[4] == (2.5, 0.5)
    assert got[3] == (1.0, 1.0)
    assert got[2] == (None, None)


def test_guarded_restart_equals_split_partition(spark):
    p = P.with_split(weekly_panel(spark, 3, 40), "2010-08-01")
    a = hist.economic_changes(p, hist.C.ENTITY, restart_col="split")
    b = hist.economic_changes(p, ["split", hist.C.ENTITY])
    cols = ["Store", "Date", "fuel_change", "fuel_pct_change", "cpi_change", "cpi_pct_change",
            "unemployment_change"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_positions_and_quantiles_against_pandas(spark):
    import numpy as np
    import pandas as pd
    from panelcast.operators import order
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 500), "v": np.where(rng.random(500) < .3, 7.0, rng.normal(0, 1e4, 500).round(1))})
    pdf.loc[::50, "v"] = np.nan
    df = spark.createDataFrame([(int(g), None if v != v else float(v)) for g, v in pdf.values], "g int, v double")
    got = order.quantiles(df, "v", {"a": .1, "b": .5, "c": 1.0}, ["g"]).toPandas().set_index("g")
    for g, s in pdf.groupby("g").v:
        assert got.loc[g].tolist() == pytest.approx([s.quantile(q) for q in (.1, .5, 1.0)])
    ranks = {r["v"]: r["rank"] for r in order.average_ranks(df, "v").collect()}
    want = dict(zip(pdf.v, pdf.v.rank()))
    assert ranks == pytest.approx({v: r for v, r in want.items() if v == v})
    assert order.quantiles(df.filter("false"), "v", {"a": .5}, ["g"]).count() == 0


def test_ewma_equals_pandas(spark):
    """All rows weigh in, a null row ages the others, blocks join without a seam."""
    import numpy as np
    import pandas as pd
    from panelcast import config as C
    from panelcast.operators import history
    rng = np.random.default_rng(3)
    series = {1: [1e6] + [0.0] * 89, 2: [1.0, None, 2.0, 3.0], 3: [None, 5.0, None, 6.0],
              4: rng.uniform(1, 100, 1200).tolist()}
    rows = [(s, i, None if y is None else float(y)) for s, ys in series.items() for i, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "Store int, Date int, Weekly_Sales double")
    got = history.ewma_features(df).toPandas().sort_values(["Store", "Date"])
    for s, ys in series.items():
        for span in C.EWMA_SPANS:
            want = pd.Series(ys, dtype=float).ewm(span=span, adjust=True).mean().shift(1)
            have = got.loc[got.Store == s, f"ewma_{span}w"].to_numpy()
            assert np.allclose(have, want, rtol=1e-9, atol=0, equal_nan=True), (s, span)


def test_rows_without_a_date_are_in_no_split(spark):
    from panelcast.operators import panel as P
    df = spark.createDataFrame([("2012-01-01",), (None,)], "Date string").withColumn("Date", F.to_date("Date"))
    assert [r["split"] for r in P.with_split(df).orderBy("Date").collect()] == [None, "validation"]


def test_missing_value_strategies(spark):
    from panelcast.operators import panel as P
    df = spark.createDataFrame([(1, 2.0), (1, None)], "Store int, x double")
    assert P.handle_missing(df, "drop").count() == 1
    assert [r["x"] for r in P.handle_missing(df, "fill").collect()] == [2.0, 2.0]
    with pytest.raises(ValueError):
        P.handle_missing(df, "guess")


@pytest.mark.parametrize("spread", [2_000.0, 1e-3, 1e12])
def test_close_values_spread_over_buckets(spark, spread):
    """Values that lie close together are dealt out like any other, and ranks stay exact."""
    from panelcast.operators import order
    n = 30_000
    df = spark.range(n).select((1e6 + F.pmod(F.col("id") * 7919, F.lit(n)) * (spread / n)).alias("v"))
    counts = df.groupBy(F.col("v").alias("_v")).agg(F.count("*").alias("_c"))
    sizes = [r["count"] for r in order.with_buckets(counts).groupBy("_b").count().collect()]
    assert len(sizes) > 500 and max(sizes) <= 6 * n / order.LEVEL**2
    values = sorted(r.v for r in df.collect())
    got = {r.v: r["rank"] for r in order.average_ranks(df, "v").collect()}
    assert all(got[v] == i + 1 for i, v in enumerate(values) if i % 1000 == 0 and values.count(v) == 1)


def test_tasks_of_wide_features_hold_a_bounded_number_of_rows(spark, monkeypatch):
    """Twice the series are twice the tasks, through all windows; no row changes."""
    from panelcast.plans import queries as Q
    monkeypatch.setattr(P, "SERIES_ROWS", 120)
    monkeypatch.setattr(Q, "_PANELS", {})
    stored = {}
    monkeypatch.setattr(Q, "build_panel", lambda spark, sf, grain: stored[sf])
    tasks = {}
    for stores in (12, 24):
        stored[str(stores)] = weekly_panel(spark, stores, 40)
        got = Q.featured(spark, str(stores))
        tasks[stores] = [n for (n,) in got.groupBy(F.spark_partition_id()).agg(F.count("*")).select("count(1)").collect()]
        want = engineer_features_split(weekly_panel(spark, stores, 40))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert max(tasks[12]) < 360 and max(tasks[24]) < 360
    assert len(tasks[24]) > len(tasks[12]) >= 3
    small = weekly_panel(spark, 2, 40)
    assert P.by_series(small) is small
