import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators import history as hist
from panelcast.operators import long_series as ls

SCHEMA = "Store int, Date date, Weekly_Sales double, Fuel_Price double, CPI double, Unemployment double"


@pytest.fixture(scope="module")
def series(spark):
    """A hot series, two short ones, a null entity; missing targets."""
    rng = np.random.default_rng(5)
    rows, day = [], dt.date(2000, 1, 7)
    for store, n in ((1, 700), (2, 61), (3, 1), (None, 130)):
        for i in range(n):
            y = None if rng.random() < 0.1 or (store == 1 and 200 <= i < 290) else round(float(rng.uniform(10, 999)), 2)
            rows.append((store, day + dt.timedelta(days=7 * i), y, *(round(float(x), 3) for x in rng.uniform(2, 9, 3))))
    rng.shuffle(rows)
    rows = [(None if r[0] is None else int(r[0]), *r[1:]) for r in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(6).cache()


def _same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    cols = want.columns
    a, b = (sorted((tuple(r) for r in d.select(*cols).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])) for d in (got, want))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for c, u, v in zip(cols, x, y):
            if isinstance(v, float) and u is not None:
                assert u == pytest.approx(v, rel=1e-9, abs=1e-9), (c, x, y)
            else:
                assert u == v, (c, x, y)


@pytest.mark.parametrize("task_rows", [1, 100, 10_000])
def test_positions(series, task_rows):
    got = ls.numbered(series, task_rows=task_rows).toPandas()
    for _, g in got.groupby("Store", dropna=False):
        g = g.sort_values("Date")
        assert g["_pos"].tolist() == list(range(len(g)))


def test_blocks_equal_the_plain_windows(series):
    rows = ls.numbered(series, task_rows=90)
    w = hist.series_window()
    _same(ls.lag_features(rows, block=60).drop("_pos"), hist.lag_features(series))
    _same(ls.rolling_features(rows, block=30).drop("_pos"), series.withColumns(hist.rolling_columns("Weekly_Sales", w)))
    rolled = series.withColumns(hist.rolling_columns("Weekly_Sales", w, windows=(4,)))
    for leak_safe in (False, True):
        _same(ls.trend_features(ls.numbered(rolled), leak_safe=leak_safe, block=7).drop("_pos"),
              hist.trend_features(rolled, leak_safe=leak_safe))
    split = series.withColumn("split", F.when(F.col("Date") < "2003-01-01", "train").otherwise("val"))
    _same(ls.economic_changes(ls.numbered(split), restart_col="split", block=3).drop("_pos"),
          hist.economic_changes(split, restart_col="split"))


@pytest.mark.parametrize("block,states", [(512, 4096), (40, 200), (16, 120), (7, 260)])
def test_ewma_equals_the_plain_one(series, block, states):
    """Also through a gap of 90 rows without a value."""
    got = ls.ewma_features(ls.numbered(series, task_rows=200), block=block, states_block=states).drop("_pos")
    _same(got, hist.ewma_features(series))


def test_ewma_against_pandas_over_many_blocks(spark):
    values = np.random.default_rng(2).uniform(0, 1000, 3000)
    df = spark.createDataFrame(pd.DataFrame({"e": 1, "t": range(3000), "y": values}))
    got = ls.ewma_features(ls.numbered(df, "e", "t", 500), (4, 60), "e", "y", block=64).toPandas().sort_values("t")
    shifted = pd.Series(values).shift(1)
    for span in (4, 60):
        np.testing.assert_allclose(got[f"ewma_{span}w"], shifted.ewm(span=span, min_periods=1).mean(), rtol=1e-11)


def test_all_features_at_once(series):
    want = hist.lag_features(series)
    want = hist.trend_features(hist.rolling_features(want))
    _same(ls.history_features(series, block=64, task_rows=150), want)


def test_no_task_holds_the_hot_series(series):
    rows = ls.numbered(series, task_rows=100)
    blocks = ls.with_halo(rows, halo=52, block=64)
    sizes = blocks.groupBy("Store", "_block").agg(F.count("*").alias("n"), F.sum(F.col("_own").cast("int")).alias("own"))
    most = sizes.agg(F.max("n"), F.max("own")).first()
    assert most[0] <= 64 + 52 and most[1] == 64
    assert blocks.filter("_own").count() == series.count()


def test_ties_repeats_and_empty_tables(spark):
    day = dt.date(2001, 1, 5)
    df = spark.createDataFrame([(1, day, 5.0), (1, day, 5.0), (1, day, 7.0), (1, None, 2.0), (1, dt.date(2001, 1, 12), None)],
                               "Store int, Date date, Weekly_Sales double")
    got = [(r["Date"], r["Weekly_Sales"], r["sales_lag_1"]) for r in
           ls.lag_features(ls.numbered(df, task_rows=1), lags=(1,), block=2).orderBy("_pos").collect()]
    assert got[0] == (None, 2.0, None) and got[-1][0] == dt.date(2001, 1, 12)
    assert sorted(r[1] for r in got[1:4]) == [5.0, 5.0, 7.0]
    assert [r[2] for r in got[1:]] == [r[1] for r in got[:-1]]
    empty = df.filter("false")
    assert ls.history_features(empty).collect() == []
    none = df.withColumn("Weekly_Sales", F.lit(None).cast("double"))
    assert all(r["ewma_4w"] is None for r in ls.ewma_features(ls.numbered(none)).collect())


def test_limits_are_checked(series):
    with pytest.raises(ValueError):
        ls.with_halo(ls.numbered(series), halo=9, block=8)
    with pytest.raises(ValueError):
        ls.ewma_features(ls.numbered(series), spans=(1,))
    with pytest.raises(ValueError):
        ls.ewma_features(ls.numbered(series), block=1 << 14)
