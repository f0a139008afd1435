"""Range and nearest joins with tables of windows and events, and rolling folds."""
from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import weekly_panel
from panelcast.functions.calendar import DEFAULT_CALENDAR
from panelcast.operators import calendar_features as cf
from panelcast.operators import calendar_joins as cj
from panelcast.operators import validation

D0 = dt.date(2010, 1, 1)


def day(rng, span=900):
    return D0 + dt.timedelta(days=rng.randrange(-span, span))


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("width", [1, 7, 64, 5000])
def test_against_nested_loops(spark, keys, width):
    rng = random.Random(width)
    rows = [(i, rng.randrange(3), day(rng)) for i in range(120)] + [(500 + i, 0, D0) for i in range(30)]
    rows += [(900, None, D0), (901, 1, None)]
    windows = [(f"w{i % 9}", rng.randrange(3), s, s + dt.timedelta(days=rng.randrange(-3, 200))) for i in range(60) for s in [day(rng)]]
    windows += [windows[0], ("null", 1, None, D0), ("day", 0, D0, D0)]
    events = [(rng.randrange(3), day(rng)) for _ in range(25)] + [(0, D0), (0, D0), (None, D0), (2, None)]
    df = spark.createDataFrame(rows, "id int, k int, d date")
    w = spark.createDataFrame(windows, "name string, k int, start date, end date")
    e = spark.createDataFrame(events, "k int, at date")
    got = {r.id: r.windows_at for r in cj.windows_at(df, w, "d", keys, width).collect()}
    near = {r.id: (r.previous_event, r.next_event) for r in cj.nearest_events(df, e, "d", "at", keys, width).collect()}
    assert len(got) == len(near) == len(rows)
    for i, k, d in rows:
        fits = (lambda x: x is not None and x == k) if keys else (lambda x: True)
        assert got[i] == sorted({n for n, x, a, b in windows if d and a and b and fits(x) and a <= d <= b})
        own = [t for x, t in events if t and d and fits(x)]
        assert near[i] == (max((t for t in own if t <= d), default=None), min((t for t in own if t >= d), default=None))


def test_calendar_table_equals_the_rule(spark):
    p = weekly_panel(spark, 3, 160)
    table = DEFAULT_CALENDAR.frame(spark, 2008, 2015)
    for rule, join in ((cf.holiday_window_flags(p), cj.holiday_window_flags(p, table)),
                       (cf.holiday_distance(p), cj.holiday_distance(p, table))):
        assert rule.columns == join.columns
        assert sorted(map(tuple, rule.collect())) == sorted(map(tuple, join.collect()))
    none = cj.holiday_distance(p, table.limit(0)).agg(F.min("weeks_to_next_holiday"), F.max("weeks_since_last_holiday")).first()
    assert tuple(none) == (7, 7) and cj.holiday_window_flags(p.limit(0), table).count() == 0


def test_no_fold_sees_later_rows(spark):
    p = weekly_panel(spark, 3, 120).select("Store", "Date", "Weekly_Sales")
    folds = validation.rolling_folds(p, 3, 8).collect()
    for k in (1, 2, 3):
        train = {r.Date for r in folds if r.fold == k and r.role == "train"}
        test = {r.Date for r in folds if r.fold == k and r.role == "test"}
        assert len(test) == 8 and max(train) < min(test) and len(train) == 120 - 8 * (4 - k)
    assert len({r.Date for r in folds if r.role == "test"}) == 24
    first = [r for r in validation.rolling_origin_forecasts(p, 3, 8).collect() if r.fold == 1]
    cut = min(r.Date for r in first)
    changed = p.withColumn("Weekly_Sales", F.when(F.col("Date") >= F.lit(cut), F.lit(-1.0)).otherwise(F.col("Weekly_Sales")))
    again = [r for r in validation.rolling_origin_forecasts(changed, 3, 8).collect() if r.fold == 1]
    key = lambda r: (r.Store, r.Date, r.model)
    assert [r.pred for r in sorted(first, key=key)] == [r.pred for r in sorted(again, key=key)] and len(first) == 3 * 8 * 3


def test_folds_of_short_and_empty_tables(spark):
    p = weekly_panel(spark, 1, 9).select("Store", "Date", "Weekly_Sales")
    assert {r.role for r in validation.rolling_folds(p, 2, 4).collect() if r.fold == 1} == {"train", "test"}
    assert validation.rolling_origin_metrics(validation.rolling_origin_forecasts(p.limit(0))).count() == 0
    with pytest.raises(ValueError):
        validation.rolling_origin_forecasts(p, horizon=53)


@pytest.mark.parametrize("name", ["holiday_window_flags_table", "holiday_distance_table", "rolling_origin_metrics"])
def test_queries_against_sql(spark, name):
    import __spark_entry__ as entry
    from oracle_check import compare, duck
    sf = "/root/testdata/sf0.001"
    messages, _, _ = compare(spark, duck(sf), name, entry.queries()[name], entry.oracle_sql()[name], sf)
    assert not messages, messages
