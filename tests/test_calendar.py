import datetime as dt

from pyspark.sql import functions as F

from panelcast import config as C
from panelcast.functions import calendar as cal
from panelcast.operators import calendar_features as cf
from conftest import make_panel


def test_rule_reproduces_reference_dates():
    got = cal.rule_calendar(range(2010, 2014))
    for name, dates in C.REFERENCE_HOLIDAYS.items():
        assert [d.isoformat() for d in got[name]] == list(dates)


def test_spark_rule_matches_python(spark):
    df = cal.DEFAULT_CALENDAR.frame(spark, 1990, 2030)
    spark_dates = {(r["holiday"], r["date"]) for r in df.collect()}
    py = {(n, d) for n, ds in cal.rule_calendar(range(1990, 2031)).items() for d in ds}
    assert spark_dates == py


def test_window_flags_and_bounds(spark):
    # Thanksgiving 2010-11-26: flag +-3 days; pre window [-14,-3); black Friday (0,+7]
    rows = [(1, d, 1.0) for d in ("2010-11-12", "2010-11-19", "2010-11-23", "2010-11-26",
                                  "2010-11-29", "2010-11-30", "2010-12-03", "2010-12-04")]
    out = {r["Date"].isoformat(): r for r in
           cf.holiday_window_flags(make_panel(spark, rows)).collect()}
    assert out["2010-11-26"]["is_thanksgiving"] == 1
    assert out["2010-11-23"]["is_thanksgiving"] == 1 and out["2010-11-29"]["is_thanksgiving"] == 1
    assert out["2010-11-30"]["is_thanksgiving"] == 0
    assert out["2010-11-12"]["is_pre_thanksgiving"] == 1
    assert out["2010-11-19"]["is_pre_thanksgiving"] == 1
    assert out["2010-11-23"]["is_pre_thanksgiving"] == 0      # h-3 excluded
    assert out["2010-11-26"]["is_black_friday_week"] == 0     # h excluded
    assert out["2010-12-03"]["is_black_friday_week"] == 1     # h+7 included
    assert out["2010-12-04"]["is_black_friday_week"] == 0


def test_christmas_across_year_boundary(spark):
    rows = [(1, "2011-01-02", 1.0)]   # 2 days after Christmas 2010-12-31
    r = cf.holiday_window_flags(make_panel(spark, rows)).first()
    assert r["is_christmas"] == 1


def test_distance_and_default(spark):
    rows = [(1, "2010-02-05", 1.0), (1, "2010-02-12", 1.0), (1, "2014-06-06", 1.0)]
    p = make_panel(spark, rows)
    out = {r["Date"].isoformat(): r for r in cf.holiday_distance(p).collect()}
    assert out["2010-02-05"]["weeks_to_next_holiday"] == 1
    assert out["2010-02-12"]["weeks_to_next_holiday"] == 0
    assert out["2010-02-12"]["weeks_since_last_holiday"] == 0
    # explicit calendar without a later holiday: default 52 days -> 52 // 7 = 7
    explicit = cal.HolidayCalendar(C.REFERENCE_HOLIDAYS)
    out2 = {r["Date"].isoformat(): r for r in cf.holiday_distance(p, calendar=explicit).collect()}
    assert out2["2014-06-06"]["weeks_to_next_holiday"] == 7
    assert out2["2010-02-05"]["weeks_since_last_holiday"] == 7


def test_holidays_in_range(spark):
    p = make_panel(spark, [(1, "2010-02-01", 1.0), (1, "2010-12-01", 1.0)])
    names = {r["holiday"] for r in cf.holidays_in_range(p).collect()}
    assert names == {"Super_Bowl", "Labour_Day", "Thanksgiving"}
