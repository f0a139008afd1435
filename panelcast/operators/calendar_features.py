"""Row-local feature operators: calendar, cyclical, holiday, interactions.

Pure projections (no exchange): every column is a built-in expression of the
row's own date and values, so they fuse into one whole-stage-codegen span.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import calendar as cal
from ..functions.dates import CYCLES, month_name, sin_cos, temporal_columns


def temporal_features(df: DataFrame, time: str = C.TIME) -> DataFrame:
    return df.withColumns(temporal_columns(F.col(time)))


def cyclical_features(df: DataFrame) -> DataFrame:
    """{month,week,day_of_year,quarter}_{sin,cos}; needs temporal_features."""
    cols = {}
    for prefix, source, period in CYCLES:
        s, c = sin_cos(F.col(source), period)
        cols[f"{prefix}_sin"] = s
        cols[f"{prefix}_cos"] = c
    return df.withColumns(cols)


def holiday_window_flags(df: DataFrame, time: str = C.TIME,
                         calendar: cal.HolidayCalendar = cal.DEFAULT_CALENDAR) -> DataFrame:
    """is_<holiday> (+-3 days), is_pre_thanksgiving [-14d,-3d),
    is_pre_christmas [-28d,-3d), is_black_friday_week (0,+7d]."""
    d = F.col(time)
    cols = {f"is_{n.lower()}": cal.near_holiday(d, calendar, n) for n in calendar.names}
    if "Thanksgiving" in calendar.names:
        cols["is_pre_thanksgiving"] = cal.in_window_before(d, calendar, "Thanksgiving",
                                                           C.PRE_THANKSGIVING_DAYS)
    if "Christmas" in calendar.names:
        cols["is_pre_christmas"] = cal.in_window_before(d, calendar, "Christmas",
                                                        C.PRE_CHRISTMAS_DAYS)
    if "Thanksgiving" in calendar.names:
        cols["is_black_friday_week"] = cal.in_window_after(d, calendar, "Thanksgiving",
                                                           C.BLACK_FRIDAY_DAYS)
    return df.withColumns(cols)


def holiday_distance(df: DataFrame, time: str = C.TIME,
                     calendar: cal.HolidayCalendar = cal.DEFAULT_CALENDAR) -> DataFrame:
    """weeks_to_next_holiday / weeks_since_last_holiday (as-of lookups, both
    directions, expressed as least() over the candidate holidays)."""
    d = F.col(time)
    return df.withColumns({"weeks_to_next_holiday": cal.weeks_to_next(d, calendar),
                           "weeks_since_last_holiday": cal.weeks_since_last(d, calendar)})


def holiday_features(df: DataFrame, time: str = C.TIME,
                     calendar: cal.HolidayCalendar = cal.DEFAULT_CALENDAR) -> DataFrame:
    """Window flags and distances. The candidate holiday dates of each row are
    projected once as columns and shared by all nine outputs."""
    projected, view, tmp = cal.project_candidates(df, time, calendar)
    out = holiday_distance(holiday_window_flags(projected, time, view), time, view)
    return out.drop(*tmp)


def interaction_features(df: DataFrame, entity: str = C.ENTITY,
                         flag: str = C.HOLIDAY_FLAG) -> DataFrame:
    """store_holiday, store_month, temp_quarter; needs temporal_features."""
    return df.withColumns({
        "store_holiday": F.col(entity) * F.col(flag),
        "store_month": F.col(entity) * F.col("month"),
        "temp_quarter": F.col("Temperature") * F.col("quarter"),
    })


def month_labels(df: DataFrame, time: str = C.TIME) -> DataFrame:
    return df.withColumns({"Month": F.month(time), "Month_Name": month_name(F.col(time))})


def holidays_in_range(df: DataFrame, time: str = C.TIME,
                      calendar: cal.HolidayCalendar = cal.DEFAULT_CALENDAR) -> DataFrame:
    """Calendar holidays between the panel's first and last date (chart markers).

    The date range is a one-row aggregate; calendar years are exploded from it in
    Spark and filtered by the range, so nothing passes through the driver.
    """
    rng = df.agg(F.min(time).alias("_d0"), F.max(time).alias("_d1"))
    hol = calendar.frame(df.sparkSession, F.year("_d0"), F.year("_d1"), source=rng)
    bounds = rng.select(F.struct("_d0", "_d1")).scalar()
    return hol.filter(F.col("date").between(bounds.getField("_d0"), bounds.getField("_d1")))


def prophet_holidays(df: DataFrame, time: str = C.TIME,
                     calendar: cal.HolidayCalendar = cal.DEFAULT_CALENDAR) -> DataFrame:
    """Long holiday table for the years the panel spans: holiday (lower case), ds,
    lower_window -1, upper_window 1."""
    rng = df.agg(F.year(F.min(time)).alias("_y0"), F.year(F.max(time)).alias("_y1"))
    hol = calendar.frame(df.sparkSession, F.col("_y0"), F.col("_y1"), source=rng)
    return hol.select(F.lower("holiday").alias("holiday"), F.col("date").alias("ds"),
                      F.lit(-1).alias("lower_window"), F.lit(1).alias("upper_window"))
