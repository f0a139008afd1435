"""Joins with a calendar table of any size: which windows hold a date, and the nearest
events before and after it, in all or by keys.

Both work on the distinct dates (and keys) of the rows, so a date that many rows share is
looked up once, and join the result back by equality. Days fall into buckets. The range
join meets windows and dates in the buckets that a window touches. The nearest join sorts
dates and events of a bucket together; what a bucket without events lacks comes from the
buckets around it by a window over one row a bucket.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C

#: Days of a bucket.
BUCKET = 64


def _bucket(day: Column, width: int) -> Column:
    return F.floor(F.unix_date(day) / width)


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def windows_at(rows: DataFrame, windows: DataFrame, time: str, keys: list[str] | None = None, width: int = BUCKET,
               name: str = "name", start: str = "start", end: str = "end") -> DataFrame:
    """``rows`` with ``windows_at``: the sorted distinct names of the windows (name, start, end
    dates, both inclusive, keys) that hold the row's date. Rows and windows with null keys or
    dates, and windows that end before they start, match nothing; repeated windows count once."""
    keys = keys or []
    asked = rows.select(*keys, F.col(time).alias("_t")).dropna().distinct()
    touched = F.sequence(_bucket(F.col("_s"), width), _bucket(F.col("_e"), width))
    held = (windows.select(*keys, F.col(name).alias("_n"), F.col(start).alias("_s"), F.col(end).alias("_e")).dropna()
            .filter("_s <= _e").withColumn("_b", F.explode(touched)))
    met = (asked.withColumn("_b", _bucket(F.col("_t"), width)).join(held, [*keys, "_b"])
           .filter("_t between _s and _e").groupBy(*keys, "_t").agg(F.sort_array(F.collect_set("_n")).alias("windows_at")))
    met = met.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_t"), "windows_at")
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)], F.col(time) == F.col("_t"))
    out = rows.join(met, on, "left")
    return out.select(*rows.columns, F.coalesce("windows_at", F.array().cast("array<string>")).alias("windows_at"))


def nearest_events(rows: DataFrame, events: DataFrame, time: str, event_time: str, keys: list[str] | None = None,
                   width: int = BUCKET) -> DataFrame:
    """``rows`` with ``previous_event`` and ``next_event``: the last event date not after the row's
    and the first not before it (of the row's keys), null where there is none. Null dates
    and keys match nothing."""
    keys = keys or []
    asked = rows.select(*keys, F.col(time).alias("_t")).dropna().distinct()
    known = events.select(*keys, F.col(event_time).alias("_t")).dropna().distinct()
    both = (asked.withColumn("_event", F.lit(None).cast("date")).withColumn("_asked", F.lit(True))
            .unionByName(known.withColumn("_event", F.col("_t")).withColumn("_asked", F.lit(False)))
            .withColumn("_b", _bucket(F.col("_t"), width)))
    inside = Window.partitionBy(*keys, "_b").orderBy("_t")  # equal dates are peers, so an event counts on its own day
    near = both.select(*keys, "_b", "_t", "_asked",
                       F.max("_event").over(inside.rangeBetween(Window.unboundedPreceding, 0)).alias("_p"),
                       F.min("_event").over(inside.rangeBetween(0, Window.unboundedFollowing)).alias("_n"))
    order = Window.partitionBy(*keys).orderBy("_b")  # one row a bucket: time span / width
    around = both.groupBy(*keys, "_b").agg(F.min("_event").alias("_lo"), F.max("_event").alias("_hi")).select(
        *keys, "_b", F.max("_hi").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_bp"),
        F.min("_lo").over(order.rowsBetween(1, Window.unboundedFollowing)).alias("_bn"))
    found = (near.filter("_asked").join(around, [*keys, "_b"])
             .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_t",
                     F.coalesce("_p", "_bp").alias("previous_event"), F.coalesce("_n", "_bn").alias("next_event")))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)], F.col(time) == F.col("_t"))
    return rows.join(found, on, "left").select(*rows.columns, "previous_event", "next_event")


def holiday_windows(calendar: DataFrame) -> DataFrame:
    """(name, start, end) of the window flags of a calendar (holiday, date)."""
    near, h = C.HOLIDAY_HALF_WIDTH_DAYS, F.col("date")
    own = calendar.select(F.concat(F.lit("is_"), F.lower("holiday")).alias("name"),
                          F.date_sub(h, near).alias("start"), F.date_add(h, near).alias("end"))
    for holiday, name, first, last in (
            ("Thanksgiving", "is_pre_thanksgiving", -C.PRE_THANKSGIVING_DAYS, -near - 1),
            ("Christmas", "is_pre_christmas", -C.PRE_CHRISTMAS_DAYS, -near - 1),
            ("Thanksgiving", "is_black_friday_week", 1, C.BLACK_FRIDAY_DAYS)):
        own = own.unionByName(calendar.filter(F.col("holiday") == holiday).select(
            F.lit(name).alias("name"), F.date_add(h, first).alias("start"), F.date_add(h, last).alias("end")))
    return own


def holiday_window_flags(df: DataFrame, calendar: DataFrame, time: str = C.TIME, names=C.HOLIDAY_NAMES) -> DataFrame:
    """The window flags of the holidays ``names`` by a range join with a calendar table."""
    flags = [f"is_{n.lower()}" for n in names] + ["is_pre_thanksgiving", "is_pre_christmas", "is_black_friday_week"]
    out = windows_at(df, holiday_windows(calendar), time)
    return out.withColumns({f: F.array_contains("windows_at", f).cast("int") for f in flags}).drop("windows_at")


def holiday_distance(df: DataFrame, calendar: DataFrame, time: str = C.TIME,
                     default_days: int = C.NO_HOLIDAY_DEFAULT_DAYS) -> DataFrame:
    """weeks_to_next_holiday and weeks_since_last_holiday by a nearest join with a calendar table."""
    out = nearest_events(df, calendar, time, "date")

    def weeks(days):
        return F.floor(F.coalesce(days, F.lit(default_days)) / 7).cast("int")
    d = F.col(time)
    return out.withColumns({"weeks_to_next_holiday": weeks(F.datediff("next_event", d)),
                            "weeks_since_last_holiday": weeks(F.datediff(d, "previous_event"))}).drop("previous_event", "next_event")
