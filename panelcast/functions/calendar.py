"""Holiday calendar and the date-to-holiday column expressions.

The calendar is generated by rule for any year, so holiday flags and distances
are plain column expressions over the candidate holidays of the previous, the
current and the next year: no join, no broadcast, and no calendar edge effects.
An explicit calendar (name -> list of dates) is also accepted; it is a bounded
literal set.

Rules (all holidays fall on the Friday that closes the retail week):
  Super Bowl    second Friday of February
  Labour Day    first Monday of September + 4 days
  Thanksgiving  fourth Thursday of November + 1 day
  Christmas     last Friday of December
"""
from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C


# ---------------------------------------------------------------- Python side
def _next_weekday(d: _dt.date, weekday: int) -> _dt.date:
    """First date >= d with the given weekday (Mon=0)."""
    return d + _dt.timedelta(days=(weekday - d.weekday()) % 7)


def rule_holidays(year: int) -> dict[str, _dt.date]:
    fri, mon, thu = 4, 0, 3
    return {
        "Super_Bowl": _next_weekday(_dt.date(year, 2, 1), fri) + _dt.timedelta(days=7),
        "Labour_Day": _next_weekday(_dt.date(year, 9, 1), mon) + _dt.timedelta(days=4),
        "Thanksgiving": _next_weekday(_dt.date(year, 11, 1), thu) + _dt.timedelta(days=22),
        "Christmas": _next_weekday(_dt.date(year, 12, 25), fri),
    }


def rule_calendar(years: Iterable[int]) -> dict[str, list[_dt.date]]:
    out: dict[str, list[_dt.date]] = {n: [] for n in C.HOLIDAY_NAMES}
    for y in years:
        for name, d in rule_holidays(y).items():
            out[name].append(d)
    return out


# ----------------------------------------------------------------- Spark side
def _rule_holiday_col(name: str, year: Column) -> Column:
    if name == "Super_Bowl":
        return F.date_add(F.next_day(F.make_date(year, F.lit(1), F.lit(31)), "FRI"), 7)
    if name == "Labour_Day":
        return F.date_add(F.next_day(F.make_date(year, F.lit(8), F.lit(31)), "MON"), 4)
    if name == "Thanksgiving":
        return F.date_add(F.next_day(F.make_date(year, F.lit(10), F.lit(31)), "THU"), 22)
    if name == "Christmas":
        return F.next_day(F.make_date(year, F.lit(12), F.lit(24)), "FRI")
    raise ValueError(f"unknown holiday {name}")


class HolidayCalendar:
    """Holiday dates by name: rule-generated (default) or an explicit mapping."""

    def __init__(self, explicit: Mapping[str, Sequence] | None = None):
        self.explicit = None
        if explicit is not None:
            self.explicit = {name: [_dt.date.fromisoformat(str(d)[:10]) for d in dates]
                             for name, dates in explicit.items()}

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(self.explicit) if self.explicit is not None else C.HOLIDAY_NAMES

    def candidates(self, date_col: Column) -> dict[str, list[Column]]:
        """Holiday dates that can be near ``date_col``, per holiday name."""
        if self.explicit is not None:
            return {n: [F.lit(d) for d in ds] for n, ds in self.explicit.items()}
        y = F.year(date_col)
        return {n: [_rule_holiday_col(n, y + k) for k in (-1, 0, 1)] for n in self.names}

    def frame(self, spark: SparkSession, first_year: Column | int, last_year: Column | int,
              source: DataFrame | None = None) -> DataFrame:
        """(holiday, date) rows for the years in [first_year, last_year].

        ``first_year``/``last_year`` may be columns of a one-row ``source`` frame
        (e.g. the min/max year of a panel); the years are exploded in Spark.
        """
        if self.explicit is not None:
            rows = [(n, d) for n, ds in self.explicit.items() for d in ds]
            cal = spark.createDataFrame(rows, "holiday string, date date")
            if source is None:
                return cal
            bounds = source.select(F.lit(first_year).alias("_y0"), F.lit(last_year).alias("_y1"))
            return (cal.join(F.broadcast(bounds), F.year("date").between(F.col("_y0"), F.col("_y1")))
                    .select("holiday", "date"))
        base = source if source is not None else spark.range(1)
        years = base.select(F.explode(F.sequence(F.lit(first_year).cast("int"),
                                                 F.lit(last_year).cast("int"))).alias("year"))
        per_name = [F.struct(F.lit(n).alias("holiday"), _rule_holiday_col(n, F.col("year")).alias("date"))
                    for n in self.names]
        return (years.select(F.explode(F.array(*per_name)).alias("h"))
                .select("h.holiday", "h.date"))


DEFAULT_CALENDAR = HolidayCalendar()


class ProjectedCalendar:
    """A calendar whose candidate dates were projected once as columns (see
    ``project_candidates``): flags and distances then reference the columns
    instead of repeating the date expressions."""

    def __init__(self, columns: dict[str, list[str]]):
        self.columns = columns

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(self.columns)

    def candidates(self, date_col: Column) -> dict[str, list[Column]]:
        return {n: [F.col(c) for c in cs] for n, cs in self.columns.items()}


def project_candidates(df: DataFrame, time: str, cal: HolidayCalendar,
                       prefix: str = "_hol") -> tuple[DataFrame, ProjectedCalendar, list[str]]:
    """Adds one column per candidate holiday date of each row; returns the frame,
    a calendar view over those columns and the column names (to drop later)."""
    cands = cal.candidates(F.col(time))
    cols = {n: [f"{prefix}_{n}_{i}" for i in range(len(cs))] for n, cs in cands.items()}
    out = df.withColumns({c: e for n, cs in cands.items() for c, e in zip(cols[n], cs)})
    return out, ProjectedCalendar(cols), [c for cs in cols.values() for c in cs]


def _any(conds: list[Column]) -> Column:
    out = F.lit(False)
    for c in conds:
        out = out | F.coalesce(c, F.lit(False))
    return out


def near_holiday(date_col: Column, cal: HolidayCalendar, name: str,
                 half_width: int = C.HOLIDAY_HALF_WIDTH_DAYS) -> Column:
    """1 if the date is within +-half_width days of a holiday of that name."""
    cands = cal.candidates(date_col)[name]
    return _any([F.abs(F.datediff(date_col, h)) <= half_width for h in cands]).cast("int")


def any_holiday(date_col: Column, cal: HolidayCalendar = DEFAULT_CALENDAR,
                half_width: int = C.HOLIDAY_HALF_WIDTH_DAYS) -> Column:
    conds = [F.abs(F.datediff(date_col, h)) <= half_width
             for hs in cal.candidates(date_col).values() for h in hs]
    return _any(conds).cast("int")


def in_window_before(date_col: Column, cal: HolidayCalendar, name: str,
                     days_before: int, stop_before: int = C.HOLIDAY_HALF_WIDTH_DAYS) -> Column:
    """1 if h - days_before <= date < h - stop_before for a holiday h."""
    cands = cal.candidates(date_col)[name]
    return _any([(date_col >= F.date_sub(h, days_before)) & (date_col < F.date_sub(h, stop_before))
                 for h in cands]).cast("int")


def in_window_after(date_col: Column, cal: HolidayCalendar, name: str, days_after: int) -> Column:
    """1 if h < date <= h + days_after for a holiday h."""
    cands = cal.candidates(date_col)[name]
    return _any([(date_col > h) & (date_col <= F.date_add(h, days_after)) for h in cands]).cast("int")


def weeks_to_next(date_col: Column, cal: HolidayCalendar = DEFAULT_CALENDAR,
                  default_days: int = C.NO_HOLIDAY_DEFAULT_DAYS) -> Column:
    """Whole weeks until the next holiday on/after the date.

    The default (no later holiday) is applied in days before the week division,
    so a missing holiday yields 52 div 7 = 7.
    """
    dists = [F.when(h >= date_col, F.datediff(h, date_col))
             for hs in cal.candidates(date_col).values() for h in hs]
    return F.floor(F.coalesce(F.least(*dists), F.lit(default_days)) / 7).cast("int")


def weeks_since_last(date_col: Column, cal: HolidayCalendar = DEFAULT_CALENDAR,
                     default_days: int = C.NO_HOLIDAY_DEFAULT_DAYS) -> Column:
    dists = [F.when(h <= date_col, F.datediff(date_col, h))
             for hs in cal.candidates(date_col).values() for h in hs]
    return F.floor(F.coalesce(F.least(*dists), F.lit(default_days)) / 7).cast("int")


def sql_values(years: Iterable[int]) -> str:
    """The rule calendar as a SQL VALUES list (for oracle queries)."""
    cal = rule_calendar(years)
    rows = [f"('{n}', DATE '{d.isoformat()}')" for n in C.HOLIDAY_NAMES for d in cal[n]]
    return "(VALUES " + ", ".join(rows) + ") AS hol(holiday, h)"
