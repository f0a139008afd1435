"""Calendar column expressions (built-ins only, whole-stage codegen friendly)."""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_ending_friday(ts: Column) -> Column:
    """Friday of the ISO (Monday-based) week of a date/timestamp, time-zone free."""
    return F.date_add(F.trunc(F.to_date(ts), "week"), 4)


def temporal_columns(d: Column) -> dict[str, Column]:
    day = F.dayofmonth(d)
    month = F.month(d)
    return {
        "year": F.year(d),
        "month": month,
        "week_of_year": F.weekofyear(d),          # ISO week, 1..53
        "day_of_year": F.dayofyear(d),
        "quarter": F.quarter(d),
        "week_of_month": (F.floor((day - 1) / 7) + 1).cast("int"),
        "is_month_start": (day <= 7).cast("int"),
        "is_month_end": (day >= 24).cast("int"),
        "is_quarter_start": (month.isin(1, 4, 7, 10) & (day <= 7)).cast("int"),
        "is_quarter_end": (month.isin(3, 6, 9, 12) & (day >= 24)).cast("int"),
        "is_year_start": ((month == 1) & (day <= 7)).cast("int"),
        "is_year_end": ((month == 12) & (day >= 24)).cast("int"),
    }


# Cyclical periods: month 12, ISO week 52, day of year 365, quarter 4.
CYCLES = (("month", "month", 12), ("week", "week_of_year", 52),
          ("day_of_year", "day_of_year", 365), ("quarter", "quarter", 4))


def sin_cos(x: Column, period: int) -> tuple[Column, Column]:
    angle = x * (2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")
