"""Feature pipelines: one lazy plan from panel to the wide feature frame.

Every history column shares the (entity, time) window, so the whole pipeline
costs one hash exchange on the entity plus sorts; the store statistics are a
per-entity aggregate joined back; training scalars are scalar subqueries.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.calendar import DEFAULT_CALENDAR, HolidayCalendar
from ..operators import calendar_features as cf
from ..operators import economic as eco
from ..operators import entity as ent
from ..operators import history as hist
from ..operators.panel import with_split


def history_features(df: DataFrame, include_lag: bool = True, include_rolling: bool = True,
                     leak_safe: bool = False, entity: str = C.ENTITY, time: str = C.TIME,
                     target: str = C.TARGET) -> DataFrame:
    if include_lag:
        df = hist.lag_features(df, entity=entity, time=time, target=target)
        df = hist.same_week_last_year(df, entity, time, target)
    if include_rolling:
        df = hist.rolling_features(df, entity=entity, time=time, target=target)
    return hist.trend_features(df, entity, time, target, leak_safe=leak_safe)


def row_features(df: DataFrame, time: str = C.TIME,
                 calendar: HolidayCalendar = DEFAULT_CALENDAR) -> DataFrame:
    df = cf.temporal_features(df, time)
    df = cf.cyclical_features(df)
    return cf.holiday_features(df, time, calendar)


def engineer_features(df: DataFrame, train: DataFrame | None = None, include_lag: bool = True,
                      include_rolling: bool = True, leak_safe: bool = False,
                      calendar: HolidayCalendar = DEFAULT_CALENDAR) -> DataFrame:
    """temporal -> cyclical -> holiday -> lag -> rolling -> trend -> store ->
    economic -> interaction. Statistics come from ``train`` when given."""
    out = row_features(df, calendar=calendar)
    out = history_features(out, include_lag, include_rolling, leak_safe)
    out = ent.store_features(out, train)
    out = eco.economic_features(out, train)
    return cf.interaction_features(out)


def engineer_features_split(full: DataFrame, val_start: str = C.VALIDATION_START,
                            include_lag: bool = True, include_rolling: bool = True,
                            leak_safe: bool = False, diff_scope: str = "split",
                            calendar: HolidayCalendar = DEFAULT_CALENDAR) -> DataFrame:
    """History features on the full series, then the split; entity and economic
    statistics from training rows only. Returns one frame with a ``split``
    column ('train' | 'validation').

    ``diff_scope='split'`` restarts the economic changes at the split boundary
    (each entity's first validation row has NULL changes); ``'full'`` computes
    them on the whole series. Partition sizes are AQE's.
    """
    # statistics read the training rows of the input panel directly (same values
    # as the featured rows, without re-running the feature windows)
    train = full.filter(F.col(C.TIME) < F.lit(val_start).cast("date"))
    out = row_features(full, calendar=calendar)
    out = history_features(out, include_lag, include_rolling, leak_safe)
    out = cf.interaction_features(out)
    out = with_split(out, val_start)
    out = out.join(ent.store_table(train), C.ENTITY, "left")
    restart = "split" if diff_scope == "split" else None
    return eco.economic_features(out, train, series_keys=C.ENTITY, restart_col=restart)


def split_frames(featured: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (featured.filter(F.col("split") == "train").drop("split"),
            featured.filter(F.col("split") == "validation").drop("split"))


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def feature_columns(df: DataFrame, exclude=C.FEATURE_EXCLUDE + ("split",)) -> list[str]:
    """Numeric columns except date, target and the categorical labels (schema order)."""
    return [f.name for f in df.schema.fields
            if f.name not in exclude and isinstance(f.dataType, NUMERIC)]
