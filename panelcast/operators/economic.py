"""Economic / regressor features with training-row statistics.

Training statistics (temperature mean/std, unemployment mean) are scalar
subqueries over the training rows: Spark evaluates each once and inlines the
value, no cross join and no driver round trip in the plan.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .history import economic_changes


def train_scalars(train: DataFrame) -> dict[str, Column]:
    """The three training statistics from ONE scalar subquery (one pass)."""
    stats = train.select(F.struct(F.avg("Temperature").alias("temp_mean"),
                                  F.stddev_samp("Temperature").alias("temp_std"),
                                  F.avg("Unemployment").alias("unemp_mean"))).scalar()
    return {k: stats.getField(k) for k in ("temp_mean", "temp_std", "unemp_mean")}


def train_stat_scalars(df: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """Attach the global training statistics to every row."""
    s = train_scalars(train if train is not None else df)
    return df.withColumns({k: v for k, v in s.items()})


def temp_category(t: Column) -> Column:
    """Right-closed bins: (-inf,32] freezing ... (85,inf) hot."""
    expr = None
    for edge, label in C.TEMP_BINS:
        expr = (F.when(t <= edge, label) if expr is None else expr.when(t <= edge, label))
    return F.when(t.isNull(), F.lit(None)).otherwise(expr.otherwise(C.TEMP_TOP_LABEL))


def temperature_features(df: DataFrame, train: DataFrame | None = None) -> DataFrame:
    s = train_scalars(train if train is not None else df)
    t = F.col("Temperature")
    return df.withColumns({
        "temp_deviation": F.try_divide(t - s["temp_mean"], s["temp_std"]),
        "temp_squared": t * t,
        "temp_category": temp_category(t),
    })


def unemployment_level(df: DataFrame, train: DataFrame | None = None) -> DataFrame:
    s = train_scalars(train if train is not None else df)
    return df.withColumn("unemployment_above_avg",
                         F.coalesce(F.col("Unemployment") > s["unemp_mean"], F.lit(False)).cast("int"))


def cpi_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn("cpi_unemployment_ratio",
                         F.try_divide(F.col("CPI"), F.col("Unemployment") + C.CPI_UNEMPLOYMENT_OFFSET))


def economic_features(df: DataFrame, train: DataFrame | None = None,
                      series_keys=C.ENTITY, time: str = C.TIME,
                      restart_col: str | None = None) -> DataFrame:
    """temp_deviation, temp_squared, temp_category, fuel/cpi changes,
    unemployment_change, unemployment_above_avg, cpi_unemployment_ratio."""
    s = train_scalars(train if train is not None else df)
    t = F.col("Temperature")
    out = df.withColumns({
        "temp_deviation": F.try_divide(t - s["temp_mean"], s["temp_std"]),
        "temp_squared": t * t,
        "temp_category": temp_category(t),
    })
    out = economic_changes(out, series_keys, time, restart_col)
    return out.withColumns({
        "unemployment_above_avg": F.coalesce(F.col("Unemployment") > s["unemp_mean"],
                                             F.lit(False)).cast("int"),
        "cpi_unemployment_ratio": F.try_divide(F.col("CPI"),
                                               F.col("Unemployment") + C.CPI_UNEMPLOYMENT_OFFSET),
    })
