"""Exploratory aggregates (the data behind each dashboard chart).

Each is one grouped aggregation with partial (map-side) aggregation; histogram
bounds are scalar subqueries, so no query pulls raw rows to the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import month_name
from .order import quantiles
from .panel import exact_mean, holiday_label


def sales_by_date(df: DataFrame, store_id: int | None = None, entity: str = C.ENTITY,
                  time: str = C.TIME, target: str = C.TARGET) -> DataFrame:
    """Mean target per date over entities, or one entity's series."""
    if store_id is not None:
        return df.filter(F.col(entity) == store_id).select(time, target)
    return df.groupBy(time).agg(exact_mean(target).alias(target))


def sales_by_store(df: DataFrame, entity: str = C.ENTITY, target: str = C.TARGET) -> DataFrame:
    return (df.groupBy(entity).agg(exact_mean(target).alias(target))
            .orderBy(F.col(target).desc()))


def seasonality(df: DataFrame, time: str = C.TIME, target: str = C.TARGET) -> DataFrame:
    return (df.groupBy(F.month(time).alias("Month"), month_name(F.col(time)).alias("Month_Name"))
            .agg(exact_mean(target).alias(target)).orderBy("Month"))


def holiday_box(df: DataFrame, target: str = C.TARGET, digits: int = 6) -> DataFrame:
    """Box statistics per Holiday label: min, q1, median, q3, max, count. Quantiles are
    exact and linearly interpolated; a label holds much of the table, so they are taken
    from distributed positions (``order.quantiles``)."""
    y = F.col(target)
    labelled = holiday_label(df)
    stats = labelled.groupBy("Holiday").agg(F.min(y).alias("min"), F.max(y).alias("max"), F.count(y).alias("count"))
    q = quantiles(labelled, target, {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["Holiday"])
    q = q.select(F.col("Holiday").alias("_h"), *[F.round(c, digits).alias(c) for c in ("q1", "median", "q3")])
    return (stats.join(q, F.col("Holiday").eqNullSafe(F.col("_h")), "left")
            .select("Holiday", "min", "q1", "median", "q3", "max", "count"))


def store_month_pivot(df: DataFrame, entity: str = C.ENTITY, time: str = C.TIME,
                      target: str = C.TARGET) -> DataFrame:
    """Entity x month (1..12) mean matrix; columns month_1 .. month_12."""
    base = df.withColumn("_m", F.month(time))
    p = base.groupBy(entity).pivot("_m", list(range(1, 13))).agg(exact_mean(target))
    return p.select(entity, *[F.col(str(m)).alias(f"month_{m}") for m in range(1, 13)])


CORR_COLUMNS = (C.TARGET, "Temperature", "Fuel_Price", "CPI", "Unemployment", C.HOLIDAY_FLAG)


def correlation_matrix(df: DataFrame, columns=CORR_COLUMNS, digits: int = 6) -> DataFrame:
    """Pearson correlation of every column pair in one aggregation, as long rows
    (var1, var2, corr); pairwise-complete (rows where both are non-null)."""
    cols = list(columns)
    aggs = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}"))
    one = df.agg(*aggs)
    pairs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                val = F.lit(1.0)
            else:
                x, y = (a, b) if i < j else (b, a)
                val = F.col(f"`{x}|{y}`")
            pairs.append(F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"),
                                  F.round(val, digits).alias("corr")))
    return one.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def equal_width_histogram(df: DataFrame, value: str, bins: int = C.HISTOGRAM_BINS,
                          by: list[str] | None = None) -> DataFrame:
    """Counts in ``bins`` equal-width bins over [min, max] (per group ``by``), empty bins
    included; the maximum falls in the last bin, nulls in none. Bounds come from a grouped
    aggregate joined on the (small) group keys, or scalar subqueries without groups."""
    v = F.col(value)
    by = by or []
    df = df.filter(v.isNotNull())
    edges = df.groupBy(*by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi")).filter("_lo is not null")
    if by:
        x = df.join(edges, by)
        lo, hi = F.col("_lo"), F.col("_hi")
    else:
        x = df
        lo = df.select(F.min(value)).scalar()
        hi = df.select(F.max(value)).scalar()
    width = (hi - lo) / bins
    idx = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((v - lo) / width), F.lit(bins - 1))).cast("int")
    counted = x.groupBy(*by, idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = edges.select(*by, "_lo", ((F.col("_hi") - F.col("_lo")) / bins).alias("_w"),
                         F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(counted, [*by, "bin"], "left").select(
        *by, "bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"))


def sales_histogram(df: DataFrame, target: str = C.TARGET, bins: int = C.HISTOGRAM_BINS) -> DataFrame:
    return equal_width_histogram(df, target, bins)


def actual_vs_predicted(long: DataFrame, time: str = C.TIME, digits: int = 4) -> DataFrame:
    """Per (date, model): total actual and total prediction over entities."""
    return long.groupBy(time, "model").agg(
        F.round(F.sum("actual"), digits).alias("actual_total"),
        F.round(F.sum("pred"), digits).alias("pred_total"))


def residual_histogram(long: DataFrame, bins: int = C.HISTOGRAM_BINS, digits: int = 6) -> DataFrame:
    """Residual (actual - pred) histogram per model plus the model's mean residual."""
    res = long.withColumn("residual", F.col("actual") - F.col("pred"))
    hist = equal_width_histogram(res, "residual", bins, by=["model"])
    mean = res.groupBy("model").agg(F.round(F.avg("residual"), digits).alias("mean_residual"))
    return hist.join(mean, "model")
