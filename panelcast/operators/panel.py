"""Panel-level operators: validation, summary, split, slices, missing values.

All are DataFrame -> DataFrame and lazy. Means of money columns are exact
(decimal sum, one cast to double) so they do not depend on partitioning.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from .order import quantiles

EXACT = "decimal(18,4)"

#: Rows of a task that holds whole series.
SERIES_ROWS = 1 << 15


def by_series(df: DataFrame, entity: str = C.ENTITY, rows: int | None = None) -> DataFrame:
    """The rows, dealt by series to tasks of about ``rows`` rows (SERIES_ROWS).

    The windows over a series run where this deals it and widen its rows tenfold. Spark
    would size those tasks by the bytes of the narrow rows it shuffles, so their memory
    would grow with the panel. The input is counted: give stored rows. Fewer rows than a
    task holds stay as they are."""
    tasks = math.ceil(df.count() / (rows or SERIES_ROWS))
    return df.repartition(tasks, entity) if tasks > 1 else df


def exact_mean(col: Column | str) -> Column:
    """Mean of a column carrying at most 4 decimals, summed exactly."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_divide(F.sum(c.cast(EXACT)).cast("double"), F.count(c).cast("double"))


def validate_panel(df: DataFrame, entity: str = C.ENTITY, time: str = C.TIME,
                   target: str = C.TARGET) -> DataFrame:
    """One row: total_rows, n_stores, n_weeks, date_min, date_max, missing_<col>,
    duplicates (full-row), negative_sales, complete_coverage."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("total_rows"),
            F.count_distinct(entity).alias("n_stores"),
            F.count_distinct(time).alias("n_weeks"),
            F.min(time).alias("date_min"), F.max(time).alias("date_max")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in cols]
    # only rows whose hash repeats are compared in full
    row_hash = F.xxhash64(*cols)
    repeated = (df.groupBy(row_hash.alias("_h")).agg(F.count(F.lit(1)).alias("_m")).filter("_m > 1")
                .select("_h"))
    same = (df.withColumn("_h", row_hash).join(repeated, "_h").groupBy(*cols)
            .agg(F.count(F.lit(1)).alias("_m")).agg(F.coalesce(F.sum(F.col("_m") - 1), F.lit(0))))
    aggs += [F.coalesce(same.scalar(), F.lit(0)).alias("duplicates"),
             F.count_if(F.col(target) < 0).alias("negative_sales")]
    out = df.agg(*aggs)
    return out.withColumn("complete_coverage",
                          F.col("total_rows") == F.col("n_stores") * F.col("n_weeks"))


def panel_summary(df: DataFrame, entity: str = C.ENTITY, time: str = C.TIME,
                  target: str = C.TARGET, flag: str = C.HOLIDAY_FLAG) -> DataFrame:
    """One row: shape, date range, weeks, stores, target mean/std/min/max/median,
    holiday weeks count and percentage. The (unbounded) list of entities is a
    separate query (``store_list``), never packed into one row. The median is exact
    and comes from distributed positions (``order.quantiles``)."""
    y = F.col(target)
    median = quantiles(df, target, {"m": 0.5}).scalar()
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_cols"),
        F.min(time).alias("date_start"), F.max(time).alias("date_end"),
        F.count_distinct(time).alias("n_weeks"),
        F.count_distinct(entity).alias("n_stores"),
        exact_mean(y).alias("sales_mean"),
        F.round(F.stddev_samp(y), 2).alias("sales_std"),
        F.min(y).alias("sales_min"), F.max(y).alias("sales_max"),
        median.alias("sales_median"),
        F.sum(flag).cast("long").alias("holiday_count"),
        F.round(F.avg(flag) * 100, 6).alias("holiday_pct"))


def store_list(df: DataFrame, entity: str = C.ENTITY) -> DataFrame:
    return df.select(entity).distinct().orderBy(entity)


def with_split(df: DataFrame, val_start: str = C.VALIDATION_START, time: str = C.TIME) -> DataFrame:
    """Adds ``split`` = 'train' (time < start) | 'validation' (time >= start); a row
    without a date is in neither."""
    start = F.lit(val_start).cast("date")
    return df.withColumn("split", F.when(F.col(time) < start, "train")
                         .when(F.col(time) >= start, "validation"))


def time_split(df: DataFrame, val_start: str = C.VALIDATION_START,
               time: str = C.TIME) -> tuple[DataFrame, DataFrame]:
    start = F.lit(val_start).cast("date")
    return df.filter(F.col(time) < start), df.filter(F.col(time) >= start)


def split_report(df: DataFrame, val_start: str = C.VALIDATION_START, time: str = C.TIME) -> DataFrame:
    """Rows and date range per split (the split log)."""
    return (with_split(df, val_start, time).groupBy("split")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min(time).alias("date_min"),
                 F.max(time).alias("date_max")))


def store_slice(df: DataFrame, store_id: int, entity: str = C.ENTITY) -> DataFrame:
    return df.filter(F.col(entity) == F.lit(store_id))


def series_frame(df: DataFrame, store_id: int | None = None, entity: str = C.ENTITY,
                 time: str = C.TIME, target: str = C.TARGET,
                 regressors=C.REGRESSORS + (C.HOLIDAY_FLAG,)) -> DataFrame:
    """(entity, ds, y, regressors present in the frame); optional entity filter."""
    if store_id is not None:
        df = store_slice(df, store_id, entity)
    cols = [F.col(entity), F.col(time).alias("ds"), F.col(target).alias("y")]
    cols += [F.col(r) for r in regressors if r in df.columns]
    return df.select(*cols)


def drop_missing(df: DataFrame) -> DataFrame:
    return df.dropna(how="any")


def handle_missing(df: DataFrame, strategy: str = "drop", entity: str = C.ENTITY) -> DataFrame:
    """``drop`` rows with a null, or ``fill`` numeric nulls with the entity's mean; any other
    strategy is refused."""
    if strategy == "drop":
        return drop_missing(df)
    if strategy == "fill":
        return fill_missing_store_mean(df, entity)
    raise ValueError(f"unknown strategy for missing values: {strategy!r}")


def fill_missing_store_mean(df: DataFrame, entity: str = C.ENTITY,
                            columns: list[str] | None = None) -> DataFrame:
    """Numeric nulls -> the entity's mean of that column (all rows of the entity).

    An entity whose column is entirely null stays null. The window is partitioned
    by entity only; on a panel each partition is one series (bounded by periods).
    """
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
               T.DoubleType, T.DecimalType)
    if columns is None:
        columns = [f.name for f in df.schema.fields
                   if isinstance(f.dataType, numeric) and f.name != entity]
    w = Window.partitionBy(entity)
    return df.select(*[F.coalesce(F.col(c), F.avg(c).over(w)).alias(c) if c in columns else F.col(c)
                       for c in df.columns])


def holiday_label(df: DataFrame, flag: str = C.HOLIDAY_FLAG) -> DataFrame:
    return df.withColumn("Holiday", F.when(F.col(flag) == 1, "Holiday")
                         .when(F.col(flag) == 0, "Non-Holiday"))
