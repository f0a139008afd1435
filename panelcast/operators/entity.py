"""Entity-level statistics (from training rows only) and their join back.

The statistics table has one row per entity; it is joined to the fact rows with
a plain equi-join so AQE picks a broadcast when its runtime size is under the
broadcast threshold and a shuffle join (with skew splitting) otherwise.
Global quantities (min/max of the entity means) are scalar subqueries, not
cross joins.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .order import average_ranks
from .panel import exact_mean


def store_stats(train: DataFrame, entity: str = C.ENTITY, target: str = C.TARGET) -> DataFrame:
    """Per entity: store_mean_sales, store_std_sales, store_min/max/median_sales,
    store_cv (std / mean)."""
    y = F.col(target)
    stats = train.groupBy(entity).agg(
        exact_mean(y).alias("store_mean_sales"),
        F.stddev_samp(y).alias("store_std_sales"),
        F.min(y).alias("store_min_sales"),
        F.max(y).alias("store_max_sales"),
        F.median(y).alias("store_median_sales"))
    return stats.withColumn("store_cv", F.try_divide(F.col("store_std_sales"),
                                                     F.col("store_mean_sales")))


def store_rank(stats: DataFrame) -> DataFrame:
    """store_rank (descending average rank), store_percentile (ascending average rank / N)
    over the entities with a mean; an entity without one has neither. Descending average
    rank = N + 1 - ascending average rank (exact, ties included). The ranking is
    distributed at every size (``order.average_ranks``)."""
    ranks = average_ranks(stats, "store_mean_sales").select(
        F.col("store_mean_sales").alias("_mean"), "rank", "n")
    return (stats.join(ranks, F.col("store_mean_sales") == F.col("_mean"), "left")
            .withColumn("store_rank", (F.col("n") + 1 - F.col("rank")).cast("double"))
            .withColumn("store_percentile", (F.col("rank") / F.col("n")).cast("double"))
            .drop("_mean", "rank", "n"))


def store_size_bins(stats: DataFrame, labels=C.STORE_SIZE_LABELS) -> DataFrame:
    """Three equal-width, right-closed bins of store_mean_sales over [min, max];
    all-equal means fall in the middle bin. min/max come from one scalar subquery."""
    m = F.col("store_mean_sales")
    b = stats.select(F.struct(F.min(m).alias("lo"), F.max(m).alias("hi"))).scalar()
    lo, hi = b.getField("lo"), b.getField("hi")
    step = (hi - lo) / 3.0
    size = (F.when(m.isNull(), F.lit(None))
            .when(hi == lo, F.lit(labels[1]))
            .when(m <= lo + step, F.lit(labels[0]))
            .when(m <= lo + 2 * step, F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))
    return stats.withColumn("store_size", size)


def store_table(train: DataFrame, entity: str = C.ENTITY, target: str = C.TARGET) -> DataFrame:
    """Full per-entity table in the output order of the reference features; lazy."""
    t = store_rank(store_size_bins(store_stats(train, entity, target)))
    return t.select(entity, "store_mean_sales", "store_std_sales", "store_min_sales",
                    "store_max_sales", "store_median_sales", "store_rank", "store_percentile",
                    "store_cv", "store_size")


def store_features(df: DataFrame, train: DataFrame | None = None, entity: str = C.ENTITY,
                   target: str = C.TARGET) -> DataFrame:
    """Left join of the training-row statistics; an unseen entity gets NULLs."""
    stats = store_table(train if train is not None else df, entity, target)
    return df.join(stats, entity, "left")
