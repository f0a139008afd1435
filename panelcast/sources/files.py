"""File sources and sinks: panel CSV, predictions (wide CSV/parquet), metrics JSON.

Schemas are declared, never inferred. Writers produce directories of part files
(one per task), so no result is funneled through one task or the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C

PANEL_CSV_SCHEMA = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("Date", T.StringType()),
    T.StructField("Weekly_Sales", T.DoubleType()),
    T.StructField("Holiday_Flag", T.IntegerType()),
    T.StructField("Temperature", T.DoubleType()),
    T.StructField("Fuel_Price", T.DoubleType()),
    T.StructField("CPI", T.DoubleType()),
    T.StructField("Unemployment", T.DoubleType()),
])

DATE_FORMAT = "dd-MM-yyyy"


def load_panel_csv(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Panel CSV with a header and Date as dd-MM-yyyy. ``strict`` fails on a bad
    date (ANSI ``to_date``); otherwise the date becomes NULL."""
    raw = spark.read.schema(PANEL_CSV_SCHEMA).option("header", True).csv(path)
    parse = F.to_date if strict else F.try_to_date
    return raw.withColumn(C.TIME, parse(F.col(C.TIME), DATE_FORMAT))


def write_panel_csv(df: DataFrame, path: str) -> None:
    (df.withColumn(C.TIME, F.date_format(C.TIME, DATE_FORMAT))
     .write.mode("overwrite").option("header", True).csv(path))


def predictions_wide(long: DataFrame, models: list[str], entity: str = C.ENTITY,
                     time: str = C.TIME, target: str = C.TARGET) -> DataFrame:
    """Long (entity, time, actual, model, pred) -> one ``<model>_Pred`` column per
    model (pivot with the model list given, so no extra distinct job)."""
    wide = (long.groupBy(entity, time).pivot("model", models)
            .agg(F.first("actual").alias("actual"), F.first("pred").alias("pred")))
    actual = F.coalesce(*[F.col(f"{m}_actual") for m in models])
    return wide.select(entity, time, actual.alias(target),
                       *[F.col(f"{m}_pred").alias(f"{m}_Pred") for m in models])


def write_predictions(long: DataFrame, path: str, models: list[str], fmt: str = "csv") -> None:
    wide = predictions_wide(long, models)
    writer = wide.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def read_predictions(spark: SparkSession, path: str, fmt: str = "csv",
                     entity: str = C.ENTITY, time: str = C.TIME,
                     target: str = C.TARGET) -> DataFrame:
    """Wide predictions file -> long (entity, time, actual, model, pred)."""
    if fmt == "csv":
        head = spark.read.option("header", True).csv(path).columns
        schema = T.StructType([T.StructField(entity, T.IntegerType()),
                               T.StructField(time, T.DateType()),
                               T.StructField(target, T.DoubleType())]
                              + [T.StructField(c, T.DoubleType()) for c in head[3:]])
        wide = spark.read.schema(schema).option("header", True).csv(path)
    else:
        wide = spark.read.parquet(path)
    preds = [c for c in wide.columns if c.endswith("_Pred")]
    renamed = wide.select(entity, time, F.col(target).alias("actual"),
                          *[F.col(c).alias(c[: -len("_Pred")]) for c in preds])
    models = [c[: -len("_Pred")] for c in preds]
    return renamed.unpivot([entity, time, "actual"], models, "model", "pred")


METRICS_MAP = T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))


def metrics_document(metrics: DataFrame, names=None) -> DataFrame:
    """One-row frame holding the nested JSON document {model: {metric: value}}.
    The metrics table has one row per model (bounded), so it fits one row."""
    names = names or [c for c in metrics.columns if c != "model"]
    inner = F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("double"))])
    return metrics.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("model", inner))))
                       .alias("value"))


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics_document(metrics).coalesce(1).write.mode("overwrite").text(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Nested metrics JSON ({model: {metric: value}}) -> long (model, metric, value)."""
    doc = spark.read.text(path, wholetext=True)
    parsed = doc.select(F.from_json("value", METRICS_MAP).alias("m"))
    outer = parsed.select(F.explode("m").alias("model", "metrics"))
    return outer.select("model", F.explode("metrics").alias("metric", "value"))
