"""Flagship query: weekly panel -> baseline forecasts -> per-model metrics."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import evaluation as ev
from ..operators import forecast as fc
from ..operators import history as hist
from ..operators.panel import with_split
from ..sources.star import build_panel


def forecast_scorecard(spark: SparkSession, sf_dir: str, grain: str = "region",
                       val_start: str = C.VALIDATION_START) -> DataFrame:
    """Metrics (WMAPE, MAPE, SMAPE, MAE, RMSE, R2, Mean_Error, Median_AE) per
    baseline model on the validation weeks, ranked by WMAPE."""
    p = build_panel(spark, sf_dir, grain)
    w = hist.series_window()
    y = F.col(C.TARGET)
    frame = p.withColumns({
        "naive": F.lag(y, 1).over(w),
        "seasonal_naive": F.lag(y, 52).over(w),
        "moving_average_4w": hist.rolling_columns(C.TARGET, w, windows=(4,))["rolling_mean_4w"],
    })
    val = with_split(frame, val_start).filter(F.col("split") == "validation")
    long = ev.predictions_long(val, {m: m for m in fc.BASELINES}).dropna(subset=["pred"])
    return ev.model_rank(ev.all_metrics(long))
