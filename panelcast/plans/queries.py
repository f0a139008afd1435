"""Named queries over the driver's tables: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the star-schema tables (through the weekly panel) and runs
over all of it. Columns whose value depends on floating summation order (std,
EWMA, correlations, ratios of sums) are rounded in the query output; means of
money columns are exact (decimal sums), so they need no rounding.
"""
from __future__ import annotations

import contextvars
import os
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import metrics as M
from ..functions.calendar import DEFAULT_CALENDAR
from ..operators import arma
from ..operators import calendar_features as cf
from ..operators import calendar_joins as cj
from ..operators import changepoints as cp
from ..operators import economic as eco
from ..operators import eda
from ..operators import entity as ent
from ..operators import evaluation as ev
from ..operators import forecast as fc
from ..operators import history as hist
from ..operators import long_series as ls
from ..operators import panel as P
from ..operators import validation as val
from ..session import checkpoint_dir, materialize
from ..sources import files
from ..sources.star import build_panel, table
from .features import engineer_features, engineer_features_split

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# Columns rounded in outputs: name -> digits.
ROUND_FEATURES = {
    **{f"rolling_std_{k}w": 2 for k in C.ROLLING_WINDOWS},
    **{f"ewma_{s}w": 1 for s in C.EWMA_SPANS},
    **{f"{p}_{f}": 6 for p in ("month", "week", "day_of_year", "quarter") for f in ("sin", "cos")},
    "trend_strength": 6, "store_std_sales": 2, "store_cv": 8, "store_median_sales": 6,
    "temp_deviation": 6,
}


def rounded(df: DataFrame, spec: dict[str, int] = ROUND_FEATURES) -> DataFrame:
    return df.select(*[F.round(F.col(c), spec[c]).alias(c) if c in spec else F.col(c)
                       for c in df.columns])


_PANELS: dict = {}
_PANEL_LOCK = threading.Lock()


#: The panel that the named queries read: nation grain, or a variant (see VARIANTS).
_GRAIN: contextvars.ContextVar[str] = contextvars.ContextVar("grain", default="nation")


def with_gaps(p: DataFrame) -> DataFrame:
    """The panel with the target missing in about one row of eleven, by a fixed rule."""
    gap = F.pmod(F.col(C.ENTITY) * 7 + F.dayofyear(C.TIME), F.lit(11)) == 0
    return p.withColumn(C.TARGET, F.when(~gap, F.col(C.TARGET)))


def panel(spark: SparkSession, sf: str, grain: str | None = None) -> DataFrame:
    """The weekly panel, materialized once per session and table set.

    The panel is orders of magnitude smaller than the tables it is built from
    and every query reads it (often several times: main branch, training
    statistics, scalar subqueries). A reliable checkpoint in the shared
    checkpoint folder runs the star join once and cuts the lineage, so a lost
    executor never recomputes the join. Its series are dealt to tasks of a
    bounded number of rows (``panel.by_series``).
    """
    grain = grain or _GRAIN.get()
    if grain == "gaps":
        return with_gaps(panel(spark, sf, "nation"))
    key = (spark.sparkContext.applicationId, sf, grain)
    with _PANEL_LOCK:
        if key not in _PANELS:
            _PANELS[key] = P.by_series(materialize(build_panel(spark, sf, grain)))
        return _PANELS[key]


def featured(spark: SparkSession, sf: str) -> DataFrame:
    return engineer_features_split(panel(spark, sf))


def baseline_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Validation rows with the three baseline predictions (rows where all exist)."""
    p = panel(spark, sf)
    w = hist.series_window()
    y = F.col(C.TARGET)
    frame = p.withColumns({
        "naive_Pred": F.lag(y, 1).over(w),
        "seasonal_naive_Pred": F.lag(y, 52).over(w),
        "moving_average_4w_Pred": hist.rolling_columns(C.TARGET, w, windows=(4,))["rolling_mean_4w"],
    })
    return (P.with_split(frame).filter(F.col("split") == "validation").drop("split")
            .dropna(subset=[f"{m}_Pred" for m in fc.BASELINES]))


def baseline_long(spark: SparkSession, sf: str) -> DataFrame:
    wide = baseline_wide(spark, sf)
    return ev.predictions_long(wide, {m: f"{m}_Pred" for m in fc.BASELINES})


MODELS = list(fc.BASELINES)


def baseline_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return ev.all_metrics(baseline_long(spark, sf))


# ------------------------------------------------------------ sources / sinks
@query("load_panel")
def q_load_panel(spark, sf):
    # first use runs the star join and writes the panel to the checkpoint folder
    return panel(spark, sf)


@query("load_panel_region")
def q_load_panel_region(spark, sf):
    """The panel at region grain (5 series), as used by the flagship query."""
    return panel(spark, sf, "region")


@query("forecast_scorecard")
def q_forecast_scorecard(spark, sf):
    """The flagship query of entry(): region panel -> baselines -> ranked metrics."""
    from .flagship import forecast_scorecard
    return forecast_scorecard(spark, sf)


@query("write_predictions")
def q_write_predictions(spark, sf):
    """The wide predictions file as the sink writes it, read back."""
    path = os.path.join(checkpoint_dir(spark), f"predictions-{uuid.uuid4().hex[:10]}")
    files.write_predictions(baseline_long(spark, sf), path, MODELS, fmt="parquet")
    return spark.read.parquet(path)


# ------------------------------------------------------ projections / filters
@query("time_split")
def q_time_split(spark, sf):
    return P.split_report(panel(spark, sf))


@query("store_list")
def q_store_list(spark, sf):
    return P.store_list(panel(spark, sf))


@query("store_slice")
def q_store_slice(spark, sf):
    return P.store_slice(panel(spark, sf), 1)


@query("series_frame")
def q_series_frame(spark, sf):
    return P.series_frame(panel(spark, sf))


@query("drop_missing")
def q_drop_missing(spark, sf):
    return rounded(P.drop_missing(featured(spark, sf)))


@query("fill_missing_store_mean")
def q_fill_missing(spark, sf):
    cols = [f"sales_lag_{k}" for k in C.LAGS] + ["rolling_std_4w"]
    f = featured(spark, sf).select(C.ENTITY, C.TIME, *cols)
    filled = P.fill_missing_store_mean(f, columns=cols)
    # lags hold 4-decimal values (exact at 4 digits); std values are inexact.
    return filled.select(C.ENTITY, C.TIME, *[F.round(c, 2 if c.startswith("rolling") else 4).alias(c)
                                             for c in cols])


@query("holiday_label")
def q_holiday_label(spark, sf):
    return P.holiday_label(panel(spark, sf)).select(C.ENTITY, C.TIME, C.HOLIDAY_FLAG, "Holiday")


@query("holidays_in_range")
def q_holidays_in_range(spark, sf):
    return cf.holidays_in_range(panel(spark, sf))


@query("select_model")
def q_select_model(spark, sf):
    return ev.select_model(baseline_long(spark, sf), "naive")


@query("metrics_report")
def q_metrics_report(spark, sf):
    return ev.metrics_report(ev.all_metrics(baseline_long(spark, sf), digits=None))


# ---------------------------------------------------------- scalar functions
@query("temporal_features")
def q_temporal(spark, sf):
    return cf.temporal_features(panel(spark, sf))


@query("cyclical_features")
def q_cyclical(spark, sf):
    return rounded(cf.cyclical_features(cf.temporal_features(panel(spark, sf))))


@query("interaction_features")
def q_interaction(spark, sf):
    p = cf.temporal_features(panel(spark, sf))
    return cf.interaction_features(p).select(C.ENTITY, C.TIME, "store_holiday", "store_month",
                                             "temp_quarter")


def _train(p: DataFrame) -> DataFrame:
    return P.time_split(p)[0]


@query("temperature_features")
def q_temperature(spark, sf):
    p = panel(spark, sf)
    out = eco.temperature_features(p, _train(p))
    return rounded(out.select(C.ENTITY, C.TIME, "Temperature", "temp_deviation", "temp_squared",
                              "temp_category"))


@query("unemployment_level")
def q_unemployment(spark, sf):
    p = panel(spark, sf)
    return eco.unemployment_level(p, _train(p)).select(C.ENTITY, C.TIME, "Unemployment",
                                                       "unemployment_above_avg")


@query("cpi_ratio")
def q_cpi_ratio(spark, sf):
    return eco.cpi_ratio(panel(spark, sf)).select(C.ENTITY, C.TIME, "cpi_unemployment_ratio")


@query("store_size_bins")
def q_store_size_bins(spark, sf):
    p = panel(spark, sf)
    return rounded(ent.store_table(_train(p)))


@query("month_labels")
def q_month_labels(spark, sf):
    return cf.month_labels(panel(spark, sf)).select(C.ENTITY, C.TIME, "Month", "Month_Name")


# --------------------------------------------------------------------- joins
@query("store_features")
def q_store_features(spark, sf):
    p = panel(spark, sf)
    return rounded(ent.store_features(p, _train(p)))


@query("holiday_window_flags")
def q_holiday_flags(spark, sf):
    out = cf.holiday_window_flags(panel(spark, sf))
    return out.select(C.ENTITY, C.TIME, *[c for c in out.columns if c.startswith("is_")])


@query("holiday_distance")
def q_holiday_distance(spark, sf):
    return cf.holiday_distance(panel(spark, sf)).select(
        C.ENTITY, C.TIME, "weeks_to_next_holiday", "weeks_since_last_holiday")


def _calendar_table(p):
    """The calendar as a table of its own: the years of the panel and those beside them."""
    years = p.agg(F.min(F.year(C.TIME)).alias("_y0"), F.max(F.year(C.TIME)).alias("_y1"))
    return DEFAULT_CALENDAR.frame(p.sparkSession, F.col("_y0") - 1, F.col("_y1") + 1, source=years)


@query("holiday_window_flags_table")
def q_holiday_window_flags_table(spark, sf):
    """The window flags by a range join with a calendar table."""
    p = panel(spark, sf).select(C.ENTITY, C.TIME)
    return cj.holiday_window_flags(p, _calendar_table(p))


@query("holiday_distance_table")
def q_holiday_distance_table(spark, sf):
    """The distances by a nearest join with a calendar table."""
    p = panel(spark, sf).select(C.ENTITY, C.TIME)
    return cj.holiday_distance(p, _calendar_table(p))


@query("rolling_origin_metrics")
def q_rolling_origin_metrics(spark, sf):
    out = val.rolling_origin_metrics(val.rolling_origin_forecasts(panel(spark, sf)), digits=None)
    # means of few exact values may lie just between two rounded ones: a nudge decides them
    return out.select("fold", "model", *[F.round(F.col(c) + 1e-9, 6).alias(c) for c in out.columns if c not in ("fold", "model")])


@query("train_stat_scalars")
def q_train_stat_scalars(spark, sf):
    p = panel(spark, sf)
    out = eco.train_stat_scalars(p.select(C.ENTITY, C.TIME), _train(p))
    return out.select(C.ENTITY, C.TIME, *[F.round(c, 8).alias(c)
                                          for c in ("temp_mean", "temp_std", "unemp_mean")])


@query("align_predictions")
def q_align(spark, sf):
    p = panel(spark, sf)
    return ev.align_predictions(p, baseline_long(spark, sf), MODELS)


# -------------------------------------------------------------- aggregations
@query("validate_panel")
def q_validate(spark, sf):
    return P.validate_panel(panel(spark, sf))


@query("panel_summary")
def q_summary(spark, sf):
    return P.panel_summary(panel(spark, sf)).withColumn(
        "sales_median", F.round("sales_median", 6))


@query("store_stats")
def q_store_stats(spark, sf):
    p = panel(spark, sf)
    return rounded(ent.store_stats(_train(p)))


@query("sales_by_date")
def q_sales_by_date(spark, sf):
    return eda.sales_by_date(panel(spark, sf))


@query("sales_by_store")
def q_sales_by_store(spark, sf):
    return eda.sales_by_store(panel(spark, sf))


@query("seasonality")
def q_seasonality(spark, sf):
    return eda.seasonality(panel(spark, sf))


@query("holiday_box")
def q_holiday_box(spark, sf):
    return eda.holiday_box(panel(spark, sf))


@query("store_month_pivot")
def q_store_month_pivot(spark, sf):
    return eda.store_month_pivot(panel(spark, sf))


@query("correlation_matrix")
def q_corr(spark, sf):
    return eda.correlation_matrix(panel(spark, sf))


@query("sales_histogram")
def q_hist(spark, sf):
    return eda.sales_histogram(panel(spark, sf))


@query("actual_vs_predicted")
def q_avp(spark, sf):
    return eda.actual_vs_predicted(baseline_long(spark, sf))


@query("residual_histogram")
def q_residual_hist(spark, sf):
    return eda.residual_histogram(baseline_long(spark, sf))


@query("wmape")
def q_wmape(spark, sf):
    return ev.metric_by(baseline_long(spark, sf), "WMAPE")


@query("mape")
def q_mape(spark, sf):
    return ev.metric_by(baseline_long(spark, sf), "MAPE")


@query("smape")
def q_smape(spark, sf):
    return ev.metric_by(baseline_long(spark, sf), "SMAPE")


@query("all_metrics")
def q_all_metrics(spark, sf):
    return baseline_metrics(spark, sf)


@query("wmape_per_store")
def q_wmape_store(spark, sf):
    return ev.wmape_per_store(baseline_long(spark, sf))


@query("wmape_per_period")
def q_wmape_period(spark, sf):
    return ev.wmape_per_period(baseline_long(spark, sf))


@query("wmape_store_model")
def q_wmape_store_model(spark, sf):
    return ev.wmape_store_model(baseline_long(spark, sf), MODELS)


# ------------------------------------------------------------------- windows
@query("lag_features")
def q_lags(spark, sf):
    out = hist.lag_features(panel(spark, sf))
    return out.select(C.ENTITY, C.TIME, C.TARGET, *[f"sales_lag_{k}" for k in C.LAGS])


@query("same_week_last_year")
def q_swly(spark, sf):
    out = hist.same_week_last_year(panel(spark, sf))
    return out.select(C.ENTITY, C.TIME, "week_of_year", "sales_same_week_last_year")


@query("rolling_features")
def q_rolling(spark, sf):
    p = panel(spark, sf)
    w = hist.series_window()
    out = p.withColumns(hist.rolling_columns(C.TARGET, w))
    return rounded(out.drop("Temperature", "Fuel_Price", "CPI", "Unemployment", C.HOLIDAY_FLAG))


@query("ewma_features")
def q_ewma(spark, sf):
    out = hist.ewma_features(panel(spark, sf))
    return rounded(out.select(C.ENTITY, C.TIME, *[f"ewma_{s}w" for s in C.EWMA_SPANS]))


def _order_series(spark, sf):
    """Orders as three series, one a status, numbered: each holds a third of the table."""
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderdate", "o_orderkey", "o_totalprice")
    return ls.numbered(orders, "o_orderstatus", ["o_orderdate", "o_orderkey"])


@query("lag_features_long")
def q_lags_long(spark, sf):
    out = ls.lag_features(_order_series(spark, sf), entity="o_orderstatus", target="o_totalprice")
    return out.drop("_pos")


@query("rolling_features_long")
def q_rolling_long(spark, sf):
    out = ls.rolling_features(_order_series(spark, sf), entity="o_orderstatus", target="o_totalprice")
    return rounded(out.drop("_pos"))


@query("ewma_features_long")
def q_ewma_long(spark, sf):
    out = ls.ewma_features(_order_series(spark, sf), entity="o_orderstatus", target="o_totalprice")
    return rounded(out.drop("_pos"), {f"ewma_{s}w": 3 for s in C.EWMA_SPANS})


@query("trend_diffs")
def q_trend_diffs(spark, sf):
    out = hist.trend_features(panel(spark, sf))
    return out.select(C.ENTITY, C.TIME, "sales_diff_1", "sales_diff_4", "sales_pct_change_1",
                      "sales_pct_change_4")


@query("trend_strength")
def q_trend_strength(spark, sf):
    p = panel(spark, sf)
    w = hist.series_window()
    out = hist.trend_features(p.withColumns(hist.rolling_columns(C.TARGET, w, windows=(4,))))
    return rounded(out.select(C.ENTITY, C.TIME, "above_rolling_mean_4w", "trend_strength"))


@query("economic_changes")
def q_economic_changes(spark, sf):
    p = P.with_split(panel(spark, sf))
    out = hist.economic_changes(p, C.ENTITY, restart_col="split")
    return out.select(C.ENTITY, C.TIME, "split", "fuel_change", "fuel_pct_change", "cpi_change",
                      "cpi_pct_change", "unemployment_change")


@query("store_rank")
def q_store_rank(spark, sf):
    p = panel(spark, sf)
    return ent.store_rank(ent.store_stats(_train(p))).select(
        C.ENTITY, "store_mean_sales", "store_rank", "store_percentile")


@query("model_rank")
def q_model_rank(spark, sf):
    return ev.model_rank(baseline_metrics(spark, sf))


# ---------------------------------------------------------- sort / top-k
@query("panel_order")
def q_panel_order(spark, sf):
    return panel(spark, sf).orderBy(C.ENTITY, C.TIME)


@query("best_model")
def q_best_model(spark, sf):
    return ev.best_model(baseline_metrics(spark, sf))


@query("best_epoch")
def q_best_epoch(spark, sf):
    return ev.best_epoch(ev.history_table(baseline_long(spark, sf)))


# ------------------------------------------------------------- set operations
@query("union_model_results")
def q_union(spark, sf):
    wide = baseline_wide(spark, sf)
    fam1 = ev.predictions_long(wide, {"naive": "naive_Pred", "seasonal_naive": "seasonal_naive_Pred"})
    fam2 = ev.predictions_long(wide, {"moving_average_4w": "moving_average_4w_Pred"})
    return ev.union_model_results(fam1, fam2)


@query("append_history")
def q_history(spark, sf):
    """Backtest history appended in two runs, one of them repeated, to a history table in the checkpoint folder,
    then read back."""
    path = os.path.join(checkpoint_dir(spark), f"history-{uuid.uuid4().hex[:10]}")
    entries = materialize(ev.history_table(baseline_long(spark, sf)))
    ev.append_history(entries.filter("epoch % 2 = 0"), path, "even")
    ev.append_history(entries.filter("epoch % 2 = 1"), path, "odd")
    return ev.append_history(entries.filter("epoch % 2 = 1"), path, "odd")  # a repeated run adds nothing


# ---------------------------------------------------------- pipelines / models
@query("engineer_features")
def q_engineer_features(spark, sf):
    p = panel(spark, sf)
    return rounded(engineer_features(p, _train(p)))


@query("engineer_features_split")
def q_engineer_features_split(spark, sf):
    return rounded(featured(spark, sf))


@query("seasonal_ar_forecast")
def q_seasonal_ar(spark, sf):
    out = fc.seasonal_ar_forecast(panel(spark, sf))
    return out.withColumn("pred", F.round("pred", 2))


@query("seasonal_arma_forecast")
def q_seasonal_arma(spark, sf):
    out = arma.seasonal_arma_forecast(panel(spark, sf))
    return out.withColumn("pred", F.round("pred", 2))


@query("trend_gram")
def q_trend_gram(spark, sf):
    """Sums of products of the trend terms and the log target: what the changepoint model's
    trend is solved from, by place in the upper triangle."""
    grams = cp.gram(cp.trend_rows(panel(spark, sf), C.VALIDATION_START), cp.trend_terms())
    return grams.select(C.ENTITY, "n", F.posexplode("gram").alias("place", "total")).withColumn("total", F.round("total", 5))


@query("prophet_holidays")
def q_prophet_holidays(spark, sf):
    return cf.prophet_holidays(panel(spark, sf))


@query("ensemble_gate")
def q_ensemble_gate(spark, sf):
    return fc.ensemble_gate(baseline_metrics(spark, sf))


def _blend_models(spark, sf) -> list[str]:
    """Weight optimisation takes every model it is given (the WMAPE gate is a
    separate step of the training job, see ``ensemble_gate``)."""
    return sorted(MODELS)


@query("ensemble_weights")
def q_ensemble_weights(spark, sf):
    models = _blend_models(spark, sf)
    return fc.ensemble_weights(baseline_wide(spark, sf).withColumnRenamed(C.TARGET, "actual"),
                               models)


@query("ensemble_predict")
def q_ensemble_predict(spark, sf):
    models = _blend_models(spark, sf)
    wide = baseline_wide(spark, sf).withColumnRenamed(C.TARGET, "actual")
    weights = {r["model"]: r["weight"] for r in fc.ensemble_weights(wide, models).collect()}
    return fc.ensemble_predict(wide, models, weights)


# ------------------------------------------------------------------ variants
#: The same operators over other panels: one series per customer (as many series as the
#: data has customers), and the nation panel with missing targets.
VARIANTS = {
    "customer": ("load_panel", "panel_summary", "validate_panel", "lag_features", "rolling_features",
                 "ewma_features", "trend_diffs", "same_week_last_year", "store_stats", "store_rank",
                 "store_features", "engineer_features_split", "sales_histogram"),
    "gaps": ("panel_summary", "validate_panel", "lag_features", "rolling_features", "ewma_features",
             "store_stats", "store_rank", "sales_histogram", "residual_histogram", "all_metrics", "wmape",
             "mape", "smape", "wmape_per_store", "holiday_box"),
}


def _variant(fn, grain: str):
    def run(spark, sf):
        token = _GRAIN.set(grain)
        try:
            return fn(spark, sf)
        finally:
            _GRAIN.reset(token)
    return run


for _grain, _names in VARIANTS.items():
    for _name in _names:
        query(f"{_name}_{_grain}")(_variant(REGISTRY[_name], _grain))
