"""Forecast-accuracy metrics as aggregate Column expressions.

Each builder returns an aggregate ``Column`` usable in any ``agg`` (global, per
model, per store, per period ...), so a metric over any grouping is a single
partial/final hash aggregation, never a driver loop.

Edge semantics:
  WMAPE  sum|a-p| / sum(a) * 100 (signed denominator); NULL when sum(a) = 0.
  MAPE   mean |(a-p)/a| over a != 0, * 100; NULL when every actual is 0.
  SMAPE  mean 2|a-p|/(|a|+|p|) over non-zero denominators, * 100; 0.0 if none of the
         rows has one, NULL without rows.
  R2     1 - SSE / (n * var_pop(a)).
Only rows with both an actual value and a prediction count, in every sum.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _both(a: Column, p: Column) -> Column:
    """The actual value of rows that also have a prediction."""
    return F.when(p.isNotNull(), a)


def wmape(actual, pred) -> Column:
    a, p = _c(actual), _c(pred)
    return F.try_divide(F.sum(F.abs(a - p)), F.sum(_both(a, p))) * 100


def mape(actual, pred) -> Column:
    a, p = _c(actual), _c(pred)
    return F.avg(F.when(a != 0, F.abs(F.try_divide(a - p, a)))) * 100


def smape(actual, pred) -> Column:
    a, p = _c(actual), _c(pred)
    den = F.abs(a) + F.abs(p)
    share = F.avg(F.when(den != 0, F.try_divide(2 * F.abs(a - p), den))) * 100
    return F.when(F.count(a - p) > 0, F.coalesce(share, F.lit(0.0)))


def mae(actual, pred) -> Column:
    return F.avg(F.abs(_c(actual) - _c(pred)))


def rmse(actual, pred) -> Column:
    return F.sqrt(F.avg(F.pow(_c(actual) - _c(pred), 2)))


def r2(actual, pred) -> Column:
    a, p = _c(actual), _c(pred)
    sst = F.var_pop(_both(a, p)) * F.count(_both(a, p))
    return 1 - F.try_divide(F.sum(F.pow(a - p, 2)), sst)


def mean_error(actual, pred) -> Column:
    return F.avg(_c(pred) - _c(actual))


METRIC_NAMES = ("WMAPE", "MAPE", "SMAPE", "MAE", "RMSE", "R2", "Mean_Error", "Median_AE")
PERCENT_METRICS = ("WMAPE", "MAPE", "SMAPE")
MONEY_METRICS = ("MAE", "RMSE", "Mean_Error", "Median_AE")
_BUILDERS = {"WMAPE": wmape, "MAPE": mape, "SMAPE": smape, "MAE": mae, "RMSE": rmse,
             "R2": r2, "Mean_Error": mean_error}


def rounded_metric(name: str, col: Column, digits: int | None) -> Column:
    return col if digits is None else F.round(col, digits + 2 if name == "R2" else digits)


def metric_columns(actual="actual", pred="pred", digits: int | None = 6) -> list[Column]:
    """The seven metrics that are plain aggregates, aliased, optionally rounded (R2 keeps 2
    extra digits). Median_AE is an exact distributed quantile, see evaluation.all_metrics."""
    return [rounded_metric(name, build(actual, pred), digits).alias(name)
            for name, build in _BUILDERS.items()]


def format_metric(name: str, col: Column) -> Column:
    """Percentages as 'x.xx%', money as '$x,xxx', R2 with four digits."""
    if name in PERCENT_METRICS:
        return F.format_string("%.2f%%", col)
    if name in MONEY_METRICS:
        return F.concat(F.when(col < 0, "-$").otherwise("$"), F.format_number(F.abs(col), 0))
    return F.format_string("%.4f", col)
