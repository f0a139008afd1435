"""Per-series history operators: lags, rolling statistics, EWMA, trends, changes.

All share one window spec ``W = partitionBy(entity).orderBy(time)`` so Catalyst
plans one hash exchange on the entity and one sort for every column (plus one
extra sort, same exchange, for the same-week-last-year lag). On a panel a
partition of the window is one series, whose length is bounded by the number of
periods, not by data volume.

Semantics: lags are row-based (shift(k) within the series); rolling windows
exclude the current row (frame [-w, -1]); mean/min/max need one value, std two.
"""
from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C

EXACT = "decimal(18,4)"


def series_window(entity: str | list[str] = C.ENTITY, time: str = C.TIME):
    keys = [entity] if isinstance(entity, str) else list(entity)
    return Window.partitionBy(*keys).orderBy(time)


def lag_features(df: DataFrame, lags=C.LAGS, entity=C.ENTITY, time: str = C.TIME,
                 target: str = C.TARGET) -> DataFrame:
    w = series_window(entity, time)
    return df.withColumns({f"sales_lag_{k}": F.lag(target, k).over(w) for k in lags})


def same_week_last_year(df: DataFrame, entity: str = C.ENTITY, time: str = C.TIME,
                        target: str = C.TARGET, week_col: str = "week_of_year") -> DataFrame:
    """Previous row of the same entity and ISO week number (needs week_of_year)."""
    if week_col not in df.columns:
        df = df.withColumn(week_col, F.weekofyear(time))
    w = Window.partitionBy(entity, week_col).orderBy(time)
    return df.withColumn("sales_same_week_last_year", F.lag(target, 1).over(w))


def rolling_columns(target: str, w, windows=C.ROLLING_WINDOWS, exact: bool = True) -> dict[str, Column]:
    y = F.col(target)
    cols = {}
    for k in windows:
        frame = w.rowsBetween(-k, -1)
        if exact:
            # decimal sum -> one division: independent of summation order
            mean = F.try_divide(F.sum(y.cast(EXACT)).over(frame).cast("double"),
                                F.count(y).over(frame).cast("double"))
        else:
            mean = F.avg(y).over(frame)
        cols[f"rolling_mean_{k}w"] = mean
        cols[f"rolling_std_{k}w"] = F.stddev_samp(y).over(frame)
        if k <= C.MINMAX_MAX_WINDOW:
            cols[f"rolling_min_{k}w"] = F.min(y).over(frame)
            cols[f"rolling_max_{k}w"] = F.max(y).over(frame)
    return cols


# Rows of a series block: scaling by decay^-EWMA_BLOCK stays far inside a double's range.
EWMA_BLOCK = 512


def ewma_columns(target: str, spans=C.EWMA_SPANS, entity=C.ENTITY, time: str = C.TIME) -> dict[str, Column]:
    """Adjusted EWMA (alpha = 2/(span+1)) of all previous rows, min_periods = 1:

    sum_i (1-a)^(t-1-i) y[i] / sum_i (1-a)^(t-1-i) over the rows i < t whose y is not
    null; a null row has no weight but ages the others. There is no cut: a series is
    taken in blocks of EWMA_BLOCK rows. Inside a block both sums are running sums of
    values scaled by (1-a)^-position; the state at each block's end is folded over the
    blocks before. The work is linear in the rows, and the block windows reuse the
    entity's partitioning.
    """
    keys = [entity] if isinstance(entity, str) else list(entity)
    w = series_window(entity, time)
    row = F.row_number().over(w) - 1
    block, at = F.floor(row / EWMA_BLOCK), row % EWMA_BLOCK
    inside = (Window.partitionBy(*keys, "_ewma_block").orderBy(time)
              .rowsBetween(Window.unboundedPreceding, -1))
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    out = {"_ewma_block": block, "_ewma_at": at}
    y = F.col(target).cast("double")
    for span in spans:
        decay = 1.0 - 2.0 / (span + 1.0)
        scale = F.pow(F.lit(decay), -F.col("_ewma_at"))
        sums = []
        for value in (y, F.when(y.isNotNull(), F.lit(1.0))):
            scaled = value * scale
            running = F.coalesce(F.sum(scaled).over(inside), F.lit(0.0))
            # the sum as it stands at a block's last row, for the blocks after it
            state = F.when(F.col("_ewma_at") == EWMA_BLOCK - 1,
                           F.col(f"_run{len(sums)}_{span}") + F.coalesce(scaled, F.lit(0.0))
                           ) * (decay ** (EWMA_BLOCK - 1))
            sums.append((running, state))
        for i, (running, state) in enumerate(sums):
            out[f"_run{i}_{span}"] = running
            out[f"_state{i}_{span}"] = state
            before = F.aggregate(F.collect_list(F.col(f"_state{i}_{span}")).over(earlier), F.lit(0.0),
                                 lambda acc, x: acc * (decay ** EWMA_BLOCK) + x)
            out[f"_sum{i}_{span}"] = (F.col(f"_run{i}_{span}") * F.pow(F.lit(decay), F.col("_ewma_at") - 1)
                                      + before * F.pow(F.lit(decay), F.col("_ewma_at")))
        out[f"ewma_{span}w"] = F.when(F.col(f"_sum1_{span}") > 0, F.col(f"_sum0_{span}") / F.col(f"_sum1_{span}"))
    return out


def rolling_features(df: DataFrame, windows=C.ROLLING_WINDOWS, spans=C.EWMA_SPANS,
                     entity=C.ENTITY, time: str = C.TIME, target: str = C.TARGET,
                     exact: bool = True) -> DataFrame:
    w = series_window(entity, time)
    cols = rolling_columns(target, w, windows, exact)
    return ewma_features(df.withColumns(cols), spans, entity, time, target)


def ewma_features(df: DataFrame, spans=C.EWMA_SPANS, entity=C.ENTITY, time: str = C.TIME,
                  target: str = C.TARGET) -> DataFrame:
    columns = ewma_columns(target, spans, entity, time)
    out = df
    for prefix in ("_ewma", "_run", "_state", "_sum", "ewma_"):  # each step reads the one before
        out = out.withColumns({n: c for n, c in columns.items() if n.startswith(prefix)})
    return out.drop(*[n for n in columns if n.startswith("_")])


def trend_features(df: DataFrame, entity=C.ENTITY, time: str = C.TIME,
                   target: str = C.TARGET, leak_safe: bool = False) -> DataFrame:
    """sales_diff_{1,4}, sales_pct_change_{1,4}; above_rolling_mean_4w and
    trend_strength when the 4-week rolling columns exist.

    ``leak_safe=True`` computes them on the previous row's value instead of the
    current target, so no column is a function of the value being predicted.
    """
    w = series_window(entity, time)
    y = F.col(target)
    base = F.lag(y, 1).over(w) if leak_safe else y
    shift = 1 if leak_safe else 0
    cols = {}
    for k in (1, 4):
        prev = F.lag(y, k + shift).over(w)
        cols[f"sales_diff_{k}"] = base - prev
        cols[f"sales_pct_change_{k}"] = F.try_divide(base, prev) - 1
    out = df.withColumns(cols)
    if "rolling_mean_4w" in df.columns:
        cur = F.lag(y, 1).over(w) if leak_safe else y
        out = out.withColumn("above_rolling_mean_4w",
                             F.coalesce(cur > F.col("rolling_mean_4w"), F.lit(False)).cast("int"))
        if "rolling_std_4w" in df.columns:
            out = out.withColumn("trend_strength",
                                 F.try_divide(cur - F.col("rolling_mean_4w"),
                                              F.col("rolling_std_4w") + C.TREND_STD_OFFSET))
    return out


def economic_changes(df: DataFrame, entity=C.ENTITY, time: str = C.TIME,
                     restart_col: str | None = None) -> DataFrame:
    """fuel/cpi/unemployment changes vs the previous row of the series.

    ``restart_col`` (e.g. ``"split"``) restarts each series where that column
    changes (first validation row -> NULL). The column must be monotone in time
    within a series, so the guard "previous row has the same value" equals
    partitioning by it, while reusing the series window (no extra exchange).
    Passing ``entity=["split", "Store"]`` gives the same result with its own
    partitioning."""
    w = series_window(entity, time)
    same = (F.lag(restart_col, 1).over(w) == F.col(restart_col)) if restart_col else None
    out = {}
    for src, name, pct in (("Fuel_Price", "fuel", True), ("CPI", "cpi", True),
                           ("Unemployment", "unemployment", False)):
        prev = F.lag(src, 1).over(w)
        if same is not None:
            prev = F.when(same, prev)
        out[f"{name}_change"] = F.col(src) - prev
        if pct:
            out[f"{name}_pct_change"] = F.try_divide(F.col(src), prev) - 1
    return df.withColumns(out)
