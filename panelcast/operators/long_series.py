"""History features of long series: one series is many tasks.

``history`` gives a series to one task, which is right for panels. Here a series may hold a
third of a very large table, so its rows are numbered and cut into blocks of equal length:

1. Rows are dealt by ranges of (entity, time) to tasks of about ``task_rows`` rows and
   sorted there. A row's position in its series is its place in the task, plus the rows
   that the tasks before hold of the series (a table of one row per task and series).
2. A block is ``block`` consecutive positions. The last ``halo`` rows of a block are copied
   to the block after it, so a window that reaches back ``halo`` rows at most sees in
   (entity, block) what it would see in the whole series. Copies are dropped afterwards.
3. EWMA reaches back without end: a block's state is one row, and a block folds the states
   before it as far as a double can hold their weight.

No task holds more than ``block`` + ``halo`` rows of a window, whatever a series holds. The
price is a stored copy of the rows and one more shuffle, so panels keep to ``history``.

Rows of equal time stand in the order of a hash over all columns; rows that are equal in
every column are interchangeable. A null entity is a series of its own, null times come
first. An empty table gives no rows; columns of the input are kept.
"""
from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..session import materialize
from . import history as hist

#: Rows of a block, and of a task that numbers rows.
BLOCK = 4096
TASK_ROWS = 1 << 20
_POS, _BLOCK, _OWN = "_pos", "_block", "_own"


def _names(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _on(keys: list[str], left: DataFrame, right: DataFrame, prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"{prefix}{c}"]) for c in keys])


def numbered(df: DataFrame, entity: str | list[str] = C.ENTITY, time: str | list[str] = C.TIME,
             task_rows: int = TASK_ROWS) -> DataFrame:
    """The rows, stored, with their position ``_pos`` (from 0) in their series."""
    keys, order = _names(entity), [*_names(entity), *_names(time), "_tie"]
    tasks = max(1, math.ceil(df.count() / task_rows))
    # a stored row number: task in the upper bits, place in the task in the lower 33
    rows = materialize(df.withColumn("_tie", F.xxhash64(*df.columns))
                       .repartitionByRange(tasks, *order).sortWithinPartitions(*order)
                       .withColumn("_row", F.monotonically_increasing_id()).drop("_tie")
                       .withColumn("_task", F.shiftright("_row", 33)))
    parts = rows.groupBy(*keys, "_task").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*[F.col(c).alias(f"_k_{c}") for c in keys], F.col("_task").alias("_k__task"),
                         (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return (rows.join(parts, _on([*keys, "_task"], rows, parts, "_k_"))
            .withColumn(_POS, F.col("_row") + F.col("_shift")).select(*df.columns, _POS))


def with_halo(rows: DataFrame, halo: int, block: int = BLOCK, pos: str = _POS) -> DataFrame:
    """Rows with their ``_block``, and copies of a block's last ``halo`` rows in the next one
    (``_own`` is false). ``pos`` numbers the rows of a series without gaps."""
    if not 0 <= halo <= block:
        raise ValueError(f"a halo of {halo} rows does not fit blocks of {block}")
    home = F.floor(F.col(pos) / block)
    ahead = F.col(pos) % block >= block - halo
    return (rows.withColumn(_BLOCK, F.explode(F.when(ahead, F.array(home, home + 1)).otherwise(F.array(home))))
            .withColumn(_OWN, F.col(_BLOCK) == home))


def over_blocks(rows: DataFrame, build: Callable[[DataFrame, list[str], str], DataFrame], halo: int,
                entity: str | list[str] = C.ENTITY, block: int = BLOCK) -> DataFrame:
    """``build(rows, keys, order)`` over the blocks of numbered rows. It may add columns by
    windows over ``keys`` in the order of ``order`` that reach back ``halo`` rows."""
    out = build(with_halo(rows, halo, max(block, halo)), [*_names(entity), _BLOCK], _POS)
    return out.filter(_OWN).drop(_BLOCK, _OWN)


def lag_features(rows: DataFrame, lags=C.LAGS, entity=C.ENTITY, target: str = C.TARGET,
                 block: int = BLOCK) -> DataFrame:
    """``history.lag_features`` of numbered rows."""
    return over_blocks(rows, lambda df, keys, at: hist.lag_features(df, lags, keys, at, target),
                       max(lags), entity, block)


def rolling_features(rows: DataFrame, windows=C.ROLLING_WINDOWS, entity=C.ENTITY, target: str = C.TARGET,
                     exact: bool = True, block: int = BLOCK) -> DataFrame:
    """The rolling statistics of ``history.rolling_features`` of numbered rows."""
    def build(df, keys, at):
        return df.withColumns(hist.rolling_columns(target, hist.series_window(keys, at), windows, exact))
    return over_blocks(rows, build, max(windows), entity, block)


def trend_features(rows: DataFrame, entity=C.ENTITY, target: str = C.TARGET, leak_safe: bool = False,
                   block: int = BLOCK) -> DataFrame:
    """``history.trend_features`` of numbered rows."""
    return over_blocks(rows, lambda df, keys, at: hist.trend_features(df, keys, at, target, leak_safe),
                       5, entity, block)


def economic_changes(rows: DataFrame, entity=C.ENTITY, restart_col: str | None = None,
                     block: int = BLOCK) -> DataFrame:
    """``history.economic_changes`` of numbered rows."""
    return over_blocks(rows, lambda df, keys, at: hist.economic_changes(df, keys, at, restart_col),
                       1, entity, block)


def _folded(states: Column, decay: float) -> Column:
    """The last state, plus each earlier one aged by the blocks since."""
    return F.aggregate(states, F.lit(0.0), lambda acc, x: acc * decay + x)


def _reach(decay: float, block: int) -> int:
    """Blocks after which a weight is below the smallest double."""
    return 1 + math.ceil(1075 * math.log(2) / (-block * math.log(decay)))


def ewma_features(rows: DataFrame, spans=C.EWMA_SPANS, entity=C.ENTITY, target: str = C.TARGET,
                  block: int = hist.EWMA_BLOCK, states_block: int = BLOCK) -> DataFrame:
    """``history.ewma_features`` of numbered rows. The blocks' states, a row each, are cut
    into blocks of their own, as a long series has many."""
    keys = _names(entity)
    decays = {s: 1.0 - 2.0 / (s + 1.0) for s in spans}
    for span, decay in decays.items():
        if not 0 < decay or -block * math.log(decay) > 600:
            raise ValueError(f"blocks of {block} rows are too long for a span of {span}")
    y = F.col(target).cast("double")
    values = {"v": F.coalesce(y, F.lit(0.0)), "w": y.isNotNull().cast("double")}  # sums, and their weights
    at = F.col(_POS) % block
    homes = rows.withColumn(_BLOCK, F.floor(F.col(_POS) / block))
    ends = homes.groupBy(*keys, _BLOCK).agg(*[
        (F.sum(x * F.pow(F.lit(d), -at)) * d ** (block - 1)).alias(f"_{n}{s}")
        for s, d in decays.items() for n, x in values.items()])
    # ends: sums as they stand at position block - 1 of each block. Only a series' last block
    # is shorter, and no block follows that one.

    def fold(df, by, order):
        w = hist.series_window(by, order)
        out = {}
        for s, d in decays.items():
            frame = w.rowsBetween(-_reach(d, block), -1)
            for n in values:
                out[f"_before_{n}{s}"] = _folded(F.collect_list(f"_{n}{s}").over(frame), d ** block)
        return df.withColumns(out)
    reach = max(_reach(d, block) for d in decays.values())
    states = over_blocks(ends.withColumnRenamed(_BLOCK, _POS), fold, reach, keys, states_block)
    befores = [f"_before_{n}{s}" for s in spans for n in values]
    states = states.select(*[F.col(c).alias(f"_k_{c}") for c in keys], F.col(_POS).alias(f"_k_{_BLOCK}"), *befores)
    joined = homes.join(states, _on([*keys, _BLOCK], homes, states, "_k_"))
    inside = hist.series_window([*keys, _BLOCK], _POS).rowsBetween(Window.unboundedPreceding, -1)
    sums = {f"_sum_{n}{s}": F.coalesce(F.sum(x * F.pow(F.lit(d), -at)).over(inside), F.lit(0.0)) * F.pow(F.lit(d), at - 1)
            + F.col(f"_before_{n}{s}") * F.pow(F.lit(d), at) for s, d in decays.items() for n, x in values.items()}
    ewma = {f"ewma_{s}w": F.when(F.col(f"_sum_w{s}") > 0, F.col(f"_sum_v{s}") / F.col(f"_sum_w{s}")) for s in spans}
    return joined.withColumns(sums).withColumns(ewma).select(*rows.columns, *ewma)


def history_features(df: DataFrame, entity=C.ENTITY, time=C.TIME, target: str = C.TARGET,
                     leak_safe: bool = False, block: int = BLOCK, task_rows: int = TASK_ROWS) -> DataFrame:
    """Lags, rolling statistics, trends and EWMA of series of any length, numbered once."""
    def build(rows, keys, at):
        rows = hist.lag_features(rows, entity=keys, time=at, target=target)
        rows = rows.withColumns(hist.rolling_columns(target, hist.series_window(keys, at)))
        return hist.trend_features(rows, keys, at, target, leak_safe)
    rows = numbered(df, entity, time, task_rows)
    halo = max([*C.LAGS, *C.ROLLING_WINDOWS, 5])
    return ewma_features(over_blocks(rows, build, halo, entity, block), entity=entity, target=target).drop(_POS)
