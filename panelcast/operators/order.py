"""Exact ranks and quantiles of a whole table or of large groups, without a task that sees
a whole group.

Values are counted (partial aggregation), and the counts of distinct values are dealt to
buckets by splitters: LEVEL^2 - 1 quantiles of the distinct values from a mergeable summary,
so that a bucket holds about one in LEVEL^2 of the table's distinct values however close
they lie. A running count over the buckets of a group (a bounded table) plus one inside
each bucket gives every value its exact position; the splitters only deal out the work.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Splitters are searched in two steps of LEVEL comparisons.
LEVEL = 32
_ACCURACY = 4 * LEVEL * LEVEL


def splitters(counts: DataFrame, value: str = "_v") -> Column:
    """struct<coarse, fine>: every LEVEL-th splitter, and those between them."""
    cuts = F.percentile_approx(value, [i / LEVEL**2 for i in range(1, LEVEL**2)], _ACCURACY)
    at = counts.agg(cuts.alias("s"))
    coarse = F.transform(F.sequence(F.lit(1), F.lit(LEVEL - 1)), lambda i: F.get("s", i * LEVEL - 1))
    fine = F.transform(F.sequence(F.lit(0), F.lit(LEVEL - 1)), lambda i: F.slice("s", i * LEVEL + 1, F.lit(LEVEL - 1)))
    return at.select(F.struct(coarse.alias("coarse"), fine.alias("fine"))).scalar()


def bucket(value: Column, cuts: Column) -> Column:
    """Number of splitters that are not above a value."""
    def below(array):
        return F.size(F.filter(array, lambda x: x <= value))
    first = below(cuts["coarse"])
    return first * LEVEL + below(F.get(cuts["fine"], first))


def with_buckets(counts: DataFrame, value: str = "_v") -> DataFrame:
    return (counts.withColumn("_s", splitters(counts, value))
            .withColumn("_b", bucket(F.col(value), F.col("_s"))).drop("_s"))


def positions(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """One row per group and distinct value (nulls left out): ``_c`` rows hold the value,
    ``_before`` rows of the group a smaller one, ``_n`` rows any."""
    by = list(by or [])
    groups = [F.col(c) for c in by]
    counts = (df.filter(F.col(value).isNotNull())
              .groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_c")))
    counts = with_buckets(counts)
    totals = counts.groupBy(*by, "_b").agg(F.sum("_c").alias("_t"))
    over = Window.partitionBy(*groups)  # bounded: one row per bucket
    run = over.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*by, "_b", F.coalesce(F.sum("_t").over(run), F.lit(0)).alias("_off"),
                           F.sum("_t").over(over).alias("_n"))
    right = totals.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)],
                          F.col("_b").alias("_b2"), "_off", "_n")
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)] + [F.col("_b") == F.col("_b2")]
    inside = Window.partitionBy(*groups, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    return (counts.join(right, reduce(lambda a, b: a & b, same))
            .select(*by, "_v", "_c", (F.col("_off") + F.coalesce(F.sum("_c").over(inside), F.lit(0))).alias("_before"),
                    "_n"))


def average_ranks(df: DataFrame, value: str) -> DataFrame:
    """(value, rank, n): ascending average rank of each distinct value, and how many rows
    have one. Nulls have no rank and are not counted."""
    return positions(df, value).select(
        F.col("_v").alias(value), (F.col("_before") + (F.col("_c") + 1) / 2.0).alias("rank"), F.col("_n").alias("n"))


def quantiles(df: DataFrame, value: str, probabilities: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """One row per group: the linearly interpolated quantiles, named by ``probabilities``."""
    at = positions(df, value, by)

    def held(index: Column) -> Column:  # the value at a position
        return F.max(F.when((F.col("_before") <= index) & (index < F.col("_before") + F.col("_c")), F.col("_v")))
    last = F.col("_n") - 1
    parts, out = [], []
    for i, (name, p) in enumerate(probabilities.items()):
        where = last * F.lit(float(p))
        parts += [held(F.floor(where)).alias(f"_lo{i}"), held(F.ceil(where)).alias(f"_hi{i}"),
                  F.max(where - F.floor(where)).alias(f"_f{i}")]
        lo, hi, f = (F.col(f"_{k}{i}") for k in ("lo", "hi", "f"))
        out.append(F.when(lo == hi, lo).otherwise(lo * (1 - f) + hi * f).alias(name))
    return at.groupBy(*(by or [])).agg(*parts).select(*(by or []), *out)
