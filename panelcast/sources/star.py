"""Weekly (entity, week) sales panel derived from the star-schema tables.

Mapping (shared by every query):
  Store         c_nationkey + 1 (nation grain; region grain: r_regionkey + 1;
                customer grain: c_custkey)
  Date          Friday of the ISO week of o_orderdate
  Weekly_Sales  sum(l_extendedprice * (1 - l_discount))
  Temperature   avg(l_quantity)   Fuel_Price avg(l_tax)
  CPI           avg(l_extendedprice)   Unemployment avg(l_discount)
  Holiday_Flag  week within +-3 days of a calendar holiday

Plan shape (what scales): lineitem is pre-aggregated per order with map-side
partial aggregation, so the shuffle carries at most one row per order and
partition; the join with orders then reuses that hash partitioning on the order
key. A hot order, customer or nation never reaches one task as raw rows: the
only exchanges after the join carry partial aggregates. The customer -> nation
lookup is joined on the customer key (AQE may broadcast it when its runtime size
is small, and splits skewed partitions otherwise); the final (nation, week)
aggregation again runs partial-then-final.

Money and average columns are summed exactly as scaled integers (the inputs
carry two decimals: cents, and 1e-4 units for price x (1 - discount)), then
converted to double once. Long arithmetic keeps the hot aggregation in
whole-stage codegen (no BigDecimal buffers), overflow raises under ANSI, and
results do not depend on partitioning or summation order.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.calendar import DEFAULT_CALENDAR, HolidayCalendar, any_holiday
from ..functions.dates import week_ending_friday

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

def cents(c):
    """Two-decimal value as an exact integer number of hundredths."""
    return F.round(c * 100).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order partial sums of the line items (one row per order key)."""
    li = table(spark, sf_dir, "lineitem")
    price = cents(F.col("l_extendedprice"))
    disc = cents(F.col("l_discount"))
    return (li.groupBy(F.col("l_orderkey").alias("orderkey"))
            .agg(F.sum(price * (F.lit(100) - disc)).alias("rev"),      # 1e-4 units
                 F.sum(cents(F.col("l_quantity"))).alias("qty"),       # cents
                 F.sum(cents(F.col("l_tax"))).alias("tax"),
                 F.sum(price).alias("price"),
                 F.sum(disc).alias("disc"),
                 F.count(F.lit(1)).alias("n_lines")))


def _entity_map(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"),
                                                   F.col("c_nationkey").alias("nationkey"))
    if grain == "nation":
        return cust.select("custkey", (F.col("nationkey") + 1).cast("int").alias(C.ENTITY))
    if grain == "region":
        nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nationkey"),
                                                       F.col("n_regionkey"))
        # nation is a fixed 25-row dimension: safe to broadcast.
        return (cust.join(F.broadcast(nation), "nationkey")
                .select("custkey", (F.col("n_regionkey") + 1).cast("int").alias(C.ENTITY)))
    if grain == "customer":
        return cust.select("custkey", F.col("custkey").cast("int").alias(C.ENTITY))
    raise ValueError(f"unknown grain {grain!r} (nation | region | customer)")


def build_panel(spark: SparkSession, sf_dir: str, grain: str = "nation",
                calendar: HolidayCalendar = DEFAULT_CALENDAR) -> DataFrame:
    """Panel with schema Store int, Date date, Weekly_Sales, Holiday_Flag int,
    Temperature, Fuel_Price, CPI, Unemployment (double). One row per (Store, Date)."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"),
        week_ending_friday(F.col("o_orderdate")).alias(C.TIME))
    lines = order_lines(spark, sf_dir)
    by_order = orders.join(lines, "orderkey")
    joined = by_order.join(_entity_map(spark, sf_dir, grain), "custkey")
    agg = (joined.groupBy(C.ENTITY, C.TIME)
           .agg(F.sum("rev").alias("rev"), F.sum("qty").alias("qty"), F.sum("tax").alias("tax"),
                F.sum("price").alias("price"), F.sum("disc").alias("disc"),
                F.sum("n_lines").alias("n")))
    n = F.col("n").cast("double")

    def money(c, scale):
        return F.col(c).cast("double") / scale

    return agg.select(
        F.col(C.ENTITY), F.col(C.TIME),
        money("rev", 10000.0).alias(C.TARGET),
        any_holiday(F.col(C.TIME), calendar).alias(C.HOLIDAY_FLAG),
        (money("qty", 100.0) / n).alias("Temperature"),
        (money("tax", 100.0) / n).alias("Fuel_Price"),
        (money("price", 100.0) / n).alias("CPI"),
        (money("disc", 100.0) / n).alias("Unemployment"))


def panel_sql(grain: str = "nation") -> str:
    """DuckDB SQL of the same panel (used in oracle queries as a CTE body)."""
    from ..functions.calendar import sql_values
    ent = {"nation": "CAST(c.c_nationkey + 1 AS INTEGER)", "region": "CAST(n.n_regionkey + 1 AS INTEGER)",
           "customer": "CAST(c.c_custkey AS INTEGER)"}[grain]
    nat = " JOIN nation n ON n.n_nationkey = c.c_nationkey" if grain == "region" else ""
    return f"""
    SELECT Store, Date, CAST(rev AS DOUBLE) AS Weekly_Sales,
           CAST(CASE WHEN EXISTS (SELECT 1 FROM {sql_values(range(1990, 2013))}
                                  WHERE abs(Date - hol.h) <= 3) THEN 1 ELSE 0 END AS INTEGER) AS Holiday_Flag,
           CAST(qty AS DOUBLE) / CAST(n AS DOUBLE) AS Temperature,
           CAST(tax AS DOUBLE) / CAST(n AS DOUBLE) AS Fuel_Price,
           CAST(price AS DOUBLE) / CAST(n AS DOUBLE) AS CPI,
           CAST(disc AS DOUBLE) / CAST(n AS DOUBLE) AS Unemployment
    FROM (
      SELECT {ent} AS Store,
             CAST(o.o_orderdate AS DATE) + CAST(5 - isodow(CAST(o.o_orderdate AS DATE)) AS INTEGER) AS Date,
             sum(CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(18,2))) AS DECIMAL(18,4))) AS rev,
             sum(CAST(l.l_quantity AS DECIMAL(18,2))) AS qty,
             sum(CAST(l.l_tax AS DECIMAL(18,2))) AS tax,
             sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS price,
             sum(CAST(l.l_discount AS DECIMAL(18,2))) AS disc,
             count(*) AS n
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
           JOIN customer c ON o.o_custkey = c.c_custkey{nat}
      GROUP BY 1, 2
    ) g"""
