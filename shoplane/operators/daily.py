"""Daily totals, a gap-free day line, and windows over it.

The windows here are not partitioned: their input has one row per calendar day, a few thousand however many orders the
days hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplane.functions.scalars import TOTAL, day_of, earns, total

WIDE = "decimal(38,0)"


def revenue_columns() -> list[Column]:
    """Order count, gross revenue (every order) and net revenue (without cancelled and returned orders)."""
    return [
        F.count("*").alias("orders"),
        total(F.col("total_amount")).alias("gross_revenue"),
        total(F.when(earns(), F.col("total_amount"))).alias("net_revenue"),
    ]


def daily_totals(orders: DataFrame) -> DataFrame:
    """Orders, gross and net revenue per calendar day."""
    return orders.groupBy(day_of("ordered_at").alias("day")).agg(*revenue_columns())


def on_every_day(daily: DataFrame) -> DataFrame:
    """``daily`` with a row for every day between its first and last; missing days count zero."""
    span = daily.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    line = span.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day"))
    zero = F.lit(0).cast(TOTAL)
    return line.join(daily, "day", "left").select(
        "day",
        F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders"),
        F.coalesce("gross_revenue", zero).alias("gross_revenue"),
        F.coalesce("net_revenue", zero).alias("net_revenue"),
    )


def mean_value(amount: Column, rows: Column) -> Column:
    """Average in cents, NULL over no rows."""
    return F.try_divide(amount, rows).cast("decimal(12,2)")


def day_over_day(daily: DataFrame) -> DataFrame:
    """Orders of the previous day and the ratio to them; the ratio is NULL after a day without orders."""
    previous = F.lag("orders").over(Window.orderBy("day"))
    return (
        daily.withColumn("previous_orders", previous)
        .withColumn("ratio", F.round(F.try_divide(F.col("orders"), F.col("previous_orders")), 4))
        .select("day", "orders", "previous_orders", "ratio")
    )


def volume_anomalies(daily: DataFrame, window_days: int = 28, deviations: int = 3) -> DataFrame:
    """Flag days whose order count lies more than ``deviations`` standard deviations from the days before.

    The test ``|x - mean| > k * sd`` is squared and multiplied out, so it is decided in whole numbers:
    ``(n*x - sum)^2 * (n - 1) > k^2 * n * (n * sum_of_squares - sum^2)``.
    """
    before = Window.orderBy("day").rowsBetween(-window_days, -1)
    x = F.col("orders").cast(WIDE)
    counted = daily.select(
        "day",
        "orders",
        F.count("*").over(before).alias("baseline_days"),
        F.coalesce(F.sum("orders").over(before), F.lit(0)).alias("baseline_orders"),
        F.coalesce(F.sum((x * x).cast(WIDE)).over(before), F.lit(0)).cast(WIDE).alias("squares"),
    )
    n = F.col("baseline_days").cast(WIDE)
    s = F.col("baseline_orders").cast(WIDE)
    off = (n * x - s).cast(WIDE)
    spread = (n * F.col("squares") - s * s).cast(WIDE)
    beyond = ((off * off).cast(WIDE) * (n - F.lit(1))).cast(WIDE) > (n * spread * F.lit(deviations**2)).cast(WIDE)
    return counted.select(
        "day",
        "orders",
        "baseline_days",
        "baseline_orders",
        F.when(beyond & (off > 0), "spike").when(beyond & (off < 0), "drop").otherwise("normal").alias("flag"),
    )


def rolling_value(daily: DataFrame, days: int) -> DataFrame:
    """Order value and orders per day over the last ``days`` days, the current one included."""
    recent = Window.orderBy("day").rowsBetween(-(days - 1), 0)
    summed = daily.select(
        "day",
        F.count("*").over(recent).alias("window_days"),
        F.sum("orders").over(recent).alias("window_orders"),
        F.sum("gross_revenue").over(recent).cast(TOTAL).alias("window_revenue"),
    )
    return summed.withColumn("rolling_aov", mean_value(F.col("window_revenue"), F.col("window_orders"))).withColumn(
        "orders_per_day", F.round(F.col("window_orders") / F.col("window_days"), 4)
    )
