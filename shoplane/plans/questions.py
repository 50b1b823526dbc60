"""The self-serve question set.

Questions over one attribute of a dimension reduce the orders to one row per key first and join afterwards: the join
then sees each key once, however many orders a single customer or product holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplane.functions.scalars import TOTAL, day_of, earns, noise_in_text, total
from shoplane.operators.daily import (
    daily_totals,
    day_over_day,
    mean_value,
    on_every_day,
    revenue_columns,
    rolling_value,
    volume_anomalies,
)
from shoplane.operators.lookup import balanced_lookup, totals_without_match
from shoplane.plans.marts import payment_coverage

CUTS = ("day", "category", "segment", "country")


def daily_revenue(orders: DataFrame) -> DataFrame:
    """Question 1: orders, gross and net revenue per day."""
    return daily_totals(orders)


def revenue_by(orders: DataFrame, dim: DataFrame, key: str, attribute: str) -> DataFrame:
    """Question 1: revenue per attribute of a dimension; orders without a match fall under NULL."""
    per_key = orders.groupBy(key).agg(*revenue_columns())
    looked_up = dim.select(F.col(key).alias("_key"), attribute)
    return (
        per_key.join(looked_up, F.col(key) == F.col("_key"), "left")
        .groupBy(attribute)
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("gross_revenue").cast(TOTAL).alias("gross_revenue"),
            F.sum("net_revenue").cast(TOTAL).alias("net_revenue"),
        )
    )


def revenue_cuts(facts: DataFrame) -> DataFrame:
    """Question 1, all cuts from one scan of the fact table; ``cut`` names the cut and ``label`` its value.

    Orders are first reduced to one row per combination of the four attributes, so only that small table is multiplied
    by the grouping sets.
    """
    combined = facts.groupBy(F.col("order_day").alias("day"), "category", "segment", "country").agg(
        *revenue_columns()
    )
    grouped = combined.groupingSets(
        [[F.col(name)] for name in CUTS], *[F.col(name) for name in CUTS]
    ).agg(
        F.grouping_id(*CUTS).alias("grouping"),
        F.sum("orders").alias("orders"),
        F.sum("gross_revenue").cast(TOTAL).alias("gross_revenue"),
        F.sum("net_revenue").cast(TOTAL).alias("net_revenue"),
    )
    every_bit = 2 ** len(CUTS) - 1
    cut, label = F.lit(None), F.lit(None)
    for place, name in enumerate(CUTS):
        here = F.col("grouping") == every_bit - 2 ** (len(CUTS) - 1 - place)
        cut = F.when(here, F.lit(name)).otherwise(cut)
        label = F.when(here, F.col(name).cast("string")).otherwise(label)
    return grouped.select(cut.alias("cut"), label.alias("label"), "orders", "gross_revenue", "net_revenue")


def order_value_per_day(orders: DataFrame) -> DataFrame:
    """Question 2: orders and average order value per day."""
    daily = daily_totals(orders)
    return daily.select("day", "orders", mean_value(F.col("gross_revenue"), F.col("orders")).alias("aov"))


def order_value_trend(orders: DataFrame, days: int) -> DataFrame:
    """Question 2: the trend over any number of days."""
    return rolling_value(on_every_day(daily_totals(orders)), days)


def lifetime_value(orders: DataFrame) -> DataFrame:
    """Question 3: per customer the orders, net value (``ltv``), gross value, first and last order."""
    return (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("orders"),
            total(F.when(earns(), F.col("total_amount"))).alias("ltv"),
            total(F.col("total_amount")).alias("gross_value"),
            F.min("ordered_at").alias("first_at"),
            F.max("ordered_at").alias("last_at"),
        )
    )


def top_customers(orders: DataFrame, n: int) -> DataFrame:
    """Question 3: the ``n`` customers of highest lifetime value, ties by id."""
    return lifetime_value(orders).orderBy(F.desc("ltv"), "customer_id").limit(n)


def uncovered_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Question 4: orders whose payments do not sum to their total."""
    return (
        payment_coverage(orders.select("order_id", "total_amount"), payments)
        .filter(F.col("coverage") != "ok")
        .select("order_id", "total_amount", "paid", "gap", "coverage")
    )


def uncovered_facts(facts: DataFrame) -> DataFrame:
    """Question 4 from the fact table, which carries the coverage already."""
    gap = (F.col("total_amount") - F.col("paid")).cast(TOTAL)
    return facts.filter(F.col("coverage") != "ok").select(
        "order_id", "total_amount", "paid", gap.alias("gap"), "coverage"
    )


def orphan_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Question 5: rows and value of orders without customer or product and of payments without order."""
    orders, payments = tables["orders"], tables["payments"]
    kinds = [
        ("orders without customer", orders, tables["customers"], "customer_id", "total_amount", "order_id"),
        ("orders without product", orders, tables["products"], "product_id", "total_amount", "order_id"),
        ("payments without order", payments, orders, "order_id", "amount", "payment_id"),
    ]
    parts = [
        totals_without_match(fact, dim, key, key, amount, row_id).select(F.lit(kind).alias("kind"), "rows", "amount")
        for kind, fact, dim, key, amount, row_id in kinds
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def volume_change(orders: DataFrame) -> DataFrame:
    """Question 6: orders per day against the day before."""
    return day_over_day(on_every_day(daily_totals(orders)))


def volume_flags(raw_orders: DataFrame, window_days: int = 28, deviations: int = 3) -> DataFrame:
    """Question 6: spikes and drops.

    Takes orders as landed: deduplication would hide a burst of copies.
    """
    return volume_anomalies(on_every_day(daily_totals(raw_orders)), window_days, deviations)


def volume_until_now(raw_orders: DataFrame, now: Column, window_days: int = 28, deviations: int = 3) -> DataFrame:
    """The open day against the days before it, each up to the same time of day, as ``volume_flags`` has it; one row.

    An outage shows while the day still runs; a load that comes at its usual times does not, and a day without orders counts zero.
    """
    until = F.unix_seconds("ordered_at") % 86400 <= F.unix_seconds(now) % 86400
    daily = daily_totals(raw_orders.filter((F.col("ordered_at") <= now) & until))
    zero = F.lit(0).cast(TOTAL)
    today = raw_orders.sparkSession.range(1).select(
        day_of(now).alias("day"), F.lit(0).cast("bigint").alias("orders"), zero.alias("gross_revenue"), zero.alias("net_revenue")
    )
    summed = daily.unionByName(today).groupBy("day")
    summed = summed.agg(F.sum("orders").alias("orders"), *[F.sum(name).cast(TOTAL).alias(name) for name in ("gross_revenue", "net_revenue")])
    return volume_anomalies(on_every_day(summed), window_days, deviations).filter(F.col("day") == day_of(now))


def margin_by_product(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Units, revenue and margin per product ordered; cost is the product's own."""
    sold = orders.groupBy("product_id").agg(
        F.sum("quantity").alias("units"), total(F.col("total_amount")).alias("revenue")
    )
    costs = products.select(F.col("product_id").alias("_product"), "category", "cost")
    return sold.join(costs, F.col("product_id") == F.col("_product"), "left").select(
        "product_id",
        "category",
        "units",
        "revenue",
        (F.col("revenue") - F.col("cost") * F.col("units")).cast(TOTAL).alias("margin"),
    )


def late_signups(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders placed before their customer signed up."""
    signups = customers.select(F.col("customer_id").alias("_customer"), "created_at")
    return (
        balanced_lookup(orders, signups, "customer_id", "_customer", "order_id")
        .filter(F.col("ordered_at") < F.col("created_at"))
        .select("order_id", "customer_id", "ordered_at", "created_at")
    )


def malformed_statuses(orders: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Orders with a status outside the accepted ones, and whether it is noise rather than an unknown word."""
    return orders.filter(~F.col("status").isin(*statuses)).select(
        "order_id", "status", noise_in_text(F.col("status")).alias("noise")
    )
