"""Dimension, fact and daily-revenue tables."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplane.functions.scalars import TOTAL, day_of, earns, total
from shoplane.operators.daily import daily_totals, mean_value
from shoplane.operators.lookup import balanced_lookup


def dim_customers(customers: DataFrame) -> DataFrame:
    """One row per customer."""
    return customers.select(
        "customer_id", "full_name", "email", "country", "city", "segment", day_of("created_at").alias("signup_day")
    )


def dim_products(products: DataFrame) -> DataFrame:
    """One row per product, with the margin of one unit."""
    return products.select(
        "product_id",
        "sku",
        "name",
        "category",
        "unit_price",
        "cost",
        (F.col("unit_price") - F.col("cost")).cast("decimal(11,2)").alias("unit_margin"),
        day_of("created_at").alias("listed_day"),
    )


def paid_per_order(payments: DataFrame) -> DataFrame:
    """Sum of all payments per order, whatever their status; one row per order, so joining it never fans out."""
    return payments.groupBy("order_id").agg(total(F.col("amount")).alias("paid"))


def coverage_class(amount, paid):
    """How payments cover an order: ``missing`` without any, else ``under``, ``over`` or ``ok``."""
    return (
        F.when(paid.isNull(), "missing").when(paid < amount, "under").when(paid > amount, "over").otherwise("ok")
    )


def payment_coverage(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Every order with what was paid for it; both sides of the join have one row per order."""
    paid = paid_per_order(payments).withColumnRenamed("order_id", "_paid_order")
    amount = F.col("total_amount")
    return (
        orders.join(paid, F.col("order_id") == F.col("_paid_order"), "left")
        .withColumn("coverage", coverage_class(amount, F.col("paid")))
        .withColumn("paid", F.coalesce("paid", F.lit(Decimal("0")).cast(TOTAL)))
        .withColumn("gap", (amount - F.col("paid")).cast(TOTAL))
        .drop("_paid_order")
    )


def described_orders(
    orders: DataFrame, customers: DataFrame, products: DataFrame, heavy: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Orders with their day, segment and country of the customer, category and cost of the product.

    ``heavy`` has stored tables of keys that very many orders share, by column.
    """
    heavy = heavy or {}
    people = customers.select(F.col("customer_id").alias("_customer"), "segment", "country")
    goods = products.select(F.col("product_id").alias("_product"), "category", "cost")
    described = balanced_lookup(orders, people, "customer_id", "_customer", "order_id", heavy.get("customer_id"))
    described = balanced_lookup(described, goods, "product_id", "_product", "order_id", heavy.get("product_id"))
    return described.drop("_customer", "_product").withColumn("order_day", day_of("ordered_at"))


def fct_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    payments: DataFrame,
    heavy: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per order with customer and product attributes, margin and payment coverage."""
    described = described_orders(payment_coverage(orders, payments), customers, products, heavy)
    cost = (F.col("cost") * F.col("quantity")).cast("decimal(14,2)")
    return described.select(
        "order_id",
        "order_day",
        "ordered_at",
        "customer_id",
        "segment",
        "country",
        "product_id",
        "category",
        "quantity",
        "unit_price",
        "total_amount",
        cost.alias("cost_amount"),
        (F.col("total_amount") - cost).cast("decimal(15,2)").alias("margin_amount"),
        "status",
        earns().alias("earns_revenue"),
        "paid",
        "coverage",
    )


def fct_daily_revenue(orders: DataFrame) -> DataFrame:
    """One row per day: orders, gross and net revenue, average order value."""
    return daily_totals(orders).withColumn("aov", mean_value(F.col("gross_revenue"), F.col("orders")))
