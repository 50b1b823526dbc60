"""Clean, correlated retail tables made by Spark.

Every value is a function of (seed, column, row id), so the same ids give the same rows under any partitioning. The
makers take a table of ids, which may come from ``spark.range`` or from a table at hand.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplane.contracts import (
    CATEGORY_PRICE_BOUNDS,
    CUSTOMERS,
    MONEY,
    ORDER_STATUSES,
    ORDERS,
    PAYMENT_METHODS,
    PAYMENT_STATUSES,
    PAYMENTS,
    PRICE,
    PRODUCTS,
    SEGMENTS,
)
from shoplane.functions.scalars import (
    days_before,
    draw_below,
    email_handle,
    moment_between,
    money,
    pick,
    price,
    singular,
    stock_code,
    utc,
)
from shoplane.operators.numbering import next_key
from shoplane.operators.selection import indexed_sample
from shoplane.operators.staging import customer_column

FIRST_NAMES = (
    "Ada Bruno Carmen Dario Elin Farah Goran Hana Igor Jana Kofi Lena Marco Nadia Omar Petra Quentin Rosa Samir Tessa "
    "Uma Viktor Wanda Xenia Yusuf Zoe"
).split()
LAST_NAMES = (
    "Abbott Brandt Castillo Dumont Eriksen Fischer Garcia Hansen Ivanov Jansen Kowalski Lindgren Moreau Novak O'Brien "
    "Pereira Quinn Rossi Santos Tanaka Ueda Vargas Weber Xu Yilmaz Zhang"
).split()
COUNTRIES = "Argentina Brazil Canada Denmark Egypt France Germany Hungary India Japan Kenya Mexico Norway".split()
CITIES = "Ashford Bellview Cedarton Dunmore Eastfield Fairhaven Glenrock Hillcrest Ironbridge Juniper Kingsport".split()
MAIL_HOSTS = ("example.com", "example.net", "example.org")
COLORS = "Amber Azure Coral Crimson Ebony Ivory Jade Olive Pearl Scarlet Teal Violet".split()
WORDS = "anchor breeze comet drift ember flint grove harbor iris junction kite lantern meadow nimbus orbit".split()

HISTORY_DAYS = 3 * 365
TRAFFIC_POOL = 200  # customers and products a batch of traffic refers to at most


def row_ids(spark: SparkSession, n: int, name: str) -> DataFrame:
    """Ids 1 to ``n``."""
    return spark.range(1, n + 1).withColumnRenamed("id", name)


def _typed(df: DataFrame, contract) -> DataFrame:
    return df.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in contract.fields])


def _history(as_of: datetime, seed: int, tag: str, row_id: Column) -> Column:
    return moment_between(days_before(utc(as_of), HISTORY_DAYS), days_before(utc(as_of), 1), seed, tag, row_id)


def make_customers(ids: DataFrame, seed: int, as_of: datetime) -> DataFrame:
    """Customers with a unique email made from name and id, signed up in the last three years."""
    key = F.col("customer_id")
    first, last = pick(FIRST_NAMES, seed, "first name", key), pick(LAST_NAMES, seed, "last name", key)
    name = F.concat(first, F.lit(" "), last)
    named = ids.select(key, name.alias("full_name"))
    email = F.concat(
        email_handle(F.col("full_name")),
        F.lit("."),
        (key + 1000).cast("string"),
        F.lit("@"),
        pick(MAIL_HOSTS, seed, "mail host", key),
    )
    return _typed(
        named.select(
            "customer_id",
            "full_name",
            email.alias("email"),
            pick(COUNTRIES, seed, "country", key).alias("country"),
            pick(CITIES, seed, "city", key).alias("city"),
            pick(SEGMENTS, seed, "segment", key).alias("segment"),
            _history(as_of, seed, "signup", key).alias("created_at"),
        ),
        CUSTOMERS,
    )


def make_products(ids: DataFrame, seed: int, as_of: datetime) -> DataFrame:
    """Products priced within the bounds of their category; cost is 45 to 80 % of the price."""
    key = F.col("product_id")
    categories = list(CATEGORY_PRICE_BOUNDS)
    place = draw_below(seed, "category", key, len(categories))
    lows = F.array(*[F.lit(low * 100) for low, _ in CATEGORY_PRICE_BOUNDS.values()])
    highs = F.array(*[F.lit(high * 100) for _, high in CATEGORY_PRICE_BOUNDS.values()])
    drawn = ids.select(key, (place + 1).cast("int").alias("_place")).select(
        key,
        F.element_at(F.array(*[F.lit(category) for category in categories]), F.col("_place")).alias("category"),
        F.element_at(lows, F.col("_place")).cast("bigint").alias("_low"),
        F.element_at(highs, F.col("_place")).cast("bigint").alias("_high"),
    )
    cent = F.lit(Decimal("0.01"))
    cents = F.col("_low") + draw_below(seed, "price", key, F.col("_high") - F.col("_low") + 1)
    priced = drawn.select(key, "category", price(cents.cast("decimal(10,0)") * cent).alias("unit_price"))
    percent = (draw_below(seed, "cost", key, 36) + 45).cast("decimal(4,0)")
    name = F.concat_ws(
        " ", pick(COLORS, seed, "color", key), F.initcap(pick(WORDS, seed, "word", key)), singular(F.col("category"))
    )
    return _typed(
        priced.select(
            "product_id",
            stock_code(key).alias("sku"),
            name.alias("name"),
            "category",
            "unit_price",
            price(F.col("unit_price") * percent * cent).alias("cost"),
            _history(as_of, seed, "listed", key).alias("created_at"),
        ),
        PRODUCTS,
    )


def make_orders(
    ids: DataFrame, customers: DataFrame, products: DataFrame, seed: int, as_of: datetime
) -> DataFrame:
    """Orders of random customers for random products, none before its customer signed up.

    ``customers`` and ``products`` carry a dense ``slot`` 0, 1, 2, ...; each order draws one slot of either, so both
    joins are equi joins on evenly spread keys.
    """
    key = F.col("order_id")
    people = customers.select(F.col("slot").alias("_buyer"), "customer_id", "created_at")
    goods = products.select(F.col("slot").alias("_item"), "product_id", "unit_price")
    drawn = ids.select(
        key,
        draw_below(seed, "buyer", key, customers.select(F.count("*")).scalar()).alias("_buyer_slot"),
        draw_below(seed, "item", key, products.select(F.count("*")).scalar()).alias("_item_slot"),
        (draw_below(seed, "quantity", key, 6) + 1).cast("int").alias("quantity"),
        pick(ORDER_STATUSES, seed, "status", key).alias("status"),
    )
    return _typed(
        drawn.join(people, F.col("_buyer_slot") == F.col("_buyer"))
        .join(goods, F.col("_item_slot") == F.col("_item"))
        .withColumn("total_amount", money(F.col("unit_price") * F.col("quantity")))
        .withColumn("ordered_at", moment_between(F.col("created_at"), utc(as_of), seed, "ordered", key)),
        ORDERS,
    )


def make_payments(orders: DataFrame, seed: int, as_of: datetime) -> DataFrame:
    """One payment per order for its full amount; a returned order is refunded."""
    key = F.col("order_id")
    status = F.when(F.col("status") == "returned", F.lit("refunded")).otherwise(
        pick(PAYMENT_STATUSES, seed, "payment status", key)
    )
    return _typed(
        orders.select(
            key.alias("payment_id"),
            key,
            pick(PAYMENT_METHODS, seed, "method", key).alias("method"),
            F.col("total_amount").cast(MONEY).alias("amount"),
            status.alias("status"),
            moment_between(F.col("ordered_at"), utc(as_of), seed, "paid", key).alias("paid_at"),
        ),
        PAYMENTS,
    )


def make_traffic(tables: dict[str, DataFrame], n: int, seed: int, as_of: datetime) -> DataFrame:
    """``n`` normal orders at ``as_of`` for a sample of customers and products; none if either is empty.

    The samples hold at most 200 rows each, which makes them safe to broadcast.
    """
    orders = tables["orders"]
    link = customer_column(orders)
    pool = min(n, TRAFFIC_POOL)
    people = indexed_sample(tables["customers"], pool, "customer_id", seed, "traffic customers")
    goods = indexed_sample(tables["products"], pool, "product_id", seed, "traffic products")
    key = F.col("order_id")
    drawn = (
        row_ids(orders.sparkSession, n, "_nth")
        .select((next_key(orders, "order_id") + F.col("_nth") - 1).alias("order_id"))
        .select(
            key,
            draw_below(seed, "buyer", key, F.greatest(people.select(F.count("*")).scalar(), F.lit(1))).alias("_buyer"),
            draw_below(seed, "item", key, F.greatest(goods.select(F.count("*")).scalar(), F.lit(1))).alias("_item"),
            (draw_below(seed, "quantity", key, 6) + 1).cast("int").alias("quantity"),
            pick(ORDER_STATUSES, seed, "status", key).alias("status"),
        )
    )
    people = F.broadcast(people.select(F.col("slot").alias("_c"), F.col("customer_id").alias(link)))
    goods = F.broadcast(goods.select(F.col("slot").alias("_p"), "product_id", F.col("unit_price").cast(PRICE)))
    return (
        drawn.join(people, F.col("_buyer") == F.col("_c"))
        .join(goods, F.col("_item") == F.col("_p"))
        .withColumn("total_amount", money(F.col("unit_price") * F.col("quantity")))
        .withColumn("ordered_at", utc(as_of))
        .select(*orders.columns)
    )


def make_baseline(
    spark: SparkSession,
    as_of: datetime,
    customers: int = 500,
    products: int = 200,
    orders: int = 5000,
    seed: int = 42,
) -> dict[str, DataFrame]:
    """The four tables of a clean shop."""
    people = make_customers(row_ids(spark, customers, "customer_id"), seed, as_of)
    goods = make_products(row_ids(spark, products, "product_id"), seed, as_of)
    sales = make_orders(
        row_ids(spark, orders, "order_id"),
        people.withColumn("slot", F.col("customer_id") - 1),
        goods.withColumn("slot", F.col("product_id") - 1),
        seed,
        as_of,
    )
    return {
        "customers": people,
        "products": goods,
        "orders": sales,
        "payments": make_payments(sales, seed, as_of),
    }


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of every table, in one job."""
    counts = None
    for table, df in tables.items():
        here = df.agg(F.count("*").alias("rows")).select(F.lit(table).alias("table_name"), "rows")
        counts = here if counts is None else counts.unionByName(here)
    return counts
