"""The four retail tables as views over the star-schema parquet files.

``clean_tables`` maps the star schema onto customers, products, orders and payments. ``defect_tables`` lays one defect
of every row-level kind over them; a residue of the order id stands for chance, so every run and every engine corrupts
the same rows. All views are lazy and read the whole tables.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplane.contracts import DOMAINS, MONEY, ORDER_STATUSES, PAYMENT_METHODS, PRICE

# Words the star-schema tables hold where the source has its own vocabulary.
MARKET_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

FAILURE_KEYS_IN_VIEWS = {
    "missing_customer": (997, 1),
    "invalid_quantity": (991, 2),
    "negative_price": (983, 3),
    "destructive_fix": (977, 4),
    "malformed_data": (971, 5),
    "duplicate_order": (967, 6),
    "orphan_payment": (953, 7),
}
GARBAGE_STATUS = "<script>/0x00 status?"
COPY_OFFSET = 100000000
GHOST_ORDER = 999999999


# Declared so that no job has to look into the files for them.
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_star(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One star-schema table."""
    return spark.read.schema(STAR_SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")


def _chosen(failure: str, order_id: str = "order_id") -> Column:
    modulus, residue = FAILURE_KEYS_IN_VIEWS[failure]
    return F.pmod(F.col(order_id), F.lit(modulus)) == residue


def _one_of(selector: Column, words: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(word) for word in words]), (selector + 1).cast("int"))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with nation as country and region as city; the two lookups hold 25 and 5 rows at every scale."""
    nation = read_star(spark, folder, "nation")
    region = read_star(spark, folder, "region")
    return (
        read_star(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("full_name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("city"),
            F.col("c_mktsegment").alias("segment"),
            F.lit("1994-01-01 00:00:00").cast("timestamp").alias("created_at"),
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as products; cost is 45 to 80 % of the price."""
    unit_price = F.col("p_retailprice").cast(PRICE)
    percent = (F.lit(45) + F.pmod(F.col("p_partkey"), F.lit(36))).cast("decimal(4,0)")
    return read_star(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        unit_price.alias("unit_price"),
        (unit_price * percent * F.lit(Decimal("0.01"))).cast(PRICE).alias("cost"),
        F.lit("1994-01-01 00:00:00").cast("timestamp").alias("created_at"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of one product line each, spread over all parts."""
    parts = read_star(spark, folder, "part").select(F.count("*")).scalar()
    return as_orders(read_star(spark, folder, "orders"), products(spark, folder), parts)


def streamed_orders(stream: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """The same from a stream of star-schema orders."""
    return as_orders(stream, products(spark, folder), F.lit(read_star(spark, folder, "part").count()))


def as_orders(rows: DataFrame, goods: DataFrame, parts: Column) -> DataFrame:
    """Star-schema order rows as retail orders over ``parts`` products with keys from 0."""
    quantity = (F.lit(1) + F.pmod(F.col("o_orderkey"), F.lit(6))).cast("int")
    status_at = F.pmod(F.col("o_orderkey") + F.col("o_custkey"), F.lit(5))
    return (
        rows.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.pmod(F.col("o_orderkey"), parts).alias("product_id"),
            quantity.alias("quantity"),
            _one_of(status_at, ORDER_STATUSES).alias("status"),
            F.col("o_orderdate").cast("timestamp").alias("ordered_at"),
        )
        .join(goods.select("product_id", "unit_price"), "product_id")
        .select(
            "order_id",
            "customer_id",
            "product_id",
            "quantity",
            "unit_price",
            (F.col("unit_price") * F.col("quantity")).cast(MONEY).alias("total_amount"),
            "status",
            "ordered_at",
        )
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """One payment per order for its full amount."""
    return orders(spark, folder).select(
        F.col("order_id").alias("payment_id"),
        "order_id",
        _one_of(F.pmod(F.col("order_id"), F.lit(5)), PAYMENT_METHODS).alias("method"),
        F.col("total_amount").alias("amount"),
        F.when(F.col("status") == "returned", "refunded")
        .when(F.pmod(F.col("order_id"), F.lit(3)) == 0, "authorized")
        .otherwise("captured")
        .alias("status"),
        F.col("ordered_at").alias("paid_at"),
    )


def defect_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with NULL customers, bad quantities, prices, totals and statuses, and re-inserted clean copies.

    A copy is a second row out of the same scan: ``shift`` is 0 for the order itself and the id offset for its copy.
    """
    shifts = F.when(_chosen("duplicate_order"), F.array(F.lit(0), F.lit(COPY_OFFSET))).otherwise(F.array(F.lit(0)))
    rows = orders(spark, folder).withColumn("shift", F.explode(shifts))

    def spoil(failure: str) -> Column:
        return _chosen(failure) & (F.col("shift") == 0)

    negative = F.lit(Decimal("-49.99"))
    return rows.select(
        (F.col("order_id") + F.col("shift")).alias("order_id"),
        F.when(~spoil("missing_customer"), F.col("customer_id")).alias("customer_id"),
        "product_id",
        F.when(spoil("invalid_quantity"), F.lit(-5)).otherwise(F.col("quantity")).alias("quantity"),
        F.when(spoil("negative_price"), negative.cast(PRICE)).otherwise(F.col("unit_price")).alias("unit_price"),
        F.when(spoil("invalid_quantity"), F.lit(0).cast(MONEY))
        .when(spoil("negative_price"), negative.cast(MONEY))
        .when(spoil("destructive_fix"), F.lit(0).cast(MONEY))
        .otherwise(F.col("total_amount"))
        .alias("total_amount"),
        F.when(spoil("malformed_data"), F.lit(GARBAGE_STATUS)).otherwise(F.col("status")).alias("status"),
        "ordered_at",
    )


def defect_payments(spark: SparkSession, folder: str) -> DataFrame:
    """Payments with ghost orders, halved amounts and missing rows."""
    ghost = F.lit(GHOST_ORDER).cast("bigint")
    halved = (F.col("amount") * F.lit(Decimal("0.5"))).cast(MONEY)
    key = F.col("order_id")
    return (
        payments(spark, folder)
        .filter(F.pmod(key, F.lit(941)) != 9)
        .select(
            "payment_id",
            F.when(F.pmod(key, F.lit(947)) == 8, halved).otherwise(F.col("amount")).alias("amount"),
            "method",
            "status",
            "paid_at",
            F.when(_chosen("orphan_payment"), ghost).otherwise(key).alias("order_id"),
        )
        .select("payment_id", "order_id", "method", "amount", "status", "paid_at")
    )


def clean_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four tables without defects."""
    return {
        "customers": customers(spark, folder),
        "products": products(spark, folder),
        "orders": orders(spark, folder),
        "payments": payments(spark, folder),
    }


def defect_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four tables with defects in orders and payments."""
    return {
        "customers": customers(spark, folder),
        "products": products(spark, folder),
        "orders": defect_orders(spark, folder),
        "payments": defect_payments(spark, folder),
    }


def star_domains() -> dict[str, dict[str, tuple[str, ...]]]:
    """Accepted values for the views."""
    return {**DOMAINS, "customers": {"segment": MARKET_SEGMENTS}, "products": {"category": PART_TYPES}}


def defect_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """What ``defect_tables`` corrupts, row by row: the failure and the order or payment it sits in."""
    failures = [
        F.when(
            _chosen(failure),
            F.struct(
                F.lit(failure).alias("failure_key"),
                (F.col("order_id") + F.lit(COPY_OFFSET if failure == "duplicate_order" else 0)).alias("item"),
            ),
        )
        for failure in FAILURE_KEYS_IN_VIEWS
        if failure != "orphan_payment"
    ]
    in_orders = orders(spark, folder).select(F.inline(F.array_compact(F.array(*failures))))
    in_payments = (
        payments(spark, folder)
        .filter(_chosen("orphan_payment") & (F.pmod(F.col("order_id"), F.lit(941)) != 9))
        .select(F.lit("orphan_payment").alias("failure_key"), F.col("payment_id").alias("item"))
    )
    return in_orders.unionByName(in_payments)


def timed_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """``defect_ledger`` as the ledger itself has it: failure and moment, no row."""
    moments = orders(spark, folder).select(F.col("order_id").alias("_order"), F.col("ordered_at").alias("injected_at"))
    struck = defect_ledger(spark, folder).withColumn("_of", F.pmod("item", F.lit(COPY_OFFSET)))
    return struck.join(moments, F.col("_of") == F.col("_order")).select("failure_key", "injected_at")


def landed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Defective orders with the moment each landed: the same day for one in four, up to three days late otherwise."""
    delay = F.pmod(F.col("order_id"), F.lit(4)) * 86400
    landed_at = F.timestamp_seconds(F.unix_seconds("ordered_at") + delay)
    return defect_orders(spark, folder).withColumn("landed_at", landed_at)


def changed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """A later snapshot of the orders: some cancelled, some zeroed, some gone, some new."""
    old = orders(spark, folder)
    key = F.col("order_id")
    kept = old.filter(F.pmod(key, F.lit(101)) != 7).select(
        "order_id",
        "customer_id",
        "product_id",
        "quantity",
        "unit_price",
        F.when(F.pmod(key, F.lit(97)) == 3, F.lit(0).cast(MONEY))
        .otherwise(F.col("total_amount"))
        .alias("total_amount"),
        F.when(F.pmod(key, F.lit(89)) == 5, F.lit("cancelled")).otherwise(F.col("status")).alias("status"),
        "ordered_at",
    )
    fresh = old.filter(F.pmod(key, F.lit(103)) == 9).withColumn("order_id", key + F.lit(2 * COPY_OFFSET))
    return kept.unionByName(fresh)


def change_files(spark: SparkSession, folder: str) -> list[dict[str, tuple[DataFrame, DataFrame | None]]]:
    """Two deliveries of changes of the four tables, each as (rows to upsert, rows to delete).

    First everything; then the orders' later snapshot, some of them 40 days later than before, payments halved or gone, customers of
    another segment and products of another category.
    """
    tables = clean_tables(spark, folder)
    later = changed_orders(spark, folder)
    moved = F.when(F.pmod("order_id", F.lit(107)) == 11, F.timestamp_seconds(F.unix_seconds("ordered_at") + 40 * 86400))
    later = later.withColumn("ordered_at", F.coalesce(moved, F.col("ordered_at")))
    key = F.col("payment_id")
    customer_part = F.pmod("customer_id", F.lit(53)) == 4
    halved = tables["payments"].filter(F.pmod(key, F.lit(223)) == 6).withColumn("amount", (F.col("amount") * F.lit(Decimal("0.5"))).cast(MONEY))
    touched = (F.pmod("order_id", F.lit(97)) == 3) | (F.pmod("order_id", F.lit(89)) == 5) | moved.isNotNull() | (F.col("order_id") > COPY_OFFSET)
    return [
        {table: (rows, None) for table, rows in tables.items()},
        {
            "customers": (tables["customers"].filter(customer_part).withColumn("segment", F.lit("MACHINERY")), None),
            "products": (tables["products"].filter(F.pmod("product_id", F.lit(41)) == 7).withColumn("category", F.lit("LARGE")), None),
            "orders": (later.filter(touched), tables["orders"].filter(F.pmod("order_id", F.lit(101)) == 7)),
            "payments": (halved, tables["payments"].filter(F.pmod(key, F.lit(211)) == 5)),
        },
    ]


def incidents(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """The events as an incident ledger over ``keys``."""
    return read_star(spark, folder, "events").select(
        F.col("event_id").alias("incident_id"),
        _one_of(F.pmod(F.col("event_id"), F.lit(len(keys))), tuple(keys)).alias("failure_key"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("detail"),
        F.col("ts").cast("timestamp").alias("injected_at"),
    )


def timings(spark: SparkSession, folder: str) -> DataFrame:
    """The events as recorded run times: one question per event type."""
    return read_star(spark, folder, "events").select(
        F.col("event_type").alias("question"), F.col("value").alias("seconds"), F.col("event_id").alias("run_id")
    )
