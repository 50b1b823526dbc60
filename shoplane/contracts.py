"""Table contracts of the retail source: schemas, keys and accepted values."""

from __future__ import annotations

from pyspark.sql import types as T


def _required(name: str, data_type: T.DataType) -> T.StructField:
    return T.StructField(name, data_type, nullable=False)


PRICE = T.DecimalType(10, 2)
MONEY = T.DecimalType(12, 2)

CUSTOMERS = T.StructType(
    [
        _required("customer_id", T.LongType()),
        _required("full_name", T.StringType()),
        _required("email", T.StringType()),
        _required("country", T.StringType()),
        _required("city", T.StringType()),
        _required("segment", T.StringType()),
        _required("created_at", T.TimestampType()),
    ]
)

PRODUCTS = T.StructType(
    [
        _required("product_id", T.LongType()),
        _required("sku", T.StringType()),
        _required("name", T.StringType()),
        _required("category", T.StringType()),
        _required("unit_price", PRICE),
        _required("cost", PRICE),
        _required("created_at", T.TimestampType()),
    ]
)

ORDERS = T.StructType(
    [
        _required("order_id", T.LongType()),
        _required("customer_id", T.LongType()),
        _required("product_id", T.LongType()),
        _required("quantity", T.IntegerType()),
        _required("unit_price", PRICE),
        _required("total_amount", MONEY),
        _required("status", T.StringType()),
        _required("ordered_at", T.TimestampType()),
    ]
)

PAYMENTS = T.StructType(
    [
        _required("payment_id", T.LongType()),
        _required("order_id", T.LongType()),
        _required("method", T.StringType()),
        _required("amount", MONEY),
        _required("status", T.StringType()),
        _required("paid_at", T.TimestampType()),
    ]
)

INCIDENTS = T.StructType(
    [
        _required("incident_id", T.LongType()),
        _required("failure_key", T.StringType()),
        _required("detail", T.StringType()),
        _required("injected_at", T.TimestampType()),
    ]
)

TABLES = {"customers": CUSTOMERS, "products": PRODUCTS, "orders": ORDERS, "payments": PAYMENTS}
PRIMARY_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "payments": "payment_id",
}
EVENT_TIMES = {
    "customers": "created_at",
    "products": "created_at",
    "orders": "ordered_at",
    "payments": "paid_at",
}
NATURAL_KEY = ("customer_id", "product_id", "ordered_at")

# The controlled vocabularies of the source.
CATEGORY_PRICE_BOUNDS = {
    "Electronics": (49, 1999),
    "Home & Kitchen": (9, 499),
    "Apparel": (12, 249),
    "Beauty": (5, 149),
    "Sports": (15, 899),
    "Books": (4, 79),
    "Toys": (6, 199),
    "Grocery": (1, 89),
}
SEGMENTS = ("consumer", "prime", "business", "wholesale")
ORDER_STATUSES = ("placed", "shipped", "delivered", "returned", "cancelled")
PAYMENT_METHODS = ("credit_card", "debit_card", "paypal", "bank_transfer", "wallet")
PAYMENT_STATUSES = ("authorized", "captured", "refunded", "failed")

# Orders in these states bring no net revenue.
REVERSED_STATUSES = ("returned", "cancelled")

# Accepted values per table and column; callers may pass their own.
DOMAINS = {
    "customers": {"segment": SEGMENTS},
    "products": {"category": tuple(CATEGORY_PRICE_BOUNDS)},
    "orders": {"status": ORDER_STATUSES},
    "payments": {"method": PAYMENT_METHODS, "status": PAYMENT_STATUSES},
}
