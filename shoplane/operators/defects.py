"""Defect transforms: tables in, corrupted tables out.

Each defect is a pure function of the tables, a moment and a seed. It also yields a one-row report with what it really
touched; whether that is recorded in the incident ledger is up to the caller.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplane.contracts import EVENT_TIMES, MONEY, PAYMENTS, PRICE
from shoplane.functions.scalars import days_before, price, utc
from shoplane.operators.numbering import next_key
from shoplane.operators.quantiles import incident_counts
from shoplane.operators.selection import indexed_sample, latest_rows, sample_rows, update_where
from shoplane.operators.staging import customer_column
from shoplane.sources.tables import Lake

Tables = dict[str, DataFrame]

# What the defects write and how far they reach.
NEGATIVE_PRICE = Decimal("-49.99")
RECURRING_PRICE = Decimal("-19.99")
BAD_QUANTITY = -5
LATE_DAYS = 45
BURST = 500
BURST_POOL = 50
GHOST_ORDER = 999999999
GHOST_AMOUNT = Decimal("10.00")
CANCELLED_ORDERS = 200
PRICE_CUT_PRODUCTS = 20
PRICE_CUT = Decimal("0.5")
ZEROED_ORDERS = 300
GARBLED_ORDERS = 25
GARBAGE_STATUS = "���/NULL/<script>/0x00 ¿status?"
STALL_MINUTES = 10


@dataclass(frozen=True)
class Context:
    """When and how a defect strikes; ``ledger`` is the incident ledger if one is kept."""

    as_of: datetime
    seed: int = 42
    ledger: DataFrame | None = None


@dataclass(frozen=True)
class Injection:
    """Corrupted tables, a one-row report and the rows the ledger would take (``failure_key, detail``)."""

    tables: Tables
    report: DataFrame
    records: DataFrame


Transform = Callable[[Tables, Context], Injection]


@dataclass(frozen=True)
class Defect:
    """A named defect."""

    key: str
    summary: str
    apply: Transform


REGISTRY: dict[str, Defect] = {}


def defect(key: str, summary: str) -> Callable[[Transform], Transform]:
    """Put a transform into the registry."""

    def register(transform: Transform) -> Transform:
        REGISTRY[key] = Defect(key, summary, transform)
        return transform

    return register


def _done(tables: Tables, changed: Tables, key: str, detail: DataFrame) -> Injection:
    report = detail.select(F.lit(key).alias("failure_key"), F.col("detail"))
    return Injection({**tables, **changed}, report, report)


def _detail(df: DataFrame, template: str, *values: str | Column) -> DataFrame:
    return df.select(F.format_string(template, *values).alias("detail"))


def _one_order(
    tables: Tables,
    context: Context,
    tag: str,
    *,
    status: str = "placed",
    quantity: int = 1,
    unit_price: Decimal | None = None,
    total_amount: Decimal | None = None,
    with_customer: bool = True,
    ordered_at: Column | None = None,
) -> DataFrame:
    """One new order for a sampled customer and product; price and total are the product's unless given."""
    orders = tables["orders"]
    link = customer_column(orders)
    customer = (
        sample_rows(tables["customers"], 1, "customer_id", context.seed, tag).select("customer_id").scalar()
        if with_customer
        else F.lit(None)
    )
    paid = F.col("unit_price") if unit_price is None else F.lit(unit_price)
    sums = paid if total_amount is None else F.lit(total_amount)
    values = {
        "order_id": next_key(orders, "order_id"),
        link: customer,
        "product_id": F.col("product_id"),
        "quantity": F.lit(quantity),
        "unit_price": paid.cast(PRICE),
        "total_amount": sums.cast(MONEY),
        "status": F.lit(status),
        "ordered_at": utc(context.as_of) if ordered_at is None else ordered_at,
    }
    product = sample_rows(tables["products"], 1, "product_id", context.seed, tag)
    return product.select(
        *[values[field.name].cast(field.dataType).alias(field.name) for field in orders.schema.fields]
    )


@defect("negative_price", "One order with a negative price and total.")
def _negative_price(tables: Tables, context: Context) -> Injection:
    row = _one_order(tables, context, "negative_price", unit_price=NEGATIVE_PRICE)
    detail = _detail(row, "order_id=%d unit_price=%s", "order_id", F.col("unit_price").cast("string"))
    return _done(tables, {"orders": tables["orders"].unionByName(row)}, "negative_price", detail)


@defect("missing_customer", "One order without a customer.")
def _missing_customer(tables: Tables, context: Context) -> Injection:
    row = _one_order(tables, context, "missing_customer", with_customer=False)
    link = customer_column(tables["orders"])
    detail = _detail(row, f"inserted order with {link}=NULL")
    return _done(tables, {"orders": tables["orders"].unionByName(row)}, "missing_customer", detail)


@defect("invalid_quantity", "One order with quantity -5.")
def _invalid_quantity(tables: Tables, context: Context) -> Injection:
    row = _one_order(tables, context, "invalid_quantity", quantity=BAD_QUANTITY, total_amount=Decimal("0.00"))
    detail = _detail(row, "order_id=%d quantity=%d", "order_id", "quantity")
    return _done(tables, {"orders": tables["orders"].unionByName(row)}, "invalid_quantity", detail)


@defect("duplicate_order", "The latest order again under a new id.")
def _duplicate_order(tables: Tables, context: Context) -> Injection:
    orders = tables["orders"]
    copy = latest_rows(orders, "order_id").withColumn("order_id", F.col("order_id") + 1)
    made = copy.agg(F.max("order_id").alias("order_id"))
    said = F.when(F.col("order_id").isNull(), F.lit("no orders to duplicate")).otherwise(
        F.format_string("duplicated into order_id=%d", "order_id")
    )
    return _done(
        tables, {"orders": orders.unionByName(copy)}, "duplicate_order", made.select(said.alias("detail"))
    )


@defect("late_arrival", "One order dated 45 days back.")
def _late_arrival(tables: Tables, context: Context) -> Injection:
    backdated = days_before(utc(context.as_of), LATE_DAYS)
    row = _one_order(tables, context, "late_arrival", status="delivered", ordered_at=backdated)
    day = F.date_format("ordered_at", "yyyy-MM-dd")
    detail = _detail(row, "order_id=%d ordered_at=%s", "order_id", day)
    return _done(tables, {"orders": tables["orders"].unionByName(row)}, "late_arrival", detail)


def burst_rows(tables: Tables, context: Context, burst: int = BURST) -> DataFrame:
    """``burst`` orders at one instant: up to 50 customers and 50 products walked in lockstep.

    Without customers the orders carry NULL; without products there are none.
    """
    orders = tables["orders"]
    link = customer_column(orders)
    tag = "volume_spike"
    people = indexed_sample(tables["customers"], BURST_POOL, "customer_id", context.seed, tag)
    goods = indexed_sample(tables["products"], BURST_POOL, "product_id", context.seed, tag)
    people = people.select(F.col("slot").alias("_c"), F.col("customer_id").alias(link))
    goods = goods.select(F.col("slot").alias("_p"), "product_id", "unit_price")
    n_people = F.greatest(people.select(F.count("*")).scalar(), F.lit(1))
    n_goods = F.greatest(goods.select(F.count("*")).scalar(), F.lit(1))
    rows = orders.sparkSession.range(burst).select(
        F.col("id"),
        F.pmod(F.col("id"), n_people).alias("_buyer"),
        F.pmod(F.col("id"), n_goods).alias("_item"),
        (next_key(orders, "order_id") + F.col("id")).alias("order_id"),
    )
    values = {
        "quantity": F.lit(1),
        "unit_price": F.col("unit_price"),
        "total_amount": F.col("unit_price"),
        "status": F.lit("placed"),
        "ordered_at": utc(context.as_of),
    }
    return (
        rows.join(F.broadcast(people), F.col("_buyer") == F.col("_c"), "left")
        .join(F.broadcast(goods), F.col("_item") == F.col("_p"))
        .select(
            *[
                values.get(field.name, F.col(field.name)).cast(field.dataType).alias(field.name)
                for field in orders.schema.fields
            ]
        )
    )


@defect("volume_spike", "A burst of orders at one instant.")
def _volume_spike(tables: Tables, context: Context) -> Injection:
    rows = burst_rows(tables, context)
    detail = _detail(rows.agg(F.count("*").alias("n")), "inserted %d orders in one burst", "n")
    return _done(tables, {"orders": tables["orders"].unionByName(rows)}, "volume_spike", detail)


@defect("schema_drift", "The customer column of the orders renamed to user_id.")
def _schema_drift(tables: Tables, context: Context) -> Injection:
    orders = tables["orders"]
    one = orders.sparkSession.range(1)
    if customer_column(orders) == "user_id":
        return _done(tables, {}, "schema_drift", _detail(one, "already drifted (column is user_id)"))
    drifted = orders.withColumnRenamed("customer_id", "user_id")
    return _done(tables, {"orders": drifted}, "schema_drift", _detail(one, "orders.customer_id renamed to user_id"))


@defect("orphan_payment", "A payment for an order that does not exist.")
def _orphan_payment(tables: Tables, context: Context) -> Injection:
    payments = tables["payments"]
    values = {
        "payment_id": next_key(payments, "payment_id"),
        "order_id": F.lit(GHOST_ORDER),
        "method": F.lit("credit_card"),
        "amount": F.lit(GHOST_AMOUNT),
        "status": F.lit("captured"),
        "paid_at": utc(context.as_of),
    }
    row = payments.sparkSession.range(1).select(
        *[values[field.name].cast(field.dataType).alias(field.name) for field in PAYMENTS.fields]
    )
    detail = _detail(row, "payment inserted for order_id=%d", "order_id")
    return _done(tables, {"payments": payments.unionByName(row)}, "orphan_payment", detail)


@defect("recurring_incident", "A negative price that keeps coming back.")
def _recurring_incident(tables: Tables, context: Context) -> Injection:
    key = "recurring_incident"
    row = _one_order(tables, context, key, unit_price=RECURRING_PRICE)
    seen = F.lit(0)
    if context.ledger is not None:
        seen = F.coalesce(incident_counts(context.ledger, key).select("incidents").scalar(), F.lit(0))
    told = row.select("order_id", (seen + 1).cast("bigint").alias("nth"))
    detail = _detail(told, "order_id=%d (occurrence #%d)", "order_id", "nth")
    return _done(tables, {"orders": tables["orders"].unionByName(row)}, key, detail)


def price_cut(products: DataFrame, seed: int, n: int = PRICE_CUT_PRODUCTS) -> tuple[DataFrame, DataFrame]:
    """Halve the price of ``n`` sampled products; also returns the sample."""
    chosen = sample_rows(products, n, "product_id", seed, "price_cut")
    halved = price(F.col("unit_price") * F.lit(PRICE_CUT))
    return update_where(products, F.broadcast(chosen), "product_id", {"unit_price": halved}), chosen


def cancel_latest(orders: DataFrame, n: int = CANCELLED_ORDERS) -> tuple[DataFrame, DataFrame]:
    """Cancel the ``n`` latest orders not yet cancelled; also returns the chosen rows."""
    chosen = latest_rows(orders.filter(F.col("status") != "cancelled"), "order_id", n)
    return update_where(orders, F.broadcast(chosen), "order_id", {"status": F.lit("cancelled")}), chosen


@defect("ambiguous_anomaly", "Cancellations and a price cut at once.")
def _ambiguous_anomaly(tables: Tables, context: Context) -> Injection:
    orders, cancelled = cancel_latest(tables["orders"])
    products, cut = price_cut(tables["products"], context.seed)
    counts = cancelled.agg(F.count("*").alias("orders")).withColumn("products", cut.select(F.count("*")).scalar())
    detail = _detail(counts, "%d orders cancelled + %d products price-cut 50%%", "orders", "products")
    return _done(tables, {"orders": orders, "products": products}, "ambiguous_anomaly", detail)


def zero_latest(orders: DataFrame, n: int = ZEROED_ORDERS) -> tuple[DataFrame, DataFrame]:
    """Set the total of the ``n`` latest orders to zero; also returns the chosen rows."""
    chosen = latest_rows(orders, "order_id", n)
    return update_where(orders, F.broadcast(chosen), "order_id", {"total_amount": F.lit(0)}), chosen


@defect("destructive_fix", "The totals of the latest orders overwritten with zero.")
def _destructive_fix(tables: Tables, context: Context) -> Injection:
    orders, chosen = zero_latest(tables["orders"])
    count = chosen.agg(F.count("*").alias("n"))
    detail = _detail(count, "zeroed total_amount on %d orders (bulk fix required)", "n")
    return _done(tables, {"orders": orders}, "destructive_fix", detail)


@defect("malformed_data", "Noise in the status of the latest orders.")
def _malformed_data(tables: Tables, context: Context) -> Injection:
    chosen = latest_rows(tables["orders"], "order_id", GARBLED_ORDERS)
    orders = update_where(tables["orders"], F.broadcast(chosen), "order_id", {"status": F.lit(GARBAGE_STATUS)})
    detail = _detail(chosen.agg(F.count("*").alias("n")), "wrote garbage status to %d orders", "n")
    return _done(tables, {"orders": orders}, "malformed_data", detail)


@defect("slow_source", "Nothing lands for a while.")
def _slow_source(tables: Tables, context: Context) -> Injection:
    """Nothing of the last minutes has landed, which is what a stalled source looks like from the lane."""
    orders = tables["orders"]
    moment = "landed_at" if "landed_at" in orders.columns else EVENT_TIMES["orders"]
    cutoff = F.timestamp_seconds(F.unix_seconds(utc(context.as_of)) - F.lit(STALL_MINUTES * 60))
    stalled = orders.filter(F.col(moment) < cutoff)
    detail = _detail(orders.sparkSession.range(1), f"source stalled for {STALL_MINUTES * 60}s")
    return _done(tables, {"orders": stalled}, "slow_source", detail)


@defect("multi_failure_cascade", "Missing customer, volume spike and schema drift together.")
def _multi_failure_cascade(tables: Tables, context: Context) -> Injection:
    records, parts = None, ("missing_customer", "volume_spike", "schema_drift")
    for part in parts:
        step = get(part).apply(tables, context)
        tables = step.tables
        records = step.records if records is None else records.unionByName(step.records)
    said = _detail(tables["orders"].sparkSession.range(1), "cascade: " + ", ".join(parts))
    report = said.select(F.lit("multi_failure_cascade").alias("failure_key"), "detail")
    return Injection(tables, report, records)


def get(key: str) -> Defect:
    """The defect named ``key``; the error lists the names there are."""
    if key not in REGISTRY:
        raise KeyError(f"no defect named {key!r}; there are: {', '.join(sorted(REGISTRY))}")
    return REGISTRY[key]


def inject(tables: Tables, key: str, context: Context) -> Injection:
    """Apply one defect. Silent: nothing is recorded unless the caller appends ``records`` to the ledger."""
    return get(key).apply(tables, context)


def inject_recorded(lake: Lake, tables: Tables, key: str, context: Context) -> Injection:
    """Apply one defect and append its records to the lake's ledger; a cascade leaves one row per part."""
    done = inject(tables, key, replace(context, ledger=lake.ledger()))
    lake.record(done.records, utc(context.as_of))
    return done
