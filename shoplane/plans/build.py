"""The gated build: contract, staging, marts, gates, reconciliation, publication, as one call."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from shoplane.contracts import DOMAINS, NATURAL_KEY, ORDERS, PRIMARY_KEYS, PRODUCTS, TABLES
from shoplane.functions.scalars import day_of, utc
from shoplane.operators import gates, reconcile
from shoplane.operators.capture import diff
from shoplane.operators.lookup import heavy_keys
from shoplane.operators.staging import deduplicate, quarantine, removed_by_dedup, row_rules, stage
from shoplane.plans import marts, questions
from shoplane.sources.tables import ADJUSTMENTS, Lake

Domains = Mapping[str, Mapping[str, Sequence[str]]]


@dataclass(frozen=True)
class BuildResult:
    """The marts of a build and the gate report, one row per check."""

    tables: dict[str, DataFrame]
    report: list[Row]


def all_gates(staged: Mapping[str, DataFrame], domains: Domains) -> DataFrame:
    """Every gate on values, keys and references of the landed tables.

    Copies of an order by its natural key only warn here, as a burst looks the same: deduplication takes them out, and
    ``staged_gate`` makes sure that none is left.
    """
    reports = [gates.row_gates(staged[table], table, row_rules(table, domains.get(table, {}))) for table in TABLES]
    reports += [gates.unique_gate(staged[table], table, (PRIMARY_KEYS[table],)) for table in TABLES]
    reports += [
        gates.unique_gate(staged["customers"], "customers", ("email",)),
        gates.unique_gate(staged["products"], "products", ("sku",)),
        gates.unique_gate(staged["orders"], "orders", NATURAL_KEY, gates.WARN),
        gates.reference_gate(staged["orders"], staged["customers"], "orders", "customer_id"),
        gates.reference_gate(staged["orders"], staged["products"], "orders", "product_id"),
        gates.reference_gate(staged["payments"], staged["orders"], "payments", "order_id"),
        gates.payment_rule_gates(staged["orders"], staged["payments"]),
    ]
    return gates.union_all(reports)


def staged_gate(orders: DataFrame) -> DataFrame:
    """No natural key twice among orders after deduplication."""
    return gates.unique_gate(orders, "orders", NATURAL_KEY).withColumn("check", F.concat(F.lit("staged "), "check"))


def timely_gates(orders: DataFrame, as_of: datetime) -> list[DataFrame]:
    """Volume of the last two days, from orders as landed up to ``as_of``, and freshness.

    A day that is not over may already be a spike of a whole day; a drop is judged against earlier days up to the same time.
    """
    now = utc(as_of)
    today = day_of(now)
    whole_days = questions.volume_flags(orders.filter(F.col("ordered_at") <= now))
    until_now = questions.volume_until_now(orders, now)
    flags = whole_days.filter((F.col("flag") == "spike") | (F.col("day") < today)).unionByName(until_now.filter("flag = 'drop'"))
    return [
        gates.volume_gate(flags, F.date_sub(today, 1)),
        gates.freshness_gate(orders, "ordered_at", now),
    ]


def build(
    lake: Lake,
    source: Mapping[str, DataFrame],
    as_of: datetime,
    domains: Domains = DOMAINS,
    strict: bool = True,
    grain: str = "day",
) -> BuildResult:
    """Stage the source, build the marts, run every gate and publish the result if no error-level gate failed.

    The contract is checked on schemas before any data is read. With ``strict=False`` marts are published whatever the
    gates say; quarantined rows stay out of them either way. Each stage is written once and read back, so nothing is
    computed twice and a lost executor costs one stage. The fact table is partitioned by ``span``, the day or a coarser
    ``grain`` where days hold too few rows for a file.
    """
    spark = lake.spark
    contracts = gates.contract_gate(spark, {table: (source[table].schema, TABLES[table]) for table in TABLES})
    broken = contracts.filter("failed_rows > 0")
    if not broken.isEmpty():
        lake.append(broken.withColumn("as_of", utc(as_of)).coalesce(1), "gate_reports")  # the ledger's scoring reads the reports
    for table, contract in TABLES.items():
        gates.require_contract(source[table], table, contract)
    today = day_of(utc(as_of))

    staged = {table: lake.write(stage(source[table], TABLES[table]), f"landed_{table}") for table in TABLES}
    rows = {table: lake.open(written) for table, written in staged.items()}
    split = {table: quarantine(rows[table], row_rules(table, domains.get(table, {}))) for table in TABLES}
    good = {table: kept for table, (kept, _) in split.items()}
    aside = {table: bad for table, (_, bad) in split.items()}
    outputs = {f"landed_{table}": written for table, written in staged.items()}
    for table in TABLES:
        kept = deduplicate(good[table]) if table == "orders" else good[table]
        outputs[f"stg_{table}"] = lake.write(kept, f"stg_{table}")
        outputs[f"quarantine_{table}"] = lake.write(aside[table], f"quarantine_{table}")
    clean = {table: lake.open(outputs[f"stg_{table}"]) for table in TABLES}

    heavy = {}
    for key in ("customer_id", "product_id"):
        outputs[f"heavy_{key}"] = lake.write(heavy_keys(clean["orders"], key), f"heavy_{key}")
        heavy[key] = lake.open(outputs[f"heavy_{key}"])
    facts = marts.fct_orders(clean["orders"], clean["customers"], clean["products"], clean["payments"], heavy)
    outputs["dim_customers"] = lake.write(marts.dim_customers(clean["customers"]), "dim_customers")
    outputs["dim_products"] = lake.write(marts.dim_products(clean["products"]), "dim_products")
    facts = facts.withColumn("span", F.date_trunc(grain, "order_day").cast("date"))
    outputs["fct_orders"] = lake.write(facts, "fct_orders", "span")
    fact_rows = lake.open(outputs["fct_orders"])
    outputs["fct_daily_revenue"] = lake.write(marts.fct_daily_revenue(fact_rows), "fct_daily_revenue")

    set_aside = lake.open(outputs["quarantine_orders"])
    removed = removed_by_dedup(good["orders"])
    matched = reconcile.reconcile(rows["orders"], fact_rows, removed, set_aside, today)
    orders_before, stored = lake.read("landed_orders"), lake.closed_totals()
    reports = [
        all_gates(rows, domains),
        staged_gate(clean["orders"]),
        *timely_gates(rows["orders"], as_of),
        reconcile.agreement_gate(matched),
        *against_last_build(rows, orders_before, lake.read("landed_products"), stored, today),
    ]
    report = _judge(lake, gates.union_all(reports), as_of, strict)
    if orders_before is not None and stored is not None:
        late = reconcile.added_totals(lake.read(ADJUSTMENTS), late_totals(rows["orders"], orders_before, stored))
        outputs[ADJUSTMENTS] = lake.write(late.coalesce(1), ADJUSTMENTS)  # one row per closed day with late rows
    lake.publish(outputs)
    totals = reconcile.totals_per_day(rows["orders"]).filter(F.col("day") < today)
    lake.store_control_totals(totals)
    return BuildResult({name: lake.open(written) for name, written in outputs.items()}, report)


def late_totals(orders: DataFrame, orders_before: DataFrame, stored: DataFrame) -> DataFrame:
    """Totals per closed day of the orders that the last build did not have."""
    arrived = orders.join(orders_before.select("order_id"), "order_id", "left_anti")
    last_closed = stored.agg(F.max("day").alias("_last"))  # one row
    return reconcile.totals_per_day(arrived).join(F.broadcast(last_closed), F.col("day") <= F.col("_last")).drop("_last")


def against_last_build(
    rows: Mapping[str, DataFrame],
    orders_before: DataFrame | None,
    products_before: DataFrame | None,
    stored: DataFrame | None,
    today: Column,
) -> list[DataFrame]:
    """Gates that need an earlier build: closed days unchanged, late rows, revenue drivers.

    ``stored`` are the totals of closed days with the late rows of earlier builds added, see ``Lake.closed_totals``.
    """
    if orders_before is None or products_before is None or stored is None:
        return []
    last_closed = stored.select(F.max("day")).scalar()
    late = late_totals(rows["orders"], orders_before, stored)
    current = reconcile.totals_per_day(rows["orders"]).filter(F.col("day") <= last_closed)
    history = reconcile.reconcile_history(stored, current, late, today)
    orders, products = ORDERS.fieldNames(), PRODUCTS.fieldNames()
    drivers = reconcile.revenue_drivers(
        diff(orders_before.select(*orders), rows["orders"].select(*orders), "order_id", by_fingerprint=True),
        diff(products_before.select(*products), rows["products"].select(*products), "product_id", by_fingerprint=True),
    )
    return [reconcile.history_gate(history), reconcile.driver_gate(drivers)]


def _judge(lake: Lake, reports: DataFrame, as_of: datetime, strict: bool) -> list[Row]:
    """Collect the report, log it, and raise if it must stop the build."""
    found = reports.orderBy("check").collect()
    log = lake.spark.createDataFrame(found, reports.schema).withColumn("as_of", utc(as_of))
    lake.append(log.coalesce(1), "gate_reports")
    if strict:
        gates.raise_if_broken(found)
    return found
