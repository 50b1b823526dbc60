"""The gate matrix: a clean shop is green, and every defect trips the checks meant for it and no others."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shoplane.contracts import DOMAINS, TABLES
from shoplane.functions.scalars import day_of, utc
from shoplane.operators import defects, gates, quantiles, reconcile, staging
from shoplane.operators.daily import daily_totals
from shoplane.plans import build as builds
from shoplane.plans import questions
from shoplane.session import scratch_path, settle
from shoplane.sources.tables import Lake

from conftest import AS_OF

CONTEXT = defects.Context(AS_OF, seed=5)


def failing(tables):
    """Checks that fail, contract first and alone."""
    spark = tables["orders"].sparkSession
    contract = gates.contract_gate(spark, {table: (tables[table].schema, TABLES[table]) for table in TABLES})
    broken = {row.check for row in contract.collect() if row.failed_rows}
    if broken:
        return broken
    tables = {table: settle(df) for table, df in tables.items()}
    reports = gates.union_all([builds.all_gates(tables, DOMAINS), *builds.timely_gates(tables["orders"], AS_OF)])
    return {row.check for row in reports.collect() if row.failed_rows}


def today():
    return day_of(utc(AS_OF))


def against(before, after):
    """Failing checks that compare with the last build of ``before``."""
    stored = reconcile.totals_per_day(before["orders"]).filter(F.col("day") < today())
    reports = builds.against_last_build(after, before["orders"], before["products"], stored, today())
    return {row.check: row for row in gates.union_all(reports).collect() if row.failed_rows}


def struck(shop, key):
    return defects.inject(shop, key, CONTEXT)


def test_clean_shop_is_green(shop):
    assert failing(shop) == set()
    assert against(shop, shop) == {}


NEGATIVE = {"orders: unit_price negative", "orders: total_amount negative"}
MISSING = {"orders: customer_id is null", "orders: customer_id known"}

MATRIX = {
    "negative_price": NEGATIVE,
    "missing_customer": MISSING,
    "invalid_quantity": {"orders: quantity not positive", "orders: total is not price times quantity"},
    "duplicate_order": {"orders: customer_id, product_id, ordered_at unique"},
    "late_arrival": set(),
    "volume_spike": {"orders: daily volume", "orders: customer_id, product_id, ordered_at unique"},
    "schema_drift": {"orders: contract"},
    "orphan_payment": {"payments: order_id known"},
    "recurring_incident": NEGATIVE,
    "destructive_fix": {"orders: total is not price times quantity"},
    "malformed_data": {"orders: status not accepted"},
    "slow_source": {"landing: fresh"},
    "multi_failure_cascade": {"orders: contract"},
    "ambiguous_anomaly": set(),
}


def test_matrix_covers_every_defect():
    assert set(MATRIX) == set(defects.REGISTRY)


@pytest.fixture(scope="module")
def tripped(shop):
    """Failing checks per defect; small jobs, so several run at a time."""
    keys = sorted(MATRIX)
    with ThreadPoolExecutor(6) as pool:
        return dict(zip(keys, pool.map(lambda key: failing(struck(shop, key).tables), keys), strict=True))


@pytest.mark.parametrize("key", sorted(MATRIX))
def test_defect_trips_its_gates(tripped, key):
    assert tripped[key] == MATRIX[key]


def test_contract_names_both_sides_of_a_rename(spark, shop):
    drifted = struck(shop, "schema_drift").tables["orders"].withColumn("channel", F.lit("web"))
    report = gates.contract_gate(spark, {"orders": (drifted.schema, TABLES["orders"])}).first()
    assert report.failed_rows == 1 and report.sample == "customer_id missing, user_id extra, channel extra"
    added = gates.contract_gate(spark, {"orders": (shop["orders"].withColumn("x", F.lit(1)).schema, TABLES["orders"])})
    assert added.first().failed_rows == 0


def test_cascade_behind_the_contract(shop):
    tables = dict(struck(shop, "multi_failure_cascade").tables)
    tables["orders"] = staging.rename_back(tables["orders"])
    expected = MISSING | {"orders: daily volume", "orders: customer_id, product_id, ordered_at unique"}
    assert failing(tables) == expected


def test_destructive_fix_changes_history(shop):
    found = against(shop, struck(shop, "destructive_fix").tables)
    assert set(found) == {"orders: closed days unchanged"}
    zeroed = struck(shop, "destructive_fix").tables["orders"].filter(F.col("total_amount") == 0).count()
    assert zeroed == 300


def test_late_arrival_is_a_late_row_and_no_mismatch(shop):
    found = against(shop, struck(shop, "late_arrival").tables)
    assert set(found) == {"orders: late rows in closed days"}


def test_ambiguous_anomaly_names_both_drivers(shop):
    found = against(shop, struck(shop, "ambiguous_anomaly").tables)
    drivers = {check: row.failed_rows for check, row in found.items() if check.startswith("revenue driver")}
    assert drivers == {"revenue driver: cancellations": 200, "revenue driver: price changes": 20}


def test_dedup_hides_a_burst_but_raw_counts_show_it(shop):
    spiked = struck(shop, "volume_spike").tables["orders"]
    raw = daily_totals(spiked).filter(F.col("day") == today()).first().orders
    kept = daily_totals(staging.deduplicate(spiked)).filter(F.col("day") == today()).first().orders
    before = daily_totals(shop["orders"]).filter(F.col("day") == today()).first().orders
    assert (raw - before, kept - before) == (500, 50)
    assert staging.removed_by_dedup(spiked).count() == 450


def test_reports_say_what_was_touched(shop):
    said = {key: struck(shop, key).report.first().detail for key in sorted(defects.REGISTRY)}
    top = shop["orders"].agg(F.max("order_id")).first()[0]
    assert said["negative_price"] == f"order_id={top + 1} unit_price=-49.99"
    assert said["invalid_quantity"] == f"order_id={top + 1} quantity=-5"
    assert said["duplicate_order"] == f"duplicated into order_id={top + 1}"
    assert said["late_arrival"] == f"order_id={top + 1} ordered_at=2025-12-01"
    assert said["volume_spike"] == "inserted 500 orders in one burst"
    assert said["destructive_fix"] == "zeroed total_amount on 300 orders (bulk fix required)"
    assert said["ambiguous_anomaly"] == "200 orders cancelled + 20 products price-cut 50%"
    assert said["multi_failure_cascade"] == "cascade: missing_customer, volume_spike, schema_drift"
    assert said["recurring_incident"] == f"order_id={top + 1} (occurrence #1)"


def test_reports_count_real_rows(shop):
    few = {**shop, "orders": shop["orders"].filter("order_id <= 7")}
    assert defects.inject(few, "destructive_fix", CONTEXT).report.first().detail.startswith("zeroed total_amount on 7 ")
    none = {**shop, "orders": shop["orders"].limit(0)}
    assert defects.inject(none, "duplicate_order", CONTEXT).report.first().detail == "no orders to duplicate"
    assert defects.inject(none, "duplicate_order", CONTEXT).tables["orders"].count() == 0


def test_burst_without_customers_has_null_customers(shop):
    alone = {**shop, "customers": shop["customers"].limit(0)}
    rows = defects.burst_rows(alone, CONTEXT)
    assert rows.count() == 500 and rows.filter("customer_id is not null").count() == 0


def test_cascade_records_its_parts(shop):
    records = struck(shop, "multi_failure_cascade").records
    assert [row.failure_key for row in records.collect()] == ["missing_customer", "volume_spike", "schema_drift"]


def test_recurring_counts_the_ledger(spark, shop):
    ledger = spark.createDataFrame(
        [(1, "recurring_incident"), (2, "negative_price"), (3, "recurring_incident")], "incident_id int, failure_key string"
    )
    context = defects.Context(AS_OF, 5, ledger)
    assert defects.inject(shop, "recurring_incident", context).report.first().detail.endswith("(occurrence #3)")


def test_recording_is_opt_in_and_numbers_recurrences(spark, shop):
    lake = Lake(spark, scratch_path(spark, "ledger"))
    for key in ("recurring_incident", "multi_failure_cascade", "recurring_incident"):
        done = defects.inject_recorded(lake, shop, key, CONTEXT)
    assert done.report.first().detail.endswith("(occurrence #2)")
    recorded = sorted((row.incident_id, row.failure_key) for row in lake.ledger().collect())
    assert [key for _, key in recorded] == [
        "recurring_incident",
        "missing_customer",
        "volume_spike",
        "schema_drift",
        "recurring_incident",
    ]
    numbered = {(row.failure_key, row.occurrence) for row in quantiles.occurrences(lake.ledger()).collect()}
    assert ("recurring_incident", 2) in numbered and ("volume_spike", 1) in numbered


def test_drift_is_idempotent_and_others_tolerate_it(shop):
    drifted = struck(shop, "schema_drift").tables
    again = defects.inject(drifted, "schema_drift", CONTEXT)
    assert again.report.first().detail == "already drifted (column is user_id)"
    spoiled = defects.inject(drifted, "missing_customer", CONTEXT)
    assert spoiled.tables["orders"].filter("user_id is null").count() == 1
    assert spoiled.report.first().detail == "inserted order with user_id=NULL"


def test_unknown_defect_lists_the_known():
    with pytest.raises(KeyError, match="volume_spike"):
        defects.get("nothing")


def test_clean_shop_keeps_its_invariants(shop):
    orders, payments = shop["orders"], shop["payments"]
    joined = payments.join(orders.withColumnRenamed("status", "order_status"), "order_id")
    wrong = joined.filter(
        (F.col("amount") != F.col("total_amount"))
        | (F.col("paid_at") < F.col("ordered_at"))
        | ((F.col("order_status") == "returned") & (F.col("status") != "refunded"))
    )
    assert wrong.count() == 0
    assert questions.late_signups(orders, shop["customers"]).count() == 0
    margin = shop["products"].select((F.col("cost") / F.col("unit_price")).alias("share"))
    low, high = margin.agg(F.min("share"), F.max("share")).first()
    assert low >= Decimal("0.44") and high <= Decimal("0.81")
    spread = orders.filter("order_id <= 1500").agg(F.min("quantity"), F.max("quantity")).first()
    assert tuple(spread) == (1, 6)
