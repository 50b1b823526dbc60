"""Synthesis, storage, the gated build and the stream."""

from __future__ import annotations

from collections import Counter
from datetime import UTC, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shoplane.contracts import DOMAINS, ORDERS, TABLES
from shoplane.functions.scalars import utc
from shoplane.operators import defects, gates, reconcile, staging, synth
from shoplane.plans import build as builds
from shoplane.plans import catalog, ingest, marts, questions, serving
from shoplane.session import configure, scratch_path
from shoplane.sources import tables as store
from shoplane.sources.tables import Lake
from shoplane.streaming import sync

from conftest import AS_OF


def rows_of(df):
    return Counter(tuple(row) for row in df.collect())


def test_synthesis_does_not_depend_on_partitions(spark):
    made = synth.make_baseline(spark, AS_OF, 40, 30, 200)
    ids = synth.row_ids(spark, 200, "order_id").repartition(7)
    customers = synth.make_customers(synth.row_ids(spark, 40, "customer_id").repartition(5), 42, AS_OF)
    products = synth.make_products(synth.row_ids(spark, 30, "product_id").coalesce(1), 42, AS_OF)
    orders = synth.make_orders(
        ids,
        customers.withColumn("slot", F.col("customer_id") - 1),
        products.withColumn("slot", F.col("product_id") - 1),
        42,
        AS_OF,
    )
    assert rows_of(orders) == rows_of(made["orders"])
    assert rows_of(customers) == rows_of(made["customers"])
    assert rows_of(synth.make_payments(orders, 42, AS_OF)) == rows_of(made["payments"])
    assert rows_of(synth.make_products(synth.row_ids(spark, 30, "product_id"), 43, AS_OF)) != rows_of(products)


def test_baseline_sizes_and_contract(spark):
    made = synth.make_baseline(spark, AS_OF)
    counts = {row.table_name: row["rows"] for row in synth.table_counts(made).collect()}
    assert counts == {"customers": 500, "products": 200, "orders": 5000, "payments": 5000}
    for table, contract in TABLES.items():
        assert [(f.name, f.dataType) for f in made[table].schema.fields] == [(f.name, f.dataType) for f in contract.fields]
    assert made["customers"].select("email").distinct().count() == 500
    assert made["products"].select("sku").distinct().count() == 200


def test_traffic_needs_customers_and_products(shop):
    assert synth.make_traffic(shop, 50, 1, AS_OF).count() == 50
    assert synth.make_traffic({**shop, "customers": shop["customers"].limit(0)}, 50, 1, AS_OF).count() == 0
    assert synth.make_traffic({**shop, "products": shop["products"].limit(0)}, 50, 1, AS_OF).count() == 0
    moments = synth.make_traffic(shop, 5, 1, AS_OF).select(F.unix_seconds("ordered_at")).distinct().collect()
    assert [row[0] for row in moments] == [int(AS_OF.timestamp())]


def test_jdbc_reader_is_read_only_and_bounded():
    options = store.jdbc_options("orders", {"POSTGRES_HOST": "db", "POSTGRES_DB": "shop"})
    assert options["url"] == "jdbc:postgresql://db:5432/shop"
    assert options["dbtable"] == "public.orders"
    assert "READ ONLY" in options["sessionInitStatement"]
    assert options["user"] == "postgres"


def test_lake_versions_and_ledger(spark):
    lake = Lake(spark, scratch_path(spark, "lake"))
    assert lake.read("t") is None and lake.ledger().count() == 0
    lake.replace(spark.range(3), "t")
    written = lake.write(spark.range(5), "t")
    assert lake.read("t").count() == 3
    lake.publish({"t": written})
    assert lake.read("t").count() == 5
    lake.replace(spark.range(0).withColumn("d", F.lit("x")), "empty", "d")
    assert lake.read("empty").count() == 0
    first = spark.createDataFrame([("a", "x"), ("b", "y")], "failure_key string, detail string")
    lake.record(first, utc(AS_OF))
    lake.record(first.limit(1), utc(AS_OF))
    ledger = lake.ledger().select("incident_id", "failure_key", "detail").collect()
    assert sorted(row.incident_id for row in ledger) == [1, 2, 3]
    lake.refresh(synth.make_baseline(spark, AS_OF, 5, 4, 20))
    assert lake.read("raw_orders").count() == 20 and lake.ledger().count() == 3


def test_build_publishes_only_green_tables(spark, shop):
    configure(spark)
    lake = Lake(spark, scratch_path(spark, "build"))
    result = builds.build(lake, shop, AS_OF, grain="year")
    assert not [row for row in result.report if row.severity == "error" and row.failed_rows]
    daily = lake.read("fct_daily_revenue")
    assert rows_of(daily.select("day", "orders", "gross_revenue", "net_revenue")) == rows_of(
        questions.daily_revenue(shop["orders"])
    )
    fresh = marts.fct_orders(shop["orders"], shop["customers"], shop["products"], shop["payments"])
    assert rows_of(lake.read("fct_orders").select(*fresh.columns)) == rows_of(fresh)

    served = serving.answers(lake)
    assert rows_of(served["revenue_cuts"]) == rows_of(questions.revenue_cuts(fresh))
    assert rows_of(served["top_customers"]) == rows_of(questions.top_customers(shop["orders"], 10))
    # Traffic carries no payments.
    assert rows_of(served["uncovered_orders"]) == rows_of(questions.uncovered_orders(shop["orders"], shop["payments"]))
    assert served["uncovered_orders"].count() == 3
    assert rows_of(served["volume_flags"]) == rows_of(questions.volume_flags(shop["orders"]))
    runs = serving.timed_runs(lake, 1)
    p95, p99 = serving.latency(runs).filter("question = 'all'").orderBy("probability").collect()
    assert 0 < p95["quantile"] <= p99["quantile"] and p95["rows"] == len(served)

    zeroed = defects.inject(shop, "destructive_fix", defects.Context(AS_OF)).tables
    with pytest.raises(gates.GateFailure, match="closed days unchanged"):
        builds.build(lake, zeroed, AS_OF, grain="year")
    assert rows_of(lake.read("fct_daily_revenue")) == rows_of(daily)

    drifted = defects.inject(shop, "schema_drift", defects.Context(AS_OF)).tables
    with pytest.raises(gates.GateFailure, match=r"missing columns \['customer_id'\], unexpected columns \['user_id'\]"):
        builds.build(lake, drifted, AS_OF)

    spoiled = defects.inject(shop, "malformed_data", defects.Context(AS_OF)).tables
    loose = builds.build(lake, spoiled, AS_OF, strict=False, grain="year")
    assert lake.read("quarantine_orders").count() == 25
    assert lake.read("stg_orders").count() == shop["orders"].count() - 25
    checks = {row.check: row.failed_rows for row in loose.report}
    assert checks["orders: status not accepted"] == 25
    assert checks["orders: reconciled per closed day"] == 0
    totals = lake.read_log("control_totals")
    assert totals.select("day").distinct().count() == totals.count()


def failed(result):
    return {row.check: row.failed_rows for row in result.report if row.failed_rows}


def test_late_rows_stay_explained_in_later_builds(spark, shop):
    configure(spark)
    lake = Lake(spark, scratch_path(spark, "late"))
    builds.build(lake, shop, AS_OF, grain="year")
    late = defects.inject(shop, "late_arrival", defects.Context(AS_OF)).tables
    assert failed(builds.build(lake, late, AS_OF, grain="year")) == {"orders: late rows in closed days": 1}
    for _ in range(2):
        assert failed(builds.build(lake, late, AS_OF, grain="year")) == {}
    again = defects.inject(late, "late_arrival", defects.Context(AS_OF, seed=8)).tables
    assert failed(builds.build(lake, again, AS_OF, grain="year")) == {"orders: late rows in closed days": 1}
    assert [row["rows"] for row in lake.read(store.ADJUSTMENTS).collect()] == [2]
    assert lake.closed_totals().agg(F.sum("rows")).first()[0] == lake.read_log("control_totals").agg(F.sum("rows")).first()[0] + 2
    day = F.col("ordered_at").cast("date") == F.lit("2025-12-01")
    zeroed = again["orders"].withColumn("total_amount", F.when(day, F.col("total_amount") * 0).otherwise(F.col("total_amount")).cast("decimal(12,2)"))
    with pytest.raises(gates.GateFailure, match="closed days unchanged"):
        builds.build(lake, {**again, "orders": zeroed}, AS_OF, grain="year")


@pytest.mark.parametrize(("key", "removed"), [("volume_spike", 450), ("duplicate_order", 1)])
def test_strict_build_takes_copies_out_and_publishes(spark, shop, key, removed):
    configure(spark)
    lake = Lake(spark, scratch_path(spark, "copies"))
    spoiled = defects.inject(shop, key, defects.Context(AS_OF)).tables
    found = failed(builds.build(lake, spoiled, AS_OF, grain="year"))
    assert found.pop("orders: customer_id, product_id, ordered_at unique") == removed
    assert set(found) == ({"orders: daily volume"} if key == "volume_spike" else set())
    assert lake.read("stg_orders").count() == spoiled["orders"].count() - removed


def test_rows_ahead_of_time_hide_no_staleness(spark):
    rows = [(AS_OF - timedelta(days=5),), (datetime(2030, 1, 1, tzinfo=UTC),)]
    report = gates.freshness_gate(spark.createDataFrame(rows, "ordered_at timestamp"), "ordered_at", utc(AS_OF))
    assert {row.check: (row.severity, row.failed_rows) for row in report.collect()} == {
        "landing: fresh": ("warn", 1),
        "landing: not ahead of time": ("warn", 1),
    }
    newest = gates.freshness({"orders": spark.createDataFrame(rows, "ordered_at timestamp")}, utc(AS_OF)).first()
    assert newest.lag_seconds == 5 * 86400 and not newest.fresh


@pytest.mark.parametrize("hour", [0, 2, 13, 23])
def test_even_load_raises_no_volume_warning(spark, hour):
    as_of = datetime(2026, 1, 15, hour, tzinfo=UTC)
    minutes = F.lit(int(as_of.timestamp())) - F.col("id") * 600
    orders = spark.range(40 * 144).select(F.timestamp_seconds(minutes).alias("ordered_at"), F.lit(Decimal("1.00")).alias("total_amount"), F.lit("placed").alias("status"))
    orders = orders.filter(F.col("ordered_at") >= F.lit("2025-12-10").cast("timestamp"))
    reports = {row.check: row.failed_rows for row in gates.union_all(builds.timely_gates(orders, as_of)).collect()}
    assert reports["orders: daily volume"] == 0


@pytest.mark.parametrize(("hour", "warns"), [(12, 0), (14, 1), (23, 1)])
def test_an_outage_at_noon_warns_while_the_day_runs(spark, hour, warns):
    as_of = datetime(2026, 1, 15, hour, tzinfo=UTC)
    minutes = F.lit(int(as_of.timestamp())) - F.col("id") * 600
    orders = spark.range(40 * 144).select(F.timestamp_seconds(minutes).alias("ordered_at"), F.lit(Decimal("1.00")).alias("total_amount"), F.lit("placed").alias("status"))
    orders = orders.filter(F.col("ordered_at") >= F.lit("2025-12-10").cast("timestamp"))
    struck = orders.filter(F.col("ordered_at") <= F.lit("2026-01-15 12:00:00").cast("timestamp"))
    reports = {row.check: row.failed_rows for row in gates.union_all(builds.timely_gates(struck, as_of)).collect()}
    assert reports["orders: daily volume"] == warns
    silent = orders.filter(F.col("ordered_at") < F.lit("2026-01-15").cast("timestamp"))
    assert questions.volume_until_now(silent, utc(as_of)).first().flag == "drop"


def test_accounting_holds_under_any_defects(spark, shop):
    tables = shop
    for key in ("negative_price", "missing_customer", "duplicate_order", "invalid_quantity", "volume_spike"):
        tables = defects.inject(tables, key, defects.Context(AS_OF, seed=3)).tables
    rows = staging.stage(tables["orders"], ORDERS)
    good, aside = staging.quarantine(rows, staging.row_rules("orders", DOMAINS["orders"]))
    matched = reconcile.reconcile(
        tables["orders"],
        staging.deduplicate(good),
        staging.removed_by_dedup(good),
        aside,
        F.lit("2026-02-01").cast("date"),
    )
    assert matched.filter(~F.col("agrees")).count() == 0
    sums = matched.agg(F.sum("removed_rows"), F.sum("aside_rows")).first()
    # The order copied is the latest, the one without customer: the copy is set aside with it.
    assert tuple(sums) == (450, 4)


def test_landing_by_key_and_by_snapshot(spark, shop):
    lake = Lake(spark, scratch_path(spark, "ingest"))
    orders = shop["orders"]
    early = orders.filter("order_id <= 1000 and order_id != 990")
    assert ingest.land_new(lake, early, "orders") == 0
    assert ingest.land_new(lake, orders, "orders", lookback=50) == 1000
    assert rows_of(ingest.landed(lake, "orders")) == rows_of(orders)
    ingest.land_new(lake, orders, "orders", lookback=50)
    assert ingest.landed(lake, "orders").count() == orders.count()

    assert {row.change for row in ingest.land_snapshot(lake, orders, "orders").select("change").collect()} == {"insert"}
    zeroed, _ = defects.zero_latest(orders.filter("order_id != 5"), 10)
    changes = ingest.land_snapshot(lake, zeroed, "orders").groupBy("change").count().collect()
    assert {row.change: row["count"] for row in changes} == {"update": 10, "delete": 1}
    assert rows_of(lake.read("raw_orders")) == rows_of(zeroed)
    drifted = orders.withColumnRenamed("customer_id", "user_id")
    with pytest.raises(gates.GateFailure):
        ingest.land_new(lake, drifted, "orders")


BASE = datetime(2026, 1, 1, tzinfo=UTC)


def order_file(spark, folder, name, rows):
    spark.createDataFrame(rows, ORDERS).coalesce(1).write.parquet(f"{folder}/{name}")


def some_orders():
    def make(order_id, day, status="placed", total="20.00"):
        at = BASE + timedelta(days=day, hours=order_id % 5)
        return (order_id, order_id % 4, order_id % 3, 2, Decimal("10.00"), Decimal(total), status, at)

    first = [make(i, i % 3) for i in range(12)]
    second = [make(i, 4) for i in range(20, 26)] + [make(3, 0, "cancelled")]
    late = [make(40, -45, "delivered")]
    return first, second, late


@pytest.fixture(scope="module")
def change_files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("changes")
    for place, rows in enumerate(some_orders()):
        order_file(spark, folder, f"part{place}", rows)
    return str(folder)


def synced(spark, folder, files_per_batch):
    lake = Lake(spark, scratch_path(spark, "sync"))
    stream = sync.change_stream(spark, f"{folder}/*", files_per_batch=files_per_batch, glob="*.parquet")
    sync.sync_orders(stream, lake, scratch_path(spark, "sync-at"), AS_OF).awaitTermination()
    return lake


def test_stream_keeps_late_rows_and_updates(spark, change_files):
    lake = synced(spark, change_files, 1)
    daily = {str(row.day): (row.orders, str(row.net_revenue)) for row in lake.read(sync.DAILY).collect()}
    assert daily["2025-11-17"] == (1, "20.00")
    assert sum(orders for orders, _ in daily.values()) == 19
    assert lake.read_log(sync.STAGED).filter("order_id = 3").first().status == "cancelled"
    notes = lake.read_log(sync.FRESHNESS).collect()
    assert len(notes) == 3 and all(str(note.newest_at)[:10] >= "2026-01-03" for note in notes)


def test_batch_cuts_do_not_matter(spark, change_files):
    many, one = synced(spark, change_files, 1), Lake(spark, scratch_path(spark, "sync"))
    for place, rows in enumerate(some_orders()):
        sync.land_batch(one, spark.createDataFrame(rows, ORDERS), place)
    assert rows_of(one.read(sync.DAILY)) == rows_of(many.read(sync.DAILY))


def test_repeating_a_batch_changes_nothing(spark):
    lake = Lake(spark, scratch_path(spark, "sync"))
    first, second, late = (spark.createDataFrame(rows, ORDERS) for rows in some_orders())
    for place, batch in enumerate((first, second, late)):
        sync.land_batch(lake, batch, place)
    before = rows_of(lake.read(sync.DAILY)), rows_of(lake.read_log(sync.STAGED))
    sync.land_batch(lake, second, 1)
    assert (rows_of(lake.read(sync.DAILY)), rows_of(lake.read_log(sync.STAGED))) == before


def test_score_expands_the_cascade(spark):
    ledger = spark.createDataFrame([("multi_failure_cascade", 1), ("negative_price", 2)], "failure_key string, item int")
    seen = spark.createDataFrame(
        [("missing_customer", 1), ("volume_spike", 1), ("negative_price", 3)], "failure_key string, item int"
    )
    scores = {row.failure_key: (row.precision, row.recall) for row in reconcile.score(ledger, seen).collect()}
    assert scores == {
        "missing_customer": (1.0, 1.0),
        "volume_spike": (1.0, 1.0),
        "schema_drift": (None, 0.0),
        "negative_price": (0.0, 0.0),
    }


@pytest.fixture(scope="module")
def part_files(spark, tmp_path_factory):
    """The tables as folders of part files, moments shuffled over the files, some rows in two of them."""
    folder = tmp_path_factory.mktemp("parts")
    small = "/root/testdata/sf0.001"
    for table in ("orders", "events"):
        spark.read.parquet(f"{small}/{table}.parquet").orderBy(F.rand(3)).repartition(4).write.parquet(f"{folder}/{table}.parquet")
    again = spark.read.parquet(f"{small}/orders.parquet").limit(200).coalesce(1)
    again.write.mode("append").parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_streams_lose_nothing_over_many_batches(spark, part_files):
    once = catalog.stream_dedup(spark, part_files, files_per_batch=1)
    keys = spark.read.parquet(f"{part_files}/orders.parquet").select("o_orderkey").distinct().count()
    assert (once.count(), once.select("o_orderkey").distinct().count()) == (keys, keys)
    rate = catalog.stream_order_rate(spark, part_files, files_per_batch=1)
    assert rate.agg(F.sum("rows")).first()[0] == spark.read.parquet(f"{part_files}/events.parquet").count()
