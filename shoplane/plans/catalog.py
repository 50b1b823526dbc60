"""Every query of the lane over the star-schema tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplane.contracts import NATURAL_KEY, ORDERS, PRIMARY_KEYS, TABLES
from shoplane.functions.scalars import day_of, utc
from shoplane.operators import capture, decompose, defects, gates, quantiles, reconcile, scoring, selection, staging, synth
from shoplane.operators.lookup import without_match
from shoplane.operators.numbering import append_with_keys
from shoplane.plans import marts, questions, refresh
from shoplane.session import scratch_path
from shoplane.sources import keyed, star
from shoplane.sources.snapshots import Snapshot
from shoplane.sources.tables import Lake
from shoplane.streaming import sync

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2001, 8, 2, tzinfo=UTC)  # the day after the last order of the test tables
SEED = 42
TRAFFIC = 200
QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    """Register a query under the name of its function."""
    QUERIES[make.__name__] = make
    return make


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text, so that results compare across engines."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType | T.TimestampNTZType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def queries() -> dict[str, Query]:
    """All queries with portable output."""

    def wrap(make: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return portable(make(spark, folder))

        return run

    return {name: wrap(make) for name, make in QUERIES.items()}


# Question set


@query
def daily_revenue(spark, folder):
    return questions.daily_revenue(star.orders(spark, folder))


@query
def revenue_by_category(spark, folder):
    return questions.revenue_by(star.orders(spark, folder), star.products(spark, folder), "product_id", "category")


@query
def revenue_by_segment(spark, folder):
    return questions.revenue_by(star.orders(spark, folder), star.customers(spark, folder), "customer_id", "segment")


@query
def revenue_by_country(spark, folder):
    return questions.revenue_by(star.orders(spark, folder), star.customers(spark, folder), "customer_id", "country")


@query
def revenue_grouping_sets(spark, folder):
    customers, products = star.customers(spark, folder), star.products(spark, folder)
    return questions.revenue_cuts(marts.described_orders(star.defect_orders(spark, folder), customers, products))


@query
def aov_orders_per_day(spark, folder):
    return questions.order_value_per_day(star.orders(spark, folder))


@query
def rolling_aov_7d(spark, folder):
    return questions.order_value_trend(star.orders(spark, folder), 7)


@query
def customer_ltv(spark, folder):
    return questions.lifetime_value(star.defect_orders(spark, folder))


@query
def top_customers_ltv(spark, folder):
    return questions.top_customers(star.orders(spark, folder), 100)


@query
def payment_coverage(spark, folder):
    return questions.uncovered_orders(star.defect_orders(spark, folder), star.defect_payments(spark, folder))


@query
def orphan_orders(spark, folder):
    orders, customers = star.defect_orders(spark, folder), star.customers(spark, folder)
    return without_match(orders, customers, "customer_id", "customer_id", "order_id")


@query
def orphan_products(spark, folder):
    """Orders without a product once the LARGE parts are taken out of the catalogue."""
    listed = star.products(spark, folder).filter(F.col("category") != "LARGE")
    return without_match(star.orders(spark, folder), listed, "product_id", "product_id", "order_id")


@query
def orphan_payments(spark, folder):
    payments, orders = star.defect_payments(spark, folder), star.defect_orders(spark, folder)
    return without_match(payments, orders, "order_id", "order_id", "payment_id")


@query
def orphan_summary(spark, folder):
    return questions.orphan_summary(star.defect_tables(spark, folder))


@query
def dod_change(spark, folder):
    return questions.volume_change(star.orders(spark, folder))


@query
def volume_anomaly(spark, folder):
    return questions.volume_flags(star.orders(spark, folder))


@query
def product_margin(spark, folder):
    return questions.margin_by_product(star.orders(spark, folder), star.products(spark, folder))


@query
def late_signups(spark, folder):
    """Orders before signup, with customers signing up day by day of their key."""
    signup = F.timestamp_seconds(F.unix_seconds("created_at") + F.col("customer_id") * 86400)
    customers = star.customers(spark, folder).withColumn("created_at", signup)
    return questions.late_signups(star.orders(spark, folder), customers)


@query
def malformed_statuses(spark, folder):
    return questions.malformed_statuses(star.defect_orders(spark, folder), star.star_domains()["orders"]["status"])


@query
def timing_percentiles(spark, folder):
    timed = quantiles.exact_quantiles(star.timings(spark, folder), "question", "seconds", (0.95, 0.99))
    return timed.withColumn("quantile", F.round("quantile", 4))


# Staging and marts


@query
def stg_orders(spark, folder):
    """Orders as landed text, typed and quarantined: the rows that stay."""
    return _staged_orders(spark, folder)[0]


@query
def quarantined_orders(spark, folder):
    return _staged_orders(spark, folder)[1].withColumn("reasons", F.concat_ws("; ", "reasons"))


def _staged_orders(spark, folder):
    as_text = star.defect_orders(spark, folder).select(
        *[F.col(name).cast("string") if name != "order_id" else F.col(name) for name in ORDERS.fieldNames()]
    )
    spoiled = as_text.withColumn(
        "quantity", F.when(F.pmod("order_id", F.lit(937)) == 10, F.lit("many")).otherwise(F.col("quantity"))
    )
    rules = staging.row_rules("orders", star.star_domains()["orders"])
    return staging.quarantine(staging.stage(spoiled, ORDERS), rules)


@query
def dedup_orders(spark, folder):
    return staging.deduplicate(star.defect_orders(spark, folder))


@query
def dedup_removed(spark, folder):
    return staging.removed_by_dedup(star.defect_orders(spark, folder))


@query
def rename_back(spark, folder):
    drifted = star.orders(spark, folder).withColumnRenamed("customer_id", "user_id")
    return staging.rename_back(drifted).select("order_id", "customer_id")


@query
def dim_customers(spark, folder):
    return marts.dim_customers(star.customers(spark, folder))


@query
def dim_products(spark, folder):
    return marts.dim_products(star.products(spark, folder))


@query
def fct_orders(spark, folder):
    tables = star.defect_tables(spark, folder)
    return marts.fct_orders(tables["orders"], tables["customers"], tables["products"], tables["payments"])


@query
def fct_daily_revenue(spark, folder):
    return marts.fct_daily_revenue(staging.deduplicate(star.defect_orders(spark, folder)))


# Gates and reconciliation


def _rules(table: str, *endings: str) -> dict:
    rules = staging.row_rules(table, star.star_domains()[table])
    return {name: broken for name, broken in rules.items() if name.endswith(endings)}


def _row_gate(spark, folder, *endings: str) -> DataFrame:
    tables = star.defect_tables(spark, folder)
    picked = {table: _rules(table, *endings) for table in TABLES}
    return gates.union_all(gates.row_gates(tables[table], table, rules) for table, rules in picked.items() if rules)


@query
def gate_not_null(spark, folder):
    return _row_gate(spark, folder, "is null")


@query
def gate_accepted_values(spark, folder):
    return _row_gate(spark, folder, "not accepted")


@query
def gate_non_negative(spark, folder):
    return _row_gate(spark, folder, "negative")


@query
def gate_positive_qty(spark, folder):
    return _row_gate(spark, folder, "not positive")


@query
def gate_row_arithmetic(spark, folder):
    return _row_gate(spark, folder, "price times quantity")


@query
def gate_payment_rules(spark, folder):
    return gates.payment_rule_gates(star.defect_orders(spark, folder), star.defect_payments(spark, folder))


@query
def gate_unique(spark, folder):
    tables = star.defect_tables(spark, folder)
    keys = [(table, (PRIMARY_KEYS[table],)) for table in TABLES]
    keys += [("customers", ("email",)), ("products", ("sku",)), ("orders", NATURAL_KEY)]
    return gates.union_all(gates.unique_gate(tables[table], table, columns) for table, columns in keys)


@query
def gate_relationships(spark, folder):
    tables = star.defect_tables(spark, folder)
    return gates.union_all(
        [
            gates.reference_gate(tables["orders"], tables["customers"], "orders", "customer_id"),
            gates.reference_gate(tables["orders"], tables["products"], "orders", "product_id"),
            gates.reference_gate(tables["payments"], tables["orders"], "payments", "order_id"),
        ]
    )


@query
def gate_contract(spark, folder):
    """The orders contract against orders whose customer column was renamed."""
    drifted = star.defect_orders(spark, folder).withColumnRenamed("customer_id", "user_id")
    return gates.contract_report(drifted, "orders", ORDERS)


@query
def gate_freshness(spark, folder):
    return gates.freshness(star.defect_tables(spark, folder), utc(AS_OF), 86400)


@query
def gate_volume(spark, folder):
    return gates.volume_gate(questions.volume_flags(star.defect_orders(spark, folder)))


@query
def open_day_volume(spark, folder):
    """The last day of the events, taken as open at noon: events so far against the 28 days before, up to noon."""
    events = star.read_star(spark, folder, "events").select(F.col("ts").cast("timestamp").alias("ordered_at"), F.lit("placed").alias("status"), F.lit(0).cast("decimal(12,2)").alias("total_amount"))
    noon = events.select(F.date_trunc("day", F.max("ordered_at")) + F.expr("interval 12 hours")).scalar()
    return questions.volume_until_now(events, noon)


@query
def late_rows(spark, folder):
    return reconcile.late_rows(star.landed_orders(spark, folder))


@query
def reconcile_closed_days(spark, folder):
    source = star.defect_orders(spark, folder)
    rules = staging.row_rules("orders", star.star_domains()["orders"])
    good, aside = staging.quarantine(staging.stage(source, ORDERS), rules)
    return reconcile.reconcile(
        source, staging.deduplicate(good), staging.removed_by_dedup(good), aside, _day_after(source)
    )


def _day_after(orders: DataFrame):
    """The day after the newest order, by which every day is closed."""
    return orders.select(F.date_add(F.max(day_of("ordered_at")), 1)).scalar()


@query
def reconcile_history(spark, folder):
    """Totals stored from clean orders as each day closed against defective orders with late rows now."""
    landed = star.landed_orders(spark, folder)
    in_time = F.pmod("order_id", F.lit(4)) == 0
    stored = reconcile.totals_per_day(star.orders(spark, folder).filter(in_time))
    late = reconcile.totals_per_day(reconcile.late_rows(landed))
    return reconcile.reconcile_history(stored, reconcile.totals_per_day(landed), late, _day_after(landed))


@query
def control_totals(spark, folder):
    return reconcile.totals_per_day(star.defect_orders(spark, folder))


@query
def revenue_drivers(spark, folder):
    old = star.clean_tables(spark, folder)
    new = defects.inject(old, "ambiguous_anomaly", _context()).tables
    return reconcile.revenue_drivers(
        capture.diff(old["orders"], new["orders"], "order_id"),
        capture.diff(old["products"], new["products"], "product_id"),
    )


@query
def revenue_decomposition(spark, folder):
    """Net revenue month by month: volume, mix of categories, price and cancellation."""
    goods = star.products(spark, folder).select(F.col("product_id").alias("_product"), "category")
    orders = star.orders(spark, folder).join(goods, F.col("product_id") == F.col("_product"))
    return decompose.revenue_decomposition(orders, "category")


@query
def detection_score(spark, folder):
    tables = star.defect_tables(spark, folder)
    statuses = star.star_domains()["orders"]["status"]
    removed = staging.removed_by_dedup(tables["orders"])
    found = reconcile.detected_in_orders(tables["orders"], removed, statuses).unionByName(
        reconcile.detected_in_payments(tables["payments"], tables["orders"])
    )
    return reconcile.score(star.defect_ledger(spark, folder), found)


@query
def detection_by_build(spark, folder):
    """A build at the end of every month, judging all there is by then, against a ledger of what was injected when."""
    tables = star.defect_tables(spark, folder)

    def counted(rows: DataFrame, moment: str, checks: dict) -> DataFrame:
        month_end = F.add_months(F.date_trunc("month", moment), 1).cast("timestamp") - F.expr("interval 1 second")
        counts = rows.groupBy(month_end.alias("as_of")).agg(*[F.count_if(broken).alias(f"n{at}") for at, broken in enumerate(checks.values())])
        lines = [F.struct(F.lit(check).alias("check"), F.col(f"n{at}").alias("failed_rows")) for at, check in enumerate(checks)]
        return counts.select("as_of", F.inline(F.array(*lines)))

    rules = staging.row_rules("orders", star.star_domains()["orders"])
    judged = counted(tables["orders"], "ordered_at", {f"orders: {name}": broken for name, broken in rules.items()})
    copies = staging.removed_by_dedup(tables["orders"]).withColumn("copy", F.lit(True))
    judged = judged.unionByName(counted(copies, "ordered_at", {scoring.SIGNS["duplicate_order"][0]: F.col("copy")}))
    orphans = without_match(tables["payments"], tables["orders"], "order_id", "order_id", "payment_id").withColumn("orphan", F.lit(True))
    judged = judged.unionByName(counted(orphans, "paid_at", {scoring.SIGNS["orphan_payment"][0]: F.col("orphan")}))
    by_then = Window.partitionBy("check").orderBy("as_of").rowsBetween(Window.unboundedPreceding, 0)  # one row per month
    reports = judged.withColumn("failed_rows", F.sum("failed_rows").over(by_then))
    return scoring.score_builds(star.timed_ledger(spark, folder), reports)


# Ingest


@query
def snapshot_diff(spark, folder):
    changes = capture.diff(star.orders(spark, folder), star.changed_orders(spark, folder), "order_id")
    return _flat_changes(changes)


@query
def snapshot_diff_by_fingerprint(spark, folder):
    changes = capture.diff(star.orders(spark, folder), star.changed_orders(spark, folder), "order_id", True)
    return _flat_changes(changes)


def _snapshot(spark, folder) -> Snapshot:
    snapshot = Snapshot(Lake(spark, scratch_path(spark, "snapshot")), "orders", "order_id", ORDERS.fieldNames(), part=4096, leaf=16)
    snapshot.bring_to(star.orders(spark, folder))
    return snapshot


@query
def snapshot_diff_by_tree(spark, folder):
    return _flat_changes(_snapshot(spark, folder).diff(star.changed_orders(spark, folder)))


@query
def snapshot_brought_up(spark, folder):
    """The orders after bringing a snapshot to a later one, in the parts that differ."""
    snapshot = _snapshot(spark, folder)
    snapshot.bring_to(star.changed_orders(spark, folder))
    return snapshot.rows()


def _flat_changes(changes: DataFrame) -> DataFrame:
    return changes.select(
        "order_id",
        "change",
        F.col("before.status").alias("old_status"),
        F.col("after.status").alias("new_status"),
        F.col("before.total_amount").alias("old_total"),
        F.col("after.total_amount").alias("new_total"),
    )


@query
def apply_changes(spark, folder):
    old, new = star.orders(spark, folder), star.changed_orders(spark, folder)
    return capture.apply_changes(old, capture.diff(old, new, "order_id"), "order_id")


@query
def latest_version(spark, folder):
    """Events as versions of their user's row."""
    events = star.read_star(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    return capture.latest_version(events, "user_id", "event_id")


@query
def new_rows(spark, folder):
    """The later snapshot against the orders landed so far: everything past the mark, or missed among the last 1,000 keys."""
    landed, source = star.orders(spark, folder), star.changed_orders(spark, folder)
    mark = capture.high_mark(landed, "order_id")
    return capture.new_rows(source, landed, "order_id", mark, lookback=1000)


@query
def append_keys(spark, folder):
    """Customers appended to the parts' key range in order of account and key."""
    parts = star.read_star(spark, folder, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("n"))
    people = star.read_star(spark, folder, "customer").select(F.col("c_name").alias("n"), "c_acctbal", "c_custkey")
    _, keyed = append_with_keys(parts, people, "item_id", ["c_acctbal", "c_custkey"])
    return keyed


@query
def row_difference(spark, folder):
    return capture.row_difference(star.orders(spark, folder), star.changed_orders(spark, folder))


@query
def table_counts(spark, folder):
    return synth.table_counts(star.defect_tables(spark, folder))


@query
def full_refresh(spark, folder):
    """Counts of the four tables after a full refresh of the lake from them."""
    lake = Lake(spark, scratch_path(spark, "refresh"))
    lake.refresh(star.clean_tables(spark, folder))
    return synth.table_counts({table: lake.read(f"raw_{table}") for table in TABLES})


@query
def ledger_append(spark, folder):
    """The ledger after recording the events in two goes: incidents per failure, and the highest id, which equals their number."""
    lake, recorded = Lake(spark, scratch_path(spark, "ledger")), _ledger(spark, folder)
    for part in (0, 1):
        rows = recorded.filter(F.pmod("incident_id", F.lit(2)) == part).select("failure_key", "detail")
        lake.record(rows, utc(AS_OF))
    ids = F.max("incident_id").over(Window.partitionBy())  # the groups below are one row per failure
    per_key = lake.ledger().groupBy("failure_key").agg(F.count("*").alias("incidents"), F.countDistinct("incident_id").alias("ids"), F.max("incident_id").alias("incident_id"))
    return per_key.select("failure_key", "incidents", "ids", ids.alias("highest_id"))


@query
def incident_counts(spark, folder):
    return quantiles.incident_counts(_ledger(spark, folder))


@query
def incident_occurrence(spark, folder):
    return quantiles.occurrences(_ledger(spark, folder))


@query
def incidents_of_key(spark, folder):
    return _ledger(spark, folder).filter(F.col("failure_key") == "recurring_incident")


def _ledger(spark, folder):
    return star.incidents(spark, folder, list(defects.REGISTRY))


# Selection, synthesis and defects


def _context() -> defects.Context:
    return defects.Context(AS_OF, SEED)


@query
def sample_customers(spark, folder):
    return selection.indexed_sample(star.customers(spark, folder), 200, "customer_id", SEED)


@query
def latest_order(spark, folder):
    return selection.latest_rows(star.orders(spark, folder), "order_id")


@query
def recent_n_update(spark, folder):
    return defects.zero_latest(star.orders(spark, folder))[0]


@query
def bulk_price_cut(spark, folder):
    return defects.price_cut(star.products(spark, folder), SEED)[0]


@query
def volume_spike_rows(spark, folder):
    return defects.burst_rows(star.clean_tables(spark, folder), _context())


def _register_defects() -> None:
    def orders_after(key: str) -> Query:
        def run(spark, folder):
            tables = star.clean_tables(spark, folder)
            return defects.inject(tables, key, _context()).tables["orders"]

        return run

    for key in defects.REGISTRY:
        if key not in ("orphan_payment", "ambiguous_anomaly"):
            QUERIES[f"defect_{key}"] = orders_after(key)


_register_defects()


@query
def defect_orphan_payment(spark, folder):
    return defects.inject(star.clean_tables(spark, folder), "orphan_payment", _context()).tables["payments"]


@query
def defect_ambiguous_anomaly(spark, folder):
    """Orders with the price their product has after both changes."""
    tables = defects.inject(star.clean_tables(spark, folder), "ambiguous_anomaly", _context()).tables
    prices = tables["products"].select("product_id", F.col("unit_price").alias("list_price"))
    return tables["orders"].join(prices, "product_id").select("order_id", "status", "product_id", "list_price")


@query
def traffic_orders(spark, folder):
    return synth.make_traffic(star.clean_tables(spark, folder), TRAFFIC, SEED, AS_OF)


def _made(spark, folder) -> dict[str, DataFrame]:
    """A clean shop with the ids of the star-schema tables."""
    ids = {
        table: star.read_star(spark, folder, source).select(F.col(column).alias(PRIMARY_KEYS[table]))
        for table, source, column in (
            ("customers", "customer", "c_custkey"),
            ("products", "part", "p_partkey"),
            ("orders", "orders", "o_orderkey"),
        )
    }
    customers = synth.make_customers(ids["customers"], SEED, AS_OF)
    products = synth.make_products(ids["products"], SEED, AS_OF)
    orders = synth.make_orders(
        ids["orders"],
        customers.withColumn("slot", F.col("customer_id")),
        products.withColumn("slot", F.col("product_id")),
        SEED,
        AS_OF,
    )
    return {
        "customers": customers,
        "products": products,
        "orders": orders,
        "payments": synth.make_payments(orders, SEED, AS_OF),
    }


@query
def synth_customers(spark, folder):
    return _made(spark, folder)["customers"]


@query
def synth_products(spark, folder):
    return _made(spark, folder)["products"]


@query
def synth_orders(spark, folder):
    return _made(spark, folder)["orders"]


@query
def synth_payments(spark, folder):
    return _made(spark, folder)["payments"]


# Streaming


@query
def stream_daily_revenue(spark, folder):
    """The orders synced as a stream of change files, with daily revenue rebuilt per batch."""
    lake = Lake(spark, scratch_path(spark, "sync"))
    files = sync.table_stream(spark, folder, "orders", star.STAR_SCHEMAS["orders"])
    stream = star.streamed_orders(files, spark, folder)
    sync.sync_orders(stream, lake, scratch_path(spark, "sync-checkpoint"), grain="month").awaitTermination()
    return lake.read(sync.DAILY)


def _synced(spark, folder) -> Lake:
    """The four tables synced from two deliveries of change files, the marts refreshed after each."""
    lake, files, at = Lake(spark, scratch_path(spark, "synced")), scratch_path(spark, "change-files"), scratch_path(spark, "synced-at")
    for seq, delivery in enumerate(star.change_files(spark, folder)):
        for table, (upserts, deletes) in delivery.items():
            for rows, op in ((upserts, keyed.UPSERT), (deletes, keyed.DELETE)):
                if rows is not None:
                    sent = rows.select(*TABLES[table].fieldNames(), F.lit(op).alias("op"), F.lit(seq).cast("bigint").alias("seq"))
                    sent.write.mode("append").parquet(f"{files}/{table}")
        sync.sync_changes(spark, files, lake, at, "month")
        refresh.refresh(lake, AS_OF, star.star_domains(), strict=False, grain="month")
    return lake


@query
def synced_orders(spark, folder):
    """The orders after both deliveries: moved, changed, deleted and new ones."""
    return keyed.current(_synced(spark, folder), "orders")


@query
def synced_fct_orders(spark, folder):
    return refresh.read_mart(_synced(spark, folder), refresh.FACTS)


@query
def synced_revenue_cuts(spark, folder):
    """Question 1, all cuts, from the refreshed fact table."""
    return questions.revenue_cuts(refresh.read_mart(_synced(spark, folder), refresh.FACTS))


@query
def synced_daily_revenue(spark, folder):
    return refresh.read_mart(_synced(spark, folder), refresh.DAILY)


@query
def stream_freshness(spark, folder):
    """How fresh the synced orders are after every batch: the newest order up to the moment asked for, and its age."""
    lake = Lake(spark, scratch_path(spark, "sync"))
    files = sync.table_stream(spark, folder, "orders", star.STAR_SCHEMAS["orders"])
    stream = star.streamed_orders(files, spark, folder)
    sync.sync_orders(stream, lake, scratch_path(spark, "sync-checkpoint"), AS_OF, grain="month").awaitTermination()
    return lake.read_log(sync.FRESHNESS)


@query
def stream_dedup(spark, folder, files_per_batch=None):
    """Every order delivered twice, kept once."""
    lake = Lake(spark, scratch_path(spark, "dedup"))
    files = sync.table_stream(spark, folder, "orders", star.STAR_SCHEMAS["orders"], files_per_batch)
    twice = files.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2)))).drop("delivery")

    def land(batch, batch_id):
        sync.land_once(lake, batch, batch_id, "orders_once", "o_orderkey", "o_orderdate")

    sync.run_batches(twice, land, scratch_path(spark, "dedup-checkpoint"))
    return lake.read_log("orders_once").drop("span", "batch_id")


@query
def stream_order_rate(spark, folder, files_per_batch=None):
    """Events per hour, late ones and the last hour included."""
    lake = Lake(spark, scratch_path(spark, "rate"))
    events = sync.table_stream(spark, folder, "events", star.STAR_SCHEMAS["events"], files_per_batch)

    def land(batch, batch_id):
        sync.land_rate(lake, batch, batch_id, "event_rate", "ts", "1 hour")

    sync.run_batches(events, land, scratch_path(spark, "rate-checkpoint"))
    return sync.rate_per_window(lake, "event_rate")
