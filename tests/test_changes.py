"""Keys that move, deletes, changes out of order, and marts refreshed span by span against whole builds."""

from __future__ import annotations

import os
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shoplane.contracts import ORDERS, TABLES
from shoplane.operators import gates
from shoplane.plans import build, refresh
from shoplane.session import scratch_path
from shoplane.sources import keyed
from shoplane.sources.tables import Lake
from shoplane.streaming import sync

from conftest import AS_OF

JAN, MARCH = datetime(2026, 1, 5, 9, tzinfo=UTC), datetime(2026, 3, 5, 9, tzinfo=UTC)


def order(key, when, customer=1, product=1, quantity=2, status="placed"):
    return (key, customer, product, quantity, Decimal("10.00"), Decimal("10.00") * quantity, status, when)


def customer(key, segment="prime", country="Peru", name="Ada"):
    return (key, name, f"c{key}@example.com", country, "Lima", segment, JAN)


def product(key, category="Books", cost="4.00"):
    return (key, f"SKU-{key}", f"thing {key}", category, Decimal("10.00"), Decimal(cost), JAN)


def payment(key, order_id, amount="20.00", when=MARCH + timedelta(days=30)):
    return (key, order_id, "wallet", Decimal(amount), "captured", when)


def changes(spark, table, rows, seq, op="upsert"):
    """Rows of a change file; for deletes the keys are enough."""
    width = len(TABLES[table].fields)
    rows = [(row, *[None] * (width - 1)) if op == "delete" else row for row in rows]
    return spark.createDataFrame([(*row, op, seq) for row in rows], sync.change_schema(table))


def new_lake(spark):
    return Lake(spark, scratch_path(spark, "changes"))


def rows_of(frame, *drop):
    frame = frame.drop(*drop)
    return sorted(map(str, frame.select(*sorted(frame.columns)).collect()))


def files(lake, log):
    """Files per partition of a log."""
    root = Path(lake.log_path(log).removeprefix("file://"))
    found: dict[str, set] = {}
    for path in root.rglob("*.parquet"):
        found.setdefault(path.parent.name, set()).add((path.name, os.stat(path).st_mtime_ns))
    return found


@pytest.mark.parametrize("cut", [1, 2, 3])
def test_an_order_that_moves_is_one_row_on_one_day(spark, cut):
    sent = [order(1, JAN), order(2, JAN, 2), order(1, MARCH), order(3, MARCH, 2), order(1, MARCH, status="shipped")]
    lake = new_lake(spark)
    for place in range(0, len(sent), cut):
        batch = {row[0]: row for row in sent[place : place + cut]}  # a batch holds an order once
        sync.land_batch(lake, spark.createDataFrame(list(batch.values()), ORDERS), place)
    staged = {row["order_id"]: (row["span"], row["status"]) for row in lake.read_log(sync.STAGED).collect()}
    assert staged == {1: (date(2026, 3, 5), "shipped"), 2: (date(2026, 1, 5), "placed"), 3: (date(2026, 3, 5), "placed")}
    assert {str(row["day"]): row["orders"] for row in lake.read(sync.DAILY).collect()} == {"2026-01-05": 1, "2026-03-05": 2}


def test_a_day_that_loses_its_only_order_goes(spark):
    lake = new_lake(spark)
    for place, when in enumerate((JAN, MARCH)):
        sync.land_batch(lake, spark.createDataFrame([order(1, when)], ORDERS), place)
    assert [(str(row["day"]), row["orders"]) for row in lake.read(sync.DAILY).collect()] == [("2026-03-05", 1)]
    assert list(files(lake, sync.STAGED)) == ["span=2026-03-05"]


def test_land_once_keeps_the_first_of_a_key_that_moves(spark):
    lake = new_lake(spark)
    for place, when in enumerate((JAN, MARCH, JAN)):
        batch = spark.createDataFrame([order(1, when), order(10 + place, when)], ORDERS)
        for _ in range(2):  # a batch that runs again changes nothing
            sync.land_once(lake, batch, place, "once", "order_id", "ordered_at")
    found = {row["order_id"]: str(row["span"]) for row in lake.read_log("once").collect()}
    assert lake.read_log("once").count() == 4
    assert found == {1: "2026-01-01", 10: "2026-01-01", 11: "2026-03-01", 12: "2026-01-01"}


def test_deletes_and_changes_out_of_order(spark):
    lake = new_lake(spark)
    keyed.land(lake, "orders", changes(spark, "orders", [order(1, JAN, status="shipped"), order(2, JAN)], 5), 0)
    keyed.land(lake, "orders", changes(spark, "orders", [order(1, MARCH)], 4), 1)  # older than what is known
    assert {row["order_id"]: row["status"] for row in keyed.current(lake, "orders").collect()} == {1: "shipped", 2: "placed"}
    keyed.land(lake, "orders", changes(spark, "orders", [1], 6, "delete"), 2)
    keyed.land(lake, "orders", changes(spark, "orders", [order(1, JAN)], 5), 3)  # sent before the delete
    assert [row["order_id"] for row in keyed.current(lake, "orders").collect()] == [2]
    keyed.land(lake, "orders", changes(spark, "orders", [order(1, JAN)], 7), 4)
    assert keyed.current(lake, "orders").count() == 2
    keyed.land(lake, "customers", changes(spark, "customers", [customer(1), customer(2)], 1), 0)
    keyed.land(lake, "customers", changes(spark, "customers", [1], 2, "delete"), 1)
    assert [row["customer_id"] for row in keyed.current(lake, "customers").collect()] == [2]
    unkeyed = changes(spark, "orders", [order(None, JAN)], 9)
    keyed.land(lake, "orders", unkeyed, 5)
    assert lake.read_log("unkeyed/orders").count() == 1 and keyed.current(lake, "orders").count() == 2


def test_payments_lie_with_their_order_whichever_comes_first(spark):
    lake = new_lake(spark)
    keyed.land(lake, "payments", changes(spark, "payments", [payment(1, 1), payment(2, 99)], 1), 0)
    assert keyed.current(lake, "payments", [keyed.NO_SPAN]).count() == 2
    keyed.land(lake, "orders", changes(spark, "orders", [order(1, JAN)], 1), 0)
    assert [row["payment_id"] for row in keyed.current(lake, "payments", [JAN.date()]).collect()] == [1]
    for _ in range(2):
        keyed.land(lake, "orders", changes(spark, "orders", [order(1, MARCH)], 2), 1)
    assert [row["payment_id"] for row in keyed.current(lake, "payments", [MARCH.date()]).collect()] == [1]
    keyed.land(lake, "payments", changes(spark, "payments", [payment(1, 1, "5.00")], 2), 1)
    assert [str(row["amount"]) for row in keyed.current(lake, "payments", [MARCH.date()]).collect()] == ["5.00"]
    keyed.land(lake, "orders", changes(spark, "orders", [1], 3, "delete"), 2)
    assert keyed.current(lake, "payments", [keyed.NO_SPAN]).count() == 2 and keyed.current(lake, "payments").count() == 2


def start(spark):
    """Ten days, three customers and two products, landed and refreshed."""
    lake = new_lake(spark)
    days = [JAN + timedelta(days=place) for place in range(10)]
    keyed.land(lake, "customers", changes(spark, "customers", [customer(1), customer(2), customer(3)], 1), 0)
    keyed.land(lake, "products", changes(spark, "products", [product(1), product(2, "Toys")], 1), 0)
    # customer 3 buys on the third and the eighth day only, product 2 on the fifth
    rows = [order(place, days[place // 3], 1 + place % 2, 1) for place in range(30)]
    rows += [order(100, days[2], 3), order(101, days[7], 3), order(102, days[4], 1, 2)]
    keyed.land(lake, "orders", changes(spark, "orders", rows, 1), 0)
    keyed.land(lake, "payments", changes(spark, "payments", [payment(row[0], row[0]) for row in rows[::2]], 1), 0)
    found = refresh.refresh(lake, AS_OF)
    assert len(found.spans) == 10
    return lake, days


def equals_a_whole_build(spark, lake):
    whole = new_lake(spark)
    source = {table: keyed.current(lake, table) for table in TABLES}
    made = build.build(whole, source, AS_OF, strict=False).tables
    assert rows_of(lake.read_log(refresh.FACTS)) == rows_of(made["fct_orders"])
    assert rows_of(refresh.read_mart(lake, refresh.DAILY)) == rows_of(made["fct_daily_revenue"])
    aside = lake.read_log(refresh.ASIDE)
    assert ([] if aside is None else rows_of(aside, "span")) == rows_of(made["quarantine_orders"])


def rewritten(lake, land):
    before = files(lake, refresh.FACTS)
    land()
    found = refresh.refresh(lake, AS_OF, strict=False)
    after = files(lake, refresh.FACTS)
    changed = {name for name in before.keys() | after.keys() if before.get(name) != after.get(name)}
    assert changed <= {f"span={span}" for span in found.spans}
    return sorted(name.removeprefix("span=") for name in changed)


def names(days, *places):
    return [str(days[place].date()) for place in places]


def test_a_batch_rewrites_exactly_the_spans_it_touches(spark):
    lake, days = start(spark)

    def two_days_and_a_customer():
        moved = [order(0, days[5], 1, 1), order(29, days[9], 2, 1, status="cancelled")]
        keyed.land(lake, "orders", changes(spark, "orders", moved, 2), 1)
        keyed.land(lake, "customers", changes(spark, "customers", [customer(3, "business")], 2), 1)

    assert rewritten(lake, two_days_and_a_customer) == names(days, 0, 2, 5, 7, 9)
    equals_a_whole_build(spark, lake)

    # a name is nothing facts take; a payment touches the day of its order
    def a_name():
        keyed.land(lake, "customers", changes(spark, "customers", [customer(1, name="Eve")], 3), 2)

    assert rewritten(lake, a_name) == []

    def a_payment():
        keyed.land(lake, "payments", changes(spark, "payments", [payment(1000, 101)], 3), 1)

    assert rewritten(lake, a_payment) == names(days, 7)

    def a_cost():
        keyed.land(lake, "products", changes(spark, "products", [product(2, "Toys", "6.00")], 3), 1)

    assert rewritten(lake, a_cost) == names(days, 4)

    # a customer without a segment is set aside, and no longer describes its orders
    def a_broken_customer():
        keyed.land(lake, "customers", changes(spark, "customers", [customer(3, None)], 4), 3)

    assert rewritten(lake, a_broken_customer) == names(days, 2, 7)
    equals_a_whole_build(spark, lake)

    # a day that loses all its orders goes; an order that breaks a rule is set aside
    def deletes():
        keyed.land(lake, "orders", changes(spark, "orders", [9, 10, 11], 5, "delete"), 2)
        keyed.land(lake, "orders", changes(spark, "orders", [order(12, days[4], 1, 1, -1)], 5), 3)
        keyed.land(lake, "products", changes(spark, "products", [2], 5, "delete"), 2)

    assert rewritten(lake, deletes) == names(days, 3, 4)
    assert f"span={days[3].date()}" not in files(lake, refresh.FACTS)
    equals_a_whole_build(spark, lake)
    assert refresh.refresh(lake, AS_OF).spans == []


def test_a_failed_gate_keeps_marts_and_batches_waiting(spark):
    lake, days = start(spark)
    before = files(lake, refresh.FACTS)
    keyed.land(lake, "orders", changes(spark, "orders", [order(0, days[0], 1, 1, -1)], 2), 1)
    with pytest.raises(gates.GateFailure):
        refresh.refresh(lake, AS_OF)
    assert files(lake, refresh.FACTS) == before
    keyed.land(lake, "orders", changes(spark, "orders", [order(0, days[0], 1, 1, 5)], 3), 2)
    assert [str(span) for span in refresh.refresh(lake, AS_OF).spans] == names(days, 0)
    equals_a_whole_build(spark, lake)


def test_a_batch_that_died_halfway_is_repeated(spark, monkeypatch):
    lake, days = start(spark)

    def dies(*_args, **_more):
        raise OSError("lost")

    for place, step in enumerate(("_rewrite", "_follow", "put"), 1):
        batch = changes(spark, "orders", [order(place, days[place + 5], 1, 1), order(20, days[0], 2, 1)], place + 1)
        with monkeypatch.context() as patch, pytest.raises(OSError, match="lost"):
            patch.setattr(keyed.KeyIndex if step == "put" else keyed, step, dies)
            keyed.land(lake, "orders", batch, place)
        for _ in range(2):
            keyed.land(lake, "orders", batch, place)
    assert [str(span) for span in refresh.refresh(lake, AS_OF).spans] == names(days, 0, 1, 6, 7, 8)
    equals_a_whole_build(spark, lake)


def test_change_files_of_four_tables_reach_the_marts(spark):
    folder, lake = scratch_path(spark, "change-files"), new_lake(spark)
    at = scratch_path(spark, "change-at")

    def deliver(table, rows, seq, op="upsert"):
        changes(spark, table, rows, seq, op).coalesce(1).write.mode("append").parquet(f"{folder}/{table}")

    deliver("payments", [payment(1, 1), payment(2, 2)], 1)
    deliver("orders", [order(1, JAN), order(2, JAN, 2), order(3, MARCH)], 1)
    deliver("customers", [customer(1), customer(2)], 1)
    deliver("products", [product(1)], 1)
    sync.sync_changes(spark, folder, lake, at)
    refresh.refresh(lake, AS_OF)
    equals_a_whole_build(spark, lake)
    deliver("orders", [3], 2, "delete")
    deliver("orders", [order(2, MARCH, 2)], 2)
    deliver("payments", [1], 2, "delete")
    deliver("customers", [customer(2, "business", "Chile")], 2)
    sync.sync_changes(spark, folder, lake, at, files_per_batch=1)
    found = refresh.refresh(lake, AS_OF)
    assert [str(span) for span in found.spans] == ["2026-01-05", "2026-03-05"]
    assert {row["order_id"]: row["segment"] for row in lake.read_log(refresh.FACTS).collect()} == {1: "prime", 2: "business"}
    equals_a_whole_build(spark, lake)


def test_files_do_not_add_up_with_batches(spark):
    lake = new_lake(spark)
    counts = []
    for place in range(12):
        when = JAN + timedelta(days=place % 2)
        batch = spark.createDataFrame([order(place, when), order(place % 5, when)], ORDERS).coalesce(1)
        sync.land_once(lake, batch, place, "once", "order_id", "ordered_at", "day")
        for _ in range(2):
            sync.land_rate(lake, batch, place, "rate", "ordered_at", "1 hour", "day")
        counts.append(tuple(sum(map(len, files(lake, log).values())) for log in ("once", "rate", "index/once")))
    assert max(counts[2:]) <= counts[2] and counts[-1] <= (4, 4, 2)
    assert sorted(row["order_id"] for row in lake.read_log("once").collect()) == list(range(12))
    assert {row["rows"] for row in sync.rate_per_window(lake, "rate").collect()} == {12}


def test_a_log_is_read_by_batch_and_forgotten_on_request(spark):
    lake = new_lake(spark)
    for place in range(4):
        keyed.land(lake, "orders", changes(spark, "orders", [order(place, JAN)], place + 1), place)
    one = keyed.logged(lake, keyed.change_log("orders"), 2)
    assert [row["order_id"] for row in one.collect()] == [2] and all("batch_id=2" in name for name in one.inputFiles())
    refresh.refresh(lake, AS_OF, strict=False)
    assert keyed.forget(lake, keyed.change_log("orders"), refresh.marks(lake)["orders"]) == 4
    keyed.land(lake, "orders", changes(spark, "orders", [order(1, MARCH)], 9), 4)
    assert [str(span) for span in refresh.refresh(lake, AS_OF, strict=False).spans] == ["2026-01-05", "2026-03-05"]


def test_replacing_partitions_computes_their_rows_once(spark):
    lake, seen = new_lake(spark), spark.sparkContext.accumulator(0)

    @F.udf("int")
    def placed(number):
        seen.add(1)
        return number % 2

    keyed.replace(lake, "parts", spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "id int, part int"), "part", [0, 1, 2], None)
    read = lake.read_log("parts").filter("part < 2")
    keyed.replace(lake, "parts", spark.range(4).select("id", placed(F.col("id") * 2).alias("part")), "part", [0, 1], read)
    assert seen.value == 4
    assert sorted(map(tuple, lake.read_log("parts").select("id", "part").collect())) == [(0, 0), (1, 0), (2, 0), (3, 0), (3, 2)]


def test_rows_of_keys_sent_once_are_not_grouped(spark):
    batch = changes(spark, "customers", [customer(key) for key in range(5)], 1).unionByName(changes(spark, "customers", [customer(2, name="Bo")], 2))
    latest = keyed.accepted(batch, "customer_id", None, {})
    assert [(row.customer_id, row.full_name) for row in latest.orderBy("customer_id").collect()] == [(0, "Ada"), (1, "Ada"), (2, "Bo"), (3, "Ada"), (4, "Ada")]
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "Union" in plan


def test_a_batch_is_logged_without_a_shuffle(spark):
    lake, batch = new_lake(spark), spark.range(100).repartition(4)
    assert keyed.once(lake, "numbers", 3, lambda: batch).count() == 100
    assert len(lake.read_log("numbers").inputFiles()) == 4
