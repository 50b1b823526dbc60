"""Operators against brute force on small tables, hot keys and NULLs included."""

from __future__ import annotations

from collections import Counter
from datetime import UTC, datetime
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from shoplane.contracts import ORDERS
from shoplane.functions import scalars
from shoplane.operators import capture, quantiles, selection, staging
from shoplane.operators.lookup import balanced_lookup, heavy_keys, totals_without_match, without_match
from shoplane.operators.numbering import append_with_keys, number_rows


def rows_of(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """300 rows: a third on key 7, a third NULL, the rest spread; keys 90 and up are unknown to the dimension."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 2, F.col("id") % 100)
    fact = spark.range(300).select("id", key.cast("bigint").alias("k"), (F.col("id") * 2).alias("v"))
    dim = spark.range(90).select(F.col("id").alias("dk"), F.concat(F.lit("n"), "id").alias("name"))
    return fact, dim


@pytest.mark.parametrize("salted", [False, True])
def test_balanced_lookup_is_a_left_join(skewed, salted):
    fact, dim = skewed
    plain = fact.join(dim, F.col("k") == F.col("dk"), "left")
    balanced = balanced_lookup(fact, dim, "k", "dk", "id", heavy_keys(fact, "k", 50) if salted else None, salts=5)
    assert balanced.columns == plain.columns
    assert rows_of(balanced) == rows_of(plain)


def test_heavy_keys_go_by_their_size(skewed):
    fact, _ = skewed
    assert [row.heavy_key for row in heavy_keys(fact, "k", 50).collect()] == [7]
    assert heavy_keys(fact, "k", 1000).count() == 0


def test_salted_rows_are_spread(spark, skewed):
    """No partition of the salted join holds the whole hot key."""
    fact, dim = skewed
    copies = fact.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(39))))
    wide = copies.select((F.col("id") * 40 + F.col("copy")).alias("id"), "k", "v")
    joined = balanced_lookup(wide, dim, "k", "dk", "id", heavy_keys(wide, "k", 1000), salts=64)
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    plain["spark.sql.shuffle.partitions"] = "16"
    usual = {key: spark.conf.get(key) for key in plain}
    try:
        for key, value in plain.items():
            spark.conf.set(key, value)
        sizes = [row["count"] for row in joined.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for key, value in usual.items():
            spark.conf.set(key, value)
    assert sum(sizes) >= 4000 and max(sizes) < 0.25 * sum(sizes)


def test_without_match_keeps_null_and_unknown_keys(skewed):
    fact, dim = skewed
    missing = without_match(fact, dim, "k", "dk", "id")
    expected = {row.id for row in fact.collect() if row.k is None or row.k >= 90}
    assert {row.id for row in missing.collect()} == expected
    totals = totals_without_match(fact, dim, "k", "dk", "v", "id").first()
    assert (totals.rows, totals.first_id) == (len(expected), min(expected))
    assert totals.amount == sum(2 * i for i in expected)


def test_number_rows_within_groups(spark):
    group = F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 4))
    df = spark.range(500).select("id", group.alias("g"), (F.col("id") * 37 % 11).alias("v")).repartition(7)
    numbered = number_rows(df, "n", ["v", "id"], within="g").collect()
    by_group = {}
    for row in sorted(numbered, key=lambda row: (row.g, row.v, row.id)):
        by_group.setdefault(row.g, []).append(row.n)
    assert all(numbers == list(range(1, len(numbers) + 1)) for numbers in by_group.values())


def test_number_rows_splits_equal_rows(spark):
    numbered = number_rows(spark.range(1000).select(F.lit(1).alias("same")), "n", ["same"])
    assert sorted(row.n for row in numbered.collect()) == list(range(1, 1001))


def test_append_keeps_order_and_keys(spark):
    base = spark.createDataFrame([(1, "a"), (5, "b")], "id bigint, s string")
    rows = spark.createDataFrame([("z",), ("x",), ("y",)], "s string").repartition(3)
    table, keyed = append_with_keys(base, rows, "id", ["s"])
    assert rows_of(keyed) == Counter([(6, "x"), (7, "y"), (8, "z")])
    assert table.count() == 5
    first, _ = append_with_keys(base.limit(0), rows, "id", ["s"])
    assert sorted(row.id for row in first.collect()) == [1, 2, 3]


def test_exact_quantiles(spark):
    values = {"a": [1.0, 2.0, 4.0, 8.0], "b": [5.0], "hot": [float(i * i % 97) for i in range(300)]}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g string, v double")
    found = quantiles.exact_quantiles(df, "g", "v", [0.0, 0.5, 0.95, 1.0]).collect()
    assert len(found) == 12
    for row in found:
        assert row["quantile"] == pytest.approx(np.quantile(values[row.g], row.probability))
        assert row["rows"] == len(values[row.g])


def order(order_id, customer, product, at, total="10.00", quantity=1, price="10.00", status="placed"):
    return (order_id, customer, product, quantity, Decimal(price), Decimal(total), status, at)


NOON, LATER = datetime(2026, 1, 1, 12), datetime(2026, 1, 1, 13)


def test_dedup_keeps_the_first_and_is_stable(spark):
    rows = [order(3, 1, 1, NOON), order(1, 1, 1, NOON), order(2, 1, 1, LATER), order(4, None, 1, NOON)]
    rows += [order(5, None, 1, NOON)]
    df = spark.createDataFrame(rows, [field.name for field in ORDERS.fields])
    kept = staging.deduplicate(df)
    assert {row.order_id for row in kept.collect()} == {1, 2, 4}
    assert rows_of(staging.deduplicate(kept)) == rows_of(kept)
    assert {row.order_id for row in staging.removed_by_dedup(df).collect()} == {3, 5}


def test_dedup_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame([order(1, 1, 1, NOON)], [field.name for field in ORDERS.fields])
    plan = staging.deduplicate(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_stage_sets_bad_values_aside(spark):
    text = [("1", "2", "3", "two", "4.50", "9.00", "placed", "2026-01-01 00:00:00")]
    text += [("2", "2", "3", "2", "4.50", "9.00", "placed", "2026-01-01 00:00:00")]
    df = spark.createDataFrame(text, [field.name for field in ORDERS.fields])
    good, aside = staging.quarantine(staging.stage(df, ORDERS), staging.row_rules("orders", {}))
    assert [row.order_id for row in good.collect()] == [2]
    assert aside.first().reasons == ["quantity uncastable", "quantity is null"]
    assert good.schema["unit_price"].dataType.simpleString() == "decimal(10,2)"


def test_customer_column_never_defaults(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        staging.customer_column(df)
    assert staging.rename_back(df.withColumnRenamed("id", "user_id")).columns == ["customer_id"]
    assert staging.rename_back(df.withColumnRenamed("id", "customer_id")).columns == ["customer_id"]


SNAPSHOT = st.dictionaries(
    st.integers(0, 12), st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from("ab")), max_size=8
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=SNAPSHOT, new=SNAPSHOT, by_fingerprint=st.booleans())
def test_diff_then_apply_gives_the_new_snapshot(spark, old, new, by_fingerprint):
    schema = "id bigint, n int, s string"
    before = spark.createDataFrame([(key, *value) for key, value in old.items()], schema)
    after = spark.createDataFrame([(key, *value) for key, value in new.items()], schema)
    changes = capture.diff(before, after, "id", by_fingerprint)
    kinds = {row.id: row.change for row in changes.collect()}
    expected = {key: "insert" for key in new.keys() - old.keys()} | {key: "delete" for key in old.keys() - new.keys()}
    expected |= {key: "update" for key in old.keys() & new.keys() if old[key] != new[key]}
    assert kinds == expected
    assert rows_of(capture.apply_changes(before, changes, "id")) == rows_of(after)


@pytest.mark.parametrize("by_fingerprint", [False, True])
def test_diff_sees_a_null_that_moved(spark, by_fingerprint):
    schema = "id bigint, a int, b int"
    before = spark.createDataFrame([(1, None, 5), (2, 3, None)], schema)
    after = spark.createDataFrame([(1, 5, None), (2, 3, None)], schema)
    changes = capture.diff(before, after, "id", by_fingerprint).collect()
    assert [(row.id, row.change) for row in changes] == [(1, "update")]


def test_new_rows_look_back(spark):
    landed = spark.createDataFrame([(1,), (2,), (4,), (9,)], "id bigint")
    source = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 8, 9, 10, 12)], "id bigint")
    mark = capture.high_mark(landed, "id")
    assert mark == 9
    assert sorted(row.id for row in capture.new_rows(source, landed, "id", mark).collect()) == [10, 12]
    assert sorted(row.id for row in capture.new_rows(source, landed, "id", mark, 2).collect()) == [8, 10, 12]
    assert capture.high_mark(landed.limit(0), "id") == 0


def test_row_difference_counts_copies(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id bigint, s string")
    right = spark.createDataFrame([(1, "a"), (3, "c")], "id bigint, s string")
    found = rows_of(capture.row_difference(left, right))
    assert found == Counter([(1, "a", "left", 1), (2, None, "left", 1), (3, "c", "right", 1)])


def test_update_where_touches_chosen_rows_only(spark):
    df = spark.createDataFrame([Row(id=i, s="x", n=i) for i in range(6)])
    chosen = selection.latest_rows(df, "id", 2)
    updated = selection.update_where(df, chosen, "id", {"s": F.lit("y")})
    assert {row.id: row.s for row in updated.collect()} == {0: "x", 1: "x", 2: "x", 3: "x", 4: "y", 5: "y"}
    assert updated.schema == df.schema or updated.columns == df.columns


def test_money_rounds_half_up(spark):
    values = [("2.675", "2.68"), ("-2.675", "-2.68"), ("0.005", "0.01"), ("1.004", "1.00")]
    df = spark.createDataFrame(values, "v string, e string")
    for row in df.select(scalars.money(F.col("v").cast("decimal(12,4)")).alias("m"), "e").collect():
        assert row.m == Decimal(row.e)


def test_text_helpers(spark):
    df = spark.createDataFrame([("Mary O'Neil Smith",)], "s string")
    assert df.select(scalars.email_handle(F.col("s"))).first()[0] == "mary.oneil.smith"
    words = spark.createDataFrame([("Books",), ("Beauty",)], "s string").select(scalars.singular(F.col("s")))
    assert [row[0] for row in words.collect()] == ["Book", "Beauty"]
    codes = spark.createDataFrame([(7,), (100000001,), (2600000003,)], "i bigint")
    found = [row[0] for row in codes.select(scalars.stock_code(F.col("i"))).collect()]
    assert found == ["AAA-00000007", "AAB-00000001", "ABA-00000003"]
    noisy = spark.createDataFrame([("placed",), ("�",), ("0x00",), ("<script>",)], "s string")
    assert [row[0] for row in noisy.select(scalars.noise_in_text(F.col("s"))).collect()] == [False, True, True, True]


def test_draws_are_even_and_independent(spark):
    drawn = spark.range(20000).select(
        scalars.draw_below(1, "a", F.col("id"), 10).alias("a"), scalars.draw_below(1, "b", F.col("id"), 10).alias("b")
    )
    cells = {(row.a, row.b): row["count"] for row in drawn.groupBy("a", "b").count().collect()}
    assert len(cells) == 100
    chi = sum((n - 200) ** 2 / 200 for n in cells.values())
    assert chi < 160  # 99 degrees of freedom
    large = spark.range(2**40, 2**40 + 1000).select(scalars.draw(1, "a", F.col("id")).alias("d"))
    assert large.distinct().count() == 1000


def test_later_copies_are_what_deduplication_takes_out(spark):
    moment = datetime(2026, 1, 5, tzinfo=UTC)
    rows = [(1, 1, 1, moment), (2, 1, 1, moment), (3, None, 1, moment), (4, None, 1, moment), (5, None, 1, None), (6, 1, None, moment), (7, 1, 1, moment)]
    orders = spark.createDataFrame(rows, "order_id long, customer_id long, product_id long, ordered_at timestamp")
    taken = sorted(row[0] for row in staging.later_copies(orders).collect())
    assert taken == [2, 4, 7] == sorted({row[0] for row in rows} - {row.order_id for row in staging.deduplicate(orders).collect()})
