"""Snapshots with a tree of checksums: a difference reads a share of the leaves and rewrites the parts that differ."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import functions as F

from shoplane.contracts import ORDERS
from shoplane.operators import capture
from shoplane.session import scratch_path
from shoplane.sources import star
from shoplane.sources.snapshots import Snapshot, leaves, rolled_up
from shoplane.sources.tables import Lake

MIDDLE = "/root/testdata/sf0.01"


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def kept(spark, rows, key="id", columns=("id", "v", "w"), part=100, leaf=10):
    snapshot = Snapshot(Lake(spark, scratch_path(spark, "snapshot")), "t", key, columns, part, leaf)
    snapshot.bring_to(rows)
    return snapshot


def files(snapshot, log):
    root = Path(snapshot.lake.log_path(log).removeprefix("file://"))
    return {(path.parent.name, path.name, os.stat(path).st_mtime_ns) for path in root.rglob("*.parquet")}


def table(spark, n=1000):
    return spark.range(n).select("id", (F.col("id") * 7 % 13).alias("v"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("w"), "id")).alias("w"))


def test_the_query_data_read_a_share_of_the_leaves(spark):
    old, new = star.orders(spark, MIDDLE), star.changed_orders(spark, MIDDLE)
    snapshot = kept(spark, old, "order_id", ORDERS.fieldNames(), part=1024, leaf=4)
    parts, found = snapshot.differing(new)
    changes = capture.diff(old, new, "order_id")
    touched = changes.select(F.floor(F.col("order_id") / 4)).distinct().count()
    assert found.count() == touched < 0.25 * snapshot.tree().count()
    assert rows_of(snapshot.diff(new)) == rows_of(changes)


def test_only_differing_parts_are_rewritten(spark):
    snapshot = kept(spark, table(spark))
    before = files(snapshot, snapshot.rows_log), files(snapshot, snapshot.tree_log)
    new = table(spark).withColumn("v", F.when(F.col("id").isin(205, 207, 910), F.lit(99)).otherwise(F.col("v"))).filter("id <> 206")
    parts, found = snapshot.differing(new)
    assert parts == [2, 9] and sorted(row["leaf"] for row in found.collect()) == [20, 91]
    assert {row["change"] for row in snapshot.diff(new).collect()} == {"update", "delete"}
    assert snapshot.bring_to(new).count() == 4
    for old, log in zip(before, (snapshot.rows_log, snapshot.tree_log), strict=True):
        assert {name for name, *_ in old ^ files(snapshot, log)} == {"part=2", "part=9"}
    assert rows_of(snapshot.rows()) == rows_of(new)
    assert snapshot.differing(new) == ([], None) and snapshot.diff(new).count() == 0


def test_parts_that_come_and_go(spark):
    snapshot = kept(spark, table(spark, 250))
    new = table(spark, 420).filter("id >= 100")
    snapshot.bring_to(new)
    assert rows_of(snapshot.rows()) == rows_of(new)
    assert {row["part"] for row in snapshot.tree().select("part").distinct().collect()} == {1, 2, 3, 4}
    snapshot.bring_to(new.limit(0))
    assert (snapshot.rows() is None or snapshot.rows().count() == 0) and snapshot.diff(table(spark, 3)).count() == 3
    snapshot.bring_to(table(spark, 3))
    assert rows_of(snapshot.rows()) == rows_of(table(spark, 3))


def test_nulls_moving_between_columns_differ(spark):
    kind = "id long, v string, w string"
    snapshot = kept(spark, spark.createDataFrame([(1, "x", None), (-5, None, None)], kind))
    new = spark.createDataFrame([(1, None, "x"), (-5, None, None)], kind)
    assert [(row["id"], row["change"]) for row in snapshot.diff(new).collect()] == [(1, "update")]


def test_a_run_that_died_before_the_checksums_is_repeated(spark, monkeypatch):
    snapshot = kept(spark, table(spark, 300))
    new = table(spark, 300).withColumn("v", F.col("v") + (F.col("id") == 150).cast("int"))
    written = snapshot.lake.overwrite_days
    monkeypatch.setattr(snapshot.lake, "overwrite_days", lambda rows, log, *by: None if log == snapshot.tree_log else written(rows, log, *by))
    snapshot.bring_to(new)
    monkeypatch.undo()
    snapshot.bring_to(new)
    assert rows_of(snapshot.rows()) == rows_of(new) and snapshot.differing(new) == ([], None)


def test_levels_add_up(spark):
    tree = leaves(table(spark), "id", 100, 10)
    assert tree.count() == 100 and rolled_up(tree, "part").count() == 10
    assert rolled_up(rolled_up(tree, "part")).first() == rolled_up(tree).first()


def test_checksums_are_exact_sums_without_a_decimal_per_row(spark):
    rows = spark.range(300).select("id", F.col("id").cast("string").alias("name"))
    tree = leaves(rows, "id", 300, 100)
    plain = [F.xxhash64(F.lit(salt), F.col("id"), F.col("name"), F.col("id").isNull(), F.col("name").isNull()) for salt in (0, 1)]
    hashes = rows.select("id", *plain).collect()
    expected = {leaf: tuple(sum(row[at] for row in hashes if row[0] // 100 == leaf) for at in (1, 2)) for leaf in range(3)}
    assert {row.leaf: (int(row.low), int(row.high)) for row in tree.collect()} == expected
    assert "cast(xxhash64" not in tree._jdf.queryExecution().optimizedPlan().toString()
