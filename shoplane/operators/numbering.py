"""Row numbers over whole tables without sorting them, or one group of them, in a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplane.session import settle

POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above and the position below this bit


def number_rows(df: DataFrame, name: str, order: Sequence[str] = (), within: str | None = None) -> DataFrame:
    """Add ``name``: 1, 2, 3, ... in ``order``, restarting for each value of ``within``.

    Without ``order`` rows keep the order they come in. Rows are range partitioned by (``within``, ``order``, arrival),
    which is unique, so even one value holding most of the rows is split over many partitions. The sorted rows are
    written once; offsets then come from a table with one row per partition and value.
    """
    arrived = settle(df).withColumn("_arrival", F.monotonically_increasing_id())
    if order or within:
        keys = [*([within] if within else []), *order, "_arrival"]
        arrived = settle(arrived.repartitionByRange(*keys).sortWithinPartitions(*keys))
    group = F.col(within) if within else F.lit(0)
    placed = (
        arrived.drop("_arrival")
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", POSITION_BITS).cast("int"))
        .withColumn("_group", group)
    )
    sizes = placed.groupBy("_group", "_part").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_group").alias("_g"),
        F.col("_part").alias("_p"),
        "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
    )
    if within is None:
        offsets = F.broadcast(offsets)  # one row per partition
    here = F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p"))
    number = (F.col("_before") + F.col("_place") - F.col("_first") + 1).cast("bigint")
    return (
        placed.join(offsets, here)
        .withColumn(name, number)
        .drop("_place", "_part", "_group", "_g", "_p", "_first", "_before")
    )


def append_with_keys(
    base: DataFrame, rows: DataFrame, key: str, order: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Append ``rows`` under fresh keys after the highest of ``base``; also returns the keyed rows."""
    highest = F.coalesce(base.select(F.max(key)).scalar(), F.lit(0))
    numbered = number_rows(rows, "_number", order)
    keyed = numbered.withColumn(key, highest + F.col("_number")).drop("_number").select(*base.columns)
    return base.unionByName(keyed), keyed


def next_key(table: DataFrame, key: str):
    """The key after the highest one, as a scalar."""
    return F.coalesce(table.select(F.max(key)).scalar(), F.lit(0)) + F.lit(1)
