"""The least row of every group of equal values, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplane.llm.common import stored

#: A group is heavy beyond this share of all rows, so there are fewer than ``1 / HEAVY`` of them, however many rows there are.
HEAVY = 1 / 4096


def with_first(rows: DataFrame, key: str, order: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: the least ``order`` among the rows of the same ``key``; null where the key occurs once or is null.

    ``rows`` should be a stored table, as it is read three times. Groups are reduced inside tasks before the shuffle. Heavy ones,
    fewer than 4,096, are broadcast, so their rows are never dealt by key; the others' rows join by key, no key with more than
    one row in 4,096.
    """
    counted = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias(name), F.count("*").alias("_n")).filter("_n > 1")
    groups = stored(counted, "groups")
    least = rows.count() * HEAVY
    heavy = groups.filter(F.col("_n") > least).drop("_n")
    light = groups.filter(F.col("_n") <= least).drop("_n")
    looked_up = rows.join(F.broadcast(heavy), key, "left")
    in_heavy = looked_up.filter(F.col(name).isNotNull())
    others = looked_up.filter(F.col(name).isNull()).drop(name).join(light, key, "left")
    return in_heavy.unionByName(others.select(*in_heavy.columns))
