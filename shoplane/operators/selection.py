"""Sampling, latest rows and updates of a chosen subset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplane.functions.scalars import draw


def sample_rows(df: DataFrame, n: int, key: str, seed: int, tag: str = "sample") -> DataFrame:
    """``n`` rows in a random order that only the seed decides."""
    return df.orderBy(draw(seed, tag, F.col(key)), key).limit(n)


def indexed_sample(df: DataFrame, n: int, key: str, seed: int, tag: str = "sample") -> DataFrame:
    """``sample_rows`` with ``slot`` 0, 1, 2, ... in sample order; the window sees at most ``n`` rows."""
    order = Window.orderBy(draw(seed, tag, F.col(key)), key)
    return sample_rows(df, n, key, seed, tag).withColumn("slot", F.row_number().over(order) - 1)


def latest_rows(df: DataFrame, key: str, n: int = 1) -> DataFrame:
    """The ``n`` rows with the highest keys."""
    return df.orderBy(F.desc(key)).limit(n)


def update_where(df: DataFrame, chosen: DataFrame, key: str, changes: dict[str, Column]) -> DataFrame:
    """Set ``changes`` on the rows of ``df`` whose unique key is in ``chosen``; other rows stay as they are."""
    marks = chosen.select(F.col(key).alias("_chosen"))
    marked = df.join(marks, F.col(key) == F.col("_chosen"), "left")
    is_chosen = F.col("_chosen").isNotNull()
    columns = [
        F.when(is_chosen, changes[name].cast(df.schema[name].dataType)).otherwise(F.col(name)).alias(name)
        if name in changes
        else F.col(name)
        for name in df.columns
    ]
    return marked.select(*columns)
