"""Many-to-one joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_ROWS = 1_000_000
SALTS = 64


def heavy_keys(fact: DataFrame, key: str, rows: int = HEAVY_ROWS) -> DataFrame:
    """Non-NULL keys with more than ``rows`` rows, as column ``heavy_key``.

    Counts are combined before the shuffle. The size is absolute, so a key left out never weighs more however large
    ``fact`` is, and there are at most as many keys as ``fact`` has rows over ``rows``. Keep the result as a table.
    """
    return (
        fact.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("heavy_key"))
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > rows)
        .select("heavy_key")
    )


def balanced_lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    spread: str,
    heavy: DataFrame | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Left join ``fact`` to ``dim`` on a key that is unique in ``dim``; ``dim_key`` stays in the result.

    Spark decides from the sizes it knows or measures whether ``dim`` is broadcast, and splits skewed partitions. With
    ``heavy``, a stored result of ``heavy_keys``, the rows of those keys are spread over ``salts`` partitions by
    ``spread`` (a row id) and their few ``dim`` rows copied once per salt. NULL keys never match, so they are spread
    too. The result is that of the plain left join either way, and nothing runs before it is used.
    """
    if fact_key == dim_key:
        raise ValueError("rename one key: both sides keep theirs")
    if heavy is None:
        return fact.join(dim, F.col(fact_key) == F.col(dim_key), "left")
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    spread_out = F.col("heavy_key").isNotNull() | F.col(fact_key).isNull()
    salted_fact = (
        fact.join(heavy, F.col(fact_key) == F.col("heavy_key"), "left")
        .withColumn("_salt", F.when(spread_out, salt).otherwise(F.lit(0)))
        .drop("heavy_key")
    )
    every_salt, no_salt = F.sequence(F.lit(0), F.lit(salts - 1)), F.array(F.lit(0))
    salted_dim = (
        dim.join(heavy, F.col(dim_key) == F.col("heavy_key"), "left")
        .withColumn("_dim_salt", F.explode(F.when(F.col("heavy_key").isNotNull(), every_salt).otherwise(no_salt)))
        .drop("heavy_key")
    )
    matches = (F.col(fact_key) == F.col(dim_key)) & (F.col("_salt") == F.col("_dim_salt"))
    return salted_fact.join(salted_dim, matches, "left").drop("_salt", "_dim_salt")


def without_match(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, spread: str) -> DataFrame:
    """Rows of ``fact`` whose key is NULL or absent from ``dim``."""
    keys = dim.select(F.col(dim_key).alias("_found"))
    return balanced_lookup(fact, keys, fact_key, "_found", spread).filter(F.col("_found").isNull()).drop("_found")


def totals_without_match(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, amount: str, row_id: str
) -> DataFrame:
    """Rows, value and first id of the keys of ``fact`` that are NULL or absent from ``dim``, as one row.

    ``fact`` is reduced to one row per key before the anti join, so no key is heavier than another.
    """
    per_key = fact.groupBy(fact_key).agg(
        F.count("*").alias("rows"), F.sum(amount).alias("amount"), F.min(row_id).alias("first_id")
    )
    keys = dim.select(F.col(dim_key).alias("_found"))
    return per_key.join(keys, F.col(fact_key) == F.col("_found"), "left_anti").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("amount"), F.lit(0)).cast("decimal(28,2)").alias("amount"),
        F.min("first_id").alias("first_id"),
    )
