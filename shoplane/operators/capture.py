"""Incremental landing: new rows, snapshot differences and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def new_rows(source: DataFrame, landed: DataFrame, key: str, mark: int, lookback: int = 0) -> DataFrame:
    """Rows past the key mark, and rows up to ``lookback`` keys below it that have not landed yet.

    Keys can become visible out of order, hence the look back. The range goes to the source as a pushed filter, and
    only landed keys in the same range are read for the anti join.
    """
    recent = F.col(key) > F.lit(mark - lookback)
    seen = landed.filter(recent).select(key)
    return source.filter(recent).join(seen, key, "left_anti")


def high_mark(landed: DataFrame, key: str) -> int:
    """The highest landed key, 0 when nothing has landed; one number."""
    return landed.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]


def _fingerprint(columns: Sequence[str]) -> Column:
    """128 bits of the whole row; the hash passes over NULLs, so which columns are NULL is hashed as well."""
    values = [*[F.col(name) for name in columns], *[F.col(name).isNull() for name in columns]]
    return F.struct(F.xxhash64(*values), F.xxhash64(F.lit(1), *values))


def diff(old: DataFrame, new: DataFrame, key: str, by_fingerprint: bool = False) -> DataFrame:
    """What changed between two snapshots: ``key, change, before, after``, the latter two as structs.

    Both snapshots are joined on their unique key and compared by value, NULLs equal. ``by_fingerprint`` first joins
    only keys and 128-bit row hashes and fetches whole rows for the changed keys alone: far less to shuffle when rows are
    wide and changes few. Spark broadcasts the changed keys if it measures them to be few.
    """
    columns = new.columns
    if by_fingerprint:
        mark = [F.col(key), _fingerprint(columns).alias("_row")]
        changed = _changes(old.select(*mark), new.select(*mark), key, "_row").select(key)
        old, new = old.join(changed, key, "left_semi"), new.join(changed, key, "left_semi")
    return changes_between(old, new, key)


def changes_between(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The changes from a join of whole rows."""
    whole = [F.col(key), F.struct(*new.columns).alias("_row")]
    return _changes(old.select(*whole), new.select(*whole), key, "_row")


def _changes(old: DataFrame, new: DataFrame, key: str, row: str) -> DataFrame:
    before = old.select(F.col(key).alias("_old_key"), F.col(row).alias("before"))
    after = new.select(F.col(key).alias("_new_key"), F.col(row).alias("after"))
    change = (
        F.when(F.col("_old_key").isNull(), INSERT)
        .when(F.col("_new_key").isNull(), DELETE)
        .when(~F.col("before").eqNullSafe(F.col("after")), UPDATE)
    )
    return (
        before.join(after, F.col("_old_key") == F.col("_new_key"), "full_outer")
        .select(F.coalesce("_old_key", "_new_key").alias(key), change.alias("change"), "before", "after")
        .filter(F.col("change").isNotNull())
    )


def latest_version(rows: DataFrame, key: str, version: str) -> DataFrame:
    """The row of the highest version per key; Spark keeps one row per key in each task before the shuffle."""
    newest = Window.partitionBy(key).orderBy(F.desc(version))
    return rows.withColumn("_nth", F.row_number().over(newest)).filter(F.col("_nth") == 1).drop("_nth")


def apply_changes(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``base`` after ``changes`` (one per key, as ``diff`` gives them).

    Untouched rows only pass an anti join with the changed keys, so a small batch of changes does not sort the table.
    """
    untouched = base.join(changes.select(key), key, "left_anti")
    written = changes.filter(F.col("change") != DELETE).select("after.*")
    return untouched.unionByName(written)


def row_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in one table but not in the other, counted as a multiset; ``side`` tells which holds them.

    Rows are counted per distinct value before the shuffle, so copies never gather in a task; ``copies`` is how many
    more that side has.
    """
    columns = left.columns
    both = left.withColumn("_weight", F.lit(1)).unionByName(right.select(*columns).withColumn("_weight", F.lit(-1)))
    return (
        both.groupBy(*columns)
        .agg(F.sum("_weight").alias("_balance"))
        .filter(F.col("_balance") != 0)
        .withColumn("side", F.when(F.col("_balance") > 0, "left").otherwise("right"))
        .withColumn("copies", F.abs("_balance"))
        .drop("_balance")
    )
