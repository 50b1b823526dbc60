"""Typed staging, quarantine, natural-key deduplication and repair of the customer column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplane.contracts import NATURAL_KEY, TABLES

CAST_FAILED = "uncastable"


def stage(df: DataFrame, contract: T.StructType) -> DataFrame:
    """One staging row per source row, typed by ``contract``.

    A value that does not fit its type becomes NULL and its column name goes into ``cast_errors``, so nothing is lost
    silently.
    """
    typed, failed = [], []
    for field in contract.fields:
        raw = F.col(field.name)
        value = raw.try_cast(field.dataType)
        typed.append(value.alias(field.name))
        if df.schema[field.name].dataType != field.dataType:
            failed.append(F.when(raw.isNotNull() & value.isNull(), F.lit(field.name)))
    none = F.array().cast("array<string>")
    if not failed:
        return df.select(*typed, none.alias("cast_errors"))
    # the list is built for failing rows only: good ones pass a comparison that is compiled
    errors = F.when(F.coalesce(*failed).isNotNull(), F.array_compact(F.array(*failed))).otherwise(none)
    return df.select(*typed, errors.alias("cast_errors"))


def row_rules(table: str, domains: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """Rules every row of ``table`` must keep, as a name and the condition that breaks it."""
    rules = {f"{field.name} is null": F.col(field.name).isNull() for field in TABLES[table].fields}
    for column, words in domains.items():
        rules[f"{column} not accepted"] = ~F.col(column).isin(*words)
    for column in ("unit_price", "cost", "total_amount", "amount"):
        if column in TABLES[table].fieldNames():
            rules[f"{column} negative"] = F.col(column) < 0
    if table == "orders":
        rules["quantity not positive"] = F.col("quantity") <= 0
        rules["total is not price times quantity"] = F.col("total_amount") != F.col("unit_price") * F.col("quantity")
    return rules


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules a row breaks."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))


def quarantine(staged: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split staged rows into those keeping every rule and those set aside with their ``reasons``.

    A row is judged by one condition that is compiled; the list of reasons is made for the rows set aside only.
    """
    broken = [F.coalesce(condition, F.lit(False)) for condition in rules.values()]
    reasons = broken_rules(rules)
    if "cast_errors" in staged.columns:
        broken.append(F.size("cast_errors") > 0)
        cast = F.transform("cast_errors", lambda column: F.concat(column, F.lit(" " + CAST_FAILED)))
        reasons = F.concat(cast, reasons)
    bad = reduce(or_, broken, F.lit(False))
    good = staged.filter(~bad).drop("cast_errors")
    return good, staged.filter(bad).withColumn("reasons", reasons).drop("cast_errors")


def deduplicate(orders: DataFrame, natural_key: Sequence[str] = NATURAL_KEY, key: str = "order_id") -> DataFrame:
    """The first order of every natural key; NULL customers compare equal.

    Spark keeps one row per natural key in each task before the shuffle, so copies of one order never gather in a task.
    """
    first = Window.partitionBy(*natural_key).orderBy(key)
    return orders.withColumn("_nth", F.row_number().over(first)).filter(F.col("_nth") == 1).drop("_nth")


def removed_by_dedup(
    orders: DataFrame, natural_key: Sequence[str] = NATURAL_KEY, key: str = "order_id"
) -> DataFrame:
    """The orders ``deduplicate`` leaves out.

    The first ids are combined before the shuffle and matched on the order id, so a natural key with very many copies is
    spread like any other rows. Order ids must be unique, which landing provides and a gate checks.
    """
    firsts = orders.groupBy(*natural_key).agg(F.min(key).alias("_first"))
    return orders.join(firsts, F.col(key) == F.col("_first"), "left_anti")


def later_copies(orders: DataFrame, natural_key: Sequence[str] = NATURAL_KEY, key: str = "order_id") -> DataFrame:
    """Ids of the orders ``deduplicate`` leaves out, from the natural keys that occur more than once; order ids must be unique.

    Only natural keys and ids are grouped; rows are neither sorted nor sent unless they are copies.
    """
    repeated = orders.groupBy(*[F.col(name).alias(f"_{name}") for name in natural_key]).agg(F.min(key).alias("_first"), F.count("*").alias("_rows"))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in natural_key]
    return orders.join(repeated.filter("_rows > 1"), reduce(and_, same)).filter(F.col(key) != F.col("_first")).select(key)


def customer_column(orders: DataFrame) -> str:
    """The name of the customer column: ``customer_id``, or ``user_id`` after drift."""
    for name in ("customer_id", "user_id"):
        if name in orders.columns:
            return name
    raise ValueError("orders has neither customer_id nor user_id")


def rename_back(orders: DataFrame) -> DataFrame:
    """Undo the drift of the customer column; no change when it has its own name."""
    return orders.withColumnRenamed(customer_column(orders), "customer_id")
