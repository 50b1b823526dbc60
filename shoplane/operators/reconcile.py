"""Reconciliation of the marts with the source, late rows, revenue drivers and scoring against the ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplane.functions.scalars import TOTAL, day_of, earns, total
from shoplane.operators.gates import ERROR, WARN
from shoplane.operators.lookup import without_match

CASCADE = "multi_failure_cascade"
CASCADE_PARTS = ("missing_customer", "volume_spike", "schema_drift")


def totals_per_day(rows: DataFrame) -> DataFrame:
    """Rows and value per calendar day of ``ordered_at``."""
    return rows.groupBy(day_of("ordered_at").alias("day")).agg(
        F.count("*").alias("rows"), total(F.col("total_amount")).alias("amount")
    )


def _closed(day: Column, as_of_day: Column) -> Column:
    return day.isNull() | (day < as_of_day)


def reconcile(
    source: DataFrame, kept: DataFrame, deduplicated: DataFrame, set_aside: DataFrame, as_of_day: Column
) -> DataFrame:
    """Per closed day: source rows and value against kept + deduplicated + set aside, exactly.

    Each side is reduced to one row per day before the full outer join.
    """
    accounted = None
    for part, rows in (("kept", kept), ("removed", deduplicated), ("aside", set_aside)):
        here = totals_per_day(rows).withColumn("part", F.lit(part))
        accounted = here if accounted is None else accounted.unionByName(here)
    columns = []
    for part in ("kept", "removed", "aside"):
        mine = F.col("part") == part
        columns += [
            F.coalesce(F.sum(F.when(mine, F.col("rows"))), F.lit(0)).alias(f"{part}_rows"),
            total(F.when(mine, F.col("amount"))).alias(f"{part}_amount"),
        ]
    there = accounted.groupBy(F.col("day").alias("_day")).agg(*columns)
    source_totals = totals_per_day(source).withColumnsRenamed({"rows": "source_rows", "amount": "source_amount"})
    joined = source_totals.join(there, F.col("day").eqNullSafe(F.col("_day")), "full_outer").select(
        F.coalesce("day", "_day").alias("day"),
        *[
            F.coalesce(F.col(name), F.lit(0)).cast(kind).alias(name)
            for part in ("source", "kept", "removed", "aside")
            for name, kind in ((f"{part}_rows", "bigint"), (f"{part}_amount", TOTAL))
        ],
    )
    agrees = (F.col("source_rows") == F.col("kept_rows") + F.col("removed_rows") + F.col("aside_rows")) & (
        F.col("source_amount") == F.col("kept_amount") + F.col("removed_amount") + F.col("aside_amount")
    )
    return joined.filter(_closed(F.col("day"), as_of_day)).withColumn("agrees", agrees)


def reconcile_history(stored: DataFrame, now: DataFrame, late: DataFrame, as_of_day: Column) -> DataFrame:
    """Control totals stored when a day closed against today's, with late rows taken into account.

    ``stored`` and ``late`` have ``day, rows, amount``; so has ``now``. State: ``ok``, ``late`` (late rows explain the
    whole difference) or ``mismatch``.
    """
    sides = {"stored": stored, "current": now, "late": late}
    joined = None
    for name, side in sides.items():
        renamed = side.select(
            F.col("day").alias(f"{name}_day"),
            F.col("rows").alias(f"{name}_rows"),
            F.col("amount").alias(f"{name}_amount"),
        )
        if joined is None:
            joined = renamed.withColumnRenamed("stored_day", "day")
        else:
            joined = (
                joined.join(renamed, F.col("day").eqNullSafe(F.col(f"{name}_day")), "full_outer")
                .withColumn("day", F.coalesce("day", f"{name}_day"))
                .drop(f"{name}_day")
            )
    filled = joined.filter(_closed(F.col("day"), as_of_day)).select(
        "day",
        *[
            F.coalesce(F.col(name), F.lit(0)).cast(kind).alias(name)
            for side in sides
            for name, kind in ((f"{side}_rows", "bigint"), (f"{side}_amount", TOTAL))
        ],
    )
    same = (F.col("stored_rows") == F.col("current_rows")) & (F.col("stored_amount") == F.col("current_amount"))
    with_late = (F.col("stored_rows") + F.col("late_rows") == F.col("current_rows")) & (
        F.col("stored_amount") + F.col("late_amount") == F.col("current_amount")
    )
    return filled.withColumn("state", F.when(same, "ok").when(with_late, "late").otherwise("mismatch"))


def late_rows(landed: DataFrame, landed_at: str = "landed_at") -> DataFrame:
    """Rows that landed after their day was over, with the whole days between."""
    days = F.datediff(day_of(landed_at), day_of("ordered_at"))
    return landed.withColumn("days_late", days).filter(F.col("days_late") > 0)


def added_totals(totals: DataFrame | None, more: DataFrame | None) -> DataFrame | None:
    """``day, rows, amount`` of both tables added up per day; either may be missing."""
    if totals is None or more is None:
        return more if totals is None else totals
    both = totals.select("day", "rows", "amount").unionByName(more.select("day", "rows", "amount"))
    return both.groupBy("day").agg(F.sum("rows").alias("rows"), total(F.col("amount")).alias("amount"))


def agreement_gate(reconciled: DataFrame) -> DataFrame:
    """Closed days on which source and marts disagree."""
    broken = ~F.col("agrees")
    return reconciled.agg(
        F.count_if(broken).alias("_days"), F.min(F.when(broken, F.col("day"))).alias("_first")
    ).select(
        F.lit("orders: reconciled per closed day").alias("check"),
        F.lit(ERROR).alias("severity"),
        F.col("_days").alias("failed_rows"),
        F.col("_first").cast("string").alias("sample"),
    )


def history_gate(history: DataFrame) -> DataFrame:
    """Closed days whose totals changed (error), and those late rows explain (warning)."""
    counted = history.groupBy("state").agg(F.count("*").alias("_days"), F.min("day").alias("_first"))
    mismatch, late = F.col("state") == "mismatch", F.col("state") == "late"
    summed = counted.agg(
        F.sum(F.when(mismatch, F.col("_days"))).alias("mismatches"),
        F.min(F.when(mismatch, F.col("_first"))).alias("mismatch_at"),
        F.sum(F.when(late, F.col("_days"))).alias("lates"),
        F.min(F.when(late, F.col("_first"))).alias("late_at"),
    )
    reports = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(severity).alias("severity"),
            F.coalesce(F.col(days), F.lit(0)).cast("bigint").alias("failed_rows"),
            F.col(first).cast("string").alias("sample"),
        )
        for check, severity, days, first in (
            ("orders: closed days unchanged", ERROR, "mismatches", "mismatch_at"),
            ("orders: late rows in closed days", WARN, "lates", "late_at"),
        )
    ]
    return summed.select(F.inline(F.array(*reports)))


def revenue_drivers(order_changes: DataFrame, product_changes: DataFrame) -> DataFrame:
    """Why revenue moved between two snapshots: cancellations and price changes, each with rows and value.

    Takes the output of ``capture.diff``. Cancelled value counts the net revenue lost; price changes sum the change of
    unit prices.
    """
    cancelled = (
        (F.col("change") == "update")
        & (F.col("after.status") == "cancelled")
        & F.coalesce(F.col("before.status") != "cancelled", F.lit(True))
    )
    lost = F.when(cancelled & earns("before.status"), -F.col("before.total_amount"))
    by_orders = order_changes.agg(F.count_if(cancelled).alias("rows"), total(lost).alias("amount")).select(
        F.lit("cancellations").alias("driver"), "rows", "amount"
    )
    priced = (F.col("change") == "update") & ~F.col("before.unit_price").eqNullSafe(F.col("after.unit_price"))
    moved = F.when(priced, F.col("after.unit_price") - F.col("before.unit_price"))
    by_price = product_changes.agg(F.count_if(priced).alias("rows"), total(moved).alias("amount")).select(
        F.lit("price changes").alias("driver"), "rows", "amount"
    )
    return by_orders.unionByName(by_price)


def driver_gate(drivers: DataFrame) -> DataFrame:
    """Warnings for every driver that touched rows."""
    return drivers.select(
        F.concat(F.lit("revenue driver: "), F.col("driver")).alias("check"),
        F.lit(WARN).alias("severity"),
        F.col("rows").alias("failed_rows"),
        F.col("amount").cast("string").alias("sample"),
    )


def detected_in_orders(orders: DataFrame, removed: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Failures seen in order rows, as ``failure_key`` and ``item``; a row may show several.

    ``removed`` are the rows deduplication took out. A wrong total is blamed on a bulk overwrite only where quantity
    and price are sound, for those have checks of their own.
    """
    bad_quantity = F.col("quantity") <= 0
    bad_price = (F.col("unit_price") < 0) | (F.col("total_amount") < 0)
    wrong_total = F.col("total_amount") != F.col("unit_price") * F.col("quantity")
    signs = {
        "missing_customer": F.col("customer_id").isNull(),
        "invalid_quantity": bad_quantity,
        "negative_price": bad_price,
        "destructive_fix": wrong_total & ~bad_quantity & ~bad_price,
        "malformed_data": ~F.col("status").isin(*statuses),
    }
    keys = F.array_compact(F.array(*[F.when(sign, F.lit(key)) for key, sign in signs.items()]))
    found = orders.select(F.explode(keys).alias("failure_key"), F.col("order_id").alias("item"))
    copies = removed.select(F.lit("duplicate_order").alias("failure_key"), F.col("order_id").alias("item"))
    return found.unionByName(copies)


def detected_in_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments without order, as ``failure_key`` and ``item``."""
    orphans = without_match(payments, orders, "order_id", "order_id", "payment_id")
    return orphans.select(F.lit("orphan_payment").alias("failure_key"), F.col("payment_id").alias("item"))


def expand_cascade(ledger: DataFrame) -> DataFrame:
    """Ledger keys with the cascade replaced by its parts."""
    parts = F.array(*[F.lit(part) for part in CASCADE_PARTS])
    keys = F.when(F.col("failure_key") == CASCADE, parts).otherwise(F.array("failure_key"))
    return ledger.withColumn("failure_key", F.explode(keys))


def score(ledger: DataFrame, detected: DataFrame) -> DataFrame:
    """Precision and recall per failure key; both inputs have ``failure_key`` and ``item``."""
    recorded = expand_cascade(ledger).select("failure_key", "item", F.lit(1).alias("in_ledger"), F.lit(0).alias("seen"))
    flagged = detected.select("failure_key", "item", F.lit(0).alias("in_ledger"), F.lit(1).alias("seen"))
    per_item = (
        recorded.unionByName(flagged)
        .groupBy("failure_key", "item")
        .agg(F.max("in_ledger").alias("in_ledger"), F.max("seen").alias("seen"))
    )
    both = F.sum(F.col("in_ledger") * F.col("seen"))
    return (
        per_item.groupBy("failure_key")
        .agg(F.sum("in_ledger").alias("injected"), F.sum("seen").alias("detected"), both.alias("hits"))
        .withColumn("precision", F.round(F.try_divide(F.col("hits"), F.col("detected")), 4))
        .withColumn("recall", F.round(F.try_divide(F.col("hits"), F.col("injected")), 4))
    )
