"""Scoring of gate reports against the incident ledger, which knows only what was injected and when.

A build sees what happened after the build before it, up to its own moment. Every incident is assigned to the first build that could
see it by an interval join: a build's interval is laid out by day, incidents meet the builds of their day, and the one whose
interval holds the moment is kept. A build accuses a failure where one of the checks that show it counts more failed rows than
in the build before, so a defect that stays in the source is news only once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplane.operators.reconcile import expand_cascade

_NEGATIVE = ("orders: unit_price negative", "orders: total_amount negative")
_TOTAL = "orders: total is not price times quantity"
_COPIES = "orders: customer_id, product_id, ordered_at unique"

#: The checks that show a failure.
SIGNS: dict[str, tuple[str, ...]] = {
    "negative_price": _NEGATIVE,
    "recurring_incident": _NEGATIVE,
    "missing_customer": ("orders: customer_id is null",),
    "invalid_quantity": ("orders: quantity not positive",),
    "destructive_fix": (_TOTAL, "orders: closed days unchanged"),
    "duplicate_order": (_COPIES,),
    "volume_spike": ("orders: daily volume",),
    "late_arrival": ("orders: late rows in closed days",),
    "orphan_payment": ("payments: order_id known",),
    "malformed_data": ("orders: status not accepted",),
    "schema_drift": ("orders: contract",),
    "slow_source": ("landing: fresh",),
    "ambiguous_anomaly": ("revenue driver: cancellations", "revenue driver: price changes"),
}


def build_intervals(reports: DataFrame) -> DataFrame:
    """as_of, previous of every build in the reports; the first has no previous one. One row per build."""
    builds = reports.select("as_of").distinct()
    return builds.withColumn("previous", F.lag("as_of").over(Window.orderBy("as_of")))


def _days(low: Column, high: Column) -> Column:
    return F.sequence(F.to_date(low), F.to_date(high), F.expr("interval 1 day"))


def assigned(ledger: DataFrame, reports: DataFrame) -> DataFrame:
    """Ledger rows (failure_key, injected_at and more) with ``as_of``, the first build that could see them; NULL after the last.

    What happened before the first build, however long ago, is seen by it.
    """
    moment = F.col("injected_at")
    first = ledger.agg(F.min(moment).alias("_oldest"))  # one row
    intervals = build_intervals(reports).crossJoin(F.broadcast(first))
    low = F.coalesce("previous", F.least("_oldest", "as_of"))
    by_day = intervals.select("as_of", "previous", F.explode(_days(low, F.col("as_of"))).alias("_day"))
    inside = (F.to_date(moment) == F.col("_day")) & (moment <= F.col("as_of")) & (F.col("previous").isNull() | (moment > F.col("previous")))
    return ledger.join(by_day, inside, "left").drop("previous", "_day")


def accusations(reports: DataFrame, signs: Mapping[str, Sequence[str]] = SIGNS) -> DataFrame:
    """as_of, failure_key of every build that has fresh failures in a check that shows the failure."""
    pairs = [F.struct(F.lit(key).alias("failure_key"), F.lit(check).alias("_check")) for key, checks in signs.items() for check in checks]
    before = F.lag("failed_rows", 1, 0).over(Window.partitionBy("check").orderBy("as_of"))  # one row per build
    fresh = reports.withColumn("_before", before).filter(F.col("failed_rows") > F.col("_before")).select("as_of", "check")
    shown = fresh.select("as_of", "check", F.inline(F.array(*pairs)))
    return shown.filter(F.col("check") == F.col("_check")).select("as_of", "failure_key").distinct()


def score_builds(ledger: DataFrame, reports: DataFrame, signs: Mapping[str, Sequence[str]] = SIGNS) -> DataFrame:
    """Per failure: incidents, unseen (after the last build), builds that had some, builds that accused it, both, precision, recall,
    and the mean seconds from an incident to the build that could see it."""
    placed = assigned(expand_cascade(ledger), reports)
    delay = F.unix_seconds("as_of") - F.unix_seconds("injected_at")
    true_cells = placed.groupBy("failure_key", "as_of").agg(F.count("*").alias("incidents"), F.sum(delay).alias("delay"))
    true_cells = true_cells.select("failure_key", "as_of", "incidents", "delay", F.lit(False).alias("accused"))
    accused = accusations(reports, signs).select("failure_key", "as_of", F.lit(0).cast("bigint").alias("incidents"), F.lit(None).cast("bigint").alias("delay"), F.lit(True).alias("accused"))
    cells = true_cells.unionByName(accused).groupBy("failure_key", "as_of")
    cells = cells.agg(F.sum("incidents").alias("incidents"), F.sum("delay").alias("delay"), F.max("accused").alias("accused"))
    seen = F.col("as_of").isNotNull()
    had, blamed = seen & (F.col("incidents") > 0), seen & F.col("accused")
    counted = cells.groupBy("failure_key").agg(
        F.sum("incidents").alias("incidents"),
        F.sum(F.when(seen, 0).otherwise(F.col("incidents"))).alias("unseen"),
        F.count_if(had).alias("builds_struck"),
        F.count_if(blamed).alias("builds_accused"),
        F.count_if(had & blamed).alias("hits"),
        F.sum("delay").alias("_delay"),
    )
    return counted.select(
        "failure_key",
        "incidents",
        "unseen",
        "builds_struck",
        "builds_accused",
        "hits",
        F.round(F.try_divide(F.col("hits"), F.col("builds_accused")), 4).alias("precision"),
        F.round(F.try_divide(F.col("hits"), F.col("builds_struck")), 4).alias("recall"),
        F.round(F.try_divide(F.col("_delay"), F.col("incidents") - F.col("unseen")), 1).alias("mean_delay_seconds"),
    )
