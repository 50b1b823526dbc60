"""Exact quantiles of groups of any size by repeated histograms, and occurrence numbers in the incident ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplane.operators.numbering import number_rows


def _narrowed(rows: DataFrame, targets: DataFrame, group: str, value: str) -> DataFrame:
    """The rows that lie between the bounds of a target of their group, with the target."""
    here = F.col(group).eqNullSafe(F.col("_group")) & F.col(value).between(F.col("_low"), F.col("_high"))
    return rows.join(targets, here).select("_group", "_rank", "_left", "_low", "_high", value)


def _chosen(cells: DataFrame, order: str, *bounds: Column) -> DataFrame:
    """Of every target's ordered cells the one that holds its rank; ``_left`` becomes the rank inside it."""
    ordered = Window.partitionBy("_group", "_rank").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    reached = cells.withColumn("_upto", F.sum("_n").over(ordered))
    inside = (F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_n") < F.col("_left"))
    return reached.filter(inside).select("_group", "_rank", (F.col("_left") - F.col("_upto") + F.col("_n")).alias("_left"), *bounds)


def exact_quantiles(
    df: DataFrame, group: str, value: str, probabilities: Sequence[float], bins: int = 1024, levels: int = 3
) -> DataFrame:
    """``group, probability, rows, quantile``: linear interpolation between the two nearest values.

    The value of a rank is found by histograms: the rows between its bounds are counted in ``bins`` cells of equal width, the cell
    that holds the rank gives the next, closer bounds (its least and greatest value), and after ``levels`` such scans the distinct
    values left are counted. Nothing is sorted, written or run before the result is used; counts are combined before every
    shuffle, so a group may have any size. Levels only save work: with few of them or odd values the last step has more to count.
    """
    rows = df.filter(F.col(value).isNotNull()).select(group, value)
    sizes = rows.groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("rows"), F.min(value).alias("_low"), F.max(value).alias("_high"))
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    wanted = (
        sizes.withColumn("probability", F.explode(asked))
        .withColumn("_at", F.col("probability") * (F.col("rows") - 1))
        .withColumn("_first", F.floor("_at") + 1)
        .withColumn("_second", F.least(F.col("_first") + 1, F.col("rows")))
        .withColumn("_part", F.col("_at") - F.floor("_at"))
    )
    targets = wanted.select("_group", "_low", "_high", F.explode(F.array("_first", "_second")).alias("_rank")).distinct()
    targets = targets.withColumn("_left", F.col("_rank"))
    for _ in range(levels):
        near = _narrowed(rows, targets, group, value)
        number, low, high = (F.col(name).cast("double") for name in (value, "_low", "_high"))
        share = F.nanvl(F.try_divide(number - low, high - low), F.lit(0.0))  # an infinite range tells no cells apart
        cell = F.when(F.col(value) == F.col("_high"), bins - 1).otherwise(F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1)))
        cells = near.groupBy("_group", "_rank", "_left", cell.alias("_cell"))
        cells = cells.agg(F.count("*").alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high"))
        targets = _chosen(cells, "_cell", F.col("_low"), F.col("_high"))
    values = _narrowed(rows, targets, group, value).groupBy("_group", "_rank", "_left", F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    found = _chosen(values, "_value", F.col("_value")).select(F.col("_group").alias("_of"), F.col("_rank").alias("_nth"), "_value")
    matched = wanted.join(found, F.col("_group").eqNullSafe(F.col("_of")) & F.col("_nth").isin(F.col("_first"), F.col("_second")))
    lower = F.min(F.when(F.col("_nth") == F.col("_first"), F.col("_value")))
    upper = F.max(F.when(F.col("_nth") == F.col("_second"), F.col("_value")))
    return (
        matched.groupBy("_group", "probability", "rows", "_part")
        .agg(lower.alias("_lower"), upper.alias("_upper"))
        .select(
            F.col("_group").alias(group),
            "probability",
            "rows",
            (F.col("_lower") + (F.col("_upper") - F.col("_lower")) * F.col("_part")).alias("quantile"),
        )
    )


def incident_counts(ledger: DataFrame, failure_key: str | None = None) -> DataFrame:
    """Recorded incidents per failure key, or of one key."""
    chosen = ledger if failure_key is None else ledger.filter(F.col("failure_key") == failure_key)
    return chosen.groupBy("failure_key").agg(F.count("*").alias("incidents"))


def occurrences(ledger: DataFrame) -> DataFrame:
    """The ledger with ``occurrence``: the nth time its failure was recorded."""
    return number_rows(ledger, "occurrence", ["injected_at", "incident_id"], within="failure_key")
