"""Quality gates.

A gate reports one row: ``check``, ``severity`` (``error`` or ``warn``), ``failed_rows`` and ``sample``, the lowest key
that fails. All row rules of a table are counted in one scan; key and reference gates reduce to one row per key first.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplane.contracts import EVENT_TIMES, PRIMARY_KEYS
from shoplane.operators.lookup import balanced_lookup, totals_without_match

ERROR, WARN = "error", "warn"


class GateFailure(Exception):
    """A build broke at least one gate of severity ``error``."""


def _row(check: str, severity: str, failed_rows: Column, sample: Column) -> list[Column]:
    return [
        F.lit(check).alias("check"),
        F.lit(severity).alias("severity"),
        F.coalesce(failed_rows, F.lit(0)).cast("bigint").alias("failed_rows"),
        sample.cast("string").alias("sample"),
    ]


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """All gate reports in one table."""
    return reduce(DataFrame.unionByName, frames)


def row_gates(df: DataFrame, table: str, rules: Mapping[str, Column], severity: str = ERROR) -> DataFrame:
    """One report row per rule, from a single scan of ``df``."""
    key = F.col(PRIMARY_KEYS[table])
    counts = []
    for place, broken in enumerate(rules.values()):
        counts += [F.count_if(broken).alias(f"failed_{place}"), F.min(F.when(broken, key)).alias(f"sample_{place}")]
    reports = [
        F.struct(*_row(f"{table}: {name}", severity, F.col(f"failed_{place}"), F.col(f"sample_{place}")))
        for place, name in enumerate(rules)
    ]
    return df.agg(*counts).select(F.inline(F.array(*reports)))


def unique_gate(df: DataFrame, table: str, columns: tuple[str, ...], severity: str = ERROR) -> DataFrame:
    """Rows beyond the first of every value of ``columns``; NULLs compare equal."""
    key = PRIMARY_KEYS[table]
    repeated = (
        df.groupBy(*columns)
        .agg(F.count("*").alias("_rows"), F.min(key).alias("_first"))
        .filter(F.col("_rows") > 1)
        .agg(F.sum(F.col("_rows") - 1).alias("_extra"), F.min("_first").alias("_sample"))
    )
    return repeated.select(*_row(f"{table}: {', '.join(columns)} unique", severity, F.col("_extra"), F.col("_sample")))


def reference_gate(fact: DataFrame, dim: DataFrame, table: str, column: str, severity: str = ERROR) -> DataFrame:
    """Rows of ``fact`` whose ``column`` is NULL or unknown to ``dim``."""
    key = PRIMARY_KEYS[table]
    weighed = fact.select(F.col(column), F.col(key).alias("_row_id"), F.lit(0).cast("decimal(12,2)").alias("_nothing"))
    missing = totals_without_match(weighed, dim, column, column, "_nothing", "_row_id")
    return missing.select(*_row(f"{table}: {column} known", severity, F.col("rows"), F.col("first_id")))


def payment_rule_gates(orders: DataFrame, payments: DataFrame, severity: str = ERROR) -> DataFrame:
    """Returned orders must be refunded, and nothing is paid before it is ordered."""
    ordered = orders.select(F.col("order_id").alias("_order"), F.col("status").alias("order_status"), "ordered_at")
    joined = balanced_lookup(payments, ordered, "order_id", "_order", "payment_id")
    rules = {
        "returned order is not refunded": (F.col("order_status") == "returned") & (F.col("status") != "refunded"),
        "paid before ordered": F.col("paid_at") < F.col("ordered_at"),
    }
    return row_gates(joined, "payments", rules, severity)


def contract_differences(schema: T.StructType, contract: T.StructType) -> list[tuple[str, str, str, str]]:
    """(column, expected type, actual type, state) for every column of either side.

    States: ``ok``, ``type`` (cannot be read as promised), ``missing`` and ``extra``. A rename shows as one missing and
    one extra column.
    """
    found = {field.name: field.dataType.simpleString() for field in schema.fields}
    rows = []
    for field in contract.fields:
        expected = field.dataType.simpleString()
        actual = found.pop(field.name, None)
        state = "missing" if actual is None else "ok" if actual == expected else "type"
        rows.append((field.name, expected, actual, state))
    rows += [(name, None, actual, "extra") for name, actual in found.items()]
    return rows


def require_contract(df: DataFrame, table: str, contract: T.StructType) -> None:
    """Fail before any data is read when a promised column is gone or renamed."""
    differences = contract_differences(df.schema, contract)
    missing = [column for column, _, _, state in differences if state == "missing"]
    if missing:
        extra = [column for column, _, _, state in differences if state == "extra"]
        raise GateFailure(f"{table}: missing columns {missing}, unexpected columns {extra}")


def contract_report(df: DataFrame, table: str, contract: T.StructType) -> DataFrame:
    """The contract column by column with its state and the NULLs found in one scan; a missing column has no count."""
    differences = contract_differences(df.schema, contract)
    present = [column for column, _, actual, _ in differences if actual is not None]
    counts = df.agg(*[F.count_if(F.col(column).isNull()).alias(f"nulls_{column}") for column in present])
    text = "string"
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(expected).cast(text).alias("expected_type"),
            F.lit(actual).cast(text).alias("actual_type"),
            F.lit(state).alias("state"),
            (F.col(f"nulls_{column}") if actual is not None else F.lit(None)).cast("bigint").alias("null_rows"),
        )
        for column, expected, actual, state in differences
    ]
    return counts.select(F.inline(F.array(*rows)))


def contract_gate(spark: SparkSession, schemas: Mapping[str, tuple[T.StructType, T.StructType]]) -> DataFrame:
    """Contract gate over schemas alone, as (actual, contract) per table: reads no data.

    Missing columns fail; the sample also names extra ones, for a rename shows as both.
    """
    rows = []
    for table, (schema, contract) in schemas.items():
        states = [(column, state) for column, _, _, state in contract_differences(schema, contract)]
        missing = sum(state == "missing" for _, state in states)
        named = ", ".join(f"{column} {state}" for column, state in states if state in ("missing", "extra"))
        rows.append((f"{table}: contract", ERROR, missing, named or None))
    return spark.createDataFrame(rows, "check string, severity string, failed_rows bigint, sample string")


def freshness(tables: Mapping[str, DataFrame], as_of: Column, limit_seconds: int = 300) -> DataFrame:
    """Newest event of every table up to ``as_of``, its lag and whether that is within the limit.

    Events dated after ``as_of`` say nothing about freshness and do not count.
    """
    parts = []
    for table, df in tables.items():
        moment = F.col(EVENT_TIMES[table])
        newest = df.agg(F.max(F.when(moment <= as_of, moment)).alias("newest_at"))
        parts.append(newest.select(F.lit(table).alias("table_name"), "newest_at"))
    lag = F.unix_seconds(as_of) - F.unix_seconds("newest_at")
    return (
        union_all(parts)
        .withColumn("lag_seconds", lag)
        .withColumn("fresh", F.coalesce(F.col("lag_seconds") <= limit_seconds, F.lit(False)))
    )


def freshness_gate(df: DataFrame, moment: str, as_of: Column, limit_seconds: int = 300) -> DataFrame:
    """Warnings while nothing newer than the limit has landed, and about rows dated after ``as_of``, which hide no staleness.

    The samples are the newest moment that counts and the furthest one ahead.
    """
    at = F.col(moment)
    ahead = F.when(at > as_of, at)
    found = df.agg(F.max(F.when(at <= as_of, at)).alias("_newest"), F.count(ahead).alias("_ahead"), F.max(ahead).alias("_furthest"))
    stale = ~F.coalesce(F.unix_seconds(as_of) - F.unix_seconds("_newest") <= limit_seconds, F.lit(False))
    reports = [
        F.struct(*_row("landing: fresh", WARN, stale.cast("int"), F.col("_newest"))),
        F.struct(*_row("landing: not ahead of time", WARN, F.col("_ahead"), F.col("_furthest"))),
    ]
    return found.select(F.inline(F.array(*reports)))


def volume_gate(flags: DataFrame, since: Column | None = None) -> DataFrame:
    """Days flagged as spike or drop, as a warning; ``since`` limits the report to recent days."""
    flagged = F.col("flag") != "normal"
    if since is not None:
        flagged = flagged & (F.col("day") >= since)
    counted = flags.agg(F.count_if(flagged).alias("_days"), F.min(F.when(flagged, F.col("day"))).alias("_first"))
    return counted.select(*_row("orders: daily volume", WARN, F.col("_days"), F.col("_first")))


def raise_if_broken(rows: list) -> None:
    """Raise if any error-level check of a collected report failed."""
    broken = [row for row in rows if row["severity"] == ERROR and row["failed_rows"] > 0]
    if broken:
        raise GateFailure("; ".join(f"{row['check']}: {row['failed_rows']} (e.g. {row['sample']})" for row in broken))
