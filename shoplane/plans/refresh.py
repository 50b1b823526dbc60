"""Marts kept up to date from landed changes: only the spans that a change touches are computed again.

A changed order touches the span it left and the one it came to, a changed payment those of its order. A changed customer or
product touches the spans whose facts name it, found in a table of (key, span) pairs that is rewritten together with the facts, and
only if it changed in something facts take from it. The touched spans are staged, set aside, deduplicated, joined and gated like a
whole build; marts are then overwritten span by span, and the batches used are marked last. A refresh that dies is repeated as a
whole; one whose gates fail leaves marts and marks as they were, and its batches wait for the next.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from shoplane.contracts import DOMAINS, NATURAL_KEY, PRIMARY_KEYS, TABLES
from shoplane.functions.scalars import utc
from shoplane.operators import gates
from shoplane.operators.staging import later_copies, quarantine, row_rules, stage
from shoplane.plans import marts
from shoplane.sources import keyed
from shoplane.sources.tables import Lake

FACTS, DAILY, ASIDE, MARKS = "marts/fct_orders", "marts/fct_daily_revenue", "marts/quarantine_orders", "marts/marks"
MARK_SCHEMA = "table_name string, batch_id bigint"
KEYS = {"customers": "marts/spans_of_customers", "products": "marts/spans_of_products"}


@dataclass(frozen=True)
class Refresh:
    """The spans a refresh wrote, the gate report and the batch of each table it went up to."""

    spans: list[date]
    report: list[Row]
    marks: dict[str, int]


def marks(lake: Lake) -> dict[str, int]:
    """The last batch of every table that the marts hold."""
    rows = lake.read_log(MARKS, MARK_SCHEMA)
    if rows is None:
        return {}
    return {row.table_name: row.batch_id for row in rows.groupBy("table_name").agg(F.max("batch_id").alias("batch_id")).collect()}


def pending(lake: Lake, table: str, after: int | None) -> DataFrame | None:
    """Logged changes of the batches that the marts do not hold; the mark prunes the log."""
    rows = lake.read_log(keyed.change_log(table))
    if rows is None or after is None:
        return rows
    return rows.filter(F.col("batch_id") > after)


def touched_spans(lake: Lake, waiting: Mapping[str, DataFrame]) -> list[date]:
    """The spans whose facts the waiting changes may alter."""
    spans: set[date] = set()
    if "orders" in waiting:
        spans.update(keyed.values(waiting["orders"], "old_span", "new_span"))
    if "payments" in waiting:
        spans.update(set(keyed.values(waiting["payments"], "old_span", "new_span")) - {keyed.NO_SPAN})
    for table, log in KEYS.items():
        pairs = lake.read_log(log)
        if table in waiting and pairs is not None:
            changed = waiting[table].filter("touches").select(PRIMARY_KEYS[table])
            spans.update(keyed.values(pairs.join(changed, PRIMARY_KEYS[table], "left_semi"), "span"))
    return sorted(spans)


def span_gates(orders: DataFrame, payments: DataFrame, customers: DataFrame, products: DataFrame, kept: DataFrame, domains) -> DataFrame:
    """Gates on the rows of the touched spans; payments lie beside their orders, so one without order has no span."""
    staged = {"orders": orders, "payments": payments}
    reports = [gates.row_gates(rows, table, row_rules(table, domains.get(table, {}))) for table, rows in staged.items()]
    reports += [
        gates.unique_gate(orders, "orders", NATURAL_KEY, gates.WARN),
        gates.unique_gate(kept, "orders", NATURAL_KEY).withColumn("check", F.concat(F.lit("staged "), "check")),
        gates.reference_gate(orders, customers, "orders", "customer_id"),
        gates.reference_gate(orders, products, "orders", "product_id"),
        gates.payment_rule_gates(orders, payments),
    ]
    return gates.union_all(reports)


def refresh(
    lake: Lake,
    as_of: datetime,
    domains: Mapping[str, Mapping[str, Sequence[str]]] = DOMAINS,
    strict: bool = True,
    grain: str = "day",
) -> Refresh:
    """Bring the marts to all changes landed so far. ``grain`` is that of landing; see ``build`` for ``strict``."""
    before = marks(lake)
    waiting = {table: rows for table in TABLES if (rows := pending(lake, table, before.get(table))) is not None}
    upto = {table: last for table, rows in waiting.items() if (last := rows.agg(F.max("batch_id")).first()[0]) is not None}
    waiting = {table: waiting[table].filter(F.col("batch_id") <= last) for table, last in upto.items()}
    spans = touched_spans(lake, waiting)
    report: list[Row] = []
    if spans:
        report = _rebuild(lake, spans, as_of, domains, strict, grain)
    if upto:
        lake.append(lake.spark.createDataFrame(sorted(upto.items()), MARK_SCHEMA).coalesce(1), MARKS)
    return Refresh(spans, report, before | upto)


def _rebuild(lake: Lake, spans: list[date], as_of: datetime, domains, strict: bool, grain: str) -> list[Row]:
    orders, payments = (stage(keyed.current(lake, table, spans), TABLES[table]) for table in ("orders", "payments"))
    customers, products = keyed.current(lake, "customers"), keyed.current(lake, "products")
    good, bad = quarantine(orders, row_rules("orders", domains.get("orders", {})))
    paid, _ = quarantine(payments, row_rules("payments", domains.get("payments", {})))
    people, _ = quarantine(customers, row_rules("customers", domains.get("customers", {})))
    goods, _ = quarantine(products, row_rules("products", domains.get("products", {})))
    copies = lake.open(lake.write(later_copies(good), "removed_copies"))  # read by the gates and by the facts; landing keeps order ids unique
    kept = good.join(copies, "order_id", "left_anti")
    judged = span_gates(orders.drop("cast_errors"), payments.drop("cast_errors"), customers, products, kept, domains)
    unplaced = [keyed.current(lake, table, [keyed.NO_SPAN]) for table in ("payments", "orders")]
    judged = judged.unionByName(gates.reference_gate(*unplaced, "payments", "order_id"))
    found = judged.orderBy("check").collect()
    log = lake.spark.createDataFrame(found, judged.schema).withColumn("as_of", utc(as_of))
    lake.append(log.coalesce(1), "gate_reports")
    if strict:
        gates.raise_if_broken(found)

    facts = marts.fct_orders(kept, people, goods, paid).withColumn("span", keyed.span_of("ordered_at", grain))
    _overwrite(lake, FACTS, facts, spans)
    written = lake.read_log(FACTS).filter(F.col("span").isin(*spans))
    daily = marts.fct_daily_revenue(written).withColumn("span", keyed.span_of("day", grain))
    _overwrite(lake, DAILY, daily, spans)
    _overwrite(lake, ASIDE, bad.withColumn("span", keyed.span_of("ordered_at", grain)), spans)
    for table, log in KEYS.items():
        pairs = written.select(PRIMARY_KEYS[table], "span").filter(F.col(PRIMARY_KEYS[table]).isNotNull()).distinct()
        _overwrite(lake, log, pairs, spans)
    return found


def _overwrite(lake: Lake, log: str, rows: DataFrame, spans: list[date]) -> None:
    """Make ``rows`` the content of the spans; a span that has none any more goes."""
    before = lake.read_log(log)
    keyed.replace(lake, log, rows, "span", spans, None if before is None else before.filter(F.col("span").isin(*spans)))


def read_mart(lake: Lake, log: str) -> DataFrame | None:
    """A mart as a whole."""
    rows = lake.read_log(log)
    return None if rows is None else rows.drop("span")
