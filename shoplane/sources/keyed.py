"""Where every key lies: an index from key to span, and tables by span that change only where a batch touches them.

Orders and payments are kept by span, customers and products by range of their key. The index holds key, span and the sequence
number of the last change, also of keys that were deleted, in partitions of ``WIDTH`` keys; a batch reads and rewrites the ranges
its keys fall into and no others. So a key that comes back with another moment leaves its old span, a change that arrives after a
newer one of the same key is left out, and a deleted key stays deleted.

Every batch is first logged with what it finds in the index (``once``); state and index are then rewritten from that log, the
index last. A batch that is run again reads its log, whatever of it had been done, and ends with the same tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplane.contracts import EVENT_TIMES, PRIMARY_KEYS, TABLES
from shoplane.sources.tables import Lake

UPSERT, DELETE = "upsert", "delete"
#: Keys per range of an index or a dimension.
WIDTH = 1 << 20
#: The span of rows without a moment, and of payments whose order is not there.
NO_SPAN = date(1900, 1, 1)
#: What facts take from a dimension: a change of anything else touches no fact.
DESCRIBING = {"customers": ("segment", "country"), "products": ("category", "cost")}


def range_of(key: str) -> Column:
    """The range a key lies in; a key that is no number is spread by hash."""
    column = F.col(key)
    return F.coalesce(F.floor(column.try_cast("bigint") / WIDTH), F.pmod(F.xxhash64(column), F.lit(256))).cast("bigint")


def span_of(moment: str, grain: str) -> Column:
    """The day or coarser span of a moment."""
    return F.coalesce(F.date_trunc(grain, F.col(moment).cast("timestamp")).cast("date"), F.lit(NO_SPAN))


def logged(lake: Lake, log: str, batch_id: int) -> DataFrame | None:
    """The rows one batch has in a log; nothing but its own folder is listed, however many batches there were."""
    rows = lake.read_log(f"{log}/batch_id={batch_id}")
    return None if rows is None else rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def once(lake: Lake, log: str, batch_id: int, make: Callable[[], DataFrame]) -> DataFrame | None:
    """The rows a batch has in ``log``: those it logged when it first ran, else ``make()``, logged now; None if there are none."""
    before = logged(lake, log, batch_id)
    if before is not None and not before.isEmpty():
        return before
    lake.overwrite_days(make().withColumn("batch_id", F.lit(batch_id).cast("bigint")), log, "batch_id", balance=False)
    now = logged(lake, log, batch_id)
    return None if now is None or now.isEmpty() else now


def forget(lake: Lake, log: str, upto: int) -> int:
    """Drop the batches of a log up to and including one; returns how many. Call it for batches that marts and checkpoints are past."""
    rows = lake.read_log(log)
    if rows is None:
        return 0
    old = [row[0] for row in rows.select("batch_id").distinct().filter(F.col("batch_id") <= upto).collect()]
    lake.drop_partitions(log, "batch_id", old)
    return len(old)


def replace(lake: Lake, log: str, rows: DataFrame, partition: str, touched: Iterable, read: DataFrame | None) -> None:
    """Make ``rows`` the whole content of the ``touched`` partitions, those without rows included.

    ``read`` is what ``rows`` were made from, if anything: rows of the same log. A touched partition that got no rows still has its old
    files after the write and is dropped; so ``rows`` are computed once.
    """
    before = set() if read is None else set(read.inputFiles())
    lake.overwrite_days(rows, log, partition)
    if before:
        kept = lake.read_log(log)
        still = before.intersection(kept.inputFiles()) if kept is not None else ()
        left = {value for path in still for value in re.findall(rf"/{re.escape(partition)}=([^/]*)/", path)[-1:]}
        lake.drop_partitions(log, partition, [value for value in touched if str(value) in left])


def values(frame: DataFrame, *columns: str) -> list:
    """Distinct non-NULL values of some columns: spans or ranges, one per partition of a table."""
    every = F.explode(F.array(*columns)).alias("value")
    return sorted(row[0] for row in frame.select(every).filter("value is not null").distinct().collect())


class KeyIndex:
    """key, seq, span and more columns per key; see the module."""

    def __init__(self, lake: Lake, table: str, key: str) -> None:
        self.lake, self.key, self.log = lake, key, f"index/{table}"

    def find(self, keys: DataFrame, key: str | None = None) -> DataFrame | None:
        """Index rows of the keys in column ``key`` of ``keys``; only the ranges they fall into are read."""
        rows = self.lake.read_log(self.log)
        if rows is None:
            return None
        asked = keys.select(F.col(key or self.key).alias(self.key)).filter(F.col(self.key).isNotNull()).distinct()
        ranges = values(asked.select(range_of(self.key).alias("range")), "range")
        return rows.filter(F.col("range").isin(*ranges)).join(asked, self.key, "left_semi") if ranges else rows.limit(0)

    def put(self, rows: DataFrame) -> None:
        """Replace the entries of the keys of ``rows`` (key first, the same columns every time)."""
        placed = rows.withColumn("range", range_of(self.key))
        known = self.lake.read_log(self.log)
        if known is not None:
            touched = known.filter(F.col("range").isin(*values(placed, "range")))
            others = touched.join(rows.select(self.key), self.key, "left_anti")
            placed = placed.unionByName(others.select(*placed.columns))
        self.lake.overwrite_days(placed.sortWithinPartitions(self.key), self.log, "range")


def state_log(table: str) -> str:
    return f"state/{table}"


def change_log(table: str) -> str:
    return f"changes/{table}"


def accepted(batch: DataFrame, key: str, known: DataFrame | None, found: Mapping[str, tuple[Column, str]]) -> DataFrame:
    """The newest change per key of a batch that is not older than what is known of it.

    Of changes with one sequence number the greatest row counts, so that a repeat gives the same. Only keys sent more than once are
    grouped with their rows. ``found`` adds columns of
    ``known`` as (column, type), NULL for new keys.
    """
    others = [name for name in batch.columns if name not in (key, "seq")]
    rows = batch.filter(F.col(key).isNotNull())
    repeated = rows.groupBy(key).agg(F.count("*").alias("_rows")).filter("_rows > 1").select(key)
    newest = rows.join(repeated, key, "left_semi").groupBy(key).agg(F.max(F.struct("seq", *others)).alias("_row"))
    once_sent = rows.join(repeated, key, "left_anti").select(*batch.columns)
    latest = once_sent.unionByName(newest.select(key, "_row.*").select(*batch.columns))
    if known is None:
        return latest.withColumns({name: F.lit(None).cast(kind) for name, (_, kind) in found.items()})
    here = known.select(F.col(key).alias("_key"), F.col("seq").alias("_seq"), *[column.alias(name) for name, (column, _) in found.items()])
    joined = latest.join(here, F.col(key) == F.col("_key"), "left")
    return joined.filter(F.col("_seq").isNull() | (F.col("seq") >= F.col("_seq"))).drop("_key", "_seq")


def _upserts(changes: DataFrame, table: str) -> DataFrame:
    return changes.filter(F.col("op") != DELETE).select(*TABLES[table].fieldNames(), F.col("new_span").alias("span"))


def _rewrite(lake: Lake, table: str, changes: DataFrame) -> list:
    """Bring the state of a table by span to the batch's changes; returns the spans touched."""
    key, log = PRIMARY_KEYS[table], state_log(table)
    spans = values(changes, "old_span", "new_span")
    rows, read, state = _upserts(changes, table), None, lake.read_log(log)
    if state is not None:
        read = state.filter(F.col("span").isin(*spans))
        others = read.join(changes.select(key), key, "left_anti")
        rows = rows.unionByName(others.select(*rows.columns))
    replace(lake, log, rows, "span", spans, read)
    return spans


def land_orders(lake: Lake, batch: DataFrame, batch_id: int, grain: str = "day") -> DataFrame | None:
    """Land changes of orders; returns them as logged, with ``old_span`` and ``new_span``, None where there are none.

    ``batch`` has the columns of the contract, ``op`` (upsert or delete) and ``seq``, which grows with every change of a key.
    Payments of orders that came, went or moved follow them.
    """
    key, index = PRIMARY_KEYS["orders"], KeyIndex(lake, "orders", PRIMARY_KEYS["orders"])
    goes_to = F.when(F.col("op") != DELETE, span_of(EVENT_TIMES["orders"], grain))
    changes = once(
        lake,
        change_log("orders"),
        batch_id,
        lambda: accepted(batch, key, index.find(batch), {"old_span": (F.col("span"), "date")}).withColumn("new_span", goes_to),
    )
    if changes is None:
        return None
    _rewrite(lake, "orders", changes)
    _follow(lake, changes, batch_id)
    index.put(changes.select(key, "seq", F.col("new_span").alias("span")))
    return changes


def land_payments(lake: Lake, batch: DataFrame, batch_id: int) -> DataFrame | None:
    """Land changes of payments beside their orders; as ``land_orders``."""
    key, index = PRIMARY_KEYS["payments"], KeyIndex(lake, "payments", PRIMARY_KEYS["payments"])
    orders = KeyIndex(lake, "orders", PRIMARY_KEYS["orders"])

    def make() -> DataFrame:
        changes = accepted(batch, key, index.find(batch), {"old_span": (F.col("span"), "date")})
        places = orders.find(batch, "order_id")
        if places is None:
            return changes.withColumn("new_span", F.when(F.col("op") != DELETE, F.lit(NO_SPAN)))
        placed = changes.join(places.select(F.col("order_id").alias("_order"), F.col("span").alias("_span")), F.col("order_id") == F.col("_order"), "left")
        return placed.withColumn("new_span", F.when(F.col("op") != DELETE, F.coalesce("_span", F.lit(NO_SPAN)))).drop("_order", "_span")

    changes = once(lake, change_log("payments"), batch_id, make)
    if changes is None:
        return None
    _rewrite(lake, "payments", changes)
    index.put(changes.select(key, "seq", F.col("new_span").alias("span")))
    return changes


def _follow(lake: Lake, orders: DataFrame, batch_id: int) -> None:
    """Move the payments of orders that came, went or moved to the span of their order."""
    state = lake.read_log(state_log("payments"))
    if state is None:
        return
    moved = orders.filter(~F.col("old_span").eqNullSafe(F.col("new_span")))
    moved = moved.select(F.col("order_id").alias("_order"), F.coalesce("new_span", F.lit(NO_SPAN)).alias("new_span"))

    def make() -> DataFrame:
        places = {*values(orders, "old_span"), NO_SPAN}
        here = state.filter(F.col("span").isin(*places)).join(moved, F.col("order_id") == F.col("_order"))
        here = here.withColumnRenamed("span", "old_span").filter("old_span <> new_span")
        return here.drop("_order").withColumn("op", F.lit(UPSERT))

    followers = once(lake, "changes/followers", batch_id, make)
    if followers is None:
        return
    _rewrite(lake, "payments", followers)
    index = KeyIndex(lake, "payments", PRIMARY_KEYS["payments"])
    known = index.find(followers).select("payment_id", "seq")
    index.put(known.join(followers.select("payment_id", F.col("new_span").alias("span")), "payment_id"))


def _seen_by_facts(row: str, table: str) -> Column:
    """What facts depend on in a row of a dimension: the describing columns, and what its rules look at."""
    names = TABLES[table].fieldNames()
    prices = [F.col(f"{row}.{name}") < 0 for name in ("unit_price", "cost") if name in names]
    return F.struct(*[F.col(f"{row}.{name}") for name in DESCRIBING[table]], *[F.col(f"{row}.{name}").isNull() for name in names], *prices)


def land_dimension(lake: Lake, table: str, batch: DataFrame, batch_id: int) -> DataFrame | None:
    """Land changes of customers or products; ``touches`` says whether anything facts depend on is another than before."""
    key, log = PRIMARY_KEYS[table], state_log(table)
    columns = TABLES[table].fieldNames()
    state = lake.read_log(log)
    ranges = values(batch.select(range_of(key).alias("range")), "range")
    mine = None if state is None else state.filter(F.col("range").isin(*ranges)) if ranges else state.limit(0)

    def make() -> DataFrame:
        kind = T.StructType([T.StructField(field.name, field.dataType) for field in TABLES[table].fields]).simpleString()
        rows = accepted(batch, key, mine, {"_old": (F.when(~F.col("gone"), F.struct(*columns)), kind)})
        new = F.when(F.col("op") != DELETE, F.struct(*columns))
        rows = rows.withColumn("_new", new)
        same = (F.col("_old").isNull() == F.col("_new").isNull()) & (F.col("_old").isNull() | _seen_by_facts("_old", table).eqNullSafe(_seen_by_facts("_new", table)))
        return rows.withColumn("touches", ~same).drop("_old", "_new")

    changes = once(lake, change_log(table), batch_id, make)
    if changes is None:
        return None
    rows = changes.select(*columns, "seq", (F.col("op") == DELETE).alias("gone")).withColumn("range", range_of(key))
    if mine is not None:
        rows = rows.unionByName(mine.join(changes.select(key), key, "left_anti").select(*rows.columns))
    lake.overwrite_days(rows, log, "range")
    return changes


def land(lake: Lake, table: str, batch: DataFrame, batch_id: int, grain: str = "day") -> DataFrame | None:
    """Land changes of any of the four tables. Rows without a key cannot be placed; they are kept in ``unkeyed/<table>``."""
    unkeyed = batch.filter(F.col(PRIMARY_KEYS[table]).isNull()).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    lake.overwrite_days(unkeyed, f"unkeyed/{table}", "batch_id")
    if table == "orders":
        return land_orders(lake, batch, batch_id, grain)
    if table == "payments":
        return land_payments(lake, batch, batch_id)
    return land_dimension(lake, table, batch, batch_id)


def current(lake: Lake, table: str, spans: Iterable | None = None) -> DataFrame:
    """The rows of a table after all changes landed so far; of orders and payments those of some spans only, if asked."""
    rows = lake.read_log(state_log(table))
    names = TABLES[table].fieldNames()
    if rows is None:
        return lake.spark.createDataFrame([], TABLES[table])
    if table in DESCRIBING:
        return rows.filter(~F.col("gone")).select(*names)
    if spans is not None:
        spans = list(spans)
        rows = rows.filter(F.col("span").isin(*spans)) if spans else rows.limit(0)
    return rows.select(*names)
