"""Incremental sync of orders, late rows included, and streaming views of them.

Change files land in a folder and are read as a stream. Each batch is logged with the spans its keys lay in before
(``sources.keyed``); the spans it touches, however old, are then rebuilt. No watermark decides what counts, so an order dated
weeks back lands like any other, and one that comes back with another moment leaves its old day. Every step overwrites exactly
its own partitions or publishes a new version, so a batch that is run again after a failure leaves the same tables.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplane.contracts import ORDERS, TABLES
from shoplane.functions.scalars import day_of, utc
from shoplane.operators.gates import freshness
from shoplane.operators.staging import deduplicate
from shoplane.plans.marts import fct_daily_revenue
from shoplane.sources import keyed
from shoplane.sources.tables import Lake

STAGED, DAILY, FRESHNESS = "stg_orders", "fct_daily_revenue", "freshness"


def change_stream(
    spark: SparkSession, folder: str, schema: T.StructType | str = ORDERS, files_per_batch: int | None = None, glob: str = "*"
) -> DataFrame:
    """Landed change files as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def table_stream(
    spark: SparkSession, folder: str, table: str, schema: T.StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    """A table as a stream of its files, whether it is one file or a folder of part files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{table}.parquet")
    status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
    if status.isDirectory():
        return change_stream(spark, f"{folder}/{table}.parquet", schema, files_per_batch, "*.parquet")
    return change_stream(spark, folder, schema, files_per_batch, f"{table}.parquet")


def land_batch(
    lake: Lake, batch: DataFrame, batch_id: int, as_of: datetime | None = None, grain: str = "day"
) -> None:
    """Log one batch, rebuild the spans it touches and note how fresh the lane is.

    A span is a day, or a coarser ``grain`` such as a month where days hold few rows. An order may change in anything, its
    moment included: the span it leaves is rebuilt as well as the one it comes to.
    """
    changes = batch.withColumn("op", F.lit(keyed.UPSERT)).withColumn("seq", F.lit(batch_id).cast("bigint"))
    landed = keyed.land_orders(lake, changes, batch_id, grain)
    if landed is None:
        return
    spans = keyed.values(landed, "old_span", "new_span")
    state = lake.read_log(keyed.state_log("orders"))
    before = lake.read_log(STAGED)
    rebuilt = deduplicate(state.filter(F.col("span").isin(*spans)))
    keyed.replace(lake, STAGED, rebuilt, "span", spans, None if before is None else before.filter(F.col("span").isin(*spans)))
    staged, current = lake.read_log(STAGED, rebuilt.schema), lake.read(DAILY)
    lines = fct_daily_revenue(staged.filter(F.col("span").isin(*spans)))
    if current is not None:
        lines = lines.unionByName(current.filter(~keyed.span_of("day", grain).isin(*spans)))
    daily = lake.replace(lines.coalesce(1), DAILY)
    if as_of is not None:
        newest_span = daily.filter(F.col("day") <= day_of(utc(as_of))).agg(F.date_trunc(grain, F.max("day")).cast("date")).first()[0]
        newest = staged.filter(F.col("span") == F.lit(newest_span))  # one partition, not the whole table
        note = freshness({"orders": newest}, utc(as_of)).withColumn("batch_id", F.lit(batch_id))
        lake.overwrite_days(note.coalesce(1), FRESHNESS, "batch_id")


def change_schema(table: str) -> T.StructType:
    """A row of a change file: the table's columns, ``op`` (upsert or delete; a delete needs the key only) and ``seq``."""
    fields = [T.StructField(field.name, field.dataType) for field in TABLES[table].fields]
    return T.StructType([*fields, T.StructField("op", T.StringType()), T.StructField("seq", T.LongType())])


def sync_changes(spark: SparkSession, folder: str, lake: Lake, checkpoint: str, grain: str = "day", files_per_batch: int | None = None) -> None:
    """Land every change file under ``folder/<table>`` that has not landed, table by table, deletes included.

    Tables may come in any order and at any pace; ``plans.refresh`` brings the marts to what has landed.
    """
    for table in TABLES:

        def run(batch: DataFrame, batch_id: int, table: str = table) -> None:
            keyed.land(lake, table, batch, batch_id, grain)

        stream = change_stream(spark, f"{folder}/{table}", change_schema(table), files_per_batch, "*.parquet")
        run_batches(stream, run, f"{checkpoint}/{table}")


def sync_orders(
    stream: DataFrame,
    lake: Lake,
    checkpoint: str,
    as_of: datetime | None = None,
    every: str | None = None,
    grain: str = "day",
):
    """Run ``land_batch`` over the stream: until all landed files are in, or every so often (``every="1 minute"``)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        land_batch(lake, batch, batch_id, as_of, grain)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def _spans(batch: DataFrame, moment: str, grain: str) -> DataFrame:
    """Rows with their span; a zone-less timestamp is read in the session zone, a missing one has a span of its own."""
    timed = batch.withColumn(moment, F.col(moment).cast("timestamp"))
    return timed.withColumn("span", keyed.span_of(moment, grain))


def land_once(lake: Lake, batch: DataFrame, batch_id: int, log: str, key: str, moment: str, grain: str = "month") -> None:
    """Add rows of a batch whose key has not landed yet, however old they are and whatever their moment.

    Repeats inside the batch are reduced first; an index by key tells what has landed, of which only the ranges the batch falls into
    are read. The spans that get rows are rewritten, so files do not add up; a batch that runs again replaces its own rows.
    """
    tagged = _spans(batch, moment, grain)
    others = [name for name in tagged.columns if name != key]
    firsts = tagged.groupBy(key).agg(F.min(F.struct(*others)).alias("_row")).select(key, "_row.*")
    firsts = firsts.select(*tagged.columns).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    index = keyed.KeyIndex(lake, log, key)
    landed = index.find(batch)
    if landed is not None:
        known = landed.filter(F.col("seq") != batch_id).select(key)
        firsts = firsts.join(known, key, "left_anti").select(*firsts.columns)
    lake.overwrite_days(_beside(lake, log, firsts, batch_id), log, "span")
    rows = lake.read_log(log)
    if rows is not None:
        mine = rows.filter(F.col("span").isin(*keyed.values(tagged, "span")) & (F.col("batch_id") == batch_id))
        index.put(mine.select(key, F.col("batch_id").alias("seq"), "span"))


def _beside(lake: Lake, log: str, rows: DataFrame, batch_id: int) -> DataFrame:
    """``rows`` and what other batches have in the spans they fall into."""
    landed = lake.read_log(log)
    spans = [] if landed is None else keyed.values(rows, "span")
    if not spans:
        return rows
    others = landed.filter(F.col("span").isin(*spans) & (F.col("batch_id") != batch_id))
    return rows.unionByName(others.select(*rows.columns))


def land_rate(lake: Lake, batch: DataFrame, batch_id: int, log: str, moment: str, length: str, grain: str = "month") -> None:
    """Add the rows of a batch to the counts of their tumbling windows.

    A count is kept with the batch that changed it last and what it was before, so a batch that runs again adds to what was
    before it. The spans touched are rewritten; there is one set of files per span, whatever the number of batches.
    """
    counted = _spans(batch, moment, grain).groupBy("span", F.window(moment, length).alias("_window")).agg(F.count("*").alias("added"))
    counted = counted.select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), "added", "span")
    zero = F.lit(0).cast("bigint")
    landed, spans = lake.read_log(log), keyed.values(counted, "span")
    if not spans:
        return
    mine = F.lit(batch_id).cast("bigint")
    if landed is None:
        merged = counted.select("window_start", "window_end", F.col("added").alias("rows"), zero.alias("rows_before"), mine.alias("batch_id"), "span")
    else:
        base = F.when(F.col("batch_id") == batch_id, F.col("rows_before")).otherwise(F.col("rows"))
        kept = landed.filter(F.col("span").isin(*spans)).withColumns({"base": base, "added": zero})
        fresh = counted.withColumns({"base": zero, "rows_before": zero, "rows": zero, "batch_id": mine})
        both = kept.select(*fresh.columns).unionByName(fresh)
        summed = both.groupBy("window_start", "window_end", "span").agg(
            F.sum("added").alias("added"), F.sum("base").alias("base"), F.sum("rows").alias("was"), F.sum("rows_before").alias("was_before"), F.min("batch_id").alias("last")
        )
        changed = F.col("added") > 0
        merged = summed.select(
            "window_start",
            "window_end",
            F.when(changed, F.col("base") + F.col("added")).otherwise(F.col("was")).alias("rows"),
            F.when(changed, F.col("base")).otherwise(F.col("was_before")).alias("rows_before"),
            F.when(changed, mine).otherwise(F.col("last")).alias("batch_id"),
            "span",
        )
    lake.overwrite_days(merged, log, "span")


def rate_per_window(lake: Lake, log: str) -> DataFrame | None:
    """Rows per window over all batches so far, late rows and the latest window included."""
    landed = lake.read_log(log)
    return None if landed is None else landed.select("window_start", "window_end", "rows")


def run_batches(stream: DataFrame, land, checkpoint: str) -> None:
    """Call ``land(batch, batch_id)`` for everything there is."""
    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
