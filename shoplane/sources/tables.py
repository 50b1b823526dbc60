"""Reading the operational source and keeping the lane's own tables.

The lane's tables are parquet folders under one root. A rebuilt table goes into a new version folder and becomes
current only when a row naming it is appended to the small version table, so readers never see half a table and a job
that dies leaves the old version in place. Facts that change day by day are overwritten partition by partition.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplane.contracts import INCIDENTS, PRIMARY_KEYS, TABLES
from shoplane.operators.numbering import append_with_keys
from shoplane.operators.reconcile import added_totals

ADJUSTMENTS = "control_adjustments"
READERS = 8  # connections the source has to bear at most

VERSION_SCHEMA = "table_name string, version bigint, path string, schema string"


def jdbc_options(table: str, env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Reader options for the operational database; settings come from ``POSTGRES_*`` with local defaults.

    Every session is read-only on the server side, so the lane cannot change the source.
    """
    env = os.environ if env is None else env
    host, port = env.get("POSTGRES_HOST", "localhost"), env.get("POSTGRES_PORT", "5432")
    return {
        "url": f"jdbc:postgresql://{host}:{port}/{env.get('POSTGRES_DB', 'ecommerce')}",
        "user": env.get("POSTGRES_USER", "postgres"),
        "password": env.get("POSTGRES_PASSWORD", "postgres"),
        "driver": "org.postgresql.Driver",
        "dbtable": f"public.{table}",
        "sessionInitStatement": "SET SESSION CHARACTERISTICS AS TRANSACTION READ ONLY",
        "fetchsize": "10000",
    }


def read_jdbc(spark: SparkSession, table: str, low: int, high: int, readers: int = READERS) -> DataFrame:
    """Rows of a source table read in parallel over key ranges; the bounds only set the stride, no row is lost.

    ``low`` is the key mark of the last sync in an incremental run. Filters on the key go to the database.
    """
    reader = spark.read.format("jdbc").options(**jdbc_options(table))
    if high - low > readers:
        reader = reader.options(
            partitionColumn=PRIMARY_KEYS[table], lowerBound=str(low), upperBound=str(high), numPartitions=str(readers)
        )
    return reader.load()


def read_source(spark: SparkSession, table: str, folder: str) -> DataFrame:
    """A source table exported as parquet."""
    return spark.read.parquet(f"{folder}/{table}")


@dataclass(frozen=True)
class Written:
    """A version folder and its schema as JSON."""

    path: str
    schema: str


class Lake:
    """The lane's tables under one root folder, written by one job at a time."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _load(self, path: str, schema=None) -> DataFrame | None:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        try:
            return reader.parquet(path)
        except AnalysisException as problem:
            if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no folder, or one without a file
                return None
            raise

    def current(self) -> dict[str, Row]:
        """The current version of every table: one row per table, read in one job."""
        versions = self._load(f"{self.root}/_versions", VERSION_SCHEMA)
        if versions is None:
            return {}
        newest = F.max_by(F.struct("version", "path", "schema"), "version").alias("row")
        return {found.table_name: found.row for found in versions.groupBy("table_name").agg(newest).collect()}

    def read(self, table: str) -> DataFrame | None:
        """The current version of ``table``, or None before the first."""
        row = self.current().get(table)
        return None if row is None else self.open(Written(row.path, row.schema))

    def open(self, written: Written) -> DataFrame:
        """A written version, current or not."""
        schema = T.StructType.fromJson(json.loads(written.schema))
        return self.spark.read.schema(schema).parquet(written.path)

    def write(self, df: DataFrame, table: str, partition_by: str | None = None) -> Written:
        """Write ``df`` to a fresh folder; it is not current until ``publish``.

        A partitioned table is rebalanced first: rows of a partition meet in few files, and one with very many rows is
        split over several tasks. An unpartitioned one is written as it comes, without a shuffle.
        """
        path = f"{self.root}/{table}/{uuid.uuid4().hex}"
        if partition_by is None:
            df.write.mode("errorifexists").parquet(path)
        else:
            balanced = df.hint("rebalance", F.col(partition_by))
            balanced.write.mode("errorifexists").partitionBy(partition_by).parquet(path)
        return Written(path, df.schema.json())

    def publish(self, tables: Mapping[str, Written]) -> None:
        """Make written tables current, all in one append."""
        current = self.current()
        rows = [
            (table, current[table].version + 1 if table in current else 1, written.path, written.schema)
            for table, written in tables.items()
        ]
        named = self.spark.createDataFrame(rows, VERSION_SCHEMA).coalesce(1)
        named.write.mode("append").parquet(f"{self.root}/_versions")

    def replace(self, df: DataFrame, table: str, partition_by: str | None = None) -> DataFrame:
        """Write and publish a whole table."""
        written = self.write(df, table, partition_by)
        self.publish({table: written})
        return self.open(written)

    def log_path(self, log: str) -> str:
        """Folder of an append-only or day-partitioned table, which has no versions."""
        return f"{self.root}/logs/{log}"

    def read_log(self, log: str, schema=None) -> DataFrame | None:
        """An append-only or day-partitioned table, or None before its first row."""
        return self._load(self.log_path(log), schema)

    def append(self, df: DataFrame, log: str, partition_by: str | None = None) -> None:
        """Append rows to a log."""
        writer = df.write.mode("append")
        (writer if partition_by is None else writer.partitionBy(partition_by)).parquet(self.log_path(log))

    def overwrite_days(self, df: DataFrame, log: str, *partition_by: str, balance: bool = True) -> None:
        """Replace exactly the partitions ``df`` has rows for; repeating a write leaves the same rows.

        Without ``balance`` every task writes the rows it has, without a shuffle: for rows of a single partition.
        """
        balanced = df.hint("rebalance", *[F.col(name) for name in partition_by]) if balance else df
        balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(
            self.log_path(log)
        )

    def drop_partitions(self, log: str, partition: str, values: Iterable) -> None:
        """Take whole partitions out of a log; one that is not there is passed over."""
        for value in values:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.log_path(log)}/{partition}={value}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def refresh(self, tables: Mapping[str, DataFrame]) -> None:
        """Replace the four business tables; the incident ledger is left alone."""
        self.publish({f"raw_{table}": self.write(tables[table], f"raw_{table}") for table in TABLES})

    def ledger(self) -> DataFrame:
        """The incident ledger, fenced off from the business tables; empty before its first row."""
        rows = self.read_log("_control/injected_incidents", INCIDENTS)
        return self.spark.createDataFrame([], INCIDENTS) if rows is None else rows

    def record(self, incidents: DataFrame, as_of) -> None:
        """Append ``failure_key, detail`` rows to the ledger under fresh ids."""
        rows = incidents.withColumn("injected_at", as_of)
        _, keyed = append_with_keys(self.ledger().select(*INCIDENTS.fieldNames()), rows, "incident_id")
        self.append(keyed, "_control/injected_incidents", "failure_key")

    def closed_totals(self) -> DataFrame | None:
        """Stored totals of closed days plus the late rows that published builds found since, which a table of its own holds."""
        return added_totals(self.read_log("control_totals"), self.read(ADJUSTMENTS))

    def store_control_totals(self, totals: DataFrame) -> None:
        """Append totals of days closed since the last time; a stored day is never changed, late rows are adjustments."""
        stored = self.read_log("control_totals")
        fresh = totals
        if stored is not None:
            last = stored.agg(F.max("day").alias("_last"))
            fresh = totals.join(F.broadcast(last), F.col("_last").isNull() | (F.col("day") > F.col("_last"))).drop("_last")
        self.append(fresh.coalesce(1), "control_totals")

