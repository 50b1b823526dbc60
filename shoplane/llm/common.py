"""Reading tables, and cutting lineage through tables written to the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplane.session import scratch_path

#: The white space that separates words in every contract: space, and the controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back, so a lost executor costs a reread only."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def with_row_draw(df: DataFrame, name: str, salt: int) -> DataFrame:
    """A draw in [0, 1) for each row of (doc_id, text), of its own also where ids are null or rows repeat.

    A row of a table read from files is known by its number in the file, so its draw is the same however Spark splits the files;
    a row of any other DataFrame by its place in its partition.
    """
    read = "_metadata" in df._jdf.queryExecution().analyzed().metadataOutput().toString()
    place = F.col("_metadata.row_index") if read else F.monotonically_increasing_id()
    return df.withColumn(name, unit_hash(F.struct("doc_id", F.xxhash64("text"), place), salt))


def unit_hash(column: str | Column, salt: int) -> Column:
    """A repeatable draw in [0, 1) for a value."""
    return F.pmod(F.xxhash64(F.lit(salt), column), F.lit(1 << 30)) / float(1 << 30)
