"""Token-id files: documents in ascending id order, encoded as shards of ``rans``.

Rows are range-partitioned by (doc_id, hash of the text), sorted and encoded in one pass; a task keeps one shard of about
``SHARD_IDS`` ids in memory, more only where a single document is longer. The container is a Parquet folder with one row per
shard (part, number, n_ids, payload), so writing is committed by Spark, works on any storage Spark can write, and files sort
in id order. Every shard says where it stands in its part; the parts' totals (one row per part) give the rest.

Null texts are empty and have the end id only. Null ids come first and stay null. Repeated rows are documents of their own, next
to each other. An empty table gives an empty folder and no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplane.llm import rans
from shoplane.llm.tokens import encoder

SHARD_IDS = 1 << 21
CONTAINER = "part int, number int, n_ids long, payload binary"


def write(documents: DataFrame, tokenizer: str, folder: str, end_id: int = 2) -> None:
    """Encode every whole text and write the container to ``folder``."""

    def encode(batches):
        encode_text, end = encoder(tokenizer).encode, int(end_id).to_bytes(4, "little")
        part, number, start = TaskContext.get().partitionId(), 0, 0
        doc_ids, lengths, raws, held = [], [], [], 0

        def shard():
            ids = np.frombuffer(b"".join(raws), "<u4").astype(np.int64)
            payload = rans.encode_shard(doc_ids, lengths, ids, part, start)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([held], pa.int64()), pa.array([payload], pa.binary())],
                names=["part", "number", "n_ids", "payload"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = encode_text(text.as_py()) + end
                doc_ids.append(doc_id)
                lengths.append(len(raw) // 4)
                raws.append(raw)
                held += len(raw) // 4
                if held >= SHARD_IDS:
                    yield shard()
                    number, start = number + 1, start + held
                    doc_ids, lengths, raws, held = [], [], [], 0
        if doc_ids:
            yield shard()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    ordered.select("doc_id", "text").mapInArrow(encode, CONTAINER).write.parquet(folder)


def shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(CONTAINER).parquet(folder)


def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files; ``with_ids`` adds the ids."""
    container = shards(spark, folder)
    totals = container.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # one row per part written
    bases, base = {}, 0
    for row in totals:
        bases[row["part"]] = base
        base += row["n"]

    def decode(batches):
        for batch in batches:
            for payload in batch.column(0):
                part, start, doc_ids, lengths, ids = rans.decode_shard(payload.as_py())
                stops = np.cumsum(lengths)
                starts = stops - lengths
                pieces = [ids[a:b].tobytes() for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
                arrays = [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(starts + start + bases[part], pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([zlib.crc32(piece) for piece in pieces], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(piece, "<u4").astype(np.int32) for piece in pieces], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return container.select("payload").mapInArrow(decode, schema)
