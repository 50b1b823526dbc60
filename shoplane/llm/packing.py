"""Best-fit packing of tokenised documents, planned on the histogram of lengths.

1. Every document becomes pieces of at most ``capacity`` tokens (only longer ones are cut).
2. The histogram of piece lengths has at most ``capacity`` rows whatever the corpus. Best fit in decreasing order runs on
   its counts: a group is a run of equal bins, and a step places one length into as many bins of the tightest group as
   there are pieces or room for. The plan is a list of runs (length, ranks, first bin, pieces per bin, offset).
3. Each piece gets a rank within its length, and the run that covers its rank gives its sequence and offset. A length is
   dealt over as many buckets as its count needs, so no task ranks more than about ``PER_BUCKET`` pieces of a length.

Null texts are empty documents. Each row is a document of its own: repeated ids or rows are packed separately, ties between
equal pieces are broken by crc and are interchangeable. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplane.llm.common import stored
from shoplane.llm.tokens import CACHE_WORDS, encoder

PER_BUCKET = 2000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(documents: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False, cache_words: int = CACHE_WORDS) -> DataFrame:
    """The pieces of every document; ``with_ids`` adds their ids as an array. ``cache_words`` bounds what a worker keeps, not the result."""
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def cut(batches):
        end = int(end_id).to_bytes(4, "little")
        encode = encoder(path, cache_words).encode
        for batch in batches:
            ids, columns = batch.column(0).to_pylist(), [[], [], [], [], [], []]
            texts = batch.column(1)
            for doc_id, text in zip(ids, texts, strict=True):
                raw = encode(text.as_py()) + end
                for piece, at in enumerate(range(0, len(raw), capacity * 4)):
                    part = raw[at : at + capacity * 4]
                    values = (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    for column, value in zip(columns, values, strict=False):
                        column.append(value)
                    if with_ids:
                        columns[5].append(np.frombuffer(part, "<i4"))
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=False)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(columns[5], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit, longest first, on counts: runs of (length, first rank, first bin, pieces per bin, offset).

    Open groups are held by free room; bins of equal room lie in contiguous runs, and each step either moves a whole group
    to less room or ends the length, so the work depends on the number of lengths, not of pieces.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    rooms: list[int] = []
    open_bins: dict[int, list[tuple[int, int]]] = {}
    bins = 0

    def keep(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in open_bins:
                bisect.insort(rooms, room)
                open_bins[room] = []
            open_bins[room].append((first, n))

    for length in sorted((value for value in counts if counts[value]), reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                full, rest = divmod(left, each)
                for n, count in ((full, each), (1 if rest else 0, rest)):
                    if n:
                        runs.append((length, rank, bins, count, 0))
                        keep(capacity - count * length, bins, n)
                        rank += n * count
                        bins += n
                break
            room = rooms[at]
            first, n = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[at]
            each = min(room // length, left)
            full = min(n, left // each)
            runs.append((length, rank, first, each, capacity - room))
            keep(room - each * length, first, full)
            keep(room, first + full, n - full)
            rank += full * each
            left -= full * each
    return runs


def pack(parts: DataFrame, capacity: int = 4096) -> DataFrame:
    """``parts`` with sequence_id and offset. Takes what ``pieces`` returns; reads it three times, so pass a stored table."""
    counts = {row["length"]: row["count"] for row in parts.groupBy("length").count().collect()}  # at most ``capacity`` rows
    if not counts:
        return parts.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    spark = parts.sparkSession
    steps = np.array(plan(counts, capacity), np.int64)
    buckets = [0] * (capacity + 1)
    for length, count in counts.items():
        buckets[length] = -(-count // PER_BUCKET)
    n_buckets = F.element_at(F.lit(buckets), F.col("length").cast("int") + 1)
    salted = parts.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), n_buckets))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = salted.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    firsts = firsts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("_rank", F.row_number().over(within) - 1).join(firsts, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_first")).drop("_first", "_bucket")
    # Runs of one length follow each other in rank, so (length, first rank) is in order per length.
    ordered = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    shared = spark.sparkContext.broadcast(ordered)

    def place(batches):
        lengths, firsts_, bins, each, offsets = shared.value.T
        starts = np.searchsorted(lengths, np.arange(capacity + 2))
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
            run = np.empty(len(length), np.int64)
            for value in np.unique(length):
                mine = length == value
                low, high = starts[value], starts[value + 1]
                run[mine] = low + np.searchsorted(firsts_[low:high], rank[mine], "right") - 1
            step = rank - firsts_[run]
            sequence = bins[run] + step // each[run]
            offset = offsets[run] + step % each[run] * length
            kept = [name for name in batch.schema.names if name != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in kept] + [pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"]
            )

    fields = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in ranked.schema if field.name != "_rank")
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long").select(*parts.columns, "sequence_id", "offset")


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from placed pieces that carry ``ids``; a sequence has ``capacity`` ids at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))


def pack_documents(documents: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, cache_words: int = CACHE_WORDS) -> DataFrame:
    return pack(stored(pieces(documents, path, capacity, end_id, cache_words=cache_words), "pieces"), capacity)
