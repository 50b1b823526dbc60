"""Pages as sharded WARC archives: range-sorted, rolled by compressed size, committed by a manifest, read back and verified.

A narrow pass finds the response of every payload that occurs more than once, so a revisit knows what it refers to before
anything is written. Cut points come from a sample drawn by hash, which no partitioning or rerun changes; rows go to their shard
by page_id, hash of the payload and place in the input files, together with one small row per revisit, and are sorted, so a task
writes its shard as a stream and never looks anything up. Pages are shuffled once. A row's place is its file and row number, which
no split of the files changes; a DataFrame that is not a plain table is stored first. Equal tables give equal archives.

Every task writes under names of its own in ``_temporary`` and reports its files. Those of successful attempts are then moved to
their final names, which can be repeated, and the manifest table is written last: readers see the files it lists or none. What a
failed attempt left is not listed. Paths are opened with ``pyarrow.fs``, so any storage it knows will do (file, hdfs, s3, gs).

Null html is an empty payload. A null page_id sorts first, never makes a record the response while the payload has a record with
an id, and comes back as null. Repeated rows are records of their own: the first is the response, the others revisit it under
the same page_id. A null or empty url is written as ``urn:page:<page_id>``; controls and blanks in one are percent-encoded. An
empty table gives a manifest without files and no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplane.llm import warcfiles
from shoplane.llm.common import stored
from shoplane.llm.firsts import with_first

#: Bytes of payload a shard has on average; a shard is one task. At least and at most so many shards.
SHARD_BYTES, LEAST_SHARDS, MOST_SHARDS = 256 << 20, 64, 10_000
#: A file is closed at this compressed size, one record more at most.
FILE_BYTES = 16 << 20
#: Rows sampled per shard for the cut points, as expected; MOST_SHARDS bounds what reaches the driver.
SAMPLED = 32
DATE = "1970-01-01T00:00:00Z"
FILES = "shard int, number int, name string, temporary string, records long, bytes long, sha1 string"
TEMPORARY = "_temporary"
KEY = ("page_id", "sha", "file", "at")


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _rows(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, its hash, and the row's place (file, at)."""
    picked = [F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")]
    if pages._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        pages = stored(pages.select(*picked), "pages")
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(*picked, *place).withColumn("payload", payload).withColumn("sha", F.unhex(F.sha2("payload", 256))).drop("html")


def _cuts(narrow: DataFrame, shard_bytes: int, least_shards: int) -> tuple[int, list[tuple]]:
    """The number of shards and the keys (no id first, then page_id, sha, file, at) at which one ends and the next begins."""
    n, size = narrow.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    shards = min(max(least_shards, -(-size // shard_bytes)), MOST_SHARDS)
    share = min(1.0, SAMPLED * shards / max(n, 1))
    drawn = F.pmod(F.xxhash64(F.lit(11), "page_id", "sha", "at"), F.lit(1 << 30)) < int(share * (1 << 30))
    drawn_rows = narrow.filter(drawn).collect()  # SAMPLED * MOST_SHARDS expected at most, some 50 bytes each
    sample = sorted((row["page_id"] is not None, row["page_id"] or 0, bytes(row["sha"]), row["file"], row["at"], row["size"]) for row in drawn_rows)
    if not sample:
        return shards, []
    weight = np.cumsum([row[-1] + 1024 for row in sample])
    places = np.searchsorted(weight, weight[-1] * np.arange(1, shards) / shards)
    return shards, sorted({sample[place][:-1] for place in places})


def _shard_of(cuts: list[tuple]):
    """The shard of a key: how many cuts lie at or before it."""
    ids = np.array([page_id if known else np.iinfo(np.int64).min for known, page_id, *_ in cuts], np.int64)

    @F.pandas_udf("int")
    def shard(page_id: pd.Series, known: pd.Series, sha: pd.Series, file: pd.Series, at: pd.Series) -> pd.Series:
        missing = ~known.to_numpy(bool)
        numbers = np.where(missing, np.iinfo(np.int64).min, page_id.to_numpy(np.int64))
        low, high = np.searchsorted(ids, numbers, "left"), np.searchsorted(ids, numbers, "right")
        for place in np.flatnonzero(low < high):
            key = (not missing[place], 0 if missing[place] else int(numbers[place]), bytes(sha.iat[place]), int(file.iat[place]), int(at.iat[place]))
            high[place] = bisect_right(cuts, key)
        return pd.Series(high.astype(np.int32))

    return shard


def _revisits(narrow: DataFrame, least_bytes: int) -> DataFrame:
    """One row per record that is not the response of its payload, with the response's page_id."""
    order = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "file", "at")
    found = with_first(narrow.filter(F.col("size") >= least_bytes), "sha", order, "first")
    others = found.filter(F.col("first").isNotNull() & ((F.col("first.file") != F.col("file")) | (F.col("first.at") != F.col("at"))))
    return others.select("page_id", "sha", "file", "at", F.col("first.page_id").alias("refers"))


class _Shard:
    """The open file of a shard, rolled by compressed size."""

    def __init__(self, folder: str, prefix: str, shard: int, file_bytes: int, date: str):
        self.fs, self.path = _opened(folder)
        self.prefix, self.shard, self.file_bytes, self.date = prefix, shard, file_bytes, date
        self.number, self.written, self.out = 0, 0, None

    def add(self, record: bytes) -> tuple | None:
        """Write a record; the finished file's row if this one filled it."""
        if self.out is None:
            self.name = f"{self.prefix}-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{TEMPORARY}/{self.name}.{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(f"{self.path}/{self.temporary}", compression=None)
            self.records, self.bytes, self.sha1 = 0, 0, hashlib.sha1()
            self._put(warcfiles.info(self.name, self.date))
        self._put(record)
        self.records += 1
        self.written += 1
        return self.close() if self.bytes >= self.file_bytes else None

    def _put(self, raw: bytes) -> None:
        self.out.write(raw)
        self.sha1.update(raw)
        self.bytes += len(raw)

    def close(self) -> tuple | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        self.number += 1
        return (self.shard, self.number - 1, self.name, self.temporary, self.records, self.bytes, self.sha1.hexdigest())


def _file_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = [part.split()[0] for part in FILES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(column), kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def write(
    pages: DataFrame,
    folder: str,
    least_bytes: int = 0,
    shard_bytes: int = SHARD_BYTES,
    least_shards: int = LEAST_SHARDS,
    file_bytes: int = FILE_BYTES,
    prefix: str = "pages",
    date: str = DATE,
) -> DataFrame:
    """Write the archives of ``pages`` to the new ``folder``; returns the manifest, one row per file.

    Of records with equal payloads of ``least_bytes`` or more, that with the smallest page_id is a response, the others revisit it.
    """
    rows = _rows(pages)
    narrow = stored(rows.select("page_id", "sha", "file", "at", F.octet_length("payload").cast("long").alias("size")), "page-keys")
    revisits = stored(_revisits(narrow, least_bytes), "revisits")
    shards, cuts = _cuts(narrow, shard_bytes, least_shards)
    shard = _shard_of(cuts)

    def dealt(frame: DataFrame, kind: int, **columns: Column) -> DataFrame:
        known = F.col("page_id").isNotNull()
        number = shard(F.coalesce("page_id", F.lit(0)), known, "sha", "file", "at").alias("shard")
        return frame.select(number, *KEY, F.lit(kind).alias("kind"), *[column.alias(name) for name, column in columns.items()])

    nothing = {"refers": F.lit(None).cast("long")}
    records = dealt(rows, 1, url=F.col("url"), payload=F.col("payload"), **nothing)
    marks = dealt(revisits, 0, url=F.lit(None).cast("string"), payload=F.lit(None).cast("binary"), refers=F.col("refers"))
    placed = records.unionByName(marks).repartitionById(shards, "shard").sortWithinPartitions(*KEY, "kind")
    system, path = _opened(folder)
    system.create_dir(f"{path}/{TEMPORARY}", recursive=True)

    def archive(batches):
        current, mark, files = None, None, []
        for batch in batches:
            columns = [batch.column(place) for place in range(batch.num_columns)]
            for place in range(batch.num_rows):
                number, page_id, sha, file, at, kind, url, payload, refers = (column[place].as_py() for column in columns)
                if kind == 0:
                    mark = (file, at, refers)
                    continue
                if current is None:
                    current = _Shard(folder, prefix, number, file_bytes, date)
                digest, revisit = sha.hex(), mark is not None
                if revisit and mark[:2] != (file, at):
                    raise ValueError("a revisit's page is missing: the table changed while it was read")
                own = (number, current.written) if revisit or len(payload) < least_bytes else (page_id, digest)
                target = (mark[2], warcfiles.record_uri(mark[2], digest)) if revisit else None
                done, mark = current.add(warcfiles.page(page_id, url, payload, warcfiles.record_uri(*own), date, target)), None
                if done:
                    files.append(done)
            if files:
                yield _file_rows(files)
                files = []
        if current is not None and (done := current.close()):
            yield _file_rows([done])

    pending = stored(placed.mapInArrow(archive, FILES), "archives")
    return _commit(pending, folder)


def _commit(pending: DataFrame, folder: str) -> DataFrame:
    """Move the reported files to their names, then write the manifest; a repeated move finds its work done."""

    def move(batches):
        system, path = _opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                final, temporary = f"{path}/{row['name']}", f"{path}/{row['temporary']}"
                if system.get_file_info(temporary).type != fs.FileType.NotFound:
                    system.move(temporary, final)
                elif system.get_file_info(final).size != row["bytes"]:
                    raise FileNotFoundError(f"{row['name']} was reported but is not there")
            yield batch

    pending.mapInArrow(move, FILES).write.parquet(f"{folder}/manifest")
    system, path = _opened(folder)
    system.delete_dir(f"{path}/{TEMPORARY}")  # what failed attempts left; every reported file has been moved
    return manifest(pending.sparkSession, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(FILES).parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record of the listed files, every digest checked.

    One file at a time per task and one record at a time in memory. ``with_payload`` adds url and payload (null for a revisit).
    """
    listed = manifest(spark, folder)
    files = min(max(listed.count(), 1), MOST_SHARDS)
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + ([pa.string(), pa.binary()] if with_payload else [])
    schema += ", url string, payload binary" if with_payload else ""
    names = [part.split()[0] for part in schema.split(", ")]

    def rows_of(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    def parse(batches):
        system, path = _opened(folder)
        for batch in batches:
            for name, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, held, size = 0, [], 0
                with system.open_input_stream(f"{path}/{name}", compression=None) as raw:
                    for page in warcfiles.read_pages(raw):
                        row = (page.page_id, page.payload_bytes, page.digest, "revisit" if page.revisit else "response", page.refers_to)
                        held.append((*row, page.url, page.payload) if with_payload else row)
                        found, size = found + 1, size + (len(page.payload or b"") if with_payload else 64)
                        if size >= 1 << 22:
                            yield rows_of(held)
                            held, size = [], 0
                if found != expected:
                    raise ValueError(f"{name} has {found} records, the manifest says {expected}")
                if held:
                    yield rows_of(held)

    return listed.select("name", "records").repartition(files).mapInArrow(parse, schema)
