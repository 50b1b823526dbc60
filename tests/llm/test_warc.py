"""Archives: what is read back equals a plain computation, files roll, reruns agree, failed attempts leave no trace."""

from __future__ import annotations

import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from corpus_cases import SMALL
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from oracle import compare
from shoplane.llm import queries, warcfiles, warcshards
from shoplane.session import scratch_path

PAGES = "page_id long, url string, html string, sha string, tie string, shard string, kind int"
EXTRA = ("s", "t", "u", 5)


def odd_pages(spark):
    rows = [
        (None, None, None, *EXTRA),
        (None, "http://x/ y\r\nEvil: 1", "same", *EXTRA),
        (7, "http://x/é", "same", *EXTRA),
        (3, "http://x/3", "same", *EXTRA),
        (3, "http://x/3", "same", *EXTRA),
        (3, "http://x/other", "different", *EXTRA),
        (5, "", "", *EXTRA),
        (6, "http://x/6", None, *EXTRA),
        (-9, "http://x/-9", "naïve 日本語 \x00 \r\n\r\nWARC/1.1\r\n", *EXTRA),
        (9, "http://x/9", "long " * 200_000, *EXTRA),
    ]
    return spark.createDataFrame(rows, PAGES).repartition(3)


def expected(rows, least_bytes=0):
    """page_id, bytes, digest, type, refers_to of every row by plain Python, sorted as text."""
    payloads = [(row[0], (row[2] or "").encode()) for row in rows]
    order = sorted(range(len(rows)), key=lambda place: (payloads[place][0] is None, payloads[place][0] or 0))
    first = {}
    for place in order:
        first.setdefault(payloads[place][1], place)
    found = []
    for place, (page_id, payload) in enumerate(payloads):
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = len(payload) >= least_bytes and first[payload] != place
        refers = payloads[first[payload]][0] if revisit else None
        found.append((page_id, len(payload), digest, "revisit" if revisit else "response", refers))
    return sorted(map(str, found))


def read_back(frame):
    return sorted(str(tuple(row)) for row in frame.collect())


@pytest.mark.parametrize("least_bytes", [0, 5])
@pytest.mark.parametrize("shards", [1, 4, 50])
def test_odd_pages_come_back(spark, least_bytes, shards):
    pages = odd_pages(spark)
    folder = scratch_path(spark, "warc-odd")
    warcshards.write(pages, folder, least_bytes=least_bytes, least_shards=shards)
    assert read_back(warcshards.read(spark, folder)) == expected([tuple(row) for row in pages.collect()], least_bytes)


def test_payloads_and_addresses_come_back(spark):
    folder = scratch_path(spark, "warc-payload")
    warcshards.write(odd_pages(spark), folder, least_shards=3)
    rows = warcshards.read(spark, folder, with_payload=True).collect()
    by_id = {row["page_id"]: row for row in rows if row["page_id"] not in (None, 3)}
    assert bytes(by_id[-9]["payload"]).decode() == "naïve 日本語 \x00 \r\n\r\nWARC/1.1\r\n"
    assert by_id[7]["payload"] is None and by_id[7]["url"] == "http://x/é"
    assert by_id[5]["url"] == "urn:page:5" and bytes(by_id[5]["payload"]) == b""
    assert {row["url"] for row in rows if row["page_id"] is None} == {"urn:page:None", "http://x/%20y%0D%0AEvil:%201"}


def test_an_empty_table_gives_no_files(spark):
    folder = scratch_path(spark, "warc-empty")
    listed = warcshards.write(odd_pages(spark).limit(0), folder)
    assert listed.count() == 0 and warcshards.read(spark, folder).count() == 0


def test_files_roll_are_sorted_and_reruns_agree(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    runs = []
    for parts in ("1m", "64k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", parts)
        folder = scratch_path(spark, "warc-roll")
        listed = warcshards.write(pages, folder, least_shards=3, file_bytes=4000)
        runs.append({row["name"]: (row["records"], row["bytes"], row["sha1"]) for row in listed.collect()})
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert runs[0] == runs[1] and len(runs[0]) > 6
    assert sum(records for records, *_ in runs[0].values()) == pages.count()
    local = Path(folder.removeprefix("file://"))
    assert not (local / warcshards.TEMPORARY).exists()
    last = None
    for name in sorted(runs[0]):
        raw = (local / name).read_bytes()
        assert hashlib.sha1(raw).hexdigest() == runs[0][name][2]
        with (local / name).open("rb") as stream:
            ids = [page.page_id for page in warcfiles.read_pages(stream)]
        assert ids == sorted(ids) and (last is None or last < ids[0])
        last = ids[-1]
        assert gzip.decompress(raw).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def test_a_hot_payload_and_a_hot_id_are_spread(spark):
    copies = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 == 1, F.lit(77)).otherwise(F.col("id")).alias("page_id"),
        F.lit("http://x").alias("url"),
        F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.concat(F.lit("page "), F.col("id"))).alias("html"),
    )
    folder = scratch_path(spark, "warc-hot")
    listed = warcshards.write(copies, folder, least_shards=12)
    most = listed.groupBy("shard").agg(F.sum("records").alias("n")).agg(F.max("n")).first()[0]
    assert most < 1500
    found = warcshards.read(spark, folder)
    assert found.filter("record_type = 'revisit'").count() == 1999
    assert found.filter("record_type = 'revisit' and refers_to <> 0").count() == 0


def test_a_moved_file_is_no_error_but_a_lost_one_is(spark):
    folder = scratch_path(spark, "warc-commit")
    listed = warcshards.write(odd_pages(spark), folder, least_shards=1)
    local = Path(folder.removeprefix("file://"))
    row = listed.first()
    (local / warcshards.TEMPORARY).mkdir()
    again = spark.createDataFrame([row], warcshards.FILES)
    (local / "manifest").rename(local / "manifest-before")
    warcshards._commit(again, folder)
    lost = spark.createDataFrame([tuple(row)[:2] + ("gone.warc.gz", "_temporary/gone", 1, 1, "")], warcshards.FILES)
    (local / "manifest").rename(local / "manifest-again")
    with pytest.raises(PythonException, match="gone.warc.gz"):
        warcshards._commit(lost, folder)


def test_a_changed_byte_is_found(spark, tmp_path):
    raw = warcfiles.page(1, "http://x", b"payload", "<urn:uuid:1>", warcshards.DATE, None)
    spoiled = gzip.compress(gzip.decompress(raw).replace(b"payload", b"paxload"))
    for name, content in (("good", raw), ("bad", spoiled)):
        (tmp_path / name).write_bytes(content)
    with (tmp_path / "good").open("rb") as stream:
        assert [page.payload for page in warcfiles.read_pages(stream)] == [b"payload"]
    with (tmp_path / "bad").open("rb") as stream, pytest.raises(ValueError, match="digest"):
        list(warcfiles.read_pages(stream))


def test_the_query_equals_its_sql(spark):
    name = "op11_sharded_warc"
    assert compare(spark, SMALL, queries.queries()[name], queries.oracle_sql()[name]) is None
