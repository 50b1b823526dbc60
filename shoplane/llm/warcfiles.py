"""WARC records: headers, digests and streaming reads of gzip-compressed archives, one gzip member a record."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def sha1_base32(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_uri(*parts: object) -> str:
    """A repeatable record id from what identifies a record."""
    raw = hashlib.sha256("|".join(map(str, parts)).encode()).digest()[:16]
    return f"<urn:uuid:{uuid.UUID(bytes=raw, version=5)}>"


def safe_uri(url: str) -> str:
    """Controls and blanks percent-encoded, so that no address can break a header."""
    return _UNSAFE.sub(lambda found: f"%{ord(found[0]):02X}", url)


def compressed(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member without a time stamp, so equal records have equal bytes."""
    lines = ["WARC/1.1", *[f"{name}: {value}" for name, value in headers], f"WARC-Block-Digest: sha1:{sha1_base32(block)}"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def info(name: str, date: str) -> bytes:
    """The warcinfo record that opens a file."""
    headers = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_uri("info", name)), ("WARC-Date", date), ("WARC-Filename", name)]
    return compressed([*headers, ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")


def page(page_id: int | None, url: str | None, payload: bytes, record_id: str, date: str, refers: tuple[int | None, str] | None) -> bytes:
    """A response with its payload, or a revisit of (page_id, record id) ``refers`` with the HTTP head alone."""
    headers = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", record_id),
        ("WARC-Date", date),
        ("WARC-Target-URI", safe_uri(url) if url else f"urn:page:{page_id}"),
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if refers is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", refers[1])]
        if refers[0] is not None:
            headers.append(("X-Refers-To-Page", str(refers[0])))
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return compressed(headers, block + payload if refers is None else block)


@dataclass(frozen=True)
class Page:
    """A page record read back; ``payload`` is None for a revisit."""

    page_id: int | None
    url: str
    payload_bytes: int
    digest: str
    revisit: bool
    refers_to: int | None
    payload: bytes | None


def _fields(stream: io.BufferedReader) -> tuple[str, dict[str, str]] | None:
    first = stream.readline()
    if not first:
        return None
    fields = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().rstrip("\r\n").partition(": ")
        fields[name.lower()] = value
    return first.decode().strip(), fields


def read_pages(raw) -> Iterator[Page]:
    """The page records of an archive, one in memory at a time; raises where a digest or a length is wrong."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw))
    while (head := _fields(stream)) is not None:
        version, fields = head
        length = int(fields["content-length"])
        block = stream.read(length)
        if not version.startswith("WARC/") or len(block) != length or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"broken record {fields.get('warc-record-id')}")
        if fields["warc-block-digest"] != f"sha1:{sha1_base32(block)}":
            raise ValueError(f"block digest of {fields['warc-record-id']} is wrong")
        kind = fields["warc-type"]
        if kind not in ("response", "revisit"):
            continue
        http = io.BufferedReader(io.BytesIO(block))
        size = int(_fields(http)[1]["content-length"])
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        payload = http.read() if kind == "response" else None
        if payload is not None and (len(payload) != size or sha1_base32(payload) != digest):
            raise ValueError(f"payload digest of {fields['warc-record-id']} is wrong")
        page_id, refers = fields.get("x-page-id"), fields.get("x-refers-to-page")
        yield Page(
            None if page_id is None else int(page_id),
            fields["warc-target-uri"],
            size,
            digest,
            kind == "revisit",
            None if refers is None else int(refers),
            payload,
        )
