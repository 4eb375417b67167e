r"""ARC to WARC: legacy archive records are parsed by their version's header line and declared length, and equivalent
WARC records are synthesised (identifiers, timestamps, types, digests).

Pages are first written as ARC records (both versions, in turn), then converted, then stored as archives of about
ARCHIVE_BYTES, one row each, in the shared folder; reading parses those archives.

Defined results: a null html is an empty payload; a null url is about:blank; a null page_id is the smallest id and
reads back as null; rows equal in id and payload are all responses if that id is the largest; payloads count as equal
if their SHA-1 and length are. Extra columns are ignored. White space and control characters of a url are
percent-encoded, as ARC header lines are separated by spaces.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_facts, operator, utf8, written

ARCHIVE_BYTES = 4 << 20
#: Field names of the header lines, by version.
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "filename", "length"),
}
ARC_NAMES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"


def sha1_b32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def safe_url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f\x85\xa0]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"


def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 skyloom\n{ARC_NAMES[version]}\n".encode()
    fields = {"url": f"filedesc://{name}", "ip": "0.0.0.0", "date": date, "type": "text/plain", "result": "200", "checksum": "-", "location": "-", "offset": "0", "filename": name, "length": str(len(body))}
    return " ".join(fields[f] for f in ARC_FIELDS[1 if version == 1 else 2]).encode() + b"\n" + body + b"\n"


def arc_record(version: int, url: str, content: bytes, date: str, name: str, offset: int) -> bytes:
    fields = {"url": url, "ip": "0.0.0.0", "date": date, "type": "text/html", "result": "200", "checksum": "-", "location": "-", "offset": str(offset), "filename": name, "length": str(len(content))}
    return " ".join(fields[f] for f in ARC_FIELDS[version]).encode() + b"\n" + content + b"\n"


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records after the version block. The block's second line says the version, which fixes the fields."""
    end = data.index(b"\n")
    length = int(data[:end].rsplit(b" ", 1)[1])
    version = int(data[end + 1 : data.index(b" ", end + 1)])
    names, at = ARC_FIELDS[version], end + 1 + length + 1
    while at < len(data):
        end = data.index(b"\n", at)
        fields = dict(zip(names, data[at:end].decode().split(" "), strict=True))
        length = int(fields["length"])
        content = data[end + 1 : end + 1 + length]
        if len(content) < length:
            raise ValueError("an ARC record is shorter than declared")
        yield fields | {"content": content, "version": version}
        at = end + 1 + length + 1


def headers_of(block: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in block.decode().split("\r\n")[1:]) if k}


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>"


def warcinfo(name: str, date: str) -> bytes:
    """The record that opens an archive."""
    block = b"software: skyloom\r\nformat: WARC File Format 1.1\r\n"
    lines = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id('info:' + name)}", f"WARC-Date: {warc_date(date)}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + CRLF + CRLF + block + CRLF + CRLF


def warc_date(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def warc_record(arc: dict, refers_to: int | None, revisit: bool, place: str) -> bytes:
    """The WARC record of an ARC record; a revisit keeps the HTTP header and leaves the payload out.

    A response is named by its page and payload, so that revisits can point to it; a revisit or a page without an id by its place (archive and number)."""
    head, _, payload = arc["content"].partition(CRLF + CRLF)
    page = headers_of(head).get("x-page-id", "")
    block = head + CRLF + CRLF + (b"" if revisit else payload)
    digest = sha1_b32(payload)
    named = f"{place}:{page}" if revisit or not page else f"page:{page}:{digest}"
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(named)}",
        f"WARC-Date: {warc_date(arc['date'])}", f"WARC-Target-URI: {arc['url']}", f"WARC-IP-Address: {arc['ip']}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_b32(block)}",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(f'page:{refers_to}:{digest}')}", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(lines).encode() + CRLF + CRLF + block + CRLF + CRLF


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        end = data.index(CRLF + CRLF, at)
        headers = headers_of(data[at:end])
        start = end + 4
        stop = start + int(headers["content-length"])
        if not data.startswith(b"WARC/", at) or data[stop : stop + 4] != CRLF + CRLF:
            raise ValueError("not a WARC record")
        yield headers, data[start:stop]
        at = stop + 4


def _convert(date: str):
    def step(batches):
        for batch in batches:
            ids, urls, payloads = batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))
            keepers, revisits = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            done = 0
            while done < len(ids):
                version, name = 1 + done % 2, f"pages-{ids[done]}.arc"
                parts, size, first = [arc_version_block(version, name, date)], 0, done
                while done < len(ids) and size < ARCHIVE_BYTES:
                    mark = "" if ids[done] is None else f"X-Page-Id: {ids[done]}\r\n"
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payloads[done])}\r\n{mark}\r\n".encode()
                    parts.append(arc_record(version, safe_url(urls[done]), head + payloads[done], date, name, sum(map(len, parts[:1])) + size))
                    size += len(parts[-1])
                    done += 1
                target = name.replace(".arc", ".warc")
                warc = warcinfo(target, date) + b"".join(warc_record(r, keepers[first + i], bool(revisits[first + i]), f"{target}:{i}") for i, r in enumerate(parse_arc(b"".join(parts))))
                yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([done - first], pa.int64()), pa.array([warc], pa.binary())], names=["archive", "n_records", "content"])

    return step


def revisits(pages: DataFrame, min_bytes: int) -> DataFrame:
    """id and sha of the rows whose payload another row keeps, and that row's id. Only these small columns are shuffled, those of very common payloads not even once."""
    d = pages.select(F.col("page_id").cast("long").alias("id"), F.sha1(_payload()).alias("sha"), F.octet_length(_payload()).alias("size")).where(F.col("size") >= min_bytes)
    d = written(d.select("id", "sha"), "payloads")
    keep = written(d.groupBy("sha").agg(F.max("id").alias("keeper"), F.count("*").alias("n")).where("n > 1"), "keepers")
    return join_facts(d, keep, "sha").drop("n").where(~F.col("id").eqNullSafe(F.col("keeper"))).distinct()


def _payload():
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


@operator
def write_archives(pages: DataFrame, min_bytes: int = 0, date: str = "20260101000000") -> DataFrame:
    """The WARC archives: name, number of records, bytes; written to the shared folder."""
    again = revisits(pages, min_bytes).select("id", F.col("sha").alias("sha2"), "keeper")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").withColumn("sha", F.sha1(_payload()))
    joined = own.join(again, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("sha") == F.col("sha2")), "left")
    rows = joined.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), "keeper", F.col("sha2").isNotNull().alias("revisit"))
    return written(rows.mapInArrow(_convert(date), "archive string, n_records long, content binary"), "warc")


def _read(batches):
    for batch in batches:
        for content in batch.column(2).to_pylist():
            rows = []
            for headers, block in parse_warc(content):
                if headers["warc-type"] == "warcinfo":
                    continue
                http = headers_of(block.partition(CRLF + CRLF)[0])
                page, refers = http.get("x-page-id"), headers.get("x-refers-to-page-id")
                rows.append((page and int(page), int(http["content-length"]), headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"], int(refers) if refers not in (None, "None") else None))
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


@operator
def read_archives(archives: DataFrame) -> DataFrame:
    return archives.select("archive", "n_records", "content").mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def export(archives: DataFrame, folder: str) -> int:
    """Writes each archive as a file of a folder that the driver sees; archives come one at a time."""
    n = 0
    for n, row in enumerate(archives.select("archive", "content").toLocalIterator(), 1):
        Path(folder, f"{n:06d}-{row[0]}").write_bytes(row[1])
    return n


def digest(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    return read_archives(write_archives(pages, min_bytes))
