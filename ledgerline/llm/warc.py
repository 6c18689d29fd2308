"""Web archives packed in ZIP files, read without extraction (operator 4).

An archive is a ZIP file of stored members: ``archive/data.warc.gz`` (WARC 1.1
records, one gzip member each), ``indexes/index.cdxj`` (a line per record:
key, time, JSON with offset, length and digest) and ``datapackage.json``. The
reader finds the end record of the directory (its ZIP64 form too), walks the
central directory to the stored members, reads the index, and then reads each
record by its byte range.

Of records with equal payloads the one of the largest page_id carries the
payload; the others are revisits that name it and keep the HTTP header with
the payload's length, and its digest.

Scale: a task writes the pages it reads into archives of about
``archive_bytes``, under names of its own, listed in a manifest that Spark
commits; a lost task's files are never listed. Equal payloads are found by an
aggregation over digests; only the digests that occur twice are joined back,
and the planner broadcasts them while they are few, so the pages themselves
need not move. A reader's task holds one record at a time.

Defined cases: null html is an empty payload; null url is left out of the
record; rows that repeat the largest id are responses both; rows without id
count as smaller than any id, and where no equal payload has an id they are
responses; an empty table makes no archive; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import files
from ledgerline.llm.common import scratch_path, stored

ARCHIVE_BYTES = 64 << 20
DATA, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
#: The tables have no time of capture.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed values of the ZIP format.
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def named_page(name: str) -> int | None:
    own = name.strip("<>").rpartition(":")[2]
    return None if own == "none" else int(own)


def clean_url(url: str | None) -> str | None:
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers: int | None,
                revisit: bool) -> bytes:
    """One WARC record."""
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_name(page_id)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append(f"WARC-Target-URI: {clean_url(url)}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_name(refers)}"]
    else:
        block += payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The headers of a WARC record, those of its HTTP message, the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    more = {k.strip().lower(): v.strip() for k, _, v in (
        x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}
    return {"warc": fields, "http": more, "payload": payload}


class Archive:
    """An archive being written."""

    def __init__(self, uri: str):
        self.uri, self.lines, self.at = uri, [], 0
        self.out = files.create(uri)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)

    def add(self, page_id, url, payload: bytes, digest: str, refers, revisit: bool) -> None:
        packed = gzip.compress(make_record(page_id, url, payload, digest, refers, revisit), 6, mtime=0)
        self.data.write(packed)
        entry = {"url": url, "mime": "warc/revisit" if revisit else "text/html", "digest": f"sha1:{digest}",
                 "offset": self.at, "length": len(packed), "filename": DATA.rpartition("/")[2]}
        key = (clean_url(url) or "-").lower()
        self.lines.append(f"{key} {re.sub('[^0-9]', '', DATE)} {json.dumps(entry)}\n")
        self.at += len(packed)

    def close(self) -> dict:
        self.data.close()
        self.zip.writestr(INDEX, "".join(sorted(self.lines)).encode("utf-8", "surrogatepass"))
        self.zip.writestr(PACKAGE, json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "resources": [
            {"name": x.rpartition("/")[2], "path": x} for x in (DATA, INDEX)]}))
        self.zip.close()
        self.out.close()
        return {"path": self.uri, "n_records": len(self.lines), "bytes": self.at}


def members(f, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (method, where its local header is, stored size), from the
    central directory of a ZIP file; ZIP64 too."""
    tail = f.read_at(min(size, 65_557 + 20), max(0, size - 65_557 - 20))
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("no ZIP directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20:at - 16] == LOCATOR64:
        where = struct.unpack_from("<Q", tail, at - 12)[0]
        wide = f.read_at(56, where)
        if wide[:4] != END64:
            raise ValueError("broken ZIP64 directory")
        count, length, start = struct.unpack_from("<QQQ", wide, 32)
    directory = f.read_at(length, start)
    out, at = {}, 0
    for _ in range(count):
        if directory[at:at + 4] != CENTRAL:
            raise ValueError("broken ZIP directory")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, full = struct.unpack_from("<II", directory, at + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", directory, at + 28)
        place, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46:at + 46 + n_name].decode()
        extra = directory[at + 46 + n_name:at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:  # the fields that are full in the short form, in this order
                wide = list(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                full = wide.pop(0) if full == 0xFFFFFFFF else full
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                place = wide.pop(0) if place == 0xFFFFFFFF else place
            extra = extra[4 + n:]
        out[name] = (method, place, packed)
        at += 46 + n_name + n_extra + n_comment
    return out


def data_start(f, place: int) -> int:
    """Where a member's bytes begin, behind its local header."""
    head = f.read_at(30, place)
    if head[:4] != LOCAL:
        raise ValueError("broken ZIP member")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return place + 30 + n_name + n_extra


def archive_records(uri: str) -> Iterator[dict]:
    """The records of one archive, each read by its range, in file order."""
    with files.open_read(uri) as f:
        found = members(f, f.size())
        for name in (INDEX, DATA):
            if name not in found or found[name][0] != 0:
                raise ValueError(f"{uri}: {name} is not a stored member")
        index = f.read_at(found[INDEX][2], data_start(f, found[INDEX][1]))
        base = data_start(f, found[DATA][1])
        entries = [json.loads(x.split(" ", 2)[2]) for x in index.decode("utf-8", "surrogatepass").splitlines()]
        for entry in sorted(entries, key=lambda e: e["offset"]):
            raw = f.read_at(entry["length"], base + entry["offset"])
            yield parse_record(zlib.decompress(raw, 47))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every row of ``pages`` (page_id, url, html); the
    manifest: path, n_records, bytes."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    sums = rows.select("page_id", F.sha1("html").alias("sum"), F.octet_length("html").alias("n"))
    twice = stored(sums.where(F.col("n") >= min_bytes).groupBy("sum").agg(
        F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
        .select(F.col("sum").alias("of"), "first"), "twice")
    marked = rows.withColumn("sum", F.sha1("html")).join(twice, F.col("sum") == F.col("of"), "left")
    refers = F.when((F.octet_length("html") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        done = []
        for batch in batches:
            ids, urls, refs = (batch.column(k).to_pylist() for k in (0, 1, 3))
            payloads = batch.column(2).cast(pa.binary())
            for i, payload in enumerate(payloads):
                if archive is None:
                    archive = Archive(files.new_name(folder, "pages", ".wacz"))
                raw = payload.as_py()
                archive.add(ids[i], urls[i], raw, digest32(raw), refs[i], refs[i] is not None)
                if archive.at >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        yield pa.RecordBatch.from_pylist(done, schema=pa.schema(
            [("path", pa.string()), ("n_records", pa.int64()), ("bytes", pa.int64())]))

    return stored(marked.select("page_id", "url", "html", refers.alias("refers"))
                  .mapInArrow(run, "path string, n_records long, bytes long"), "archives")


def read_records(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """page_id, url, record_type, payload_bytes, payload_digest, refers_to and
    (on demand) the payload of every record of the archives listed."""
    kind = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * payload
    schema = pa.schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                held, size = [], 0
                for x in archive_records(uri):
                    warc, revisit = x["warc"], x["warc"]["warc-type"] == "revisit"
                    digest = warc["warc-payload-digest"].partition(":")[2]
                    if not revisit and digest32(x["payload"]) != digest:
                        raise ValueError(f"{uri}: {warc['warc-record-id']} does not have its digest")
                    held.append({"page_id": named_page(warc["warc-record-id"]), "url": warc.get("warc-target-uri"),
                                 "record_type": warc["warc-type"], "payload_digest": digest,
                                 "payload_bytes": int(x["http"]["content-length"]) if revisit else len(x["payload"]),
                                 "refers_to": named_page(warc["warc-refers-to"]) if revisit else None,
                                 "payload": None if revisit else x["payload"]})
                    size += len(x["payload"]) if payload else 256
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    shape = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    rows = manifest.select("path").repartition(4 * manifest.sparkSession.sparkContext.defaultParallelism)
    return rows.mapInArrow(run, shape + ", payload binary" * payload)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives to the shared folder and read every record back."""
    folder = scratch_path(pages.sparkSession, "archives")
    found = read_records(write_archives(pages, folder, min_bytes, archive_bytes), payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
