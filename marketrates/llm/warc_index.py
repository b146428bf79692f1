"""WARC archives with an index (operator 3).

Writing: each task writes one WARC/1.1 archive, a gzip member per record: a warcinfo record, then one record per page whose block is an HTTP message. It emits an index row per record: file, offset, length, URL, digest. The index is a table; only
rows of tasks that succeeded are in it, so an archive left by a lost executor is never read. Records with equal payloads of MIN_PAYLOAD bytes or more are one
response, at the largest page_id, and revisits that refer to it; a revisit's block is the HTTP head alone, which keeps the payload's length.

Reading: index rows are selected first; those of one stretch of CHUNK bytes of a file are sorted by offset and joined into one byte range where the gap between
them is at most GAP, and each range is read once and cut into its records.

Archives go to the shared folder by pyarrow's file systems (file, hdfs, s3, gs), index tables by Spark. A null payload is empty. Rows of the largest page_id that
repeat are all responses. Null page_ids never are the response others refer to unless all of the group are null. A record's id is made from its page_id, so that
revisits can name it before it is written; rows of equal page_id share it, as their page does. All records of one call bear its date. A null or empty URL is the
URN NO_URL in the archive and empty when read; one that is no URI as it stands is percent-encoded there, and kept beside it as it was. Other columns, whatever
their names, are left out; an empty table gives no archives; a payload of any length is one record, in memory once while it is written or read.
"""

from __future__ import annotations

import base64
import datetime
import gzip
import hashlib
import re
import urllib.parse
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import partitions, scratch, written

MIN_PAYLOAD = 0
CHUNK = 8 << 20
GAP = 64 << 10
LEVEL = 1  # of gzip

_index = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string())])
_index_ddl = "file string, offset long, length long, url string, digest string, page_id long, record_type string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


#: Stands for the URL of a page that has none, since records must have one.
NO_URL = "urn:marketrates:no-url"
_unsafe = re.compile(r"[^!#$%&'()*+,/:;=?@\[\]A-Za-z0-9._~-]")
_space = uuid.uuid5(uuid.NAMESPACE_URL, "urn:marketrates:page")


_scheme = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:")


def _uri(url: str | None) -> str:
    """The URL as an absolute URI."""
    if not url:
        return NO_URL
    return _unsafe.sub(lambda m: urllib.parse.quote(m[0], safe=""), url if _scheme.match(url) else "urn:marketrates:url:" + url)


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_space, str(page_id))}>"


def _member(head: list[str], block: bytes) -> bytes:
    lines = ["WARC/1.1", *head, f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", LEVEL, mtime=0)


def info(name: str, date: str) -> bytes:
    """The warcinfo record that begins the archive of that name."""
    own = f"<urn:uuid:{uuid.uuid5(_space, name)}>"
    head = ["WARC-Type: warcinfo", f"WARC-Record-ID: {own}", f"WARC-Date: {date}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields"]
    return _member(head, b"software: marketrates\r\nformat: WARC File Format 1.1\r\n")


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, date: str) -> bytes:
    """One record, a gzip member of its own; refers_to makes it a revisit."""
    target = _uri(url)
    head = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{sha1}",
        "Content-Type: application/http;msgtype=response",
    ]
    # Fields of our own: ids as numbers, and a URL that is no URI.
    head += [f"Page-ID: {page_id}"] * (page_id is not None)
    if url and target != url:
        head.append(f"Page-URL: {base64.b64encode(url.encode()).decode()}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers_to)}", f"Refers-To-Page-ID: {refers_to}"]
        return _member(head, http)
    return _member(head, http + payload)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """(fields, block) of one record."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    if lines[0] != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return fields, rest[:size]


def page(member: bytes) -> dict:
    """What read() returns of one response or revisit."""
    fields, block = parse(member)
    kind, sha1 = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    if kind == "response" and (digest(payload) != sha1 or len(payload) != size):
        raise ValueError(f"{fields['WARC-Record-ID']}: its payload differs from its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    url = base64.b64decode(fields["Page-URL"]).decode() if "Page-URL" in fields else fields["WARC-Target-URI"].replace(NO_URL, "")
    return {
        "page_id": number("Page-ID"), "url": url, "payload": payload if kind == "response" else None, "payload_bytes": size,
        "payload_digest": sha1, "record_type": kind, "refers_to": number("Refers-To-Page-ID"),
    }


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write(pages: DataFrame, path: str, min_payload: int = MIN_PAYLOAD, date: datetime.datetime | None = None) -> DataFrame:
    """Write a record per row of pages (page_id, url, html) under path, dated now unless a date is given; returns the index, a written table."""
    when = (date or datetime.datetime.now(datetime.UTC)).astimezone(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    own = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    own = own.withColumn("sha1", F.sha1("html")).withColumn("size", F.octet_length("html"))
    # Only payloads met twice or more are looked up; the counts are taken map-side first.
    groups = own.filter(F.col("size") >= min_payload).groupBy("sha1", "size").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    groups = written(groups, "payloads")  # a table, so that a hot payload's side of the join can be split
    placed = own.join(groups, ["sha1", "size"], "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    rows = placed.select("page_id", "url", "html", refers.alias("refers_to"))

    def run(batches):
        system, folder = _filesystem(path)
        system.create_dir(folder, recursive=True)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for batch in batches:
                index = []
                for page_id, url, html, refers_to in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    if out is None:
                        out = system.open_output_stream(f"{folder}/{name}", compression=None)
                        out.write(first := info(name, when))
                        at = len(first)
                    payload = html.encode()
                    sha1 = digest(payload)
                    member = record(page_id, url, payload, sha1, refers_to, when)
                    out.write(member)
                    index.append({"file": name, "offset": at, "length": len(member), "url": url, "digest": sha1, "page_id": page_id, "record_type": "response" if refers_to is None else "revisit"})
                    at += len(member)
                yield pa.RecordBatch.from_pylist(index, _index)
        finally:
            if out:
                out.close()

    return written(rows.mapInArrow(run, _index_ddl), "warc-index")


def ranges(index: DataFrame) -> DataFrame:
    """file, start, end, records (offset, length): sorted byte ranges that cover the index rows, close ones joined."""
    chunk = Window.partitionBy("file", "chunk").orderBy("offset")
    own = index.withColumn("chunk", F.floor(F.col("offset") / CHUNK)).withColumn("end", F.col("offset") + F.col("length"))
    new = (F.col("offset") - F.lag("end").over(chunk) > GAP).cast("int")
    runs = own.withColumn("new", F.coalesce(new, F.lit(0))).withColumn("run", F.sum("new").over(chunk))
    return runs.groupBy("file", "chunk", "run").agg(F.min("offset").alias("start"), F.max("end").alias("end"), F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records")).drop("chunk", "run")


def read(spark: SparkSession, path: str, index: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to of the records that the index rows name.

    payload is null for revisits; payload_bytes and payload_digest are those of the full payload.
    """
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    schema = pa.schema(fields)

    def run(batches):
        system, folder = _filesystem(path)
        for batch in batches:
            for r in batch.to_pylist():
                with system.open_input_file(f"{folder}/{r['file']}") as f:
                    raw = f.read_at(r["end"] - r["start"], r["start"])
                rows = []
                for x in r["records"]:
                    at = x["offset"] - r["start"]
                    rows.append(page(raw[at : at + x["length"]]))
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    dealt = ranges(index).select("file", "start", "end", "records").repartition(partitions(spark), "file", "start")  # by what is read, not by the size of index rows
    return dealt.mapInArrow(
        run, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def digest_query(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    index = write(pages, path)
    return read(spark, path, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    five = "cast(('0x' || substr(h, 5 * (i // 4) + 1, 5)) AS INTEGER)"
    return f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
        g AS (SELECT html, max(page_id) AS response FROM p GROUP BY html)
        SELECT page_id, strlen(p.html) AS payload_bytes,
          array_to_string(list_transform(range(32), lambda i: substr('{letters}', (({five} >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
          CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id <> response THEN response END AS refers_to
        FROM p JOIN g USING (html)"""
