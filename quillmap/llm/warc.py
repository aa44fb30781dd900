"""WARC archives: writing captures, reading records, assembling transactions.

Each capture is three records: the response (or a revisit, where an equal payload is already archived), the request that
led to it and a metadata record; the latter two name the first by WARC-Concurrent-To. Reading joins the records of a
transaction through these identifiers, wherever in the archives they stand, into one nested row per capture.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import bounded_batches, new_path, read_table, written

#: An archive is closed once it holds so many compressed bytes.
ARCHIVE_BYTES = 8 << 20
#: Payloads below this size are never stored as revisits.
REVISIT_BYTES = 100
DATE = "2020-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_id string, record_type string, concurrent_to string, target_uri string, content_type string, payload_digest string, profile string, head string, payload binary, fields map<string,string>"


def _uri(url: str | None) -> str:
    """The url without anything that could end a header line."""
    return quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")


def record(kind: str, record_id: str, block: bytes, content_type: str, headers: list[tuple[str, str]]) -> bytes:
    """One gzip member."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE), *headers, ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    z = zlib.compressobj(1, zlib.DEFLATED, 31, 8)
    return z.compress(b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n") + z.flush()


def capture(page_id: int | None, url: str | None, payload: bytes, revisit: bool, refers_uri: str | None) -> bytes:
    """The records of one capture. Identifiers are random: equal rows are captures of their own."""
    root, uri = f"<urn:uuid:{uuid.uuid4()}>", _uri(url)
    digest = ("WARC-Payload-Digest", f"sha256:{hashlib.sha256(payload).hexdigest()}")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    target = [("WARC-Target-URI", uri)] if uri else []
    if revisit:
        more = [("WARC-Profile", REVISIT)] + ([("WARC-Refers-To-Target-URI", _uri(refers_uri))] if refers_uri else [])
        out = record("revisit", root, http, "application/http; msgtype=response", [*target, digest, *more])
    else:
        out = record("response", root, http + payload, "application/http; msgtype=response", [*target, digest])
    rest = uri.partition("://")[2]
    host, _, path = rest.partition("/")
    joined = [*target, ("WARC-Concurrent-To", root)]
    out += record("request", f"<urn:uuid:{uuid.uuid4()}>", f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode(), "application/http; msgtype=request", joined)
    fields = [("payloadBytes", str(len(payload)))] + ([("pageId", str(page_id))] if page_id is not None else []) + ([("url", quote(url, safe=""))] if url is not None else [])
    return out + record("metadata", f"<urn:uuid:{uuid.uuid4()}>", "".join(f"{k}: {v}\r\n" for k, v in fields).encode(), "application/warc-fields", joined)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a path, local or remote, as any executor sees it."""
    return fs.FileSystem.from_uri(uri)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages as archives under folder (shared by all executors); return the manifest (path, captures, bytes).

    Of records with equal payloads of at least 100 bytes that with the smallest id is the response, others revisit it; ids
    that are null come last, and equal rows of the smallest id are all responses. A null html is an empty payload; one of
    any length is one record, held at once. Columns of other names are left out. No rows: an empty manifest. Only
    files in the manifest count: a lost task's leftovers are not in it, for names are unique to each attempt.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), F.coalesce(html_col, F.lit("")).cast("binary").alias("_html"))
    rows = rows.withColumn("_digest", F.when(F.length("_html") >= REVISIT_BYTES, F.sha2("_html", 256)))
    same = rows.where("_digest is not null").groupBy("_digest").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"), F.min_by("_url", "_id").alias("_refers"))
    same = same.where("_n > 1").select(F.col("_digest").alias("_d"), "_first", "_refers")
    # Pages without a digest have a key of their own each, so that they are dealt out evenly; it meets nothing.
    rows = rows.withColumn("_key", F.coalesce("_digest", F.concat(F.lit("-"), F.xxhash64("_id", "_url", "_html").cast("string"))))
    rows = rows.join(same, F.expr("_key = _d"), "left").select("_id", "_url", "_html", F.expr("_d is not null and not (_id <=> _first)").alias("_revisit"), "_refers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _open(folder)
        store.create_dir(top, recursive=True)
        out, path, size, n = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for b in batches:
            for page in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    path, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{top}/{path}", compression=None)
                    size += out.write(record("warcinfo", f"<urn:uuid:{uuid.uuid4()}>", b"software: quillmap\r\nformat: WARC File Format 1.1\r\n", "application/warc-fields", [("WARC-Filename", path)])) or 0
                data = capture(*page)
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((f"{folder}/{path}", n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{path}", n, size))
        if done:
            yield pa.record_batch([pa.array(x) for x in zip(*done, strict=True)], ["path", "captures", "bytes"])

    return written(rows.mapInArrow(run, "path string, captures long, bytes long"), "warc-manifest")


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of one archive, in order."""
    data = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 18)
    while first := data.readline():
        if not first.strip():
            continue
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not a record: {first[:40]!r}")
        head = {}
        while (line := data.readline()).strip():
            k, _, v = line.decode("utf-8", "replace").partition(":")
            head[k.strip().lower()] = v.strip()
        n = int(head["content-length"])
        block = data.read(n)
        if len(block) < n:
            raise EOFError("an archive ends within a record")
        yield head, block


def _as_row(head: dict[str, str], block: bytes) -> tuple:
    kind, content = head.get("warc-type"), head.get("content-type", "")
    text, payload, fields = None, None, None
    if content.startswith("application/http"):
        top, _, body = block.partition(b"\r\n\r\n")
        text, payload = top.decode("utf-8", "replace"), body if kind == "response" else None
    elif content.startswith("application/warc-fields"):
        fields = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n")) if k]
    return (head.get("warc-record-id"), kind, head.get("warc-concurrent-to"), head.get("warc-target-uri"), content, head.get("warc-payload-digest"), head.get("warc-profile"), text, payload, fields)


def read_records(manifest: DataFrame) -> DataFrame:
    """All records of the archives in the manifest (a column path), streamed record by record."""
    bounded_batches(manifest.sparkSession)
    kinds = [pa.string()] * 8 + [pa.binary(), pa.map_(pa.string(), pa.string())]
    names = [x.strip().split(" ")[0] for x in RECORD.replace("<string,string>", "").split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                store, at = _open(path)
                rows, size = [], 0
                with store.open_input_stream(at, compression=None) as raw:
                    for head, block in parse(io.BufferedReader(raw, 1 << 18)):
                        rows.append(_as_row(head, block))
                        size += len(block)
                        if len(rows) >= 1500 or size > 8 << 20:
                            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows, size = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    files = max(1, manifest.count())
    return manifest.select("path").repartition(files).mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, response (a struct), request (a struct), metadata (a map), n_records.

    Records meet through concurrent-to identifiers; one that names none stands for itself. A capture without a response or
    revisit record (its archive is missing) has a null response; warcinfo records belong to none and are left out.
    """
    body = F.struct("record_type", "target_uri", "payload_digest", "profile", "head", "payload")
    parts = records.where("record_type in ('response', 'revisit', 'request', 'metadata')")
    rows = parts.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id")).agg(
        F.first(F.when(F.col("record_type").isin("response", "revisit"), body), True).alias("response"),
        F.first(F.when(F.col("record_type") == "request", F.struct("record_id", "target_uri", "head")), True).alias("request"),
        F.first(F.when(F.col("record_type") == "metadata", F.col("fields")), True).alias("metadata"), F.count("*").alias("n_records"),
    )
    return rows


def resolve_revisits(captures: DataFrame, id_field: str = "pageId") -> DataFrame:
    """captures and refers_to: of a revisit the id (from the metadata) of the response with its payload digest, else null.

    Many revisits of one payload are a hot key of an equi-join whose other side has one small row.
    """
    key = F.col("response.payload_digest")
    kind = F.col("response.record_type")
    slim = captures.select(kind.alias("_kind"), key.alias("_d"), F.col("metadata")[id_field].cast("long").alias("_to"), F.col("metadata")["payloadBytes"].cast("long").alias("_n"))
    first = slim.where("_kind = 'response'").where(F.col("_n") >= REVISIT_BYTES).groupBy("_d").agg(F.min("_to").alias("refers_to"))
    # Responses have keys of their own, so that they are dealt out evenly; these meet nothing.
    own = F.concat(F.lit("-"), F.coalesce(F.col("metadata")[id_field], F.lit("")), key)
    return captures.withColumn("_key", F.when(kind == "revisit", key).otherwise(own)).join(first, F.expr("_key = _d"), "left").drop("_key", "_d")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    manifest = write_archives(read_table(spark, sf_dir, "pages"), folder)
    captures = assemble(read_records(manifest)).select(
        "metadata", "n_records", F.length("request.head").alias("_asked"), F.col("response.record_type").alias("record_type"), F.col("response.payload_digest").alias("_header"),
        F.octet_length("response.payload").cast("long").alias("_n"), F.sha2("response.payload", 256).alias("_sha"),
    )
    captures = captures.select("metadata", "n_records", (F.col("_asked") > 0).alias("has_request"), F.struct("record_type", F.col("_header").alias("payload_digest")).alias("response"), "_n", "_sha")
    slim = written(captures, "warc-captures")
    return resolve_revisits(slim).select(
        F.col("metadata")["pageId"].cast("long").alias("page_id"),
        F.coalesce("_n", F.col("metadata")["payloadBytes"].cast("long")).alias("payload_bytes"),
        F.coalesce("_sha", F.substring_index("response.payload_digest", ":", -1)).alias("payload_digest"),
        F.col("response.record_type").alias("record_type"), "refers_to", "n_records", "has_request",
    )


ORACLE = """
with p as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
f as (select payload_digest as d, min(page_id) as first from p where payload_bytes >= 100 group by payload_digest)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first then first end as refers_to, 3::bigint as n_records, true as has_request
from p left join f on d = payload_digest
"""
