"""WARC archives of page captures: writing, reading, and assembling transactions.

Each capture is three records: a request and a metadata record that name, in
WARC-Concurrent-To, the id of the capture's response (or revisit) record. A
payload that another capture of the smallest page id already holds is written
as a revisit: its WARC-Refers-To names that response. Archives are gzip files,
one member a record, one file a task, in the shared folder.

Reading parses archives record by record; assembling groups the records of a
transaction by concurrent-to id (one shuffle of records, no payload unless
asked for) into one nested row per capture, and resolves revisits by a join on
record ids.

Defined cases: null html is an empty payload; null ids sort last and have no
number in the archive; rows with one page id and payload are told apart by url
(null first); exact repeats of a row become as many captures, all but the
first of the smallest being revisits; an empty table writes no archive and
gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import open_store, stored

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 1 << 20
RECORD = ("record_id string, type string, uri string, concurrent_to string, refers_to string, "
          "payload_bytes long, payload_digest string, fields map<string,string>, payload binary")


def record_id(key: str, copy: int, kind: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{key}:{copy}:{kind}'.encode()).hexdigest())}>"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(5, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + pack.flush()


def _capture(page_id, url, html: str, key: str, first: str, copy: int, date: str) -> list[bytes]:
    payload = (html or "").encode()
    uri = (url or "urn:unknown").replace("\r", "%0D").replace("\n", "%0A")
    response = not copy and key == first
    kind = "response" if response else "revisit"
    own, digest = record_id(key, copy, "response"), base32_sha1(payload)
    common = [("WARC-Date", date), ("WARC-Target-URI", uri)]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    main = [("WARC-Type", kind), ("WARC-Record-ID", own), *common, ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "application/http;msgtype=response")]
    if not response:
        main += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first, 0, "response"))]
    notes = "".join(f"{k}: {v}\r\n" for k, v in (("page-id", page_id), ("url-known", int(url is not None))) if v is not None)
    return [
        _record([("WARC-Type", "request"), ("WARC-Record-ID", record_id(key, copy, "request")), *common,
                 ("WARC-Concurrent-To", own), ("Content-Type", "application/http;msgtype=request")],
                f"GET {uri} HTTP/1.1\r\n\r\n".encode()),
        _record(main, http + payload * response),
        _record([("WARC-Type", "metadata"), ("WARC-Record-ID", record_id(key, copy, "metadata")), *common,
                 ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields")], notes.encode()),
    ]


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write every page to archives in ``folder``; returns (file, records).

    Payloads of at least ``min_bytes`` that occur again become revisits.
    """
    spark = pages.sparkSession
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn(
        "key", F.sha1(F.concat_ws("\n", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), "digest",
                                  F.coalesce(F.concat(F.lit("u"), "url"), F.lit("")))))
    # exact repeats meet map-side; the html is shuffled once, by row key
    captures = rows.groupBy("key").agg(F.first("page_id").alias("page_id"), F.first("url").alias("url"),
                                       F.first("html").alias("html"), F.count("*").alias("copies"))
    keys = rows.select("key", "digest", F.octet_length("html").alias("n"),
                       F.struct(F.col("page_id").isNull(), "page_id", "url", "key").alias("order")).distinct()
    firsts = keys.groupBy("digest").agg(F.min("order").alias("order")).select("digest", F.col("order.key").alias("first"))
    decided = (keys.join(firsts, "digest")
               .select("key", F.when(F.col("n") < min_bytes, F.col("key")).otherwise(F.col("first")).alias("first")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        name, out, n = f"{TaskContext.get().partitionId():06d}.warc.gz", None, 0
        temp = f"{path}/{name}.{uuid.uuid4().hex}.tmp"
        for batch in batches:
            for page_id, url, html, key, first, copies, small in zip(*(c.to_pylist() for c in batch.columns)):
                out = out or store.open_output_stream(temp, compression=None)
                for copy in range(copies):
                    # a small payload's repeats are responses, too: each copy is then its own first
                    for r in _capture(page_id, url, html, f"{key}{copy or ''}" if small else key,
                                      f"{key}{copy or ''}" if small else first, 0 if small else copy, date):
                        out.write(r)
                        n += 1
        if out:
            out.close()
            store.move(temp, f"{path}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [n]})

    made = (captures.join(decided, "key")
            .select("page_id", "url", "html", "key", "first", "copies", (F.octet_length("html") < min_bytes).alias("small"))
            .mapInArrow(write, "file string, records long"))
    made.write.mode("overwrite").parquet(f"{folder}/files")
    return spark.read.parquet(f"{folder}/files")


class _Source:
    """Bytes of an archive, decompressed member by member (plain archives as they are)."""

    def __init__(self, f) -> None:
        self.f, self.data, self.raw, self.unpack = f, b"", b"", None
        head = f.read(READ_BYTES)
        self.gzip, self.raw = head[:2] == b"\x1f\x8b", head

    def more(self) -> bool:
        raw, self.raw = self.raw or self.f.read(READ_BYTES), b""
        if not raw:
            return False
        if self.gzip:
            self.unpack = self.unpack or zlib.decompressobj(31)
            self.data += self.unpack.decompress(raw)
            if self.unpack.eof:
                self.raw, self.unpack = self.unpack.unused_data, None
        else:
            self.data += raw
        return True

    def until(self, mark: bytes) -> bytes | None:
        at = 0
        while (i := self.data.find(mark, at)) < 0:
            at = max(0, len(self.data) - len(mark))
            if not self.more():
                return None
        found, self.data = self.data[:i], self.data[i + len(mark):]
        return found

    def take(self, n: int) -> bytes:
        while len(self.data) < n:
            if not self.more():
                raise ValueError("archive ends inside a record")
        found, self.data = self.data[:n], self.data[n:]
        return found


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, sep, v in (x.partition(":") for x in lines) if sep}


def parse_archive(f, with_payload: bool = False) -> Iterator[tuple]:
    """Rows of ``RECORD`` from an open archive."""
    source = _Source(f)
    while (head := source.until(b"\r\n\r\n")) is not None:
        h = _fields(head.decode().split("\r\n")[1:])
        block, kind = source.take(int(h["content-length"])), h["warc-type"]
        source.take(4)                                       # the blank lines after each block
        n = digest = payload = None
        fields = {}
        if kind in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
            fields = _fields(http.decode("latin-1").split("\r\n")[1:])
            if kind == "response":
                n, digest = len(payload), base32_sha1(payload)
            else:            # the payload is elsewhere; its length and digest are in the headers
                n, digest, payload = int(fields["content-length"]), h["warc-payload-digest"].partition(":")[2], None
        elif kind == "metadata":
            fields = _fields(block.decode().split("\r\n"))
        yield (h["warc-record-id"], kind, h.get("warc-target-uri"), h.get("warc-concurrent-to"), h.get("warc-refers-to"),
               n, digest, list(fields.items()), payload if with_payload else None)


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """Every record of the archives listed in ``folder``/files, one task a file."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        schema = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("uri", pa.string()), ("concurrent_to", pa.string()),
                            ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{path}/{name}", compression=None) as f:
                    rows, size = [], 0
                    for r in parse_archive(f, with_payload):
                        rows.append(r)
                        size += len(r[-1] or b"") + 500
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    files = spark.read.parquet(f"{folder}/files").select("file")
    return files.repartition(max(1, files.count())).mapInArrow(read, RECORD)     # one row an archive


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, request, response (or revisit), metadata; a missing part is null."""
    part = F.struct("record_id", "type", "uri", "refers_to", "payload_bytes", "payload_digest", "fields", "payload")
    is_main = F.col("type").isin("response", "revisit")
    tied = records.where(is_main | F.col("concurrent_to").isNotNull())
    return (tied.groupBy(F.when(is_main, F.col("record_id")).otherwise(F.col("concurrent_to")).alias("capture_id"))
            .agg(F.first(F.when(F.col("type") == "request", part), ignorenulls=True).alias("request"),
                 F.first(F.when(is_main, part), ignorenulls=True).alias("response"),
                 F.first(F.when(F.col("type") == "metadata", part), ignorenulls=True).alias("metadata")))


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """Flat rows: page_id, url, payload_bytes, payload_digest, record_type, refers_to (page id of the response)."""
    url = F.when(F.col("metadata.fields")["url-known"] == "1", F.col("response.uri"))
    flat = stored(captures.select("capture_id", F.col("metadata.fields")["page-id"].cast("long").alias("page_id"), url.alias("url"),
                                  F.col("response.payload_bytes").alias("payload_bytes"),
                                  F.col("response.payload_digest").alias("payload_digest"),
                                  F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("target")), "captures")
    out = ["page_id", "url", "payload_bytes", "payload_digest", "record_type"]
    originals = flat.where("record_type = 'response'")
    named = originals.select(F.col("capture_id").alias("target"), F.col("page_id").alias("refers_to"))
    return (originals.select(*out, F.lit(None).cast("long").alias("refers_to"))
            .unionAll(flat.where("record_type = 'revisit'").join(named, "target", "left").select(*out, "refers_to")))
