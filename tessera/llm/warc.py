"""A deterministic, sharded WARC writer and its reader.

Pages are range-sorted by id; each partition writes files of its own, rolled by their
compressed size, one gzip member per record.  Headers, record ids and digests are made
anew from the payloads.  A file appears under its name only when whole, and only files
that the manifest names are part of the output.
"""

from __future__ import annotations

import hashlib
import itertools
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, scratch, small_batches
from tessera.llm.shards import Committed, new_folder, one_task_each, partitions_for, store_of

MIN_REVISIT_BYTES = 100
FILE_BYTES = 8 << 20
#: Bytes read at a time; what follows a record in a piece is copied once for each record in it.
PIECE = 64 << 10
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "part int, file int, path string, n_records long, n_bytes long"
_NAMES = ["part", "file", "path", "n_records", "n_bytes"]


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def target_uri(url: str | None, page_id: int | None) -> str:
    return urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"urn:page:{page_id}"


def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def record(page_id: int | None, url: str | None, payload: bytes, earlier: dict[str, int]) -> bytes:
    """One WARC record; a revisit (of the page that `earlier` names for the payload's digest) holds the HTTP head alone."""
    digest = hashlib.sha256(payload).hexdigest()
    revisit_of = earlier.get(digest)
    is_revisit = revisit_of is not None
    block = http_head(len(payload)) + (b"" if is_revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Target-URI", target_uri(url, page_id)),
        ("WARC-Date", DATE),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        fields.append(("WARC-Page-ID", str(page_id)))
    if is_revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(revisit_of, digest)), ("WARC-Refers-To-Page-ID", str(revisit_of))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def warcinfo(name: str) -> bytes:
    body = b"software: tessera\r\nformat: WARC file version 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Date: {DATE}\r\nWARC-Filename: {name}\r\nWARC-Record-ID: {record_id(None, name)}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member without a time stamp: equal data gives equal bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def members(path: str) -> Iterator[bytes]:
    """Contents of the gzip members of a file, read piece by piece."""
    store, inner = store_of(path)
    with store.open_input_stream(inner, compression=None) as f:
        unpacker, parts, data = zlib.decompressobj(31), [], f.read(PIECE)
        while data:
            parts.append(unpacker.decompress(data))
            data = unpacker.unused_data if unpacker.eof else b""
            if unpacker.eof:
                yield b"".join(parts)
                unpacker, parts = zlib.decompressobj(31), []
            data = data or f.read(PIECE)
        if any(parts):
            raise ValueError(f"{path} ends inside a record")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of a record; its digests are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"block of {fields['warc-record-id']} is damaged")
    return fields, block


def revisits(pages: DataFrame) -> DataFrame:
    """page_id, digest and refers_to of the pages that repeat an earlier payload; no payload is shuffled for it.

    Of equal payloads of at least 100 bytes the smallest page_id is the response; a null
    page_id is never the smallest.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    long_enough = pages.filter(F.octet_length(body) >= MIN_REVISIT_BYTES)
    digests = materialize(long_enough.select("page_id", F.sha2(body.cast("binary"), 256).alias("digest")), "digests")
    twice = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) & F.col("refers_to").isNotNull())
    # Spark splits the partitions of payloads that very many pages hold.
    found = digests.join(twice.drop("n"), "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return found.select("page_id", "digest", "refers_to").distinct()


def ordered_records(pages: DataFrame) -> DataFrame:
    """Pages in ascending order of page_id, each behind the rows that say what it repeats: payloads are shuffled once.

    Rows of one page_id are ordered by url and html.
    """
    rows = pages.select("page_id", F.lit(1).alias("is_page"), "url", "html", F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("refers_to"))
    marks = revisits(pages).select("page_id", F.lit(0).alias("is_page"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "digest", "refers_to")
    by_id = F.col("page_id").asc_nulls_first()
    return rows.unionByName(materialize(marks, "revisits")).repartitionByRange(partitions_for(pages), by_id).sortWithinPartitions(by_id, "is_page", "url", "html")


def write_warc(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row in ascending page_id order; the manifest, as a written table.

    Null html counts as empty; null page_ids come first; repeated rows of the smallest page_id
    of a payload are responses each; an empty table gives no file.  The folder must be new.
    """
    small_batches(pages.sparkSession, 200)
    new_folder(folder)

    def write(batches):
        part, file, n, count, rows = TaskContext.get().partitionId(), None, 0, 0, []
        earlier: dict[str, int] = {}
        marked = None

        def close():
            file.commit()
            rows.append((part, n, f"{folder}/pages-{part:07d}-{n:05d}.warc.gz", count, file.size))

        try:
            for batch in batches:
                for page_id, is_page, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if earlier and marked != page_id:
                        earlier = {}
                    if not is_page:
                        earlier[digest], marked = refers_to, page_id
                        continue
                    if file and file.size >= file_bytes:
                        close()
                        file, n, count = None, n + 1, 0
                    if not file:
                        name = f"pages-{part:07d}-{n:05d}.warc.gz"
                        file = Committed(folder, name)
                        file.write(member(warcinfo(name)))
                    file.write(member(record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), earlier)))
                    count += 1
            if file:
                close()
        except BaseException:
            if file:
                file.abort()
            raise
        if rows:
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], _NAMES)

    return materialize(ordered_records(pages).mapInArrow(write, MANIFEST), "manifest")


def read_warc(manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record, from the archives.

    Digests of whole payloads are computed again and compared; a revisit carries its payload's digest and length in its head.
    """

    def row(data: bytes) -> tuple | None:
        fields, block = parse(data)
        if fields["warc-type"] == "warcinfo":
            return None
        digest, length = fields["warc-payload-digest"].removeprefix("sha256:"), int(fields["warc-payload-length"])
        if fields["warc-type"] == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            if (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, length):
                raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
        page, other = fields.get("warc-page-id"), fields.get("warc-refers-to-page-id")
        return page and int(page), length, digest, fields["warc-type"], other and int(other)

    def read(batches):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found = (r for r in map(row, members(path)) if r)
                while rows := list(itertools.islice(found, 4096)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return one_task_each(manifest.select("path")).mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame) -> DataFrame:
    """Write the pages as WARC files in the shared folder and read them back."""
    return read_warc(write_warc(pages, scratch(pages.sparkSession, "warc")))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, payload_bytes, d.payload_digest,
  CASE WHEN d.page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN d.page_id <> first_id THEN first_id END AS refers_to
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest AND payload_bytes >= 100
"""
