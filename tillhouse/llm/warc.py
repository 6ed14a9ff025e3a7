"""WARC archives: a deterministic sharded writer and a reader.

Records are sorted by id over ranges of even size; each range is a shard, whose task writes files that roll once their
compressed size reaches a limit. Headers and digests are made anew from the payload. Every record is a gzip member of
its own. The same rows give the same files, byte by byte: record ids follow from page id and digest, the date is a
parameter. Files get their names when complete, and only those in the manifest of the finished job count.

Payloads are digested where they are read. Of equal payloads of ``MIN_PAYLOAD`` bytes or more, the record with the
largest id is the response and the others are revisits; digests that occur more than once meet the ids only, and what
comes of it reaches the writers as narrow rows. Payloads are shuffled once.

Defined results: NULL html is an empty payload; short payloads are always responses; a NULL id sorts first, and such a
record revisits a payload that a known id has; rows that repeat the largest id are all responses; a NULL url becomes a
urn of the id; control characters and spaces in a url are escaped; an empty table gives no files and an empty result;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import shuffle_partitions
from tillhouse.llm.files import id_bytes, open_input, range_bounds, shard_of, whole_file
from tillhouse.session import new_folder, staged

MIN_PAYLOAD = 1000  # bytes of a payload that may be left out
ROLL_BYTES = 64 << 20  # compressed
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
REVISIT, PAGE = 0, 1  # kinds of rows that reach a writer

MANIFEST = "shard int, number int, path string, records bigint, bytes bigint"
RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {digest}')}>"


def _address(url: str | None, page_id: int | None) -> str:
    from urllib.parse import quote

    return quote(url, safe="%/:?#[]@!$&'()*+,;=~") if url else f"urn:page:{page_id}"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A record, uncompressed; with ``refers_to`` a revisit."""
    digest = hashlib.sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.0",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest.hexdigest())}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_address(url, page_id)}",
        f"WARC-Payload-Digest: {_base32(digest.digest())}",
        f"WARC-Block-Digest: {_base32(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest.hexdigest())}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _info(name: str, date: str) -> bytes:
    body = b"format: WARC File Format 1.0\r\n"
    head = ["WARC/1.0", "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id(None, name)}", f"WARC-Date: {date}",
            f"WARC-Filename: {name}", "Content-Type: application/warc-fields", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _records(batches: Iterator[pa.RecordBatch], date: str) -> Iterator[tuple[int, bytes]]:
    """Shard and compressed record of every page; revisits come before the pages of their id."""
    of, revisits = None, {}
    for batch in batches:
        for shard, page_id, kind, digest, refers_to, url, html in zip(*(batch.column(c).to_pylist() for c in (
                "shard", "page_id", "kind", "digest", "refers_to", "url", "html"))):
            if page_id != of:
                of, revisits = page_id, {}
            if kind == REVISIT:
                revisits[digest] = refers_to
            else:
                yield shard, _gzip(record(page_id, url, (html or "").encode(), revisits.get(digest), date))


def write_warc(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    roll_bytes: int = ROLL_BYTES, date: str = DATE,
) -> DataFrame:
    """Writes the archives and returns their manifest."""
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.sha1(body).alias("digest"), F.col(url).alias("url"), F.col(html).alias("html"))
    size = F.octet_length(F.coalesce("html", F.lit("")))
    keys = rows.filter(size >= MIN_PAYLOAD).select("page_id", "digest")
    shared = keys.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    shared = staged(shared.filter("n > 1 AND refers_to IS NOT NULL").drop("n"), "warc-shared")  # its size is then known
    older = F.coalesce(F.col("page_id") < F.col("refers_to"), F.lit(True))
    revisits = keys.join(shared, "digest").filter(older).distinct()
    bounds = range_bounds(pages.select(*id_bytes(F.col(page_id), F.col(html))), shuffle_partitions(pages.sparkSession))
    whole = rows.select("page_id", F.lit(PAGE).alias("kind"), "digest", F.lit(None).cast("bigint").alias("refers_to"), "url", "html").union(
        revisits.select("page_id", F.lit(REVISIT).alias("kind"), "digest", "refers_to", F.lit(None).cast("string"), F.lit(None).cast("string")))
    dealt = whole.withColumn("shard", shard_of(bounds)("page_id")).repartitionById(len(bounds) + 1, F.col("shard"))
    dealt = dealt.sortWithinPartitions(F.col("page_id").asc_nulls_first(), "kind", "digest", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = _records(batches, date)
        held = next(records, None)
        number = 0
        while held is not None:
            shard = held[0]
            name = f"pages-{shard:06d}-{number:05d}.warc.gz"
            count = 0
            with whole_file(f"{folder}/{name}") as out:
                size = out.write(_gzip(_info(name, date)))
                while held is not None and (not count or size < roll_bytes):
                    size += out.write(held[1])
                    count += 1
                    held = next(records, None)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "number": pa.array([number], pa.int32()), "path": [f"{folder}/{name}"],
                "records": [count], "bytes": [size]})
            number += 1

    return staged(dealt.mapInArrow(write, MANIFEST), "warc-manifest")


def _members(file) -> Iterator[bytes]:
    """The gzip members of a file, unpacked one by one."""
    data = b""
    while True:
        data = data or file.read(1 << 20)
        if not data:
            return
        unpacker = zlib.decompressobj(31)
        out = []
        while not unpacker.eof:
            if not data and not (data := file.read(1 << 20)):
                raise EOFError("an archive ends within a record")
            out.append(unpacker.decompress(data))
            data = unpacker.unused_data
        yield b"".join(out)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, by lower-case name, and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.lower()] = value.strip()
    return fields, rest[:int(fields["content-length"])]


def _row(fields: dict[str, str], block: bytes) -> tuple:
    if fields["warc-block-digest"] != _base32(hashlib.sha1(block).digest()):
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    head, _, payload = block.partition(b"\r\n\r\n")
    http = dict(line.decode().lower().split(": ", 1) for line in head.split(b"\r\n")[1:])
    size, digest = int(http["content-length"]), fields["warc-payload-digest"]
    if fields["warc-type"] == "response":
        size = len(payload)
        if digest != _base32(hashlib.sha1(payload).digest()):
            raise ValueError(f"damaged payload {fields['warc-record-id']}")
    number = lambda name: int(fields[name]) if name in fields else None
    return (number("x-page-id"), fields["warc-target-uri"], size, base64.b32decode(digest.removeprefix("sha1:")).hex(),
            fields["warc-type"], number("x-refers-to-page"))


def read_warc(manifest: DataFrame) -> DataFrame:
    """One row for each response and revisit of the archives in ``manifest``; blocks and payloads are verified."""
    shards = (manifest.agg(F.max("shard")).first()[0] or 0) + 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with open_input(path) as file:
                    for member in _members(file):
                        fields, block = parse(member)
                        if fields["warc-type"] != "warcinfo":
                            rows.append(_row(fields, block))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return manifest.repartitionById(shards, F.col("shard")).mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archives of ``pages`` in the shared folder, read back."""
    return read_warc(write_warc(pages, new_folder(pages.sparkSession, "warc")))
