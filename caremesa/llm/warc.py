"""Operator 4: WARC archives, one gzip member per record, written and read in sequence.

Of the records with equal payloads one is a response with the payload; all others are
revisits that name it. The archives go to the shared folder; each task writes its own
files and reports their names only when they are complete, so a repeated or lost task
leaves no half-read archive. The reader decompresses a file piece by piece, frames blocks
by their content length and verifies each record's digest.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremesa.llm.common import c, settle, shared_folder

#: Compressed bytes after which a task begins a new archive; bytes that the reader asks for at once.
ARCHIVE_BYTES, READ_BYTES = 256 << 20, 1 << 16
_END = b"\r\n"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: object) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, full_bytes: int, full_digest: str, refers_to: int | None) -> bytes:
    """A record: its header, an HTTP header with the payload's length, and the payload of a response."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % full_bytes
    block = http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url))
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers_to)}"]
    lines += [f"WARC-Payload-Digest: sha1:{full_digest}", f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + _END * 2 + block + _END * 2


def member(content: bytes) -> bytes:
    """One gzip member."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


def members(source: io.RawIOBase, size: int = READ_BYTES) -> Iterator[bytes]:
    """The contents of each gzip member of a file, read and decompressed piece by piece."""
    unpacker, parts, waiting = zlib.decompressobj(31), [], b""
    while True:
        data = waiting or source.read(size)
        if not data:
            break
        parts.append(unpacker.decompress(data))
        waiting = unpacker.unused_data
        if unpacker.eof:
            yield b"".join(parts)
            unpacker, parts = zlib.decompressobj(31), []
        else:
            waiting = b""
    if parts:
        raise ValueError("archive ends inside a record")


def parse(content: bytes) -> dict[str, object]:
    """Header fields (names in lower case), HTTP length and payload of a record; raises if a length or digest is wrong."""
    head, _, rest = content.partition(_END * 2)
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != _END * 2:
        raise ValueError("wrong content length")
    if fields["warc-block-digest"] != "sha1:" + digest(block):
        raise ValueError("wrong block digest")
    http, _, payload = block.partition(_END * 2)
    stated = int(re.search(rb"(?im)^Content-Length: *(\d+)", http)[1])
    if fields["warc-type"] == "response" and (len(payload) != stated or fields["warc-payload-digest"] != "sha1:" + digest(payload)):
        raise ValueError("wrong payload")
    return fields | {"payload": payload, "payload_bytes": stated}


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """What is to be written for each row: page_id, url, kind, payload, full_bytes, full_digest, refers_to.

    Payloads are shuffled once, to find one row for each digest. All that decides between
    equal payloads are ids, urls and digests.
    """
    payload = F.encode(F.coalesce(c("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("full_bytes", F.octet_length("payload").cast("bigint")).withColumn("sha", F.sha1("payload"))
    nothing = F.lit(None)
    shared = c("full_bytes") >= least_bytes
    # a response for each digest: the largest page_id, of these the largest url; nulls are smallest
    winners = rows.where(shared).groupBy("sha").agg(F.max(F.struct("page_id", "url")).alias("top"), F.first("payload").alias("payload"), F.first("full_bytes").alias("full_bytes"))
    responses = winners.select("top.page_id", "top.url", F.lit("response").alias("kind"), "payload", "full_bytes", "sha", nothing.cast("bigint").alias("refers_to"))
    # all other rows: of equal rows, the one that is the response is taken off
    counted = settle(rows.select("page_id", "url", "full_bytes", "sha").groupBy("sha", "full_bytes", "page_id", "url").agg(F.count(F.lit(1)).alias("n")))
    tops = settle(counted.where(shared).groupBy("sha").agg(F.max(F.struct("page_id", "url")).alias("top")))
    own = c("page_id").eqNullSafe(c("top.page_id")) & c("url").eqNullSafe(c("top.url"))
    others = counted.where(shared).join(tops, "sha").withColumn("n", (c("n") - own.cast("int")).cast("int")).where(c("n") > 0)
    others = others.withColumn("_", F.explode(F.sequence(F.lit(1), c("n"))))
    revisits = others.select("page_id", "url", F.lit("revisit").alias("kind"), F.lit(None).cast("binary").alias("payload"), "full_bytes", "sha", c("top.page_id").alias("refers_to"))
    single = rows.where(~shared).select("page_id", "url", F.lit("response").alias("kind"), "payload", "full_bytes", "sha", nothing.cast("bigint").alias("refers_to"))
    return responses.union(revisits).union(single) if least_bytes else responses.union(revisits)


def write(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``records`` to WARC files in ``folder``; returns their paths and sizes as a written table.

    ``folder`` is an address that pyarrow's file systems know (file, hdfs, s3, gs).
    """

    def archives(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        sink, path, size = None, "", 0
        for frame in frames:
            for row in frame.itertuples(index=False):
                if sink is None:
                    path, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                    sink = files.open_output_stream(path, compression=None)
                page_id = None if pd.isna(row.page_id) else int(row.page_id)
                refers_to = None if pd.isna(row.refers_to) else int(row.refers_to)
                full = base64.b32encode(bytes.fromhex(row.sha)).decode()
                content = member(record(row.kind, page_id, row.url, row.payload or b"", int(row.full_bytes), full, refers_to))
                sink.write(content)
                size += len(content)
                if size >= archive_bytes:
                    sink.close()
                    sink = None
                    yield pd.DataFrame({"path": [path], "bytes": [size]})
        if sink is not None:
            sink.close()
            yield pd.DataFrame({"path": [path], "bytes": [size]})

    return settle(rows.mapInPandas(archives, "path string, bytes bigint"))


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the archives in ``manifest`` (path, bytes), each verified.

    Returns page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload.
    A file is read by one task from its start to its end; it holds 256 MB at most when
    written by ``write``, plus one record.
    """
    schema = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, _ = fs.FileSystem.from_uri(folder)
        for frame in frames:
            for path in frame["path"]:
                found, held = [], 0
                with files.open_input_stream(path, compression=None) as source:
                    for content in members(source):
                        fields = parse(content)
                        found.append((
                            _page(fields["warc-record-id"]), fields.get("warc-target-uri"), fields["warc-type"], fields["payload_bytes"],
                            fields["warc-payload-digest"].removeprefix("sha1:"), _page(fields.get("warc-refers-to")), fields["payload"],
                        ))
                        held += len(content)
                        if held > 8 << 20:
                            yield _frame(found)
                            found, held = [], 0
                if found:
                    yield _frame(found)

    def _frame(found: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(found, columns=["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"])
        return frame.astype({"page_id": "Int64", "refers_to": "Int64"})

    return manifest.mapInPandas(rows, schema)


def archive(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes a record for each row of ``pages`` (page_id, url, html) and reads the archives back.

    Returns page_id, payload_bytes, payload_digest, record_type and refers_to, then url.

    Nulls: a null html is an empty payload, which is shared like any other; a null url has
    no target line; a null page_id is smaller than any other and read back as null, and a
    revisit of such a response has no refers_to. Of repeated rows that hold the largest
    page_id one is the response and the others revisit it. Blanks and control characters
    of a url are percent-encoded. An empty table gives no rows. Other columns are ignored.
    """
    folder = shared_folder(pages.sparkSession)
    manifest = write(records(pages, least_bytes), folder)
    dealt = manifest.repartition(max(1, min(manifest.count(), 100_000)), F.xxhash64("path"))
    return read(dealt, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


ORACLE = """
with payloads as (
    select page_id, url, coalesce(html, '') as payload, sha1(coalesce(html, '')) as sha from pages
), ranked as (
    select *, row_number() over (partition by sha order by page_id desc nulls last, url desc nulls last) as place,
        max(page_id) over (partition by sha) as top
    from payloads
)
select page_id, strlen(payload)::bigint as payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(sha, (5 * (i // 4) + 1)::integer, 5))::bigint >> (15 - 5 * (i % 4))::integer) & 31)::integer + 1, 1)), '') as payload_digest,
    case when place = 1 then 'response' else 'revisit' end as record_type,
    case when place > 1 then top end as refers_to, url
from ranked
"""
