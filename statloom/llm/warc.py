"""WARC archives: written one gzip member per record, read back sequentially.

The writer gives every task's pages one archive in the shared folder, under a name of its own until
it is whole, so a repeated task replaces it as a whole. The reader streams an archive in blocks: zlib
is fed until a member ends, the record's header is parsed as soon as it is there, its block is framed
by Content-Length and digested on the way, and the next member begins where the last one ended.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import col, settle, share_package, slices
from statloom.session import new_folder

BLOCK = 1 << 18  # bytes read at once
RECORD = "<urn:statloom:page:{}>"


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def _open(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if not path.startswith("file:/") or path.startswith("file://") else "file://" + path[5:])


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """The bytes of a record: a response with its payload, or a revisit with the HTTP head alone."""
    digest = base32_sha1(hashlib.sha1(payload).digest())
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {RECORD.format('' if page_id is None else page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",  # the table has no fetch time
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(hashlib.sha1(block).digest())}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {RECORD.format('' if refers_to is None else refers_to)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def planned(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """``(page_id, url, payload, response_id, revisit)``: which records repeat another one's payload.

    Payloads are compared by SHA-1, as the revisit profile says. Digests and ids alone are grouped;
    only the digests that occur with several ids come back to the pages.
    """
    rows = pages.select(
        col(id_col).cast("long").alias("page_id"),
        col(url_col).cast("string").alias("url"),
        F.coalesce(col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    digest: Column = F.sha1("payload")
    large = F.octet_length("payload") >= min_bytes
    groups = rows.where(large).select("page_id", digest.alias("digest")).groupBy("digest")
    repeated = groups.agg(F.max("page_id").alias("response_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    keyed = rows.withColumn("digest", F.when(large, digest))
    again = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return keyed.join(repeated, "digest", "left").select("page_id", "url", "payload", "response_id", again.alias("revisit"))


def write(planned_rows: DataFrame, folder: str) -> DataFrame:
    """Write one archive per task into ``folder``; ``(path, records, bytes)`` of the archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, place = _open(folder)
        system.create_dir(place, recursive=True)
        name = f"part-{task.partitionId():06d}.warc.gz"
        draft = f"{place}/.{name}.{task.taskAttemptId()}"
        records = size = 0
        with system.open_output_stream(draft, compression=None) as out:
            for batch in batches:
                for some in slices(batch, "payload"):
                    columns = [some.column(c).to_pylist() for c in ("page_id", "url", "payload", "response_id", "revisit")]
                    for row in zip(*columns):
                        data = member(record(*row))
                        out.write(data)
                        records, size = records + 1, size + len(data)
        system.move(draft, f"{place}/{name}")
        yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [records], "bytes": [size]})

    share_package(planned_rows.sparkSession)
    return settle(planned_rows.mapInArrow(run, "path string, records long, bytes long"), "warc-index")


def members(blocks: Iterator[bytes]) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as its decompressed blocks; read one before the next."""
    blocks = iter(blocks)
    rest = b""
    while True:
        while not rest:
            rest = next(blocks, None)
            if rest is None:
                return
        unpack = zlib.decompressobj(31)

        def part() -> Iterator[bytes]:
            nonlocal rest
            data: bytes | None = rest
            while True:
                out = unpack.decompress(data, BLOCK)
                if out:
                    yield out
                if unpack.eof:
                    rest = unpack.unused_data
                    return
                data = unpack.unconsumed_tail
                if not data:
                    data = next(blocks, None)
                    if data is None:
                        raise ValueError("the archive ends inside a record")

        yield (current := part())
        for _ in current:  # what the reader has left of this member
            pass


def parse(blocks: Iterator[bytes], payloads: bool) -> dict:
    """One record: header fields, payload and its size and digest, and whether the digests hold."""
    blocks = iter(blocks)
    data = b""
    while b"\r\n\r\n" not in data:
        more = next(blocks, None)
        if more is None:
            raise ValueError("a record without a header")
        data += more
    head, data = data.split(b"\r\n\r\n", 1)
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("a record doesn't begin with its version")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    left = int(fields["content-length"])
    block, payload = hashlib.sha1(), hashlib.sha1()
    kept, size, http = [], 0, b""
    inside = False
    tail = b""
    while True:
        here, tail = data[:left], data[left:]
        left -= len(here)
        block.update(here)
        if not inside:
            http += here
            if b"\r\n\r\n" in http:
                http, here = http.split(b"\r\n\r\n", 1)
                inside = True
            else:
                here = b""
        if inside and here:
            payload.update(here)
            size += len(here)
            if payloads:
                kept.append(here)
        if not left:
            break
        data = next(blocks, None)
        if data is None:
            raise ValueError("a record is shorter than its Content-Length")
    tail += b"".join(blocks)
    told = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}
    revisit = fields.get("warc-type") == "revisit"
    digest = base32_sha1(payload.digest())
    named = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    good = fields.get("warc-block-digest", "").removeprefix("sha1:") == base32_sha1(block.digest()) and tail == b"\r\n\r\n"
    if not revisit:
        good = good and named == digest and told.get("content-length") == str(size)
    return {
        "page_id": _number(fields.get("warc-record-id", "")),
        "url": fields.get("warc-target-uri"),
        "record_type": fields.get("warc-type"),
        "payload_bytes": int(told.get("content-length", size)) if revisit else size,
        "payload_digest": named if revisit else digest,
        "refers_to": _number(fields["warc-refers-to"]) if revisit else None,
        "verified": good,
        "payload": None if revisit or not payloads else b"".join(kept),
    }


def _number(urn: str) -> int | None:
    found = urn.strip("<>").rpartition(":")[2]
    return int(found) if found.lstrip("-").isdigit() else None


def read(index: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of all archives named in ``index.path``, an archive a task.

    A revisit has the digest and size of the payload that it refers to, and no payload. ``verified``
    says whether framing and digests hold; an archive that ends inside a record raises.
    """
    schema = (
        "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
        "verified boolean, payload binary"
    )
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.binary()]
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, place = _open(path)
                with system.open_input_stream(place, compression=None) as stream:
                    rows, size = [], 0
                    for part in members(iter(lambda: stream.read(BLOCK), b"")):
                        rows.append(parse(part, payloads))
                        size += 200 + len(rows[-1]["payload"] or b"")
                        if size > 8 << 20:
                            yield table(rows)
                            rows, size = [], 0
                    yield table(rows)

    def table(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], type=k) for n, k in zip(names, kinds)], names=names)

    share_package(index.sparkSession)
    # archives are whole tasks' outputs: dealing their names deals the work
    files = index.select("path").repartition(max(1, index.count()))
    return files.mapInArrow(run, schema)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, payloads: bool = False) -> DataFrame:
    """Write all pages as records into the shared folder and read the archives back.

    A NULL page is an empty payload; a NULL url is left out of the header, and characters that a
    header can't hold are percent-encoded. Of the records with equal payloads of at least
    ``min_bytes`` bytes the one with the largest page_id is the response, the others revisit it; rows
    that repeat that page_id are responses too, a NULL page_id counts as the smallest. An empty table
    gives no rows.
    """
    folder = new_folder(pages.sparkSession, "warc")
    return read(write(planned(pages, id_col, url_col, html_col, min_bytes), folder), payloads)
