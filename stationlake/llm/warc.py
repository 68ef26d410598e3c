"""WARC archives: write, normalise a whole-file gzip stream, read through the index.

Archives written as one gzip stream can only be read from the front. The normaliser inflates such a
stream once, writes every record as a gzip member of its own, and beside the archive an index of
offset and size of each member, so that later any record is read by itself.

Every task reads and writes files of the shared folder through ``pyarrow.fs`` (local and mounted paths,
hdfs, s3, gs). A file's name is drawn anew by each attempt and made known by the rows the task returns; files of
attempts that did not finish are never read. Memory: one record at a time.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.shared import shared_folder, staged, unique_name

#: Archives are closed when this many bytes of records are in them.
ARCHIVE_BYTES = 1 << 30
CHUNK = 1 << 20
#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = 31


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _clean(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in value)


def record_bytes(page_id, url, payload: bytes, size: int, digest: str, refers_to, revisit: bool) -> bytes:
    """One record. A revisit has the HTTP header of the full payload and no payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Target-URI", "urn:none" if url is None else _clean(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if revisit:
        headers += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    headers.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in headers).encode()
    return VERSION + head + b"\r\n" + block + b"\r\n\r\n"


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if lines[0].encode() + b"\r\n" != VERSION:
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return dict(line.split(": ", 1) for line in lines[1:] if line)


def records_in(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a stream of uncompressed bytes, whole and one at a time."""
    held = bytearray()
    chunks = iter(chunks)

    def more() -> bool:
        chunk = next(chunks, None)
        if chunk is not None:
            held.extend(chunk)
        return chunk is not None

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held:
                    raise ValueError("the archive ends inside a header")
                return
        size = end + 4 + int(_headers(bytes(held[:end]))["Content-Length"]) + 4
        while len(held) < size:
            if not more():
                raise ValueError("the archive ends inside a record")
        yield bytes(held[:size])
        del held[:size]


def inflated(stream) -> Iterator[bytes]:
    """The contents of a gzip file of one or more members, piece by piece."""
    unzip = zlib.decompressobj(GZIP)
    while data := stream.read(CHUNK):
        while data:
            # Bounded pieces, however well the data are compressed.
            out = unzip.decompress(data, 4 * CHUNK)
            if out:
                yield out
            if unzip.eof:
                data, unzip = unzip.unused_data, zlib.decompressobj(GZIP)
            else:
                data = unzip.unconsumed_tail
    if out := unzip.flush():
        yield out


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write (page_id, url, payload, digest, refers_to, revisit) as whole-file gzip archives.

    Returns one row per archive: path, records. Written once; the rows come from the shared folder.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, name = _opened(folder)
        out = squeeze = path = None
        done, size, count = [], 0, 0

        def close() -> None:
            out.write(squeeze.flush())
            out.close()
            done.append((f"{folder}/{path}", count))

        for batch in batches:
            for page_id, url, payload, digest, refers_to, revisit in zip(
                *(column.to_pylist() for column in batch.columns), strict=True
            ):
                if out is None:
                    path, size, count = f"{unique_name('whole')}.warc.gz", 0, 0
                    out = target.open_output_stream(f"{name}/{path}", compression=None)
                    squeeze = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                text = base64.b32encode(bytes.fromhex(digest)).decode()
                payload = payload or b""
                record = record_bytes(page_id, url, payload, len(payload), text, refers_to, revisit)
                out.write(squeeze.compress(record))
                size, count = size + len(record), count + 1
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict(
            {"path": [d[0] for d in done], "records": [d[1] for d in done]},
            schema=pa.schema([("path", pa.string()), ("records", pa.int64())]),
        )

    _opened(folder)[0].create_dir(_opened(folder)[1], recursive=True)
    return staged(records.mapInArrow(write, "path string, records long"), "archives")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive (column path) with one gzip member per record and a sidecar index.

    Returns path, index_path and records of the new archives, one row each. The sidecar has a JSON line per
    record: offset, size, record id, type.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = _opened(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                source, name = _opened(path)
                new = unique_name("members")
                offset = count = 0
                with (
                    source.open_input_stream(name, compression=None) as stream,
                    target.open_output_stream(f"{base}/{new}.warc.gz", compression=None) as out,
                    target.open_output_stream(f"{base}/{new}.idx", compression=None) as index,
                ):
                    for record in records_in(inflated(stream)):
                        squeeze = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                        member = squeeze.compress(record) + squeeze.flush()
                        out.write(member)
                        head = _headers(record[: record.index(b"\r\n\r\n")])
                        entry = [offset, len(member), head["WARC-Record-ID"], head["WARC-Type"]]
                        index.write(json.dumps(entry).encode() + b"\n")
                        offset, count = offset + len(member), count + 1
                yield pa.RecordBatch.from_pydict(
                    {
                        "path": [f"{folder}/{new}.warc.gz"],
                        "index_path": [f"{folder}/{new}.idx"],
                        "records": [count],
                    },
                    schema=pa.schema(
                        [("path", pa.string()), ("index_path", pa.string()), ("records", pa.int64())]
                    ),
                )

    _opened(folder)[0].create_dir(_opened(folder)[1], recursive=True)
    # A fixed number of parts: small rows that stand for large files must not be put together.
    rows = archives.select("path").repartition(max(1, archives.count()), "path")
    return staged(rows.mapInArrow(rewrite, "path string, index_path string, records long"), "normalised")


def _page(text: str | None) -> int | None:
    number = (text or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of normalised archives, each read by its index entry.

    Columns: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload (null for revisits).
    """
    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ("payload", pa.binary()),
        ]
    )

    def one(member: bytes) -> tuple:
        record = zlib.decompress(member, GZIP)
        end = record.index(b"\r\n\r\n")
        head = _headers(record[:end])
        block = record[end + 4 : -4]
        http_end = block.index(b"\r\n\r\n")
        http = dict(line.split(": ", 1) for line in block[:http_end].decode().split("\r\n")[1:])
        payload = None if head["WARC-Type"] == "revisit" else block[http_end + 4 :]
        url = head["WARC-Target-URI"]
        return (
            _page(head["WARC-Record-ID"]), None if url == "urn:none" else url, int(http["Content-Length"]),
            head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"],
            _page(head.get("WARC-Refers-To")), payload,
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, index_path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                files, name = _opened(path)
                with files.open_input_file(name) as archive, files.open_input_stream(
                    _opened(index_path)[1], compression=None
                ) as index:
                    rows, size = [], 0
                    for line in index.read().splitlines():
                        offset, length, _, _ = json.loads(line)
                        archive.seek(offset)
                        rows.append(one(archive.read(length)))
                        size += rows[-1][2]
                        if size > 16 * CHUNK or len(rows) >= 5000:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)],
                                schema=schema,
                            )
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)],
                            schema=schema,
                        )

    kinds = (
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, payload binary"
    )
    parts = max(1, archives.count())
    return archives.select("path", "index_path").repartition(parts, "path").mapInArrow(read, kinds)


def with_revisits(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0
) -> DataFrame:
    """(page_id, url, payload, digest, refers_to, revisit) for each page.

    Of pages with equal payloads (SHA-1) of least_bytes or more, the smallest page_id is the response and the others
    revisit it. Rows that repeat that page_id with the same payload are responses too, as are rows without a page_id. A
    null payload is empty.
    """
    content = F.coalesce(F.encode(F.col(f"`{payload}`").cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), content.alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    firsts = (
        rows.filter(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("rows"))
        .filter("rows > 1 AND first IS NOT NULL")
        .select("digest", "first")
    )
    revisit = F.coalesce(F.col("first") != F.col("page_id"), F.lit(False))
    return rows.join(firsts, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"),
    )


def archive_pages(pages: DataFrame, least_bytes: int = 0, **columns: str) -> DataFrame:
    """Write pages as archives, normalise them, and read them back by their indexes.

    An empty table has no archives and gives no rows. Repeated rows each have a record. Other columns of pages are not
    carried.
    """
    spark = pages.sparkSession
    whole = write_archives(with_revisits(pages, least_bytes=least_bytes, **columns), shared_folder(spark, "warc-whole"))
    return read_archives(normalise(whole, shared_folder(spark, "warc-members")))
