"""WARC archives with an index, written and read by byte ranges.

Writing makes one index row per record: file, offset, length, URL and digest.  Each task
writes files of its own, one gzip member per record, and a new file from ``FILE_BYTES`` on.
A task that is run again writes under other names; the index holds the rows of the run that
counted, so files of lost runs are never read.

Reading starts from the index, whichever rows of it were selected: rows are sorted by file
and offset, neighbouring ranges are coalesced into one read, and records are parsed out of
it.  Only the selected records travel.

Of records with equal payloads the one with the smallest id is a ``response``, the others
are ``revisit`` records that name it and hold no payload.  Who is first follows from
digests alone; payloads are shuffled only if more payloads repeat than can be broadcast.

Files are opened with ``pyarrow.fs``, so the folder may be local, HDFS or an object store.

Defined results: a null payload is empty; payloads under ``least`` bytes never revisit; of
rows that repeat id and payload all are responses if their id is the smallest; a null id is
a response only if all equal payloads have none; a null URL is written as ``urn:page:<id>``.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmark.llm.frames import stored
from textmark.operators.lookup import fits_broadcast
from textmark.runtime import work_folder

FILE_BYTES = 64 << 20
RANGE_BYTES = 8 << 20
GAP_BYTES = 64 << 10
DATE = "2024-01-01T00:00:00Z"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_INDEX = (
    "page_id long, file string, offset long, length long, url string, payload_digest string, "
    "record_type string, refers_to long"
)
_INDEX_NAMES = [x.split()[0] for x in _INDEX.split(", ")]


def bare_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}:{digest}')}>"


def _clean(url: str) -> str:
    """No blank or control character reaches a header line."""
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def _block(headers: list[tuple[str, str]], body: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in [*headers, ("Content-Length", str(len(body)))])
    return f"WARC/1.1\r\n{lines}\r\n".encode() + body + b"\r\n\r\n"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A record before compression."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _clean(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest))]
    return _block(headers, http.encode() + (b"" if revisit else payload))


def parsed(data: bytes) -> tuple[dict[str, str], int, bytes | None]:
    """Headers of a record, bytes of its payload, and the payload unless it is a revisit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = rest[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    if headers["WARC-Type"] == "revisit":
        return headers, size, None
    if len(payload) != size:
        raise ValueError("a payload is cut short")
    return headers, size, payload


def _gzipped(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, revisit, first in zip(
                    *(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "revisit", "first")), strict=True
                ):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out, at = files.open_output_stream(f"{root}/{name}", compression=None), 0
                    digest = bare_digest(payload)
                    url = f"urn:page:{page_id}" if url is None else url
                    data = _gzipped(record(page_id, url, payload, digest, first, revisit))
                    out.write(data)
                    rows.append((page_id, name, at, len(data), url, digest, "revisit" if revisit else "response", first if revisit else None))
                    at += len(data)
                if rows:
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=_INDEX_NAMES
                    )
        finally:
            if out is not None:
                out.close()

    return run


def write(
    df: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write a record per row of ``df`` below ``folder``; the written index of them."""
    pages = df.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    )
    digest = F.struct(F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("size"))
    digests = pages.select("page_id", digest.alias("digest")).where(F.col("digest.size") >= least)
    repeated = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = stored(repeated.where("n > 1").drop("n"), "warc-repeated")
    rows = pages.withColumn("digest", digest)
    rows = rows.join(F.broadcast(repeated) if fits_broadcast(repeated) else repeated, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.select("page_id", "url", "payload", "first", revisit.alias("revisit"))
    return stored(rows.mapInArrow(_writer(folder, file_bytes), _INDEX), "warc-index")


def ranges(rows: list[tuple[str, int, int]], gap: int, most: int) -> Iterator[tuple[str, int, int, int, int]]:
    """Runs of sorted ``(file, offset, length)`` that one read serves: (file, from, to, first, end)."""
    first = 0
    for i in range(1, len(rows) + 1):
        if i < len(rows):
            stop = max(rows[i - 1][1] + rows[i - 1][2], rows[first][1])
            near = rows[i][0] == rows[first][0] and rows[i][1] <= stop + gap
            if near and rows[i][1] + rows[i][2] - rows[first][1] <= most:
                continue
        stop = max(offset + length for _, offset, length in rows[first:i])
        yield rows[first][0], rows[first][1], stop, first, i
        first = i


_PAYLOADS = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
)


def _reader(folder: str, gap: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            index = batch.to_pylist()
            for name, start, stop, first, end in ranges([(x["file"], x["offset"], x["length"]) for x in index], gap, most):
                with files.open_input_file(f"{root}/{name}") as source:
                    data = memoryview(source.read_at(stop - start, start))
                out = []
                for row in index[first:end]:
                    at = row["offset"] - start
                    headers, size, payload = parsed(zlib.decompress(data[at : at + row["length"]], 31))
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if payload is not None and bare_digest(payload) != digest:
                        raise ValueError(f"{name} at {row['offset']}: the payload does not match its digest")
                    out.append((row["page_id"], headers["WARC-Target-URI"], headers["WARC-Type"], row["refers_to"], digest, size, payload))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=[x.split()[0] for x in _PAYLOADS.split(", ")],
                )

    return run


def read(index: DataFrame, folder: str, gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> DataFrame:
    """The records of the given index rows: ``_PAYLOADS``; a revisit's payload is null.

    Rows are dealt by file and stretch of ``most`` bytes, so each task reads its stretches
    in order; every payload is checked against its digest.
    """
    stretch = F.floor(F.col("offset") / most)
    rows = index.select("page_id", "file", "offset", "length", "refers_to")
    rows = rows.repartition("file", stretch).sortWithinPartitions("file", "offset")
    return rows.mapInArrow(_reader(folder, gap, most), _PAYLOADS)


def new_folder(spark: SparkSession) -> str:
    """A folder for archives below the shared one, as a URI or an absolute path."""
    return work_folder(spark, "warc")
