"""WARC archives in Zstandard: one frame per record, and the dictionary of
an archive in its leading skippable frame.

Writing: every page becomes a record whose payload is its html.  Of equal
payloads of some size the smallest page id is the response and the others
are revisits that refer to it (no payload of their own, its length and
digest kept).  A task writes its rows into archives of a bounded size in
the shared folder, each with a dictionary trained on the archive's own
first records; the list of archives is a Spark table, so an attempt that
was lost leaves at most files that no list names.

Reading: Spark's binary file source hands each archive to a task, which
loads the dictionary from the leading skippable frame, walks the frames by
their block headers, decodes one frame per record, and checks version,
mandatory headers, lengths, record end and payload digest.  A damaged
record raises with archive and offset.

Defined results: a null html is an empty payload; payloads under the limit
are all responses; a null page id is kept as null, and never is the
response others refer to while some id is known; repeated rows (same id and
payload) are all responses; control characters in urls are
percent-encoded; an empty table gives no archive and no row; further
columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm.common import ready, shared_folder, stored

#: Fixed values of the formats.
SKIPPABLE, FRAME, DICTIONARY = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
VERSION = b"WARC/1.1"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Parameters: an archive is closed beyond so many compressed bytes, its
#: dictionary has at most so many bytes and is trained on the first so many
#: bytes of records; payloads below the limit are never revisited.
ARCHIVE_BYTES, DICT_BYTES, SAMPLE_BYTES, REVISIT_FROM = 8 << 20, 16 << 10, 512 << 10, 100
LEVEL, DATE = 3, "2024-01-01T00:00:00Z"


def _urn(page_id) -> str:
    return "<urn:page>" if page_id is None else f"<urn:page:{quote(str(page_id), safe='')}>"


def _id(urn: str) -> str | None:
    return None if urn == "<urn:page>" else unquote(urn[len("<urn:page:"):-1])


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))])
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)),
               ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha256:{digest}"),
               ("Content-Type", "application/http;msgtype=response")]
    if url is not None:
        headers.append(("WARC-Target-URI", "".join(quote(c) if c < " " or c == "\x7f" else c for c in url)))
    if revisit:
        headers += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", PROFILE)]
    return record(headers, http if revisit else http + payload)


def trained(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A dictionary, or nothing where the records are too few to train one."""
    try:
        return zstandard.train_dictionary(size, samples, k=200, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def archives(records: Iterator[bytes], limit: int = ARCHIVE_BYTES) -> Iterator[tuple[bytes, int]]:
    """(archive, its records) for a stream of records; memory holds one
    archive and the sample before it."""
    out, count, wait, held, press = bytearray(), 0, [], 0, None

    def begin(samples):
        d = trained(samples)
        lead = struct.pack("<II", SKIPPABLE, len(d)) + d if d else b""
        kw = {"dict_data": zstandard.ZstdCompressionDict(d)} if d else {}
        return bytearray(lead), zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, **kw).compress

    info = record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'info')}>"),
                   ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")

    for rec in records:
        if press is None:
            wait.append(rec)
            held += len(rec)
            if held < SAMPLE_BYTES:
                continue
            out, press = begin(wait)
            todo, wait, held = [info, *wait], [], 0
            count = len(todo) - 1
        else:
            todo = [rec]
            count += 1
        for r in todo:
            out += press(r)
        if len(out) >= limit:
            yield bytes(out), count
            press = None
    if press is None and wait:
        out, press = begin(wait)
        for r in [info, *wait]:
            out += press(r)
        count = len(wait)
    if press is not None:
        yield bytes(out), count


def frame_end(data: bytes, at: int) -> int:
    """End of the frame at ``at``, by its block headers."""
    try:
        shape = zstandard.get_frame_parameters(data[at:at + 18])
        end = at + zstandard.frame_header_size(data[at:at + 18])
        while True:
            head = int.from_bytes(data[end:end + 3], "little")
            if end + 3 > len(data) or head >> 1 & 3 == 3:
                raise ValueError("bad block")
            end += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
            if head & 1:
                break
    except zstandard.ZstdError as e:
        raise ValueError(f"bad frame: {e}") from e
    end += 4 * shape.has_checksum
    if end > len(data):
        raise ValueError("the frame is cut off")
    return end


def records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of every record of an archive."""
    at, kw = 0, {}
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", data, 4)[0]
        lead, at = data[8:8 + size], 8 + size
        if len(lead) != size:
            raise ValueError("the dictionary frame is cut off")
        if lead[:4] == struct.pack("<I", FRAME):  # the dictionary may be compressed itself
            lead = zstandard.ZstdDecompressor().decompressobj().decompress(lead)
        if lead[:4] != struct.pack("<I", DICTIONARY):
            raise ValueError("the leading frame holds no dictionary")
        kw = {"dict_data": zstandard.ZstdCompressionDict(lead)}
    unpack = zstandard.ZstdDecompressor(**kw)
    while at < len(data):
        try:
            end = frame_end(data, at)
            raw = unpack.decompressobj().decompress(data[at:end])
            yield at, *parsed(raw)
        except (ValueError, zstandard.ZstdError) as e:
            raise ValueError(f"offset {at}: {e}") from e
        at = end


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record, checked."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] != VERSION:
        raise ValueError("not a WARC/1.1 record")
    headers = dict(line.decode().split(": ", 1) for line in lines[1:])
    if missing := [k for k in NEEDED if k not in headers]:
        raise ValueError(f"without {missing}")
    size = int(headers["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"{len(rest) - 4} bytes where {size} are declared")
    return headers, rest[:size]


def page_of(headers: dict[str, str], block: bytes) -> dict:
    """The page of a response or revisit record."""
    kind = headers["WARC-Type"]
    http, mark, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:])
    size = int(fields[b"Content-Length"])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if not mark or kind == "response" and len(payload) != size or kind == "revisit" and payload:
        raise ValueError("the payload's length is not the declared one")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("the payload's digest is not the declared one")
    return {"page_id": _id(headers["WARC-Record-ID"]), "url": headers.get("WARC-Target-URI"),
            "record_type": kind, "payload_bytes": size, "payload_digest": digest,
            "refers_to": _id(headers["WARC-Refers-To"]) if kind == "revisit" else None,
            "payload": payload if kind == "response" else None}


def _filesystem(folder: str) -> tuple[pa.fs.FileSystem, str]:
    if folder.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    if "://" in folder:
        return pa.fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
    return pa.fs.LocalFileSystem(), folder


def with_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str,
                  revisit_from: int = REVISIT_FROM) -> DataFrame:
    """(page_id, url, payload, digest, refers_to, revisit)."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    first = stored(rows.where(F.octet_length("payload") >= revisit_from).groupBy("digest")
                   .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1 and first is not null").select("digest", "first"), "responses")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to"),
        revisit.alias("revisit"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES,
                   revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Writes the archives into ``folder`` and returns (archive, records, bytes)."""
    ready(pages)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _filesystem(folder)
        fs.create_dir(path, recursive=True)

        def stream():
            for batch in batches:
                for k in range(batch.num_rows):
                    page_id, url, payload, digest, refers, revisit = (c[k].as_py() for c in batch.columns)
                    yield page_record(page_id, url, payload, digest, refers, revisit)

        for data, count in archives(stream(), archive_bytes):
            name = f"pages-{uuid.uuid4().hex}.warc.zst"
            with fs.open_output_stream(f"{path}/{name}", compression=None) as f:
                f.write(data)
            yield pa.record_batch([pa.array([name]), pa.array([count], pa.int64()),
                                   pa.array([len(data)], pa.int64())], names=["archive", "records", "bytes"])

    rows = with_revisits(pages, id_col, url_col, html_col, revisit_from)
    return stored(rows.mapInArrow(write, "archive string, records long, bytes long"), "archives")


SCHEMA = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("refers_to", pa.string()), ("payload", pa.binary())])


def read_archives(spark: SparkSession, folder: str, listed: DataFrame) -> DataFrame:
    """One row per page record of the listed archives of ``folder``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0), batch.column(1)):
                rows, size = [], 0
                try:
                    for _, headers, block in records(data.as_py()):
                        if headers["WARC-Type"] not in ("response", "revisit"):
                            continue
                        rows.append(page_of(headers, block))
                        size += len(block)
                        if size > 4_000_000:
                            yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                            rows, size = [], 0
                except ValueError as e:
                    raise ValueError(f"{path.as_py()}: {e}") from e
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    kept = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
            .join(listed.select("archive"), F.element_at(F.split("path", "/"), -1) == F.col("archive"), "left_semi"))
    return kept.select("path", "content").mapInArrow(
        read, "page_id string, url string, record_type string, payload_bytes long, "
              "payload_digest string, refers_to string, payload binary")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               **kw) -> DataFrame:
    """Pages written to archives and read back: page_id, payload_bytes,
    payload_digest, record_type, refers_to, url, payload."""
    spark = ready(pages)
    folder = shared_folder(spark, "warc")
    listed = write_archives(pages, folder, id_col, url_col, html_col, **kw)
    id_type = pages.schema[id_col].dataType
    if listed.isEmpty():
        back = spark.createDataFrame([], "page_id string, url string, record_type string, payload_bytes long, "
                                         "payload_digest string, refers_to string, payload binary")
    else:
        back = read_archives(spark, folder, listed)
    return back.select(F.col("page_id").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest",
                       "record_type", F.col("refers_to").cast(id_type).alias("refers_to"), "url", "payload")


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
