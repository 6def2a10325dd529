"""Web archives as Zstandard WARC files: a leading skippable frame with the dictionary, then one frame per record.

Writing is a map over typed rows: each task fills archives in the given folder and returns a manifest row per closed archive. Names are new for
every attempt, and only archives in the manifest count, so a repeated task leaves at most files that nobody reads. The folder must
be one that all executors reach (a path or a URI that Arrow's file systems know).

Reading takes a manifest (paths). The frame's end is found from its block headers, so an archive is read in steps and no more than one record
is decoded at a time. Checked are: the dictionary frame, that a frame holds exactly one record, version line, mandatory headers,
Content-Length against the block, the closing line ends, and the payload's digest. ``errors="raise"`` stops at the first fault,
``"report"`` returns it as a row with ``error`` and goes on with the next frame.

Defined cases: null and empty payloads are written as empty ones; null ids and urls come back as null; rows
repeated in full are records of their own, and if they are the first of their payload all of them are responses. An empty
table gives an empty manifest and no records. Payloads are taken whole; one must fit in memory.
"""

from __future__ import annotations

import hashlib
import math
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import shared_folder, staged

# Fixed values of the format.
SKIPPABLE_DICTIONARY = 0x184D2A5D
FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
MANDATORY = (b"WARC-Record-ID", b"WARC-Type", b"WARC-Date", b"Content-Length")

ID_PREFIX, ID_END = "<urn:plumbline:page:", ">"
LEAST_REVISIT = 100             # smaller payloads are written again
HOT_COPIES = 1000               # of a payload, from which on it is looked up in a broadcast list
MOST_HOT = 500_000              # rows of that list
ARCHIVE_BYTES = 64 << 20        # an archive is closed beyond this
DICTIONARY_BYTES = 64 << 10
DICTIONARY_SAMPLE = 200         # payloads a dictionary is made from; it changes the compression only
SAMPLE_BYTES = 16 << 10         # of each of them
READ_BYTES = 1 << 20
READ_TASK_BYTES = 16 << 20      # of archives per reading task

_MANIFEST = "path string, n_records bigint, n_bytes bigint"
_RECORD = [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
           ("payload_digest", pa.string()), ("payload_length", pa.int64()), ("payload", pa.binary()), ("path", pa.string()),
           ("error", pa.string())]


class WarcError(ValueError):
    pass


# Typing rows

def typed_records(pages: DataFrame, least: int = LEAST_REVISIT, hot: int = HOT_COPIES) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to. Digests and ids are shuffled to find the first page of
    each payload that occurs more than once. Payloads of more than ``hot`` copies are looked up in a broadcast list, of at most a row
    per ``hot`` pages and MOST_HOT rows; the others by their digest, where pages that have nothing to look up are dealt out by a
    key of their own. If the list of the others is small enough to be broadcast, no payload is shuffled."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")) \
        .withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))
    firsts = staged(rows.where(F.col("payload_bytes") >= least).groupBy(F.col("payload_digest").alias("_digest"))
                    .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    while firsts.where(F.col("_n") > hot).count() > MOST_HOT:
        hot *= 2
    often = firsts.where(F.col("_n") > hot).select(F.col("_digest").alias("_often"), F.col("_first").alias("_often_first"))
    rows = rows.join(F.broadcast(often), (F.col("payload_digest") == F.col("_often")) & (F.col("payload_bytes") >= least), "left")
    alone = F.concat(F.lit("-"), F.xxhash64("page_id", "url", "payload_digest").cast("string"))
    rows = rows.withColumn("_key", F.when(F.col("_often").isNull() & (F.col("payload_bytes") >= least), F.col("payload_digest")).otherwise(alone))
    rare = firsts.where(F.col("_n") <= hot).select("_digest", "_first")
    joined = rows.join(rare, rows["_key"] == rare["_digest"], "left")
    found = F.col("_often").isNotNull() | F.col("_digest").isNotNull()
    first = F.when(F.col("_often").isNotNull(), F.col("_often_first")).otherwise(F.col("_first"))
    again = found & first.isNotNull() & ~first.eqNullSafe(F.col("page_id"))
    return joined.withColumn("record_type", F.when(again, "revisit").otherwise("response")) \
        .withColumn("refers_to", F.when(again, first)).drop("_digest", "_first", "_often", "_often_first", "_key")


# Writing

def trained_dictionary(pages: DataFrame, samples: int = DICTIONARY_SAMPLE) -> bytes:
    """A dictionary made from a few payloads, or empty if they do not suffice."""
    some = [bytes(r[0]) for r in pages.where("html IS NOT NULL").select(F.substring(F.col("html").cast("binary"), 1, SAMPLE_BYTES))
            .limit(samples).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, some).as_bytes() if len(some) >= 10 else b""
    except zstandard.ZstdError:
        return b""


def _header(name: str, value: object) -> bytes:
    return f"{name}: {str(value)}\r\n".replace("\r\n\r\n", "\r\n").encode()


def record_bytes(record_id: str, kind: str, uri: str | None, date: str, payload: bytes, digest: str, length: int,
                 refers_to: str | None) -> bytes:
    """One record with its closing line ends. A revisit holds the response's headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    lines = [VERSION + b"\r\n", _header("WARC-Type", kind), _header("WARC-Record-ID", record_id), _header("WARC-Date", date)]
    if uri is not None:
        lines.append(_header("WARC-Target-URI", "".join(c for c in uri if c not in "\r\n")))
    if refers_to is not None:
        lines += [_header("WARC-Refers-To", refers_to),
                  _header("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    lines += [_header("WARC-Payload-Digest", f"sha256:{digest}"), _header("Content-Type", "application/http; msgtype=response"),
              _header("Content-Length", len(block))]
    return b"".join([*lines, b"\r\n", block, b"\r\n\r\n"])


class ArchiveWriter:
    def __init__(self, folder: str, dictionary: bytes):
        self.files, root = fs.FileSystem.from_uri(folder)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.path = f"{folder.rstrip('/')}/{self.name}"
        self.files.create_dir(root, recursive=True)
        self.out = self.files.open_output_stream(f"{root.rstrip('/')}/{self.name}", compression=None)     # by its name Arrow would compress it again
        self.n_records = self.n_bytes = 0
        used = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=used, write_content_size=True, write_checksum=True)
        if dictionary:
            packed = zstandard.ZstdCompressor(level=9).compress(dictionary)
            self._write(struct.pack("<II", SKIPPABLE_DICTIONARY, len(packed)) + packed)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.n_bytes += len(data)

    def add(self, record: bytes) -> None:
        self._write(self.compressor.compress(record))
        self.n_records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.n_records, self.n_bytes


def write_archives(records: DataFrame, folder: str, dictionary: bytes = b"", date: str = "2024-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes typed rows as archives and returns the manifest, itself written, so that no later job writes them again."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        closed = []
        for batch in batches:
            for page, url, payload, length, digest, kind, first in zip(*(c.to_pylist() if c.type != pa.binary() else c for c in batch.columns)):
                archive = archive or ArchiveWriter(folder, dictionary)
                archive.add(record_bytes(f"{ID_PREFIX}{page}{ID_END}", kind, url, date, payload.as_py(), digest, length,
                                         f"{ID_PREFIX}{first}{ID_END}" if kind == "revisit" else None))
                if archive.n_bytes >= archive_bytes:
                    closed.append(archive.close())
                    archive = None
        if archive:
            closed.append(archive.close())
        yield pa.RecordBatch.from_arrays([pa.array([c[i] for c in closed], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
                                         ["path", "n_records", "n_bytes"])

    typed = records.select(F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("page_id"), "url", "payload", "payload_bytes",
                           "payload_digest", "record_type", F.col("refers_to").cast("string").alias("refers_to"))
    return staged(typed.mapInArrow(write, _MANIFEST))


# Reading

def frame_end(data: bytes | memoryview, at: int) -> int | None:
    """Where the frame that begins at ``at`` ends; None if ``data`` does not hold all of it."""
    try:
        end = at + zstandard.frame_header_size(data[at:at + 18])
        checked = zstandard.get_frame_parameters(data[at:at + 18]).has_checksum
    except zstandard.ZstdError:
        if len(data) - at < 18:
            return None
        raise WarcError("no Zstandard frame") from None
    while True:
        if end + 3 > len(data):
            return None
        head = int.from_bytes(data[end:end + 3], "little")
        end += 3 + (1 if (head >> 1) & 3 == 1 else head >> 3)
        if head & 1:
            end += 4 * checked
            return end if end <= len(data) else None


def frames(stream) -> Iterator[tuple[int, bytes]]:
    """(magic, bytes) of each frame of an archive, read in steps; for a skippable frame its content."""
    data = b""
    while True:
        at = 0
        while len(data) - at >= 8:
            magic, size = struct.unpack_from("<II", data, at)
            if magic & 0xFFFFFFF0 == 0x184D2A50:
                end = at + 8 + size if at + 8 + size <= len(data) else None
                begin = at + 8
            elif magic == FRAME:
                end, begin = frame_end(data, at), at
            else:
                raise WarcError(f"unknown frame {magic:#x}")
            if end is None:
                break
            yield magic, data[begin:end]
            at = end
        more = stream.read(max(READ_BYTES, len(data) - at))
        if not more:
            if len(data) > at:
                raise WarcError("the archive ends within a frame")
            return
        data = data[at:] + more


def parsed(record: bytes) -> tuple[dict[bytes, bytes], bytes]:
    """Headers and block of one record, checked."""
    end = record.find(b"\r\n\r\n")
    if end < 0:
        raise WarcError("no end of headers")
    version, *lines = record[:end].split(b"\r\n")
    if version not in (VERSION, b"WARC/1.0"):
        raise WarcError(f"version {version[:20]!r}")
    headers = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name:
            raise WarcError(f"header line {line[:40]!r}")
        headers[name] = value.strip()
    if missing := [h for h in MANDATORY if h not in headers]:
        raise WarcError(f"without {missing}")
    if not headers[b"Content-Length"].isdigit():
        raise WarcError("Content-Length is no number")
    length = int(headers[b"Content-Length"])
    if len(record) != end + 4 + length + 4 or record[-4:] != b"\r\n\r\n":
        raise WarcError(f"a block of {length} bytes in a record of {len(record)}, headers {end + 4}")
    return headers, record[end + 4:-4]


def _http(block: bytes) -> tuple[int | None, bytes]:
    """Declared length and body of an HTTP response."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        raise WarcError("no HTTP response")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.lower() == b"content-length":
            return int(value), body
    return None, body


def record_row(record: bytes, path: str) -> tuple:
    headers, block = parsed(record)
    text = {k: v.decode("utf-8", "replace") for k, v in headers.items()}
    kind, digest = text[b"WARC-Type"], text.get(b"WARC-Payload-Digest", "")
    payload, length = None, None
    if kind in ("response", "revisit") and text.get(b"Content-Type", "").startswith("application/http"):
        length, body = _http(block)
        if kind == "response":
            if length is not None and length != len(body):
                raise WarcError(f"a payload of {len(body)} bytes, declared {length}")
            if digest.startswith("sha256:") and hashlib.sha256(body).hexdigest() != digest[7:]:
                raise WarcError("payload does not have its digest")
            payload, length = body, len(body)
    if kind == "revisit" and b"WARC-Refers-To" not in headers:
        raise WarcError("a revisit of nothing")
    return (text[b"WARC-Record-ID"], kind, text.get(b"WARC-Target-URI"), text.get(b"WARC-Refers-To"), digest.removeprefix("sha256:"),
            length, payload, path, None)


def archive_rows(path: str, errors: str = "raise") -> Iterator[tuple]:
    """A row per record of an archive, in order."""
    files, place = fs.FileSystem.from_uri(path)
    fault = lambda e: (None,) * 7 + (path, str(e))      # noqa: E731
    with files.open_input_stream(place, compression=None) as stream:
        decompressor, leading = zstandard.ZstdDecompressor(), True
        try:
            for magic, data in frames(stream):
                if magic != FRAME:
                    if leading and magic == SKIPPABLE_DICTIONARY:
                        own = zstandard.ZstdDecompressor().decompress(data) if data[:4] == struct.pack("<I", FRAME) else data
                        decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(own))
                    leading = False
                    continue
                leading = False
                try:
                    size = zstandard.frame_content_size(data)
                    yield record_row(decompressor.decompress(data) if size >= 0 else decompressor.decompressobj().decompress(data), path)
                except (WarcError, zstandard.ZstdError, ValueError) as e:
                    if errors == "raise":
                        raise WarcError(f"{path}: {e}") from e
                    yield fault(e)
        except (WarcError, zstandard.ZstdError) as e:
            if errors == "raise":
                raise
            yield fault(e)      # no later frame can be found


def read_archives(manifest: DataFrame, errors: str = "raise", task_bytes: int = READ_TASK_BYTES) -> DataFrame:
    """All records of the archives of a manifest (path, n_bytes), with whole payloads. Revisits have none."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_RECORD)],
                                              [name for name, _ in _RECORD])

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for row in archive_rows(path, errors):
                    rows.append(row)
                    size += len(row[6] or b"")
                    if size >= 8 * READ_BYTES:
                        yield out(rows)
                        rows, size = [], 0
                yield out(rows)

    sizes = manifest.agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    tasks = min(max(1, sizes["n"]), max(manifest.sparkSession.sparkContext.defaultParallelism, math.ceil((sizes["bytes"] or 0) / task_bytes)))
    schema = ", ".join(f"{n} {'bigint' if t == pa.int64() else 'binary' if t == pa.binary() else 'string'}" for n, t in _RECORD)
    return manifest.select("path").repartition(tasks).mapInArrow(read, schema)


def page_id_of(record_id):
    """The page id in a record id of this writer; null for a page without one."""
    return F.nullif(F.substring_index(F.substring_index(record_id, ":", -1), ">", 1), F.lit("")).cast("long")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes a record per page to archives in the shared folder and reads them back: page_id and the record's columns."""
    folder = shared_folder(pages.sparkSession)
    manifest = write_archives(typed_records(pages), folder, trained_dictionary(pages))
    records = read_archives(manifest)
    return records.select(page_id_of("record_id").alias("page_id"), "record_type", page_id_of("refers_to").alias("refers_to"),
                          "target_uri", "payload", "payload_digest", "payload_length", "path")
