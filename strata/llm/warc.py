"""WARC archives with one Zstandard frame per record and a dictionary in a leading skippable frame.

Writer: every task trains a dictionary on its first payloads, writes it as a skippable frame and then one frame
per record. Archives get a fresh name per task attempt; the manifest lists those of the attempts that counted, so
leftovers of lost executors are never read. Reader: every archive of the manifest is streamed frame by frame; a
record that is malformed gives a row with `error` instead of stopping the job.

Defined cases: a null payload is empty; a null url gives a record without target; a null id is written empty and
read as null; rows with the same id are records of their own; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_bytes, record_batch, saved, shuffle_partitions
from strata.plans.workspace import work_dir

DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE_FIRST, SKIPPABLE_LAST = 0x184D2A50, 0x184D2A5F
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
RECORD_ID = "urn:strata:record:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 1 << 20

MANIFEST = pa.schema([("archive", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])
RECORDS = pa.schema(
    [
        ("archive", pa.string()),
        ("position", pa.int64()),
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("target_uri", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.string()),
        ("payload", pa.binary()),
        ("error", pa.string()),
    ]
)


def with_revisits(pages: DataFrame, id_column: str, payload: str, min_bytes: int = 1000) -> DataFrame:
    """Add `_digest` (hex SHA-1 of the payload), `_revisit` and `_refers_to`.

    Of rows with equal payloads of at least `min_bytes`, that with the largest id is kept and the others revisit it;
    rows without an id revisit it too, and where none has an id all are kept. Only digests that occur more than once
    meet the rows again, in an outer join whose hot digests adaptive execution can split.
    """
    content = F.coalesce(F.col(f"`{payload}`"), F.lit("")).cast("binary")
    ids = pages.select(F.col(f"`{id_column}`").alias("_refers_to"), F.sha1(content).alias("_digest"), F.octet_length(content).alias("_n"))
    groups = ids.where(F.col("_n") >= min_bytes).groupBy("_digest")
    repeated = groups.agg(F.max("_refers_to").alias("_refers_to"), F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
    joined = pages.withColumn("_digest", F.sha1(content)).join(repeated.drop("_copies"), "_digest", "left")
    other = F.col("_refers_to").isNotNull() & ~F.col(f"`{id_column}`").eqNullSafe(F.col("_refers_to"))
    return joined.withColumn("_revisit", other).withColumn("_refers_to", F.when(other, F.col("_refers_to")))


def _record(record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{RECORD_ID}{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{RECORD_ID}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes], size: int) -> zstandard.ZstdCompressionDict | None:
    """None where the samples are too few or too alike to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8)
    except (zstandard.ZstdError, ValueError, MemoryError):
        return None


class _Archive:
    def __init__(self, folder: str, dictionary: zstandard.ZstdCompressionDict | None, level: int):
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        files, path = pyarrow.fs.FileSystem.from_uri(self.uri)
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.stream = files.open_output_stream(path, compression=None)
        self.records = self.bytes = 0
        self.coder = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True, write_content_size=True)
        if dictionary is not None:
            content = dictionary.as_bytes()
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(content)) + content)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.bytes += len(data)

    def add(self, record: bytes) -> None:
        self._put(self.coder.compress(record))
        self.records += 1

    def close(self) -> pa.RecordBatch:
        self.stream.close()
        return record_batch({"archive": [self.uri], "n_records": [self.records], "n_bytes": [self.bytes]}, MANIFEST)


def write_archives(
    records: DataFrame,
    folder: str,
    *,
    date: str = "1970-01-01T00:00:00Z",
    level: int = 3,
    dictionary_bytes: int = 65536,
    sample_bytes: int = 1 << 20,
    archive_bytes: int = 1 << 30,
) -> DataFrame:
    """Write rows (record_id text, url, payload text, digest hex, refers_to text or null) and return the manifest.

    The dictionary of a task is trained on its first `sample_bytes` of payload; `archive_bytes` is the size after
    which a task begins the next archive. `folder` must be shared by all executors.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                names = [batch.column(c).to_pylist() for c in ("record_id", "url", "digest", "refers_to")]
                yield from zip(*names, as_bytes(batch.column("payload")))

        archive, sample, size, pending = None, [], 0, rows()
        for row in pending:
            sample.append(row)
            size += len(row[4])
            if size >= sample_bytes:
                break
        dictionary = _dictionary([row[4] for row in sample if row[4]], dictionary_bytes)
        for record_id, url, digest, refers_to, payload in chain(sample, pending):
            archive = archive or _Archive(folder, dictionary, level)
            archive.add(_record(record_id or "", url, payload, digest, refers_to, date))
            if archive.bytes >= archive_bytes:
                yield archive.close()
                archive = None
        if archive is not None:
            yield archive.close()

    wanted = records.select(
        F.col("record_id").cast("string"), "url", "payload", "digest", F.col("refers_to").cast("string").alias("refers_to")
    )
    return saved(wanted.mapInArrow(pack, "archive string, n_records bigint, n_bytes bigint"), "warc-manifest")


class _Frames:
    """The frames of an archive, one after the other, with bounded buffering of the compressed side."""

    def __init__(self, stream: pa.NativeFile):
        self.stream, self.held = stream, b""
        self.decoder = zstandard.ZstdDecompressor()

    def _fill(self, n: int) -> bool:
        while len(self.held) < n:
            more = self.stream.read(max(READ_BYTES, n - len(self.held)))
            if not more:
                return False
            self.held += more
        return True

    def _skippable(self) -> tuple[int, bytes] | None:
        if not self._fill(8):
            return None
        magic, size = struct.unpack_from("<II", self.held)
        if not SKIPPABLE_FIRST <= magic <= SKIPPABLE_LAST:
            return None
        if not self._fill(8 + size):
            raise ValueError("skippable frame is cut short")
        content, self.held = self.held[8 : 8 + size], self.held[8 + size :]
        return magic, content

    def open(self) -> None:
        """Read the dictionary, which may itself be compressed, where the archive begins with one."""
        frame = self._skippable()
        if frame is not None and frame[0] == DICTIONARY_FRAME:
            content = frame[1]
            if content.startswith(ZSTD_MAGIC):
                content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
            self.decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))

    def __iter__(self) -> Iterator[bytes]:
        while True:
            while self._skippable() is not None:
                pass
            if not self._fill(1):
                return
            frame, parts = self.decoder.decompressobj(), []
            while not frame.eof:
                if not self._fill(1):
                    raise ValueError("record frame is cut short")
                parts.append(frame.decompress(self.held))
                self.held = frame.unused_data if frame.eof else b""
            yield b"".join(parts)


def _fields(lines: list[bytes]) -> dict[str, str]:
    fields = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise ValueError("header line without a colon")
        fields.setdefault(name.strip().lower(), value.strip())
    return fields


def parse_record(data: bytes) -> dict:
    """A record as a row; raises ValueError where headers, lengths or digest don't agree."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not gap or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError("no WARC version line")
    fields = _fields(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"no {name} header")
    if not fields["content-length"].isdigit():
        raise ValueError("content-length is no number")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("content-length and record length differ")
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    status, *lines = http.split(b"\r\n")
    if not gap or not status.startswith(b"HTTP/"):
        raise ValueError("no HTTP message in the block")
    n_bytes = _fields(lines).get("content-length", "")
    if not n_bytes.isdigit():
        raise ValueError("HTTP message without a length")
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "")
    if not digest.startswith("sha1:"):
        raise ValueError("no SHA-1 payload digest")
    digest = base64.b32decode(digest[5:]).hex()
    if kind == "response" and (int(n_bytes) != len(payload) or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("payload doesn't fit its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ValueError("revisit with a payload or without a reference")
    return {
        "record_id": fields["warc-record-id"].strip("<>"),
        "record_type": kind,
        "target_uri": fields.get("warc-target-uri"),
        "payload_bytes": int(n_bytes),
        "payload_digest": digest,
        "refers_to": fields["warc-refers-to"].strip("<>") if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the archives that column `archive` names: where they stand, their headers, payload and `error`.

    An archive that ends early or holds a damaged frame gives one row with `error` for it, after the records before.
    """
    names = RECORDS.names

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                files, path = pyarrow.fs.FileSystem.from_uri(uri)
                rows, size, position = [], 0, 0
                with files.open_input_stream(path, compression=None) as stream:
                    frames = _Frames(stream)
                    try:
                        frames.open()
                        for data in frames:
                            try:
                                row = parse_record(data)
                            except (ValueError, UnicodeError) as error:
                                row = {"error": str(error)}
                            if not with_payload:
                                row.pop("payload", None)
                            rows.append({"archive": uri, "position": position} | row)
                            position, size = position + 1, size + (len(data) if with_payload else 200)
                            if size >= 8 << 20:
                                yield record_batch({c: [r.get(c) for r in rows] for c in names}, RECORDS)
                                rows, size = [], 0
                    except (ValueError, zstandard.ZstdError) as error:
                        rows.append({"archive": uri, "position": position, "error": f"archive: {error}"})
                if rows:
                    yield record_batch({c: [r.get(c) for r in rows] for c in names}, RECORDS)

    schema = "archive string, position bigint, record_id string, record_type string, target_uri string, payload_bytes bigint, payload_digest string, refers_to string, payload binary, error string"
    spread = manifest.select("archive").repartition(shuffle_partitions(manifest.sparkSession), "archive")
    return spread.mapInArrow(unpack, schema)


def id_of(urn: Column) -> Column:
    """The page id in a record id; null where it is empty."""
    return F.substring_index(urn, ":", -1).try_cast("bigint")


def archived_pages(pages: DataFrame, id_column: str, url: str, payload: str, min_bytes: int = 1000) -> DataFrame:
    """Write one record per row and read the archives back."""
    marked = with_revisits(pages.select(id_column, url, payload), id_column, payload, min_bytes)
    records = marked.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("record_id"),
        F.col(url).alias("url"),
        F.col(payload).alias("payload"),
        F.col("_digest").alias("digest"),
        F.col("_refers_to").alias("refers_to"),
    )
    manifest = write_archives(records, work_dir(pages.sparkSession, "warc"))
    return read_archives(manifest, with_payload=False)
