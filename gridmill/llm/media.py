"""Media columns: payloads in archives, read by a Spark data source of their own.

``media_archive`` is a Python data source that writes and reads a folder of
archives. A payload is stored as an image: 64 pixels of 8-bit red, green and blue a
row (192 bytes), deflated without loss, as PNG. An archive holds members one after
the other, each with a head of its own (id, sizes, checksum), and at its end a
directory of where every ``RANGE``-th byte's first member begins.

Writing: tasks stream Arrow batches into an archive each and report its name; the
commit writes the list of archives, so that those of failed attempts are never read.
Reading: the plan takes only the archives' directories, and makes a partition of each
byte range; a partition streams its members' payloads through Arrow. A member that
comes out damaged, or a read that fails, is tried again by its own offset, without
the members before it.

Defined cases: a null text is empty, and its payload is 192 blanks; null ids stay
null; repeated rows are stored and returned each; an empty table gives an empty
result; only the id and the text are stored.
"""

from __future__ import annotations

import hashlib
import json
import struct
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from gridmill.llm.common import filesystem, scratch, small_batches, table, tidy, utf8

ROW = 192
#: Bytes of archive in a partition.
RANGE = 8 << 20
TRIES = 4
SCHEMA = "doc_id {}, n_bytes long, media binary, payload binary"
LISTING = "archives.json"
_HEAD = struct.Struct("<4sBQQQI")  # mark, kind of the id, its bytes, payload's own bytes, media bytes, crc of id and media
_NO_ID, _NUMBER, _NAME = 0, 1, 2
_MARK = b"MEMB"
_TAIL = struct.Struct("<QQ4s")  # offset and length of the directory
_PNG = b"\x89PNG\r\n\x1a\n"  # fixed value: how such images begin
_BATCH = 4 << 20


def payload_of(text: bytes) -> bytes:
    """The text with blanks up to a whole number of rows, one at least."""
    return text + b" " * (-len(text) % ROW if text else ROW)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_image(payload: bytes, level: int = 4) -> bytes:
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    lines = np.concatenate([np.zeros((len(rows), 1), np.uint8), rows], axis=1)  # each line is unfiltered
    head = struct.pack(">IIBBBBB", ROW // 3, len(rows), 8, 2, 0, 0, 0)
    return _PNG + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def from_image(media: bytes) -> bytes:
    at, data = len(_PNG), []
    while at < len(media):
        (size,) = struct.unpack_from(">I", media, at)
        if media[at + 4 : at + 8] == b"IDAT":
            data.append(media[at + 8 : at + 8 + size])
        at += size + 12
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(-1, ROW + 1)
    return lines[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """Mean sample, share of different neighbours, and a histogram of 16 steps, in whole numbers."""
    x = np.frombuffer(payload, np.uint8)
    steps = np.bincount(x >> 4, minlength=16)
    changes = int((x[1:] != x[:-1]).sum())
    return f"mean={int(x.sum(dtype=np.int64)) * 1000 // len(x)};edges={changes * 1000 // len(x)};hist={','.join(map(str, steps.tolist()))}"


@dataclass
class ByteRange(InputPartition):
    archive: str
    first: int
    last: int

    def __init__(self, archive: str, first: int, last: int):
        super().__init__((archive, first, last))
        self.archive, self.first, self.last = archive, first, last


@dataclass
class Written(WriterCommitMessage):
    archive: str | None


class Damaged(IOError):
    pass


def read_member(source, offset: int) -> tuple[int | str | None, int, bytes, int]:
    """(id, payload's own bytes, media, offset of the next member) of the member at an offset."""
    source.seek(offset)
    head = source.read(_HEAD.size)
    if len(head) < _HEAD.size:
        raise Damaged(f"no member at {offset}")
    mark, kind, name, own, size, crc = _HEAD.unpack(head)
    body = source.read(name + size) if mark == _MARK else b""
    if mark != _MARK or len(body) < name + size or zlib.crc32(body) != crc:
        raise Damaged(f"the member at {offset} is damaged")
    doc_id = None if kind == _NO_ID else int(body[:name]) if kind == _NUMBER else body[:name].decode()
    return doc_id, own, body[name:], offset + _HEAD.size + name + size


def members(open_source, first: int, last: int, tries: int = TRIES, wait: float = 0.2) -> Iterator[tuple[int | str | None, int, bytes]]:
    """The members in [first, last). ``open_source`` opens the archive anew for another try."""
    source, at = open_source(), first
    try:
        while at < last:
            for attempt in range(tries):
                try:
                    doc_id, own, media, after = read_member(source, at)
                    break
                except OSError:
                    if attempt + 1 == tries:
                        raise
                    time.sleep(wait * 2**attempt)
                    source.close()
                    source = open_source()
            yield doc_id, own, media
            at = after
    finally:
        source.close()


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, ids: str = "long"):
        self.folder, self.ids = folder, ids

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = filesystem(self.folder)
        name, sink, starts, at, due = f"{uuid.uuid4().hex}.archive", None, [], 0, 0
        for batch in iterator:
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                if sink is None:
                    fs.create_dir(root, recursive=True)
                    sink = fs.open_output_stream(f"{root}/{name}", compression=None)
                if at >= due:
                    starts.append(at)
                    due = at + RANGE
                media = to_image(payload_of(text))
                label, kind = b"" if doc_id is None else str(doc_id).encode(), _NO_ID if doc_id is None else _NUMBER if isinstance(doc_id, int) else _NAME
                sink.write(_HEAD.pack(_MARK, kind, len(label), len(text), len(media), zlib.crc32(media, zlib.crc32(label))) + label + media)
                at += _HEAD.size + len(label) + len(media)
        if sink is None:
            return Written(None)
        directory = np.array(starts, "<u8").tobytes()
        sink.write(directory + _TAIL.pack(at, len(directory), b"TAIL"))
        sink.close()
        return Written(name)

    def commit(self, messages: list) -> None:
        fs, root = filesystem(self.folder)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{LISTING}", compression=None) as sink:
            sink.write(json.dumps({"ids": self.ids, "archives": [m.archive for m in messages if m is not None and m.archive]}).encode())

    def abort(self, messages: list) -> None:
        """Nothing to undo: what is not listed is not read."""


class ArchiveReader(DataSourceReader):
    def __init__(self, folder: str, ids: str = "long"):
        self.folder, self.ids = folder, ids

    def partitions(self) -> list[ByteRange]:
        fs, root = filesystem(self.folder)
        names = listing(self.folder)["archives"]
        out = []
        for name in names:
            with fs.open_input_file(f"{root}/{name}") as source:
                source.seek(source.size() - _TAIL.size)
                end, length, _ = _TAIL.unpack(source.read(_TAIL.size))
                source.seek(end)
                starts = np.frombuffer(source.read(length), "<u8").tolist()
            out += [ByteRange(name, a, b) for a, b in zip(starts, [*starts[1:], end])]
        return out or [ByteRange("", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(self.folder)
        schema = pa.schema([("doc_id", pa.int64() if self.ids == "long" else pa.string()), ("n_bytes", pa.int64()), ("media", pa.binary()), ("payload", pa.binary())])
        held: list[tuple] = []
        size = 0
        if partition.archive:
            for doc_id, own, media in members(lambda: fs.open_input_file(f"{root}/{partition.archive}"), partition.first, partition.last):
                payload = from_image(media)
                held.append((doc_id, own, media, payload))
                size += len(payload)
                if size > _BATCH:
                    yield pa.record_batch(list(map(pa.array, zip(*held), schema.types)), schema=schema)
                    held, size = [], 0
        if held:
            yield pa.record_batch(list(map(pa.array, zip(*held), schema.types)), schema=schema)


class MediaArchive(DataSource):
    """``spark.read.format("media_archive").option("path", folder)``, and the same to write
    (doc_id long or string, text string)."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return SCHEMA.format(listing(self.options["path"])["ids"])

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options["path"], _ids(schema))

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options["path"], _ids(schema))


def _ids(schema) -> str:
    return "long" if schema["doc_id"].dataType.typeName() == "long" else "string"


def listing(folder: str) -> dict:
    """Names of the archives, and the type of their ids."""
    fs, root = filesystem(folder)
    with fs.open_input_stream(f"{root}/{LISTING}") as source:
        return json.loads(source.read())


def register(spark: SparkSession) -> None:
    small_batches(spark)
    spark.dataSource.register(MediaArchive)


def write_archives(docs: DataFrame, folder: str, text: str = "text") -> None:
    """Whole numbers stay numbers; ids of other types are written as text."""
    register(docs.sparkSession)
    kind = "long" if docs.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long") else "string"
    docs.select(F.col("doc_id").cast(kind).alias("doc_id"), F.col(text).alias("text")).write.format("media_archive").option("path", folder).mode("append").save()


def media_features(media: DataFrame, kind: str | None = None) -> DataFrame:
    """Sizes, checksums and the feature string of archived members; ids in the type ``kind``,
    or as they were written."""
    stored = media.schema["doc_id"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stored, payloads = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            yield pa.record_batch(
                [
                    batch.column(0), batch.column(1), pa.array([len(p) for p in payloads], pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p in payloads], pa.string()),
                    pa.array([zlib.crc32(p[-16:]) for p in payloads], pa.int64()), pa.array([len(m) for m in stored], pa.int64()), pa.array([hashlib.sha256(m).hexdigest() for m in stored], pa.string()), pa.array([feature_of(p) for p in payloads], pa.string()),
                ],
                names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )

    return media.select("doc_id", "n_bytes", "media", "payload").mapInArrow(tidy(measure), f"doc_id {stored}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string").withColumn("doc_id", F.col("doc_id").cast(kind or stored))


def op7_media(spark, sf_dir: str) -> DataFrame:
    folder, docs = scratch(spark, "media"), table(spark, sf_dir, "documents")
    write_archives(docs, folder)
    return media_features(spark.read.format("media_archive").option("path", folder).load(), docs.schema["doc_id"].dataType.simpleString())
