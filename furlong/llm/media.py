"""Media columns: a Spark data source of archive directories with members that are read by offset.

Writing: each task streams its payloads as PNG members (8-bit samples, SAMPLES a row) into ZIP archives of about
ARCHIVE_BYTES; a commit writes the list of archives, so those of failed or repeated attempts are never read.
Reading: the driver reads that list alone and plans byte ranges of about SPLIT_BYTES over the archives; a task reads
the directory at an archive's end, takes the members whose headers begin in its range and yields them as Arrow batches of
bounded bytes. Every member is read by its own offset, and read again alone, up to RETRIES times, when a read
fails or its checksum is wrong; a member that stays unreadable comes with null bytes and the error's text.

Null payloads are stored as empty members and come back as empty payloads. Null ids come back null, repeated
rows are separate members, an empty table gives an archive directory without members.
"""

from __future__ import annotations

import io
import json
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import new_path

SAMPLES, ARCHIVE_BYTES, SPLIT_BYTES, BATCH_BYTES, RETRIES = 576, 64 << 20, 8 << 20, 4 << 20, 3
MANIFEST = "_archives.json"
SIGNATURE = b"\x89PNG\r\n\x1a\n"
SCHEMA = "id string, archive string, offset bigint, attempts int, error string, media binary, payload binary, n_bytes bigint, feature string"


def padded(text: Column) -> Column:
    """The UTF-8 bytes of a text (null: empty), filled with bytes 255 to a positive multiple of SAMPLES."""
    raw = F.coalesce(text.cast("string"), F.lit("")).cast("binary")
    whole = F.greatest(F.ceil(F.octet_length(raw) / SAMPLES), F.lit(1)) * SAMPLES
    return F.rpad(raw, whole.cast("int"), F.unhex(F.lit("FF")))


def png_chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    """A grey PNG of 8-bit samples; the payload's length is a multiple of SAMPLES."""
    height, rest = divmod(len(payload), SAMPLES)
    if rest:
        raise ValueError(f"a payload of {len(payload)} bytes isn't whole rows of {SAMPLES}")
    rows = np.zeros((height, SAMPLES + 1), np.uint8)  # each row starts with filter 0
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(height, SAMPLES)
    return SIGNATURE + png_chunk(b"IHDR", struct.pack(">IIBBBBB", SAMPLES, height, 8, 0, 0, 0, 0)) + png_chunk(b"IDAT", zlib.compress(rows.tobytes(), 4)) + png_chunk(b"IEND", b"")


def from_png(media: bytes) -> bytes:
    """The samples of a PNG that to_png() made; ValueError if a checksum or the form is wrong."""
    if media[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at, packed, head = 8, [], None
    while at < len(media):
        size, kind = struct.unpack_from(">I4s", media, at)
        data = media[at + 8 : at + 8 + size]
        if struct.pack(">I", zlib.crc32(kind + data)) != media[at + 8 + size : at + 12 + size]:
            raise ValueError(f"checksum of {kind!r}")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", data)
        elif kind == b"IDAT":
            packed.append(data)
        at += 12 + size
    width, height, *form = head or (0, 0)
    rows = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8)
    if form != [8, 0, 0, 0, 0] or rows.size != height * (width + 1):
        raise ValueError("not a grey 8-bit PNG")
    rows = rows.reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("a filter that to_png() doesn't use")
    return rows[:, 1:].tobytes()


def feature(payload: bytes) -> str:
    """Size, mean, deviation and a 64-bit average hash over 64 equal stretches of samples."""
    samples = np.frombuffer(payload, np.uint8)
    if not samples.size:
        return f"{SAMPLES}x0"
    means = np.add.reduceat(samples, np.arange(64) * samples.size // 64, dtype=np.int64) / (samples.size / 64)
    bits = int("".join("1" if m > samples.mean() else "0" for m in means), 2)
    return f"{SAMPLES}x{samples.size // SAMPLES} mean={samples.mean():.3f} sd={samples.std():.3f} hash={bits:016x}"


@dataclass
class Range(InputPartition):
    archive: str
    start: int
    end: int

    def __init__(self, archive: str, start: int, end: int):
        self.archive, self.start, self.end = archive, start, end


@dataclass
class Written(WriterCommitMessage):
    archives: list[tuple[str, int]]


class Members:
    """The members of one archive, by offset."""

    def __init__(self, path: str):
        self.store, self.path = fs.FileSystem.from_uri(path)

    def listed(self) -> list[zipfile.ZipInfo]:
        with self.store.open_input_file(self.path) as f, zipfile.ZipFile(f) as archive:
            return archive.infolist()

    def once(self, info: zipfile.ZipInfo) -> bytes:
        with self.store.open_input_file(self.path) as f:
            name, extra = struct.unpack("<HH", f.read_at(4, info.header_offset + 26))
            data = f.read_at(info.compress_size, info.header_offset + 30 + name + extra)
        if len(data) != info.compress_size or zlib.crc32(data) != info.CRC:
            raise OSError("checksum of a member")
        return data

    def read(self, info: zipfile.ZipInfo) -> tuple[int, str | None, bytes | None]:
        """Attempts, the last error, and the bytes."""
        for attempt in range(1, RETRIES + 1):
            try:
                return attempt, None, self.once(info)
            except OSError as e:
                error = f"{type(e).__name__}: {e}"
                time.sleep(0.05 * attempt)
        return RETRIES, error, None


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Range]:
        store, path = fs.FileSystem.from_uri(f"{self.path}/{MANIFEST}")
        with store.open_input_stream(path) as f:
            archives = json.load(io.BytesIO(f.read()))
        return [Range(name, at, min(size, at + SPLIT_BYTES)) for name, size in archives for at in range(0, size, SPLIT_BYTES)] or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        members, rows, held = Members(f"{self.path}/{partition.archive}"), [], 0
        for info in members.listed():
            if not partition.start <= info.header_offset < partition.end:
                continue
            attempts, error, media = members.read(info)
            payload = None
            if media is not None:
                try:
                    payload = from_png(media)
                except (ValueError, zlib.error) as e:
                    error = f"{type(e).__name__}: {e}"
            said = info.filename.partition("-")[2].removesuffix(".png") or None
            of = (len(payload.rstrip(b"\xff")), feature(payload)) if payload is not None else (None, None)
            rows.append((said, partition.archive, info.header_offset, attempts, error, media, payload, *of))
            held += len(media or b"") + len(payload or b"")
            if held >= BATCH_BYTES:
                yield as_batch(rows)
                rows, held = [], 0
        if rows:
            yield as_batch(rows)


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.string()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


class ArchiveWriter(DataSourceArrowWriter):
    """Takes rows (id, payload)."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        done, archive, out, number = [], None, None, 0
        for batch in iterator:
            for said, payload in zip(batch.column(0).cast(pa.string()).to_pylist(), batch.column(1), strict=True):
                if archive is None:
                    name = f"archive-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.zip"
                    out = store.open_output_stream(f"{root}/{name}")
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
                    done.append((name, out))
                member = zipfile.ZipInfo(f"{number:09d}-{'' if said is None else said}.png")
                archive.writestr(member, to_png(payload.as_py() or b""))
                number += 1
                if out.tell() >= ARCHIVE_BYTES:
                    done[-1] = self.close(archive, out, name)
                    archive = None
        if archive is not None:
            done[-1] = self.close(archive, out, name)
        return Written(done)

    @staticmethod
    def close(archive: zipfile.ZipFile, out: pa.NativeFile, name: str) -> tuple[str, int]:
        archive.close()
        size = out.tell()
        out.close()
        return name, size

    def commit(self, messages: list[Written | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write(json.dumps([a for m in messages if m for a in m.archives]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        for message in messages:
            for name, _ in message.archives if message else ():
                store.delete_file(f"{root}/{name}")


class MediaArchives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "media_archives"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options["path"])


def store(media: DataFrame, path: str) -> None:
    """Write rows (id, payload) as a new archive directory."""
    media.sparkSession.dataSource.register(MediaArchives)
    media.write.format("media_archives").mode("append").option("path", path).save()


def load(spark: SparkSession, path: str) -> DataFrame:
    """The members of an archive directory, see SCHEMA."""
    spark.dataSource.register(MediaArchives)
    return spark.read.format("media_archives").option("path", path).load()


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text as media, read it back, and describe what was read."""
    path = new_path(docs.sparkSession, "media")
    store(docs.select(F.col(id_col).alias("id"), padded(F.col(text_col)).alias("payload")), path)
    read = load(docs.sparkSession, path)
    return read.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -32, 32)")).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature", "attempts", "error",
    )
