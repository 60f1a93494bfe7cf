"""Media columns: payloads stored as images in archives, read back by a Spark data source.

Writing: each task streams its rows into ZIP archives of stored (uncompressed) members in a shared
folder, each member a lossless 8-bit greyscale PNG of the padded payload. An archive ends before it would
be longer than a byte range, so a range's reader sees an archive's directory once. It appears under its
final name, which depends on the partition and its number only, when it is complete; a repeated task
replaces it by equal bytes.

Reading: the data source `media_archive` plans byte ranges over the archives of a folder. A reader takes
the members whose local headers start in its range, by the archive's directory, and passes them on in
Arrow batches of bounded size. A member that can't be read is tried again by its offset, alone; after
the last try its row carries the error.

Defined results: null text counts as empty; the empty payload is one row of bytes 255; repeated rows and
ids give a member each; ids of any type, null too; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

import struct
import time
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .common import cut, remove, scratch

ROW = 576
RANGE_BYTES = 32 << 20
BATCH_BYTES = 8 << 20
TRIES = 3
MEMBERS = "archive string, member string, offset long, media binary, error string"
FEATURES = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string"
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def filesystem(path: str):
    """The file system of a uri or local path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def pad(raw: bytes) -> bytes:
    return raw + b"\xff" * (-len(raw) % ROW or ROW * (not raw))


def chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(payload: bytes) -> bytes:
    """A greyscale image of ROW columns, 8 bits a sample."""
    samples = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    lines = np.concatenate([np.zeros((len(samples), 1), np.uint8), samples], axis=1).tobytes()
    head = struct.pack(">IIBBBBB", ROW, len(samples), 8, 0, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines, 1)) + chunk(b"IEND", b"")


def from_png(media: bytes) -> bytes:
    """The samples of an image that `to_png` made; ValueError if it is damaged."""
    if media[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at, body, width = 8, [], 0
    while at < len(media):
        (n,) = struct.unpack_from(">I", media, at)
        kind, data = media[at + 4 : at + 8], media[at + 8 : at + 8 + n]
        if struct.unpack_from(">I", media, at + 8 + n)[0] != zlib.crc32(kind + data):
            raise ValueError("damaged chunk")
        if kind == b"IHDR":
            width = struct.unpack_from(">I", data)[0]
        elif kind == b"IDAT":
            body.append(data)
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(-1, width + 1)
    if lines[:, 0].any():
        raise ValueError("filtered lines")
    return lines[:, 1:].tobytes()


def features(payload: bytes) -> str:
    """Mean, deviation and entropy of the samples, and a 64-bit average hash of the image."""
    samples = np.frombuffer(payload, np.uint8)
    share = np.bincount(samples, minlength=256) / len(samples)
    entropy = float(-(share[share > 0] * np.log2(share[share > 0])).sum())
    image = samples.reshape(-1, ROW)
    rows = np.array_split(image, 8) if len(image) >= 8 else [image[i * len(image) // 8 : i * len(image) // 8 + 1] for i in range(8)]
    cells = np.array([r.reshape(len(r), 8, -1).mean(axis=(0, 2)) for r in rows])
    bits = (cells > cells.mean()).ravel()
    return f"mean={samples.mean():.4f};std={samples.std():.4f};entropy={entropy:.4f};ahash={int(''.join('01'[int(b)] for b in bits), 2):016x}"


def member_name(number: int, key: str | None, size: int) -> str:
    return f"{number:09d}_{'' if key is None else 'k' + quote(key, safe='')}_{size}.png"


def read_name(member: str) -> tuple[str | None, int]:
    """The id and the payload's size without padding."""
    key, _, size = member.removesuffix(".png").partition("_")[2].rpartition("_")
    return (unquote(key[1:]) if key else None), int(size)


def write_archives(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", archive_bytes: int = RANGE_BYTES) -> DataFrame:
    """Writes the archives when it is run: archive, members, bytes of each."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        context = TaskContext.get()
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        done = 0
        archive = stream = name = draft = None
        members = size = 0

        def end() -> pd.DataFrame:
            archive.close()
            stream.close()
            store.move(draft, f"{root}/{name}")
            return pd.DataFrame({"archive": [name], "members": [members], "bytes": [size]})

        for batch in batches:
            for key, text in zip(batch["id"], batch["text"], strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                media = to_png(pad(raw))
                if archive and size + len(media) > archive_bytes:
                    yield end()
                    archive, done = None, done + 1
                if not archive:
                    name, members, size = f"part-{context.partitionId():07d}-{done:05d}.zip", 0, 0
                    draft = f"{root}/.{name}-{context.taskAttemptId()}"
                    stream = store.open_output_stream(draft)
                    archive = zipfile.ZipFile(Counted(stream), "w", zipfile.ZIP_STORED)
                archive.writestr(zipfile.ZipInfo(member_name(members, key, len(raw))), media)
                members += 1
                size += len(media)
        if archive:
            yield end()

    return docs.selectExpr(f"CAST(`{id_col}` AS string) AS id", f"`{text_col}` AS text").mapInPandas(write, "archive string, members long, bytes long")


class Counted:
    """A stream that only goes forward, as zipfile writes to it."""

    def __init__(self, stream) -> None:
        self.stream = stream

    def write(self, data) -> int:
        self.stream.write(bytes(data))
        return len(data)

    def flush(self) -> None:
        pass


class ByteRange(InputPartition):
    def __init__(self, path: str, start: int, end: int) -> None:
        self.path, self.start, self.end = path, start, end


class ArchiveReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.folder = options["path"]
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.batch_bytes = int(options.get("batchBytes", BATCH_BYTES))
        self.tries = int(options.get("tries", TRIES))

    def partitions(self) -> list[ByteRange]:
        from pyarrow import fs

        store, root = filesystem(self.folder)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
        ends = [(x.path, x.size) for x in found if x.is_file and x.base_name.endswith(".zip") and not x.base_name.startswith(".")]
        return [ByteRange(path, a, min(a + self.range_bytes, size)) for path, size in sorted(ends) for a in range(0, size, self.range_bytes)] or [ByteRange("", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        store, _ = filesystem(self.folder)
        open_archive = lambda: zipfile.ZipFile(store.open_input_file(partition.path))
        archive = self.again(open_archive)
        own = sorted((x for x in archive.infolist() if partition.start <= x.header_offset < partition.end), key=lambda x: x.header_offset)
        rows: list[tuple] = []
        held = 0
        for info in own:
            media = error = None
            for turn in range(self.tries):
                try:
                    media, error = archive.read(info), None
                    break
                except (OSError, zipfile.BadZipFile, zlib.error, EOFError) as e:
                    error = f"{type(e).__name__}: {e}"
                    time.sleep(0.05 * turn)
                    archive = self.again(open_archive)
            rows.append((partition.path, info.filename, info.header_offset, media, error))
            held += len(media or b"")
            if held >= self.batch_bytes:
                yield batch_of(rows)
                rows, held = [], 0
        if rows:
            yield batch_of(rows)

    def again(self, do):
        for turn in range(self.tries):
            try:
                return do()
            except OSError:
                if turn == self.tries - 1:
                    raise
                time.sleep(0.05 * (turn + 1))


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["archive", "member", "offset", "media", "error"])


class ArchiveSource(DataSource):
    """Members of the ZIP archives in a folder. Options: path, rangeBytes, batchBytes, tries."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def read_archives(spark: SparkSession, folder: str, **options) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("media_archive").options(**{k: str(v) for k, v in options.items()}).load(folder)


def describe_media(members: DataFrame) -> DataFrame:
    """Per member: doc_id (as text), sizes and digests of payload and stored form, features, error."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        names = ["doc_id", *(x.split()[0] for x in FEATURES.split(", "))]
        for batch in batches:
            rows = []
            for member, media, error in zip(batch["member"], batch["media"], batch["error"], strict=True):
                doc_id, n_bytes = read_name(member)
                if error is None:
                    try:
                        payload = from_png(media)
                    except (ValueError, zlib.error, struct.error) as e:
                        error = f"{type(e).__name__}: {e}"
                if error is not None:
                    rows.append((doc_id, n_bytes, None, None, None, None, None, None, error))
                    continue
                rows.append((doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), features(payload), None))
            out = pd.DataFrame(rows, columns=names)
            for c in ("payload_bytes", "tail_crc32", "media_bytes"):
                out[c] = out[c].astype("Int64")
            yield out

    return members.select("member", "media", "error").mapInPandas(describe, f"doc_id string, {FEATURES}")


def media_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Stores every text and describes what is read back; `error` says what is wrong with a member that couldn't be read.

    The archives stay if a folder is named; else they go when they have been read.
    """
    spark = docs.sparkSession
    place = folder or scratch(spark, "media")
    write_archives(docs, place, id_col, text_col).agg({"members": "sum"}).collect()
    found = describe_media(read_archives(spark, place))
    found = found.withColumn("doc_id", F.col("doc_id").cast(dict(docs.dtypes)[id_col])).withColumnRenamed("doc_id", id_col)
    if not folder:
        found = cut(found)
        remove(spark, place)
    return found
