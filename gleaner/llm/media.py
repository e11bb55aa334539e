"""Media columns: payloads in archives, read by a custom Spark data source.

``write_archives`` packs each payload, as an 8-bit grey PNG 64 samples wide,
into archive files in a shared folder, one file per task: members (an id, then
the media) one after another, then a directory of fixed-size entries, then a
footer. A manifest names the archives of the tasks that Spark counted, so what a
lost task or its twin has left is never read. The data source ``gleaner_media``
plans partitions by byte ranges over the archives, finds a range's entries by
bisection of the directory, and streams the members that start in it as Arrow
batches of bounded size. A member whose bytes don't match its entry is read again
by its offset, alone, on a new handle.
"""

from __future__ import annotations

import hashlib
import struct
import time
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gleaner.llm.common import Scratch, table

WIDTH = 64
#: Bytes of payload in an Arrow batch, about, and of an archive in a partition.
BATCH_BYTES, RANGE_BYTES = 8 << 20, 32 << 20
_MAGIC = b"GLMEDIA1"
_MANIFEST = "_manifest"
_ENTRY = "<QQIQi"  # offset, length, crc32, bytes of text, bytes of the id (-1: no id)
_FOOTER = "<QQ8s"  # directory's offset, members, magic
_PNG = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def payload(data: bytes) -> bytes:
    """The data with bytes 0 up to a positive multiple of 64."""
    return data.ljust(max(1, -(-len(data) // WIDTH)) * WIDTH, b"\0")


def encode_png(data: bytes) -> bytes:
    """Lossless 8-bit grey PNG of a payload, a row for each 64 bytes."""
    rows = np.frombuffer(data, np.uint8).reshape(-1, WIDTH)
    raw = np.zeros((len(rows), WIDTH + 1), np.uint8)  # each row starts with filter type 0
    raw[:, 1:] = rows
    return _PNG + _chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(raw.tobytes(), 6)) + _chunk(b"IEND", b"")


def decode_png(data: bytes) -> bytes:
    """The samples of a PNG that ``encode_png`` made; raises ValueError for any other bytes."""
    if data[:8] != _PNG:
        raise ValueError("not a PNG")
    at, body, height = 8, [], 0
    while at < len(data):
        (n,), kind = struct.unpack_from(">I", data, at), data[at + 4 : at + 8]
        part = data[at + 8 : at + 8 + n]
        if zlib.crc32(kind + part) != struct.unpack_from(">I", data, at + 8 + n)[0]:
            raise ValueError("a chunk is damaged")
        if kind == b"IHDR":
            height = struct.unpack_from(">I", part, 4)[0]
        elif kind == b"IDAT":
            body.append(part)
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, WIDTH + 1)
    return rows[:, 1:].tobytes()


def features(data: bytes) -> str:
    """Mean, deviation, zero share and the mean step between neighbours of the samples, and the number of distinct ones."""
    x = np.frombuffer(data, np.uint8)
    counts = np.bincount(x, minlength=256)
    mean = x.mean(dtype=np.float64)
    steps = np.abs(x[1:].astype(np.int16) - x[:-1]).mean(dtype=np.float64)
    return f"mean={mean:.4f};std={x.std(dtype=np.float64):.4f};zeros={counts[0] / len(x):.6f};step={steps:.4f};levels={np.count_nonzero(counts)}"


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and its path there. Hadoop's names of S3 are known too; credentials come from the environment."""
    scheme, _, rest = uri.partition("://")
    if not rest:
        return pafs.FileSystem.from_uri("file://" + uri.removeprefix("file:"))
    return pafs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme)}://{rest}")


def write_archives(docs: DataFrame, folder: str) -> None:
    """Writes an archive per task into ``folder``, a shared one, and the manifest. Empty tasks write none.

    Every attempt of a task has a file of its own. The names of those that count,
    one for each task, reach the driver, which writes the manifest last.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, root = _open(folder)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        out, entries, at = None, [], 0
        for batch in batches:
            for key, text in zip(batch["doc_id"], batch["text"], strict=True):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}")
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                head = (key.as_py() or "").encode("utf-8", "surrogatepass")
                member = head + encode_png(payload(data))
                out.write(member)
                entries.append(struct.pack(_ENTRY, at, len(member), zlib.crc32(member), len(data), len(head) if key.is_valid else -1))
                at += len(member)
        if out is not None:
            out.write(b"".join(entries))
            out.write(struct.pack(_FOOTER, at, len(entries), _MAGIC))
            out.close()
            yield pa.record_batch({"name": [name]})

    names = sorted(r.name for r in docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(pack, "name string").collect())
    fs, root = _open(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{_MANIFEST}") as out:
        out.write("\n".join(names).encode())


@dataclass
class ByteRange(InputPartition):
    """Members of an archive that start at ``start`` or later, but before ``end``."""

    path: str
    start: int
    end: int


class ArchiveReader(DataSourceReader):
    def __init__(self, folder: str, range_bytes: int, batch_bytes: int, attempts: int):
        self.folder, self.range_bytes, self.batch_bytes, self.attempts = folder, range_bytes, batch_bytes, attempts

    def partitions(self) -> list[InputPartition]:
        """By the archives' sizes alone; their directories are read where the members are. Without a manifest all files of the folder are archives."""
        fs, root = _open(self.folder)
        if fs.get_file_info(f"{root}/{_MANIFEST}").type == pafs.FileType.File:
            with fs.open_input_file(f"{root}/{_MANIFEST}") as f:
                names = f.read().decode().split()
            found = fs.get_file_info([f"{root}/{n}" for n in names])
        else:
            found = [x for x in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if x.base_name[:1] not in "._"]
        out: list[InputPartition] = []
        for x in sorted(found, key=lambda x: x.path):
            out += [ByteRange(x.path, at, at + self.range_bytes) for at in range(0, x.size, self.range_bytes)]
        return out or [ByteRange("", 0, 0)]

    def _member(self, fs: pafs.FileSystem, file, path: str, at: int, n: int, crc: int) -> bytes:
        for attempt in range(self.attempts):
            try:
                with fs.open_input_file(path) if attempt else _Kept(file) as f:
                    data = f.read_at(n, at)
                if zlib.crc32(data) == crc:
                    return data
            except OSError:
                pass
            time.sleep(0.1 * attempt)
        raise OSError(f"member at offset {at} of {path} can't be read whole")

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = _open(self.folder)
        with fs.open_input_file(partition.path) as file:
            size = file.size()
            start, members, magic = struct.unpack(_FOOTER, file.read_at(struct.calcsize(_FOOTER), size - struct.calcsize(_FOOTER)))
            if magic != _MAGIC:
                raise ValueError(f"{partition.path} isn't an archive")
            each = struct.calcsize(_ENTRY)
            offsets = _Offsets(file, start, members)
            low, high = bisect_left(offsets, partition.start), bisect_left(offsets, partition.end)
            entries = struct.iter_unpack(_ENTRY, file.read_at((high - low) * each, start + low * each))
            ids, sizes, media, held = [], [], [], 0
            for at, n, crc, n_bytes, n_id in entries:
                member = self._member(fs, file, partition.path, at, n, crc)
                ids.append(member[:n_id].decode("utf-8", "surrogatepass") if n_id >= 0 else None)
                sizes.append(n_bytes)
                media.append(member[max(n_id, 0) :])
                held += n
                if held >= self.batch_bytes:
                    yield _batch(ids, sizes, media)
                    ids, sizes, media, held = [], [], [], 0
            if ids:
                yield _batch(ids, sizes, media)


class _Offsets:
    """The members' offsets in a directory, read one by one."""

    def __init__(self, file, start: int, members: int):
        self.file, self.start, self.members = file, start, members

    def __len__(self) -> int:
        return self.members

    def __getitem__(self, k: int) -> int:
        return struct.unpack("<Q", self.file.read_at(8, self.start + k * struct.calcsize(_ENTRY)))[0]


class _Kept:
    """Keeps a file open that its owner will close."""

    def __init__(self, file):
        self.file = file

    def __enter__(self):
        return self.file

    def __exit__(self, *_):
        return False


def _batch(ids: list, sizes: list[int], media: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch({"doc_id": pa.array(ids, pa.string()), "n_bytes": pa.array(sizes, pa.int64()), "media": pa.array(media, pa.binary())})


class ArchiveSource(DataSource):
    """``spark.read.format("gleaner_media").load(folder)``: id (as text), bytes of text and the stored bytes of each member.

    Options: ``range_bytes``, ``batch_bytes``, ``attempts`` for each member.
    """

    @classmethod
    def name(cls) -> str:
        return "gleaner_media"

    def schema(self) -> str:
        return "doc_id string, n_bytes long, media binary"

    def reader(self, schema) -> ArchiveReader:
        get = self.options.get
        return ArchiveReader(self.options["path"], int(get("range_bytes", RANGE_BYTES)), int(get("batch_bytes", BATCH_BYTES)), int(get("attempts", 4)))


def read_archives(spark: SparkSession, folder: str, **options) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("gleaner_media").options(**options).load(folder)


def media_features(media: DataFrame) -> DataFrame:
    """Digests and features of the source's rows, from the stored bytes alone."""
    fields = "doc_id string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for stored in batch["media"]:
                data = stored.as_py()
                x = decode_png(data)
                rows.append((len(x), hashlib.sha256(x).hexdigest(), zlib.crc32(x[-WIDTH:]), len(data), hashlib.sha256(data).hexdigest(), features(x)))
            cols = list(zip(*rows)) if rows else [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["doc_id", "n_bytes", *[f.split()[0] for f in fields.split(", ")[2:]]]
            yield pa.record_batch([batch["doc_id"], batch["n_bytes"], *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]], names)

    return media.mapInArrow(measure, fields)


def media_columns(docs: DataFrame) -> DataFrame:
    """Each text's payload through archives and back, with its features; a row per document.

    A null or empty text is stored as 64 bytes 0, with ``n_bytes`` 0. Rows that
    repeat an id each get a row, a null id stays null, and equal texts have equal
    values. Ids of any type that text can stand for are kept. An empty table gives
    an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = Scratch(spark, "media").path("archives")
    write_archives(docs, folder)
    found = media_features(read_archives(spark, folder))
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def op7_media_columns(spark, sf_dir: str) -> DataFrame:
    """``media_columns`` of whole ``documents``."""
    return media_columns(table(spark, sf_dir, "documents"))
