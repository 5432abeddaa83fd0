"""Token ids as files of independent zstandard frames with a trailing seek table.

A file holds one frame for each document, in ascending id order, then two skippable frames that
every zstandard reader passes over: the ids of the documents, and the seek table of the seekable
format (compressed size, size and checksum of each frame, then a footer of nine bytes). A reader takes the footer, the table
and the frames it wants, and decompresses nothing else.
"""

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.llm.staging import staged
from reviewloom.llm.textbytes import slices
from reviewloom.llm.tokens import encoder_for

# Fixed values of the file format.
SKIPPABLE_IDS = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
_ID = np.dtype([("id", "<i8"), ("known", "u1")])
_READ_BYTES = 8_000_000


class ArchiveWriter:
    """Writes one file: ``add`` documents in order, then ``close``."""

    def __init__(self, stream, level: int = 3):
        self._stream = stream
        self._zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self._entries: list[tuple[int, int, int]] = []
        self._ids: list[tuple[int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self._zstd.compress(ids)
        self._stream.write(frame)
        self._entries.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self._ids.append((doc_id or 0, doc_id is not None))

    def close(self) -> None:
        ids = np.array(self._ids, _ID).tobytes()
        self._stream.write(struct.pack("<II", SKIPPABLE_IDS, len(ids)) + ids)
        table = np.array(self._entries, _ENTRY).tobytes()
        footer = struct.pack("<IBI", len(self._entries), CHECKSUMS, SEEKABLE_MAGIC)
        self._stream.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table) + len(footer)) + table + footer)
        self._stream.close()


class ArchiveReader:
    """Reads frames of one file; what is not asked for stays compressed."""

    def __init__(self, file):
        self._file = file
        size = file.size()
        n, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        table_at = size - 9 - n * _ENTRY.itemsize
        self.entries = np.frombuffer(file.read_at(n * _ENTRY.itemsize, table_at), _ENTRY)
        ids_at = table_at - 8 - n * _ID.itemsize
        self.ids = np.frombuffer(file.read_at(n * _ID.itemsize, ids_at), _ID)
        self.begins = np.cumsum(self.entries["packed"].astype(np.int64)) - self.entries["packed"]
        self._zstd = zstandard.ZstdDecompressor()

    def _checked(self, number: int, frame: bytes) -> bytes:
        ids = self._zstd.decompress(frame)
        entry = self.entries[number]
        if len(ids) != entry["size"] or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != entry["check"]:
            raise ValueError(f"frame {number} is damaged")
        return ids

    def frame(self, number: int) -> bytes:
        """Ids of one document, as little-endian 32-bit numbers."""
        return self._checked(number, self._file.read_at(int(self.entries["packed"][number]), int(self.begins[number])))

    def frames(self):
        """All of them in order, read in runs of some megabytes."""
        begin, n = 0, len(self.entries)
        while begin < n:
            end = int(np.searchsorted(self.begins, self.begins[begin] + _READ_BYTES))
            end = min(max(end, begin + 1), n)
            at = self.begins[begin:end] - self.begins[begin]
            sizes = self.entries["packed"][begin:end].astype(np.int64)
            run = self._file.read_at(int(at[-1] + sizes[-1]), int(self.begins[begin]))
            for i, b, s in zip(range(begin, end), at.tolist(), sizes.tolist(), strict=True):
                yield self._checked(i, run[b : b + s])
            begin = end


def write_archive(
    df: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    partitions: int | None = None,
) -> DataFrame:
    """Writes the files below ``path`` (a folder every executor reaches) and returns their manifest, written too:
    ``part``, ``file``, ``n_documents``, ``n_tokens``.

    Parts are ranges of ids, so parts and frames are in ascending order; null ids come first, rows with the same id
    are ordered by a hash of their text. Null texts are empty and hold the end id. Each attempt of a task writes a file of its own name;
    only those that the manifest lists count, so a lost executor leaves a stray file at worst.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").alias("text")
    )
    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def write(batches):
        encoder = encoder_for(tokenizer)
        system, root = pyarrow.fs.FileSystem.from_uri(path)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.tok.zst"
        system.create_dir(root, recursive=True)
        end = np.array([end_id], "<u4").tobytes()
        documents = tokens = 0
        writer = ArchiveWriter(system.open_output_stream(f"{root}/{name}", compression=None))
        for batch in batches:
            known = batch.column(0).to_pylist()
            at = 0
            for texts in slices(batch.column(1)):
                ids, first = encoder(texts)
                raw, bounds = ids.astype("<u4").tobytes(), (first * 4).tolist()
                for doc_id, b, e in zip(known[at:], bounds, bounds[1:], strict=False):
                    writer.add(doc_id, raw[b:e] + end)
                documents += len(texts)
                tokens += len(ids) + len(texts)
                at += len(texts)
        writer.close()
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "file": [name], "n_documents": [documents], "n_tokens": [tokens]}
        )

    schema = "part long, file string, n_documents long, n_tokens long"
    return staged(ranged.mapInArrow(write, schema), "manifest")


def read_archive(manifest: DataFrame, path: str) -> DataFrame:
    """Every document of the files: ``doc_id``, ``start`` (ids before it in all files), ``n_tokens``,
    ``ids_crc32``, ``part`` and ``frame``; checksums are verified.

    The manifest has one row for each file, so prefix sums over it stay small.
    """
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("base", F.coalesce(before, F.lit(0)))
    spread = files.repartition(max(1, manifest.count()), "part").select("part", "file", "base")

    def read(batches):
        system, root = pyarrow.fs.FileSystem.from_uri(path)
        for batch in batches:
            for part, name, base in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                with system.open_input_file(f"{root}/{name}") as file:
                    reader = ArchiveReader(file)
                    checks = np.array([zlib.crc32(ids) for ids in reader.frames()], np.int64)
                    counts = reader.entries["size"].astype(np.int64) // 4
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(reader.ids["id"].astype(np.int64), mask=reader.ids["known"] == 0),
                            "start": base + np.cumsum(counts) - counts,
                            "n_tokens": counts,
                            "ids_crc32": checks,
                            "part": np.full(len(counts), part, np.int64),
                            "frame": np.arange(len(counts), dtype=np.int64),
                        }
                    )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, part long, frame long"
    return spread.mapInArrow(read, schema)


def read_documents(manifest: DataFrame, path: str, wanted: DataFrame) -> DataFrame:
    """``doc_id`` and ``ids`` of the documents of ``wanted`` (a table with ``doc_id``): each file's index is read,
    and only the frames asked for are fetched and decompressed."""
    listed = read_index(manifest, path).join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")

    def fetch(batches):
        system, root = pyarrow.fs.FileSystem.from_uri(path)
        for batch in batches:
            table = batch.to_pandas()
            for name, rows in table.groupby("file"):
                with system.open_input_file(f"{root}/{name}") as file:
                    reader = ArchiveReader(file)
                    ids = [reader.frame(i) for i in rows["frame"].tolist()]
                yield pa.RecordBatch.from_pydict({"doc_id": rows["doc_id"].to_numpy(), "ids": ids})

    return listed.select("file", "frame", "doc_id").mapInArrow(fetch, "doc_id long, ids binary")


def read_index(manifest: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``file``, ``frame``, ``n_tokens`` of every document, from the files' tables alone."""

    def read(batches):
        system, root = pyarrow.fs.FileSystem.from_uri(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_file(f"{root}/{name}") as file:
                    reader = ArchiveReader(file)
                n = len(reader.entries)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(reader.ids["id"].astype(np.int64), mask=reader.ids["known"] == 0),
                        "file": [name] * n,
                        "frame": np.arange(n, dtype=np.int64),
                        "n_tokens": reader.entries["size"].astype(np.int64) // 4,
                    }
                )

    spread = manifest.repartition(max(1, manifest.count()), "part").select("file")
    return spread.mapInArrow(read, "doc_id long, file string, frame long, n_tokens long")


def archive_of(spark: SparkSession, df: DataFrame, path: str, tokenizer: str, end_id: int) -> DataFrame:
    """Written and read back."""
    return read_archive(write_archive(df, path, tokenizer, end_id), path)
