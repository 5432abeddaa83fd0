"""CSV output: partitioned results, and single named files for small tables."""

import os
import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from reviewloom.schemas import SUMMARY_SCHEMA
from reviewloom.sources.runs import CSV_OPTIONS, escape_nulls, read_results_csv
from reviewloom.sources.storage import hadoop_path, small_table

# What the writer appends to the names of files it packs with a codec.
CODEC_SUFFIXES = {
    "none": "",
    "uncompressed": "",
    "gzip": ".gz",
    "bzip2": ".bz2",
    "deflate": ".deflate",
    "lz4": ".lz4",
    "snappy": ".snappy",
    "zstd": ".zst",
}


PIECE_BYTES = 1 << 26  # fixed value: what a task copies of a file that is put together


def write_csv(df: DataFrame, path: str, compression: str | None = None, header: bool = True) -> str:
    """One part file per partition, each with the header; what is read back equals what was written."""
    codec_suffix(compression)
    writer = escape_nulls(df).write.mode("overwrite").options(**CSV_OPTIONS | {"header": str(header).lower()})
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)
    return path


def write_single_csv(df: DataFrame, directory: str, name: str, compression: str | None = None) -> str:
    """``<directory>/<name>.csv`` as one file, written by one task.

    For tables whose size does not grow with the data, such as aggregates and metrics.
    """
    return _write_single(
        df, directory, name, lambda one, path: write_csv(one, path, compression), ".csv" + codec_suffix(compression)
    )


def write_single_json(df: DataFrame, directory: str, name: str) -> str:
    return _write_single(df, directory, name, lambda one, path: one.write.json(path), ".json")


def write_single_text(lines: DataFrame, directory: str, name: str) -> str:
    return _write_single(lines, directory, name, lambda one, path: one.write.text(path), ".txt")


def merge_csv(
    spark: SparkSession,
    parts_path: str,
    directory: str,
    name: str,
    schema: StructType,
    compression: str | None = None,
) -> str:
    """Part files put together as one CSV file with one header, at any size.

    The rows are written by many tasks; on a shared file system (``file:``) many tasks also copy these pieces, each to its place in the file.
    Any other store takes no bytes at a place, so there one task writes the whole. With a codec, the file is packed piece by piece.
    """
    rows = read_results_csv(spark, parts_path, schema, split=True)
    suffix = ".csv" + codec_suffix(compression)
    if hadoop_path(spark, directory)[1].getUri().getScheme() != "file":
        return write_single_csv(rows, directory, name, compression)

    def write(df: DataFrame, staging: str) -> None:
        folders = [f"{staging}/header", f"{staging}/rows"]
        write_csv(spark.createDataFrame([], df.schema), folders[0], compression)
        write_csv(df, folders[1], compression, header=False)
        _put_together(spark, folders, f"{staging}/part-whole")

    return _write_single(rows, directory, name, write, suffix, one_task=False)


def metrics_row(spark: SparkSession, metrics: dict, schema: StructType = SUMMARY_SCHEMA) -> DataFrame:
    return small_table(spark, [tuple(metrics[name] for name in schema.names)], schema)


def codec_suffix(compression: str | None) -> str:
    """File name suffix of a codec; an unknown one is refused before anything is written."""
    codec = (compression or "none").lower()
    if codec not in CODEC_SUFFIXES:
        raise ValueError(f"unknown compression {compression}: one of {', '.join(CODEC_SUFFIXES)}")
    return CODEC_SUFFIXES[codec]


def _put_together(spark: SparkSession, folders: list[str], path: str) -> None:
    """The part files of ``folders``, one after the other, as one file. Every task copies one piece; to do so twice does no harm."""
    pieces, at = [], 0
    for folder in folders:
        parent, file_system = hadoop_path(spark, folder)
        found = {s.getPath().toUri().getPath(): s.getLen() for s in file_system.listStatus(parent)}
        for part in sorted(p for p in found if posixpath.basename(p).startswith("part-")):
            pieces += [(part, begin, min(PIECE_BYTES, found[part] - begin), at + begin) for begin in range(0, found[part], PIECE_BYTES)]
            at += found[part]
    target = hadoop_path(spark, path)[0].toUri().getPath()

    def copy(piece):
        part, begin, left, place = piece
        with open(part, "rb") as source, open(os.open(target, os.O_WRONLY | os.O_CREAT, 0o644), "wb") as sink:
            source.seek(begin)
            sink.seek(place)
            while left:
                data = source.read(min(left, 1 << 20))
                if not data:
                    raise OSError(f"{part} is shorter than it was")
                sink.write(data)
                left -= len(data)

    if pieces:
        spark.sparkContext.parallelize(pieces, len(pieces)).foreach(copy)


def _write_single(df: DataFrame, directory: str, name: str, write, extension: str, one_task: bool = True) -> str:
    spark = df.sparkSession
    staging = posixpath.join(directory, f".{name}-{uuid.uuid4().hex}")
    write(df.coalesce(1) if one_task else df, staging)
    staged, file_system = hadoop_path(spark, staging)
    target_path = posixpath.join(directory, name + extension)
    target, _ = hadoop_path(spark, target_path)
    part = next(
        status.getPath()
        for status in file_system.listStatus(staged)
        if status.getPath().getName().startswith("part-")
    )
    # The old file is moved aside, so that a crash loses neither it nor the new one.
    old, _ = hadoop_path(spark, posixpath.join(staging, "replaced"))
    if file_system.exists(target) and not file_system.rename(target, old):
        raise OSError(f"could not move {target_path} aside")
    if not file_system.rename(part, target):
        raise OSError(f"could not move {part.toString()} to {target_path}")
    file_system.delete(staged, True)
    return target_path
