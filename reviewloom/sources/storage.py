"""Paths: existence, size, scratch space."""

import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"


def hadoop_path(spark: SparkSession, path: str):
    """A Hadoop path and the file system it lives on."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Also true for a glob that matches something."""
    target, file_system = hadoop_path(spark, path)
    matches = file_system.globStatus(target)
    return matches is not None and len(matches) > 0


def input_size(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Number and total bytes of the files below a file, directory or glob.

    The file listing holds the sizes; the contents are not opened, because only ``length`` is
    selected.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listing.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
    )


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes below a file, directory or glob, asked from the file system without a job."""
    target, file_system = hadoop_path(spark, path)
    matches = file_system.globStatus(target)
    if not matches:
        raise FileNotFoundError(path)
    return sum(file_system.getContentSummary(match.getPath()).getLength() for match in matches)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below a folder the cluster shares: ``spark.checkpoint.dir``, else the warehouse."""
    root = spark.conf.get(CHECKPOINT_DIR, None) or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "scratch")
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")


def small_table(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A few driver-side rows, such as metrics, as a local relation (no Python worker runs)."""
    records = [dict(zip(schema.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)), schema)

