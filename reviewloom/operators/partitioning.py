"""Partition planning and partition profiles."""

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MIB = 1024 * 1024
SLACK = 1.5  # times by which a scan's mean partition may exceed the target, and its partitions their planned number
_PLACE = "_place"
ROW_BYTES = 64  # fixed value: what a row counts besides its text, so that empty texts are dealt out too


def task_slots(spark: SparkSession) -> int:
    """Tasks that can run at the same time."""
    task_cpus = int(spark.conf.get("spark.task.cpus", "1"))
    return max(1, spark.sparkContext.defaultParallelism // task_cpus)


def plan_by_file_size(size_bytes: int, target_mb: float, slots: int) -> int:
    """Whole targets that fit in the input, rounded up to full waves of tasks."""
    whole_targets = max(1, int(size_bytes / MIB / target_mb))
    waves = -(-whole_targets // slots)
    return waves * slots


def plan_by_ceiling(size_bytes: int, target_bytes: int, min_partitions: int = 1) -> int:
    """Targets needed to hold the input, and at least ``min_partitions``."""
    return max(min_partitions, math.ceil(size_bytes / target_bytes))


def estimated_row_bytes(mean_text_length: float) -> float:
    """Two bytes per character and 200 for the rest of the row."""
    return mean_text_length * 2 + 200


def plan_by_row_size(mean_text_length: float | None, rows: int, target_bytes: int) -> tuple[int, int]:
    """(rows per partition, partitions) from the mean text length."""
    per_partition = max(1, int(target_bytes / estimated_row_bytes(mean_text_length or 0.0)))
    return per_partition, max(1, int(rows / per_partition))


def text_size_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Row count, mean text length and UTF-8 bytes of a text column, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.avg(F.length(text_col)).alias("mean_text_length"),
        F.coalesce(F.sum(F.octet_length(text_col).cast("bigint")), F.lit(0)).alias("text_bytes"),
    )


def serialized_size(df: DataFrame) -> DataFrame:
    """Characters of all rows written out as JSON."""
    as_json = F.to_json(F.struct(*[F.col(f"`{name}`") for name in df.columns]))
    return df.agg(F.coalesce(F.sum(F.length(as_json).cast("bigint")), F.lit(0)).alias("serialized_chars"))


def repartition_by_rows(df: DataFrame, target_mb: float, text_col: str = "text") -> tuple[int, DataFrame]:
    """(partitions, ``df`` dealt to them) by the row sizes of ``df`` itself, so a sample is not planned as its whole file."""
    stats = text_size_stats(df, text_col).first()
    _, partitions = plan_by_row_size(
        stats["mean_text_length"], stats["total_reviews"], int(target_mb * MIB)
    )
    return partitions, df.repartition(partitions)


def repartition_by_bytes(
    df: DataFrame, target_mb: float | None = None, partitions: int | None = None, text_col: str = "text"
) -> tuple[int, DataFrame]:
    """(partitions, ``df`` dealt to them in equal shares of bytes), for texts whose lengths differ by orders of magnitude.

    One pass over the text column adds up the bytes of each scan task. Their prefix sums (a number for each task, sent to the executors) give every
    task its place in the whole; while the rows are read again, a running sum gives each row its own place, and so its partition. A partition
    therefore exceeds the mean by less than one row. Rows move once. The input must read the same rows both times, as
    a file scan does. A null text counts as an empty one.
    """
    if (target_mb is None) == (partitions is None):
        raise ValueError("either a target size or a number of partitions is needed")
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint") + ROW_BYTES
    tasks = df.groupBy(F.spark_partition_id().alias("task")).agg(F.sum(size).alias("bytes")).collect()
    total = sum(row["bytes"] for row in tasks)
    wanted = partitions or plan_by_ceiling(total, int(target_mb * MIB))
    before = np.zeros(max((row["task"] for row in tasks), default=0) + 2, np.int64)
    for row in tasks:
        before[row["task"] + 1] = row["bytes"]
    starts, share = df.sparkSession.sparkContext.broadcast(np.cumsum(before)), max(total, 1) / wanted
    schema = StructType(list(df.schema.fields)).add(_PLACE, "integer")

    def place(batches):
        task = TaskContext.get().partitionId()
        at = int(starts.value[min(task, len(starts.value) - 1)])
        for batch in batches:
            sizes = batch.column(batch.num_columns - 1).to_numpy()
            ends = at + np.cumsum(sizes)
            places = np.minimum((ends - sizes) / share, wanted - 1).astype(np.int32)
            at = int(ends[-1]) if len(ends) else at
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(places)], names=schema.names)

    placed = df.withColumn(_PLACE, size).mapInArrow(place, schema)
    return wanted, placed.repartitionById(wanted, _PLACE).drop(_PLACE)


def partition_bytes(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Non-empty partitions, their bytes in all, the largest, and its ratio to the mean."""
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint") + ROW_BYTES
    each = df.groupBy(F.spark_partition_id().alias("partition")).agg(F.sum(size).alias("bytes"))
    return each.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
        F.max("bytes").alias("max_bytes"),
        (F.max("bytes") / F.avg("bytes")).alias("max_to_mean"),
    )


def scan_partitions(df: DataFrame) -> int:
    """Partitions of a DataFrame without a shuffle in it: planning only, no data is read.

    With a shuffle in it, asking for its partitions would run that shuffle.
    """
    return df.rdd.getNumPartitions()


def spread_plan(df: DataFrame, size_bytes: int, target_mb: float = 128) -> tuple[int, str]:
    """(partitions, ``"keep"``, ``"merge"`` or ``"shuffle"``) for a scan of ``size_bytes``.

    A large splittable input is read in splits of about the target size already, so shuffling it
    would move all bytes for nothing. Only a scan that leaves task slots idle (a small file), or
    whose partitions are too large (a gzip file is read by one task), is shuffled, row by row in turn: measuring such
    an input first would read it twice. Partitions that are too small are merged in place. So the number is the planned one, or
    the scan's own where that is between the planned number and ``SLACK`` times it.
    """
    slots = task_slots(df.sparkSession)
    wanted = plan_by_file_size(size_bytes, target_mb, slots)
    partitions = scan_partitions(df)
    if partitions < slots or size_bytes > partitions * target_mb * MIB * SLACK:
        return wanted, "shuffle"
    if partitions > wanted * SLACK:
        return wanted, "merge"
    return partitions, "keep"


def spread(df: DataFrame, plan: tuple[int, str]) -> DataFrame:
    partitions, how = plan
    if how == "shuffle":
        return df.repartition(partitions)
    return df.coalesce(partitions) if how == "merge" else df


def spread_evenly(df: DataFrame, size_bytes: int, target_mb: float = 128) -> DataFrame:
    """Give a scan the partitions its size and the cluster call for (see ``spread_plan``)."""
    return spread(df, spread_plan(df, size_bytes, target_mb))


def partition_profile(df: DataFrame) -> DataFrame:
    """Non-empty partitions and the rows they hold."""
    per_partition = df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return per_partition.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.min("rows").alias("min_rows"),
        F.avg("rows").alias("avg_rows"),
        F.max("rows").alias("max_rows"),
    )
