"""Reproducible samples that hold at any size.

A row's place in the random order is the MD5 of seed and key, so the sample does not depend on
how the input is partitioned. ``take_random`` does not sort: it looks for the hash below which
exactly ``n`` rows lie, and keeps the rows up to it.
"""

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegralType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from reviewloom.sources.storage import scratch_path

_PREFIX_DIGITS = 5  # 16**5, about a million histogram buckets
_HASH = "_order_hash"
_HEAD_GROUPS = 1000  # groups of tasks whose first rows are merged separately
_NULL_KEY = "\\N"
_TASK_ROWS = 2**33  # fixed value: row numbers that monotonically_increasing_id leaves for a task


def order_hash(df: DataFrame, seed: int = 42, keys: list[str] | None = None) -> Column:
    """Pseudo-random, partitioning-independent sort value of a row.

    ``keys`` names columns that identify a row; without it the exact values of the whole row are hashed
    (all digits of numbers, microseconds of timestamps).
    """
    if keys:
        parts = [F.coalesce(F.col(key).cast("string"), F.lit(_NULL_KEY)) for key in keys]
    else:
        parts = [F.to_json(F.struct(*[_exact(field).alias(field.name) for field in df.schema.fields]))]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def _exact(field: StructField) -> Column:
    """A value that JSON keeps without loss; null stays null."""
    value, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, MapType):
        value = F.array_sort(F.map_entries(value))
    if isinstance(kind, MapType | ArrayType | StructType):
        return F.when(value.isNotNull(), F.struct(value.alias("json"), F.xxhash64(value).alias("exact")))
    return value if isinstance(kind, StringType | IntegralType | BooleanType) else value.cast("string")


def shuffle_rows(
    df: DataFrame, seed: int = 42, keys: list[str] | None = None, partition_dependent: bool = False
) -> DataFrame:
    """Whole input in random order: a range-partitioned sort, for callers that want the order.

    Rows with the same hash (copies) have no order among themselves; a random second sort value
    lets Spark put a large group of them into several partitions.

    ``partition_dependent=True`` sorts by ``rand(seed)`` alone, which is cheaper to evaluate but
    gives another order for another partitioning.
    """
    if partition_dependent:
        return df.orderBy(F.rand(seed))
    return df.orderBy(order_hash(df, seed, keys), F.rand(seed))


def sample_ratio(
    df: DataFrame, ratio: float | None, seed: int = 42, keys: list[str] | None = None
) -> DataFrame:
    """Bernoulli sample for ``0 < ratio < 1``; None, 0 and values from 1 up keep every row.

    With ``keys`` the choice hangs on the hash of the key. Without, rows are drawn one by one:
    a hash of the content would keep or drop all copies of a text together.
    """
    if ratio is not None and ratio < 0:
        raise ValueError("the sample ratio must not be negative")
    if not ratio or ratio >= 1:
        return df
    if not keys:
        return df.sample(withReplacement=False, fraction=ratio, seed=seed)
    threshold = math.ceil(ratio * 2**32)
    if threshold == 2**32:
        return df
    return df.filter(F.substring(order_hash(df, seed, keys), 1, 8) < F.lit(f"{threshold:08x}"))


class _Cut(NamedTuple):
    hash: str
    copies: int  # rows that share the hash
    wanted: int  # of these, rows that belong to the sample


def _crossing(hashes: DataFrame, digits: int, n: int):
    """Of the rows grouped by the first ``digits`` of their hash, the group in which the ``n``-th row lies, or None.

    Groups are counted per task before the shuffle, and their number is bounded by the five digits that are new.
    """
    groups = hashes.groupBy(F.substring(_HASH, 1, digits).alias("prefix")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(_HASH).alias("least"), F.max(_HASH).alias("most")
    )
    running = F.sum("rows").over(Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
    return groups.withColumn("through", running).filter(F.col("through") >= n).orderBy("prefix").first()


def _find_cut(near: DataFrame, n: int) -> _Cut:
    """Hash of the ``n``-th row of ``near``, five more digits at a time until one hash is left."""
    digits = _PREFIX_DIGITS
    while True:
        digits += _PREFIX_DIGITS
        group = _crossing(near, digits, n)
        n -= group["through"] - group["rows"]
        if group["least"] == group["most"]:
            return _Cut(group["least"], group["rows"], n)
        near = near.filter(F.col(_HASH).between(group["least"], group["most"]))


def take_random(
    df: DataFrame, n: int | None, seed: int = 42, keys: list[str] | None = None
) -> DataFrame:
    """Exactly ``n`` random rows (all of them when there are fewer); 0 and None keep every row.

    Reads the input twice, right away. The first pass counts rows per prefix of their hash (a million counters at most, summed before the
    shuffle), which tells the prefix that holds the ``n``-th row. The second writes all rows up to that prefix, about a millionth of the
    input too many, to a table in the shared folder; the exact cut is found in that table, and the result is a filter on
    it, with no sort, no shuffle and no single task that all sampled rows would have to pass. The input must read the same rows
    both times, as a file scan does; its columns must be of types that Parquet holds.
    """
    if n is not None and n < 0:
        raise ValueError("the sample count must not be negative")
    if not n:
        return df
    hashed = df.withColumn(_HASH, order_hash(df, seed, keys))
    bucket = _crossing(hashed.select(_HASH), _PREFIX_DIGITS, n)
    if bucket is None:
        return df
    sample = _written(hashed.filter(F.substring(_HASH, 1, _PREFIX_DIGITS) <= F.lit(bucket["prefix"])))
    before = bucket["through"] - bucket["rows"]
    # Bounds on the hash itself are pushed down to the table's scan.
    cut = _find_cut(sample.filter(F.col(_HASH).between(bucket["least"], bucket["most"])), n - before)
    rows = sample.filter(F.col(_HASH) <= F.lit(cut.hash)).drop(_HASH)
    if cut.wanted == cut.copies:
        return rows
    ties = sample.filter(F.col(_HASH) == F.lit(cut.hash)).drop(_HASH)
    if keys:  # rows that share a key: order them by their whole content
        chosen = take_random(ties, cut.wanted, seed)
    else:
        chosen = _some_of(ties, cut.wanted)
    return sample.filter(F.col(_HASH) < F.lit(cut.hash)).drop(_HASH).unionByName(chosen)


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "sample")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _some_of(ties: DataFrame, wanted: int) -> DataFrame:
    """``wanted`` actual rows of ``ties``, taken task by task in scan order.

    The rows are counted per task; the table of how many each task gives has a row per task.
    """
    numbered = ties.withColumn("_row", F.monotonically_increasing_id())
    task, place = F.floor(F.col("_row") / _TASK_ROWS), F.col("_row") % _TASK_ROWS
    counts = numbered.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    quotas = counts.select("_task", (F.lit(wanted) - F.coalesce(before, F.lit(0))).alias("_quota"))
    given = numbered.withColumn("_task", task).join(F.broadcast(quotas.filter("_quota > 0")), "_task")
    return given.filter(place < F.col("_quota")).select(*[f"`{name}`" for name in ties.columns])


def sample_rows(
    df: DataFrame,
    ratio: float | None = None,
    n: int | None = None,
    seed: int = 42,
    keys: list[str] | None = None,
) -> DataFrame:
    """Ratio first, then count."""
    return take_random(sample_ratio(df, ratio, seed, keys), n, seed, keys)


def head_rows(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First ``n`` rows by an explicit order.

    ``orderBy().limit()`` merges the first ``n`` rows of every task in one task, which is much for
    hundreds of thousands of tasks. So groups of tasks are merged first, whatever ``n`` is.
    """
    within_group = Window.partitionBy("_group").orderBy(*order_by)
    heads = (
        df.withColumn("_group", F.spark_partition_id() % _HEAD_GROUPS)
        .withColumn("_position", F.row_number().over(within_group))
        .filter(F.col("_position") <= n)
        .drop("_group", "_position")
    )
    return heads.orderBy(*order_by).limit(n)
