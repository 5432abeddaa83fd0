"""Partition planning and profiles."""

from pyspark.sql import functions as F

from reviewloom.operators.partitioning import (
    MIB,
    ROW_BYTES,
    partition_bytes,
    partition_profile,
    plan_by_ceiling,
    plan_by_file_size,
    plan_by_row_size,
    repartition_by_bytes,
    serialized_size,
    text_size_stats,
)
from reviewloom.plans.sweeps import partition_size_sweep
from reviewloom.queries.tables import (
    REVIEWS_SQL,
    STAND_IN_SCORER,
    reviews,
    table,
)

TARGETS_MB = (0.25, 0.5, 1.0, 8.0, 128.0)
SLOTS = 4
FIXED_PARTITIONS = 8


def plan_rows(spark, sf_dir):
    """Rows per partition and partitions for several target sizes, from the mean text length."""
    stats = text_size_stats(reviews(spark, sf_dir)).first()
    plans = [
        (
            target,
            stats["total_reviews"],
            *plan_by_row_size(stats["mean_text_length"], stats["total_reviews"], int(target * MIB)),
        )
        for target in TARGETS_MB
    ]
    return spark.createDataFrame(
        plans, "target_mb double, total_reviews bigint, rows_per_partition bigint, partitions bigint"
    )


def plan_bytes(spark, sf_dir):
    """The plans that start from a size in bytes; here the size of the texts."""
    size = text_size_stats(reviews(spark, sf_dir)).first()["text_bytes"]
    plans = [
        (
            target,
            size,
            plan_by_file_size(size, target, SLOTS),
            plan_by_ceiling(size, int(target * MIB)),
            plan_by_ceiling(size, int(target * MIB), min_partitions=SLOTS),
        )
        for target in TARGETS_MB
    ]
    return spark.createDataFrame(
        plans,
        "target_mb double, text_bytes bigint, full_waves bigint, ceiling bigint, at_least_slots bigint",
    )


def serialized(spark, sf_dir):
    return serialized_size(table(spark, sf_dir, "documents"))


def profile(spark, sf_dir):
    rows = reviews(spark, sf_dir).repartition(FIXED_PARTITIONS)
    return partition_profile(rows).select("partitions", "total_rows", "avg_rows")


def size_sweep(spark, sf_dir):
    source = reviews(spark, sf_dir)
    size = text_size_stats(source).first()["text_bytes"]
    runs = partition_size_sweep(source, STAND_IN_SCORER, size, TARGETS_MB[1:])
    return runs.select("target_mb", "num_partitions", "reviews_per_partition", "total_reviews", "result_count")


def balanced(spark, sf_dir):
    """Documents of 1 to 20,000 words in partitions of like bytes: none above one and a half times the mean."""
    _, dealt = repartition_by_bytes(table(spark, sf_dir, "documents"), partitions=FIXED_PARTITIONS)
    return partition_bytes(dealt).select("partitions", "total_bytes", (F.col("max_to_mean") <= 1.5).alias("balanced"))


QUERIES = {
    "partition_balance": balanced,
    "partition_plan_rows": plan_rows,
    "partition_plan_bytes": plan_bytes,
    "serialized_size": serialized,
    "partition_profile": profile,
    "partition_size_sweep": size_sweep,
}

_TARGETS = "(VALUES " + ", ".join(f"({t}::DOUBLE)" for t in TARGETS_MB) + ") AS targets(target_mb)"
_STATS = f"""
WITH {REVIEWS_SQL},
stats AS (
  SELECT count(*) AS n, avg(length(text)) AS mean_length, CAST(sum(strlen(text)) AS BIGINT) AS bytes
  FROM reviews)"""

ORACLES = {
    "partition_balance": f"""
SELECT CAST({FIXED_PARTITIONS} AS BIGINT) AS partitions, CAST(sum(strlen(coalesce(text, '')) + {ROW_BYTES}) AS BIGINT) AS total_bytes,
       TRUE AS balanced
FROM documents""",
    "partition_plan_rows": f"""{_STATS},
plans AS (
  SELECT target_mb, n,
         greatest(1, CAST(floor(target_mb * {MIB} / (mean_length * 2 + 200)) AS BIGINT)) AS per_partition
  FROM stats, {_TARGETS})
SELECT target_mb, n AS total_reviews, per_partition AS rows_per_partition,
       greatest(1, n // per_partition) AS partitions
FROM plans""",
    "partition_plan_bytes": f"""{_STATS}
SELECT target_mb, bytes AS text_bytes,
       CAST(ceil(greatest(1, floor(bytes / {MIB}::DOUBLE / target_mb)) / {SLOTS}::DOUBLE) * {SLOTS} AS BIGINT)
         AS full_waves,
       greatest(1, CAST(ceil(bytes / (target_mb * {MIB})) AS BIGINT)) AS ceiling,
       greatest({SLOTS}, CAST(ceil(bytes / (target_mb * {MIB})) AS BIGINT)) AS at_least_slots
FROM stats, {_TARGETS}""",
    "serialized_size": """
SELECT CAST(sum(length(CAST(to_json({'doc_id': doc_id, 'text': text, 'lang': lang, 'source': source, 'n_chars': n_chars}) AS VARCHAR)))
       AS BIGINT) AS serialized_chars
FROM documents""",
    "partition_profile": f"""
SELECT CAST({FIXED_PARTITIONS} AS BIGINT) AS partitions, count(*) AS total_rows,
       count(*) / {FIXED_PARTITIONS}::DOUBLE AS avg_rows
FROM documents""",
    "partition_size_sweep": f"""{_STATS},
plans AS (
  SELECT target_mb, n, CAST(greatest(1, ceil(bytes / (target_mb * {MIB}))) AS INTEGER) AS partitions
  FROM stats, {_TARGETS} WHERE target_mb > {TARGETS_MB[0]})
SELECT target_mb, partitions AS num_partitions, n / CAST(partitions AS DOUBLE) AS reviews_per_partition,
       n AS total_reviews, n AS result_count
FROM plans""",
}
