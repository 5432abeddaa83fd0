"""Declared schemas: every reader and every driver-built row uses one of these."""

from pyspark.sql.types import (
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields):
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


_STRING, _INT, _LONG = StringType(), IntegerType(), LongType()
_FLOAT, _DOUBLE = FloatType(), DoubleType()

REVIEW_SCHEMA = _struct(text=_STRING, asin=_STRING, user_id=_STRING, rating=_FLOAT, title=_STRING)

SCORE_SCHEMA = _struct(token_count=_INT, sentiment=_STRING, score=_FLOAT)

SCORED_SCHEMA = StructType(
    REVIEW_SCHEMA.fields + _struct(text_length=_INT, preprocessed_text=_STRING).fields + SCORE_SCHEMA.fields
)

DISTRIBUTION_SCHEMA = _struct(sentiment=_STRING, count=_LONG, percentage=_DOUBLE)

SCORE_STATS_SCHEMA = _struct(
    total_reviews=_LONG,
    mean_confidence=_DOUBLE,
    stddev_confidence=_DOUBLE,
    min_confidence=_FLOAT,
    max_confidence=_FLOAT,
)

TOKEN_STATS_SCHEMA = _struct(
    total_tokens=_LONG,
    mean_token_count=_DOUBLE,
    stddev_token_count=_DOUBLE,
    max_token_count=_INT,
    min_token_count=_INT,
)

# The column names of run summaries.
SUMMARY_SCHEMA = _struct(
    total_reviews=_LONG,
    partitions_count=_INT,
    reviews_per_partition=_LONG,
    processing_time_seconds=_DOUBLE,
    reviews_per_second=_DOUBLE,
    total_time_seconds=_DOUBLE,
    started_at=_STRING,
    completed_at=_STRING,
    total_tokens=_LONG,
    avg_tokens_per_review=_DOUBLE,
    min_tokens_per_review=_INT,
    max_tokens_per_review=_INT,
    tokens_per_second=_DOUBLE,
)

CORE_RUN_SCHEMA = _struct(
    cores=_INT,
    total_samples=_LONG,
    total_tokens=_LONG,
    min_tokens=_INT,
    max_tokens=_INT,
    avg_tokens=_DOUBLE,
    total_time=_DOUBLE,
    throughput_samples_per_second=_DOUBLE,
    throughput_tokens_per_second=_DOUBLE,
)

# per_core_usage is a list written as text; sources.runs turns it into an array column. Older
# files have memory_before_mb and memory_after_mb in place of the initial, model and peak values.
THREAD_RUN_SCHEMA = _struct(
    threads=_INT,
    total_threads=_INT,
    total_samples=_LONG,
    total_time=_DOUBLE,
    avg_time_per_sample=_DOUBLE,
    max_time_per_sample=_DOUBLE,
    min_time_per_sample=_DOUBLE,
    total_tokens=_LONG,
    throughput_tokens_per_second=_DOUBLE,
    throughput_reviews_per_second=_DOUBLE,
    initial_memory_mb=_DOUBLE,
    model_memory_mb=_DOUBLE,
    peak_memory_mb=_DOUBLE,
    memory_before_mb=_DOUBLE,
    memory_after_mb=_DOUBLE,
    memory_increase_mb=_DOUBLE,
    num_cpu_cores=_INT,
    active_cpu_cores=_INT,
    avg_core_usage=_DOUBLE,
    max_core_usage=_DOUBLE,
    per_core_usage=_STRING,
    cpu_samples_collected=_LONG,
)

_SWEEP_TAIL = _struct(
    reviews_per_partition=_DOUBLE,
    total_reviews=_LONG,
    result_count=_LONG,
    process_time=_DOUBLE,
    total_time=_DOUBLE,
    throughput=_DOUBLE,
).fields

SIZE_SWEEP_SCHEMA = StructType(_struct(target_mb=_DOUBLE, num_partitions=_INT).fields + _SWEEP_TAIL)

COUNT_SWEEP_SCHEMA = StructType(
    _struct(target_num_partitions=_INT, actual_partitions=_INT).fields + _SWEEP_TAIL
)
