"""Timed runs of the scorer at several levels of parallelism or partition sizes.

Each run scores every row and writes to the ``noop`` sink: a ``count`` would not do, because
Catalyst drops an unused result column and with it the scoring.
"""

import time
from collections.abc import Iterable

from pyspark.sql import DataFrame

from reviewloom.operators.observation import observe
from reviewloom.operators.partitioning import MIB, plan_by_ceiling
from reviewloom.operators.scoring import score
from reviewloom.operators.statistics import score_aggregates, token_aggregates
from reviewloom.schemas import CORE_RUN_SCHEMA, COUNT_SWEEP_SCHEMA, SIZE_SWEEP_SCHEMA
from reviewloom.sources.storage import small_table


def timed_score(df: DataFrame, scorer, text_col: str, name: str) -> tuple[dict, float]:
    """Observed totals and the seconds it took to score ``df``."""
    scored, totals = observe(score(df, scorer, text_col), name, score_aggregates() + token_aggregates())
    started = time.perf_counter()
    scored.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - started
    return totals.get, seconds


def core_scaling(
    df: DataFrame, scorer, level_counts: Iterable[int], text_col: str = "text"
) -> DataFrame:
    """One run per level; as many tasks as the level, so at most that many cores work.

    Levels are meant to be multiples of an executor's cores. The raw text is scored, without cleaning or filtering: a null text gives an ERROR row.
    """
    rows = []
    for level in level_counts:
        totals, seconds = timed_score(df.repartition(level), scorer, text_col, f"cores_{level}")
        samples, tokens = totals["total_reviews"], totals["total_tokens"] or 0
        rows.append(
            (
                level,
                samples,
                tokens,
                totals["min_token_count"],
                totals["max_token_count"],
                totals["mean_token_count"],
                seconds,
                samples / seconds,
                tokens / seconds,
            )
        )
    return small_table(df.sparkSession, rows, CORE_RUN_SCHEMA)


def partition_count_sweep(
    df: DataFrame, scorer, counts: Iterable[int], text_col: str = "text"
) -> DataFrame:
    rows = [
        (count, *_sweep_run(df, count, scorer, text_col, f"partitions_{count}")) for count in counts
    ]
    return small_table(df.sparkSession, rows, COUNT_SWEEP_SCHEMA)


def partition_size_sweep(
    df: DataFrame, scorer, size_bytes: int, targets_mb: Iterable[float], text_col: str = "text"
) -> DataFrame:
    rows = []
    for target in targets_mb:
        count = plan_by_ceiling(size_bytes, int(target * MIB))
        rows.append((float(target), *_sweep_run(df, count, scorer, text_col, f"target_{target}")))
    return small_table(df.sparkSession, rows, SIZE_SWEEP_SCHEMA)


def _sweep_run(df: DataFrame, partitions: int, scorer, text_col: str, name: str) -> tuple:
    started = time.perf_counter()
    totals, seconds = timed_score(df.repartition(partitions), scorer, text_col, name)
    rows = totals["total_reviews"]
    total_seconds = time.perf_counter() - started
    return partitions, rows / partitions, rows, rows, seconds, total_seconds, rows / seconds
