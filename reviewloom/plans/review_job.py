"""The review job: read, clean, score, write, and sum up, in one pass over the data."""

import logging
import time
from contextlib import nullcontext
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from reviewloom import schemas
from reviewloom.functions.lexicon import OPINION_WORDS
from reviewloom.operators.filters import prepare_reviews
from reviewloom.operators.observation import (
    input_aggregates,
    label_metric,
    observe,
    scored_aggregates,
)
from reviewloom.operators.partitioning import repartition_by_bytes, repartition_by_rows, spread, spread_plan
from reviewloom.operators.progress import Progress, progress
from reviewloom.operators.reuse import reused
from reviewloom.operators.scoring import ERROR_LABEL, LexiconScorer, label_view, score
from reviewloom.operators.statistics import run_summary, with_share
from reviewloom.sinks.csv import (
    merge_csv,
    write_csv,
    write_single_csv,
    write_single_json,
)
from reviewloom.sinks.report import write_report
from reviewloom.operators.sampling import sample_ratio, take_random
from reviewloom.sources.reviews import read_reviews, resolve_dataset
from reviewloom.sources.storage import input_bytes, small_table

logger = logging.getLogger("reviewloom")


@dataclass(frozen=True)
class ReviewJob:
    dataset: str
    output_dir: str
    summary_dir: str
    input_root: str = "/"
    input_file: str | None = None
    sample_ratio: float | None = None
    sample_count: int | None = None
    seed: int = 42
    sample_keys: list[str] | None = None
    target_partition_mb: float = 128
    plan_by_rows: bool = False
    mask_codes_before_lower: bool = False
    clean: bool = True
    compression: str | None = None
    merge_results: bool = False
    label_file: bool = False
    progress_seconds: float | None = None
    scorer: object = field(default_factory=lambda: LexiconScorer(OPINION_WORDS))


@dataclass(frozen=True)
class ReviewResult:
    metrics: dict
    loaded: int
    retained: int
    distribution: DataFrame
    score_stats: DataFrame
    token_stats: DataFrame
    files: dict[str, str]


def scored_reviews(reviews: DataFrame, job: ReviewJob) -> DataFrame:
    """The transformation alone, without reading or writing. Without cleaning nothing is filtered either."""
    if not job.clean:
        return score(reviews, job.scorer, "text")
    prepared = prepare_reviews(reviews, mask_codes_before_lower=job.mask_codes_before_lower)
    return score(prepared, job.scorer)


def run_review_job(spark: SparkSession, job: ReviewJob) -> ReviewResult:
    """Run the job and write all its outputs.

    The data is read and scored once: counts and statistics are observed by the very stage that
    writes the results. A shuffle, where one is needed, comes before both observations.
    """
    started = time.time()
    path = resolve_dataset(spark, job.dataset, job.input_root, job.input_file)
    partitions, reviews = planned_reviews(spark, path, job)
    logger.info("Scoring %s in %s partitions", path, partitions)

    reviews, seen = observe(reviews, "input", input_aggregates())
    scored, totals = observe(scored_reviews(reviews, job), "scored", scored_aggregates(job.scorer.labels))

    results_path = f"{job.output_dir}/{job.dataset}"
    summary_path = f"{job.summary_dir}/{job.dataset}"
    processing_started = time.time()
    files = {"results": results_path}
    with progress(spark, _log_progress, job.progress_seconds) if job.progress_seconds else nullcontext():
        if job.label_file:  # two sinks, one scoring
            files["labels"] = f"{summary_path}/sentiment_labels"
            with reused(scored) as kept:
                write_csv(kept, results_path, job.compression)
                write_csv(label_view(kept), files["labels"], job.compression)
        else:
            write_csv(scored, results_path, job.compression)
    processing_seconds = time.time() - processing_started
    seen, totals = seen.get, totals.get
    _log_totals(seen, totals, job.scorer.labels, processing_seconds)

    distribution = observed_distribution(spark, totals, job.scorer.labels)
    score_stats = observed_row(spark, totals, schemas.SCORE_STATS_SCHEMA)
    token_stats = observed_row(spark, totals, schemas.TOKEN_STATS_SCHEMA)
    files |= {
        "sentiment_distribution": write_single_csv(distribution, summary_path, "sentiment_distribution"),
        "sentiment_overall_stats": write_single_csv(score_stats, summary_path, "sentiment_overall_stats"),
        "sentiment_token_stats": write_single_csv(token_stats, summary_path, "sentiment_token_stats"),
        "sentiment_analysis_report": write_report(
            {"Labels": distribution, "Confidence": score_stats, "Tokens": token_stats},
            summary_path,
            "sentiment_analysis_report",
        ),
    }
    if job.merge_results:
        name = "sentiment_analysis_full_results"
        files[name] = merge_csv(spark, results_path, summary_path, name, scored.schema, job.compression)
    ended = time.time()
    summary = small_table(
        spark,
        run_summary(
            observed_row(spark, totals, StructType(schemas.SCORE_STATS_SCHEMA.fields[:1] + schemas.TOKEN_STATS_SCHEMA.fields)),
            processing_seconds,
            ended - started,
            partitions,
            datetime.fromtimestamp(started).isoformat(" ", "seconds"),
            datetime.fromtimestamp(ended).isoformat(" ", "seconds"),
        ).collect(),
        schemas.SUMMARY_SCHEMA,
    )
    metrics = summary.first().asDict()
    files["summary_metrics"] = write_single_csv(summary, summary_path, "summary_metrics")
    files["summary_metrics_json"] = write_single_json(summary, summary_path, "summary_metrics")
    return ReviewResult(
        metrics, seen["loaded"], seen["retained"], distribution, score_stats, token_stats, files
    )


def _log_progress(seen: Progress) -> None:
    logger.info("%.1f %% of the tasks, %s of %s, %.0f seconds", seen.percent, seen.tasks_done, seen.tasks_total, seen.seconds)


def _log_totals(seen: dict, totals: dict, labels, seconds: float) -> None:
    rejected = seen["loaded"] - seen["retained"]
    logger.info("%s reviews read, %s retained, %s rejected", seen["loaded"], seen["retained"], rejected)
    for label in [*labels, ERROR_LABEL]:
        logger.info("  %s: %s", label, totals[label_metric(label)])
    for name in schemas.SCORE_STATS_SCHEMA.names + schemas.TOKEN_STATS_SCHEMA.names:
        logger.info("  %s: %s", name, totals[name])
    logger.info("Scored and written in %.1f seconds", seconds)


def observed_distribution(spark: SparkSession, totals: dict, labels) -> DataFrame:
    """Rows and share per label that occurs, from observed counts."""
    counts = [(label, totals[label_metric(label)]) for label in [*labels, ERROR_LABEL]]
    occurring = [(label, count) for label, count in counts if count]
    schema = StructType(schemas.DISTRIBUTION_SCHEMA.fields[:2])
    return with_share(small_table(spark, occurring, schema)).orderBy("sentiment")


def observed_row(spark: SparkSession, totals: dict, schema) -> DataFrame:
    return small_table(spark, [tuple(totals[name] for name in schema.names)], schema)


def planned_reviews(spark: SparkSession, path: str, job: ReviewJob) -> tuple[int, DataFrame]:
    """(partitions, reviews), sampled if the job asks for it.

    The scan is planned by the bytes that a ratio leaves of it. How large the rows of a sample of fixed count are is not known
    beforehand, so such a sample is measured (one more pass over the table it was written to) and dealt anew, by bytes.
    With ``plan_by_rows`` the number of partitions follows from the rows alone, in any session, for one more pass over the input.
    """
    scan = read_reviews(spark, path)
    if job.plan_by_rows and not job.sample_count:
        return repartition_by_rows(sample_ratio(scan, job.sample_ratio, job.seed, job.sample_keys), job.target_partition_mb)
    kept = job.sample_ratio if job.sample_ratio and job.sample_ratio < 1 else 1.0
    plan = spread_plan(scan, int(input_bytes(spark, path) * kept), job.target_partition_mb)
    reviews = sample_ratio(scan, job.sample_ratio, job.seed, job.sample_keys)
    if job.sample_count:
        sample = take_random(reviews, job.sample_count, job.seed, job.sample_keys)
        return repartition_by_bytes(sample, job.target_partition_mb)
    return plan[0], spread(reviews, plan)
