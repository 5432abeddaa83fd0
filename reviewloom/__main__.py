"""Command line: ``python -m reviewloom <command>``."""

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from reviewloom.functions.lexicon import OPINION_WORDS
from reviewloom.operators.classifier import LinearModel, fit_classifier, label_of_rating, trained_scorer
from reviewloom.operators.filters import prepare_reviews
from reviewloom.operators.scoring import LexiconScorer
from reviewloom.plans.comparison import compare_run_files, write_comparison
from reviewloom.plans.review_job import ReviewJob, run_review_job
from reviewloom.plans.sweeps import core_scaling, partition_count_sweep, partition_size_sweep
from reviewloom.sinks.csv import CODEC_SUFFIXES, write_single_csv
from reviewloom.operators.partitioning import task_slots
from reviewloom.operators.runs import best_configuration
from reviewloom.sinks.report import write_report
from reviewloom.sources.reviews import load_reviews
from reviewloom.sources.storage import input_bytes


def main(arguments: list[str] | None = None) -> int:
    options = _parser().parse_args(arguments)
    logging.basicConfig(format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("reviewloom").setLevel(logging.INFO)
    spark = SparkSession.builder.appName(f"reviewloom-{options.command}").getOrCreate()
    return options.run(spark, options)


def analyze(spark: SparkSession, options) -> int:
    job = ReviewJob(
        dataset=options.dataset,
        input_root=options.input_root,
        input_file=options.input_file,
        sample_ratio=options.sample_ratio,
        sample_count=options.sample_count,
        seed=options.seed,
        sample_keys=options.sample_keys,
        target_partition_mb=options.target_mb,
        mask_codes_before_lower=options.mask_codes_before_lower,
        merge_results=options.merge,
        label_file=options.labels,
        progress_seconds=options.progress,
        output_dir=options.output_dir,
        summary_dir=options.summary_dir,
        compression=options.compression,
        scorer=_scorer(spark, options),
    )
    result = run_review_job(spark, job)
    print(f"{result.loaded:,} reviews read, {result.retained:,} with text")
    result.distribution.show()
    for name, path in result.files.items():
        print(f"{name}: {path}")
    return 0


def fit(spark: SparkSession, options) -> int:
    """Learns from the stars of rated reviews."""
    rated = prepare_reviews(_sample(spark, options), mask_codes_before_lower=options.mask_codes_before_lower)
    rated = rated.withColumn("label", label_of_rating("rating"))
    model = fit_classifier(rated, "label", ngram_words=options.ngram_words, buckets=options.buckets, algorithm=options.algorithm)
    print(model.save(spark, options.model))
    return 0


def _scorer(spark: SparkSession, options):
    if options.model:
        return trained_scorer(spark, LinearModel.load(spark, options.model))
    return LexiconScorer(OPINION_WORDS)


def cores(spark: SparkSession, options) -> int:
    levels = options.levels or [task_slots(spark), 2 * task_slots(spark)]
    runs = core_scaling(_sample(spark, options), LexiconScorer(), levels)
    print(write_single_csv(runs, options.output_dir, "core_scaling"))
    return 0


def partitions(spark: SparkSession, options) -> int:
    reviews, folder = _sample(spark, options), options.output_dir
    if options.target_mb:
        size = input_bytes(spark, options.data)
        sweep = partition_size_sweep(reviews, LexiconScorer(), size, options.target_mb)
        column, name = "target_mb", "partition_size"
    else:
        slots = task_slots(spark)
        counts = options.counts or [slots * waves for waves in (1, 2, 4, 8)]
        sweep = partition_count_sweep(reviews, LexiconScorer(), counts)
        column, name = "target_num_partitions", "partition_count"
    print(write_single_csv(sweep, folder, f"{name}_sweep"))
    sections = {"Best": best_configuration(sweep, [column]), "Runs": sweep}
    print(write_report(sections, folder, f"{name}_sweep"))
    return 0


def compare(spark: SparkSession, options) -> int:
    comparison = compare_run_files(spark, options.core_runs, options.thread_runs)
    comparison.show()
    print(write_comparison(comparison, options.output_dir))
    return 0


def _sample(spark: SparkSession, options):
    ratio, count, keys = options.sample_ratio, options.sample_count, options.sample_keys
    return load_reviews(spark, options.data, ratio, count, options.seed, keys)


def _numbers(kind):
    return lambda text: [kind(part) for part in text.split(",")]


def _parser() -> argparse.ArgumentParser:
    # Names of commands and options are an interface.
    parser = argparse.ArgumentParser(prog="reviewloom")
    commands = parser.add_subparsers(dest="command", required=True)

    sampling = argparse.ArgumentParser(add_help=False)
    sampling.add_argument("--sample-ratio", type=float, default=1.0, help="1.0 keeps every review")
    sampling.add_argument("--sample-count", type=int, default=None, help="0 keeps every review")
    sampling.add_argument("--seed", type=int, default=42)
    sampling.add_argument("--sample-keys", type=_numbers(str), default=None, help="columns that identify a row")

    command = commands.add_parser("analyze", parents=[sampling], help="classify and sum up a dataset")
    command.add_argument("--dataset", required=True)
    command.add_argument("--input-root", default="/")
    command.add_argument("--input-file", default=None, help="used if the dataset is not in the root")
    command.add_argument("--output-dir", required=True)
    command.add_argument("--summary-dir", required=True)
    command.add_argument("--compression", choices=sorted(CODEC_SUFFIXES), default=None)
    command.add_argument("--target-mb", type=float, default=128)
    command.add_argument("--mask-codes-before-lower", action="store_true")
    command.add_argument("--model", default=None, help="a model that fit has saved; default: word lists")
    command.add_argument("--merge", action="store_true", help="also put the results into one file")
    command.add_argument("--labels", action="store_true", help="also write texts and labels alone, from the same scoring")
    command.add_argument("--progress", type=float, default=None, metavar="SECONDS", help="log how far the job is")
    command.set_defaults(run=analyze)

    command = commands.add_parser("fit", parents=[sampling], help="learn a model from rated reviews")
    command.add_argument("--data", required=True)
    command.add_argument("--model", required=True, help="where to save it")
    command.add_argument("--algorithm", choices=["bayes", "logistic"], default="bayes")
    command.add_argument("--ngram-words", type=int, default=2)
    command.add_argument("--buckets", type=int, default=1 << 16)
    command.add_argument("--mask-codes-before-lower", action="store_true")
    command.set_defaults(run=fit)

    command = commands.add_parser("cores", parents=[sampling], help="time the scorer per core count")
    command.add_argument("--data", required=True)
    command.add_argument("--levels", type=_numbers(int), default=None, help="default: once and twice the task slots")
    command.add_argument("--output-dir", required=True)
    command.set_defaults(run=cores)

    command = commands.add_parser("partitions", parents=[sampling], help="time the scorer per partitioning")
    command.add_argument("--data", required=True)
    command.add_argument("--counts", type=_numbers(int), default=None, help="default: whole waves of task slots")
    command.add_argument("--target-mb", type=_numbers(float), default=None, help="sizes instead of counts")
    command.add_argument("--output-dir", required=True)
    command.set_defaults(run=partitions)

    command = commands.add_parser("compare", help="compare core runs with thread runs")
    command.add_argument("--core-runs", required=True)
    command.add_argument("--thread-runs", required=True)
    command.add_argument("--output-dir", required=True)
    command.set_defaults(run=compare)
    return parser


if __name__ == "__main__":
    sys.exit(main())
