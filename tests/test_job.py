import json
import os

import pytest

from reviewloom.__main__ import main
from reviewloom.functions.lexicon import Lexicon
from reviewloom.operators.scoring import LexiconScorer, ModelScorer
from reviewloom.operators.statistics import score_stats, sentiment_distribution, token_stats
from reviewloom.plans.review_job import ReviewJob, planned_reviews, run_review_job
from reviewloom.plans.sweeps import core_scaling, partition_count_sweep, partition_size_sweep
from reviewloom.queries.files import review_job_metrics_file
from reviewloom.schemas import DISTRIBUTION_SCHEMA, SCORED_SCHEMA
from reviewloom.sources.runs import read_results_csv

SCORER = LexiconScorer(Lexicon(("bad",), (), ("good",)))
TEXTS = ["good thing", "bad thing @you", None, "  ", "\n", "so\nso", "good good https://x.y", "bad"]


@pytest.fixture
def dataset(spark, tmp_path):
    rows = [(TEXTS[i % 8], f"B{i}", "u", float(i % 5 + 1), 'a "title"') for i in range(80)]
    df = spark.createDataFrame(rows, "text string, asin string, user_id string, rating float, title string")
    df.coalesce(1).write.json(str(tmp_path / "root" / "sample.jsonl"))
    return str(tmp_path / "root")


def job(root, tmp_path, **changes):
    options = {
        "dataset": "sample",
        "input_root": root,
        "output_dir": str(tmp_path / "analysis"),
        "summary_dir": str(tmp_path / "summary"),
        "scorer": SCORER,
    }
    return ReviewJob(**(options | changes))


def test_partitions_planned_by_rows(spark, dataset, tmp_path):
    reviews = spark.read.json(f"{dataset}/sample.jsonl")
    target_mb = 0.001
    lengths = [len(t) for t in TEXTS if t is not None]
    per_partition = int(target_mb * 1024 * 1024 / (sum(lengths) / len(lengths) * 2 + 200))
    wanted = reviews.count() // per_partition
    assert wanted > 8  # more than the slots of the session
    result = run_review_job(spark, job(dataset, tmp_path, plan_by_rows=True, target_partition_mb=target_mb))
    assert (result.metrics["partitions_count"], result.metrics["reviews_per_partition"]) == (wanted, 60 // wanted)
    assert (result.loaded, result.retained) == (80, 60)


def test_the_metrics_query_shows_the_partitions(spark, tmp_path):
    rows = [(i, "word " * 100_000, "en", "web") for i in range(13)]  # of 1,000,200 bytes each, as estimated: four in 4 MB
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    found = review_job_metrics_file(spark, str(tmp_path))
    assert found.columns == ["total_reviews", "total_tokens", "partitions_count", "reviews_per_partition"]
    assert tuple(found.first()) == (13, 13 * 100_002, 3, 4)


def test_whole_job(spark, dataset, tmp_path, rows_of):
    result = run_review_job(spark, job(dataset, tmp_path, merge_results=True))
    assert (result.loaded, result.retained) == (80, 60)
    scored = read_results_csv(spark, result.files["results"], SCORED_SCHEMA)
    assert scored.count() == 60
    assert rows_of(read_results_csv(spark, result.files["sentiment_analysis_full_results"], SCORED_SCHEMA)) == rows_of(
        scored
    )

    # Observed while writing = computed from what was written.
    assert rows_of(result.distribution) == rows_of(sentiment_distribution(scored))
    assert rows_of(result.distribution) == [("NEG", 20, 33.33), ("NEU", 20, 33.33), ("POS", 20, 33.33)]
    assert tuple(result.token_stats.first()) == pytest.approx(tuple(token_stats(scored).first()))
    assert tuple(result.score_stats.first()) == pytest.approx(tuple(score_stats(scored).first()), rel=1e-6)
    assert rows_of(read_results_csv(spark, result.files["sentiment_distribution"], DISTRIBUTION_SCHEMA)) == rows_of(
        result.distribution
    )

    assert sorted(name for name in os.listdir(tmp_path / "summary" / "sample") if not name.startswith(".")) == [
        "sentiment_analysis_full_results.csv",
        "sentiment_analysis_report.txt",
        "sentiment_distribution.csv",
        "sentiment_overall_stats.csv",
        "sentiment_token_stats.csv",
        "summary_metrics.csv",
        "summary_metrics.json",
    ]
    metrics = json.loads((tmp_path / "summary" / "sample" / "summary_metrics.json").read_text())
    assert metrics["total_reviews"] == 60 and metrics["partitions_count"] == 8
    assert metrics["reviews_per_partition"] == 7
    assert metrics["tokens_per_second"] == pytest.approx(metrics["total_tokens"] / metrics["processing_time_seconds"])
    report = (tmp_path / "summary" / "sample" / "sentiment_analysis_report.txt").read_text().splitlines()
    assert report[:5] == [
        "Labels",
        "sentiment NEG, count 20, percentage 33.33",
        "sentiment NEU, count 20, percentage 33.33",
        "sentiment POS, count 20, percentage 33.33",
        "Confidence",
    ]


def test_sampled_and_compressed_job(spark, dataset, tmp_path):
    result = run_review_job(
        spark, job(dataset, tmp_path, sample_count=30, compression="gzip")
    )
    assert result.loaded == 30 and result.metrics["partitions_count"] == 1
    assert "sentiment_analysis_full_results" not in result.files
    assert read_results_csv(spark, result.files["results"], SCORED_SCHEMA).count() == result.retained


def test_job_on_raw_text_with_a_model(spark, dataset, tmp_path, rows_of):
    def factory():
        def model(texts):
            if any("@you" in text for text in texts):
                raise ValueError("no mentions please")
            return [2] * len(texts), [[0.0, 1.0, 0.0]] * len(texts)

        return model

    result = run_review_job(spark, job(dataset, tmp_path, scorer=ModelScorer(factory), clean=False))
    # Nothing is filtered: null texts are errors, blank ones are scored.
    assert (result.loaded, result.metrics["total_reviews"]) == (80, 80)
    assert rows_of(result.distribution) == [("ERROR", 20, 25.0), ("NEU", 60, 75.0)]


def test_planning_runs_no_job(spark, dataset, tmp_path):
    """A sample by ratio is planned from the scan and its share of the bytes."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        options = job(dataset, tmp_path, sample_ratio=0.5, sample_keys=["asin"])
        planned_reviews(spark, f"{dataset}/sample.jsonl", options)
        assert list(tracker.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_job_without_rows(spark, tmp_path):
    (tmp_path / "sample.jsonl").write_text('{"text": " "}\n')
    result = run_review_job(spark, job(str(tmp_path), tmp_path))
    assert (result.loaded, result.retained) == (1, 0)
    assert result.distribution.count() == 0
    assert result.metrics["avg_tokens_per_review"] == 0.0


def test_missing_dataset(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        run_review_job(spark, job(str(tmp_path), tmp_path))


def test_sweeps(spark):
    df = spark.createDataFrame([("good thing",), ("bad",), (None,), ("x y z",)] * 10, "text string")
    runs = core_scaling(df, SCORER, [1, 2]).collect()
    assert [(r["cores"], r["total_samples"], r["total_tokens"], r["min_tokens"], r["max_tokens"]) for r in runs] == [
        (1, 40, 120, 0, 5),
        (2, 40, 120, 0, 5),
    ]
    assert all(r["throughput_samples_per_second"] == pytest.approx(40 / r["total_time"]) for r in runs)
    counts = partition_count_sweep(df, SCORER, [2, 5]).collect()
    assert [(r["target_num_partitions"], r["actual_partitions"], r["result_count"]) for r in counts] == [
        (2, 2, 40),
        (5, 5, 40),
    ]
    assert all(r["total_time"] >= r["process_time"] > 0 for r in counts)
    sizes = partition_size_sweep(df, SCORER, 5 << 20, [2, 8.0]).collect()
    assert [(r["target_mb"], r["num_partitions"]) for r in sizes] == [(2.0, 3), (8.0, 1)]


def test_command_line(spark, dataset, tmp_path, capsys):
    out = str(tmp_path / "cli")
    data = f"{dataset}/sample.jsonl"
    common = ["--output-dir", out]
    assert main(["analyze", "--dataset", "sample", "--input-root", dataset, "--summary-dir", out, *common]) == 0
    assert "80 reviews read, 60 with text" in capsys.readouterr().out
    assert main(["cores", "--data", data, "--levels", "1,2", *common]) == 0
    assert main(["partitions", "--data", data, "--counts", "2,3", *common]) == 0
    sampled = ["--sample-count", "10", "--sample-keys", "asin"]
    assert main(["partitions", "--data", data, "--target-mb", "1,2", *sampled, *common]) == 0
    names = [name for name in os.listdir(out) if not name.startswith(".")]
    assert {
        "core_scaling.csv",
        "partition_count_sweep.csv",
        "partition_count_sweep.txt",
        "partition_size_sweep.csv",
        "partition_size_sweep.txt",
    } <= set(names)
    threads = tmp_path / "threads.csv"
    threads.write_text("threads,total_time,throughput_tokens_per_second\n1,2.0,10\n2,1.0,20\n")
    arguments = ["--core-runs", f"{out}/core_scaling.csv", "--thread-runs", str(threads)]
    assert main(["compare", *arguments, *common]) == 0
    assert os.path.exists(f"{out}/comparison.csv")
