"""Reuse of a scored frame, and progress of a running job."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from reviewloom.operators.progress import Progress, progress
from reviewloom.operators.reuse import reused
from reviewloom.operators.scoring import ModelScorer
from reviewloom.plans.review_job import ReviewJob, run_review_job
from reviewloom.sources.runs import read_results_csv

TEXTS = 96


def make_recording_factory(folder, pause=0.0):
    """A model that leaves a file for each batch it is asked for, named by the number of texts."""

    def factory():
        import os
        import time as clock
        import uuid

        def model(texts):
            open(os.path.join(folder, f"{len(texts)}-{uuid.uuid4().hex}"), "w").close()
            clock.sleep(pause)
            return [3] * len(texts), [[float(len(text) % k) for k in (2, 3, 5)] for text in texts]

        return model

    return factory


def scored_texts(folder):
    return sum(int(path.name.split("-")[0]) for path in folder.iterdir())


@pytest.fixture
def job(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    rows = [("x" * (i % 7 + 1), f"B{i}", "u", 4.0, "t") for i in range(TEXTS)]
    df = spark.createDataFrame(rows, "text string, asin string, user_id string, rating float, title string")
    df.repartition(24).write.json(str(tmp_path / "in" / "shop.jsonl"))

    def of(pause=0.0, **options):
        scorer = ModelScorer(make_recording_factory(str(tmp_path / "calls"), pause))
        return ReviewJob("shop", str(tmp_path / "out"), str(tmp_path / "sum"), str(tmp_path / "in"), scorer=scorer, **options)

    return of


def test_three_files_from_one_scoring(spark, job, tmp_path):
    result = run_review_job(spark, job(label_file=True, merge_results=True))
    assert scored_texts(tmp_path / "calls") == TEXTS
    labels = read_results_csv(spark, result.files["labels"], "review_text string, sentiment string")
    results = spark.read.option("header", True).csv(result.files["results"]).select("text", "sentiment")
    merged = spark.read.option("header", True).csv(result.files["sentiment_analysis_full_results"]).select("text", "sentiment")
    assert sorted(labels.collect()) == sorted(results.collect()) == sorted(merged.collect()) and labels.count() == TEXTS
    assert result.loaded == result.retained == TEXTS and result.metrics["total_tokens"] == 3 * TEXTS
    assert sum(r["count"] for r in result.distribution.collect()) == TEXTS
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_nothing_is_kept_after_a_failure(spark):
    df = spark.range(10).withColumn("x", F.rand())
    with pytest.raises(RuntimeError, match="sink"), reused(df) as kept:
        first = kept.collect()
        assert kept.collect() == first and df.storageLevel.useMemory
        raise RuntimeError("sink")
    assert not df.storageLevel.useMemory and spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
    with pytest.raises(Exception, match="bad row"), reused(df.selectExpr("raise_error('bad row')")) as kept:
        kept.collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_what_was_kept_before_stays_kept(spark):
    df = spark.range(10).selectExpr("id * 2 as twice").persist()
    with reused(df) as kept:
        assert kept.count() == 10
    assert df.storageLevel.useMemory
    df.unpersist(blocking=True)


def test_progress_of_a_slow_scorer(spark, job):
    seen = []
    with progress(spark, seen.append, 0.05):
        result = run_review_job(spark, job(pause=0.3))
    assert any(0 < p.percent < 100 and p.stage is not None for p in seen)
    percents = [p.percent for p in seen]
    assert percents[-1] == 100 and max(percents[:-1]) < 100 and seen[-1].finished
    assert [p.tasks_done for p in seen] == sorted(p.tasks_done for p in seen)
    assert seen[-1].tasks_done == seen[-1].tasks_total and seen[-1].seconds >= 0.3
    assert result.loaded == TEXTS  # exact counts at the end


def test_progress_sees_its_own_jobs_only(spark):
    seen, go = [], threading.Event()

    def other():
        go.wait()
        spark.range(0, 1000, 1, 50).count()

    thread = threading.Thread(target=other)
    thread.start()
    group = spark.sparkContext.getLocalProperty("spark.jobGroup.id")
    with progress(spark, seen.append, 60):
        go.set()
        thread.join()
        spark.range(0, 10, 1, 3).selectExpr("id + 1 as x").write.format("noop").mode("overwrite").save()
    assert [p.tasks_total for p in seen] == [3]
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") == group


def test_progress_of_a_job_that_fails(spark):
    seen = []
    with pytest.raises(Exception, match="bad row"), progress(spark, seen.append, 60):
        spark.range(5).selectExpr("raise_error('bad row')").collect()
    assert seen == []


def test_reports_that_fail_do_not_end_the_job(spark):
    def refuse(seen):
        if not seen.finished:
            raise ValueError("report")

    with progress(spark, refuse, 0.01):
        time.sleep(0.1)
        assert spark.range(7).count() == 7


def test_percent():
    assert Progress(0, 0, 0, None, 1.0).percent == 0
    assert Progress(1, 0, 4, 7, 1.0).percent == 25
    assert Progress(4, 0, 4, None, 1.0).percent == 99.9  # more stages may follow
    assert Progress(4, 0, 4, None, 1.0, True).percent == 100
