import random

import pytest
from pyspark.sql import functions as F

from reviewloom.functions.numeric import mean_or_zero, one_decimal, percent_of, progress_percent, ratio_or_zero
from reviewloom.operators import statistics as stats
from reviewloom.operators.observation import input_aggregates, observe, scored_aggregates
from reviewloom.operators.scoring import LABELS
from reviewloom.sinks.csv import write_single_csv
from reviewloom.sinks.report import table_lines
from reviewloom.sources.runs import read_run_statistics

SCHEMA = "token_count int, sentiment string, score float"


def scored(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def summary(df):
    return stats.run_summary(stats.summary_totals(df), 2.0, 3.0, 4, "a", "b").first()


def test_no_rows(spark):
    empty = scored(spark)
    assert stats.score_stats(empty).first() == (0, None, None, None, None)
    assert stats.token_stats(empty).first() == (None, None, None, None, None)
    assert stats.sentiment_distribution(empty).collect() == []
    assert stats.text_length_stats(spark.createDataFrame([], "text string")).first()[0] is None
    row = summary(empty)
    assert (row["total_reviews"], row["total_tokens"], row["avg_tokens_per_review"]) == (0, 0, 0.0)
    assert (row["reviews_per_second"], row["min_tokens_per_review"]) == (0.0, None)
    lines = [r["line"] for r in table_lines(stats.score_stats(empty), "Scores").orderBy("line_no").collect()]
    assert lines[0] == "Scores" and lines[1].startswith("total_reviews 0, mean_confidence n/a, ")
    assert table_lines(stats.sentiment_distribution(empty), "Labels").count() == 1
    none = stats.run_summary(stats.summary_totals(empty), 0.0, 0.0, 0, "a", "b").first()
    assert (none["reviews_per_partition"], none["reviews_per_second"]) == (0, 0.0)


def test_one_row(spark):
    one = scored(spark, (5, "POS", 0.5))
    assert stats.score_stats(one).first() == (1, 0.5, None, 0.5, 0.5)
    assert stats.token_stats(one).first() == (5, 5.0, None, 5, 5)
    assert [tuple(r) for r in stats.sentiment_distribution(one).collect()] == [("POS", 1, 100.0)]


def test_distribution_and_display(spark):
    df = scored(spark, *[(1, label, 0.5) for label in ["POS", "NEG", "POS", "ERROR", "NEU", "POS"]])
    shares = stats.display_series(stats.sentiment_distribution(df))
    assert [tuple(r) for r in shares.collect()] == [
        ("ERROR", 1, 16.67, "blue", "ERROR (16.7%)"),
        ("NEG", 1, 16.67, "red", "NEG (16.7%)"),
        ("NEU", 1, 16.67, "gray", "NEU (16.7%)"),
        ("POS", 3, 50.0, "green", "POS (50.0%)"),
    ]


def test_summary(spark):
    row = summary(scored(spark, (3, "POS", 0.5), (5, "NEG", 0.5), (2, "NEU", 0.5)))
    assert row.asDict() == {
        "total_reviews": 3,
        "partitions_count": 4,
        "reviews_per_partition": 0,
        "processing_time_seconds": 2.0,
        "reviews_per_second": 1.5,
        "total_time_seconds": 3.0,
        "started_at": "a",
        "completed_at": "b",
        "total_tokens": 10,
        "avg_tokens_per_review": pytest.approx(10 / 3),
        "min_tokens_per_review": 2,
        "max_tokens_per_review": 5,
        "tokens_per_second": 5.0,
    }
    totals = stats.summary_totals(scored(spark, (3, "POS", 0.5)))
    no_time = stats.run_summary(totals, 0.0, 0.0, 1, "a", "b").first()
    assert (no_time["reviews_per_second"], no_time["tokens_per_second"]) == (0.0, 0.0)


def test_guarded_arithmetic(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (1.0, -2.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(ratio_or_zero("a", "b")).collect()] == [0.25, 0.0, 0.0, None]
    assert [r[0] for r in df.select(percent_of("a", "b")).collect()] == [25.0, None, -50.0, None]
    assert [r[0] for r in df.select(progress_percent("a", "b")).collect()] == [25.0, 0.0, 0.0, 0.0]
    assert [r[0] for r in df.select(mean_or_zero("a", "b")).collect()] == [0.25, 0.0, -0.5, 0.0]


def test_one_decimal_rounds_like_exact_arithmetic(spark):
    values = [n / 100 for n in range(10001)] + [14.4499, 14.4551, 0.049, 99.99999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", one_decimal("v").alias("text")).collect():
        assert row["text"] == f"{row['v']:.1f}"


def test_observed_counts_are_exact(spark):
    """Counts of a job with many small partitions; nothing is lost below a batch size."""
    source = spark.range(1234).repartition(37).select(
        F.when(F.col("id") % 5 == 0, F.lit(" ")).otherwise(F.lit("x")).alias("text"),
        F.lit(3).alias("token_count"),
        F.element_at(F.array(*map(F.lit, [*LABELS, "ERROR"])), (F.col("id") % 4 + 1).cast("int")).alias("sentiment"),
        F.lit(0.5).cast("float").alias("score"),
    )
    df, seen = observe(source, "in", input_aggregates())
    df, totals = observe(df.filter("text <> ' '"), "out", scored_aggregates(LABELS))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"loaded": 1234, "retained": 987}
    result = totals.get
    assert result["total_reviews"] == 987
    assert sum(result[f"label_{label}"] for label in [*LABELS, "ERROR"]) == 987
    assert result["total_tokens"] == 3 * 987


def test_merged_statistics_equal_those_of_the_union(spark):
    draw = random.Random(4)
    rows = [(r, draw.randrange(1, 2000), "POS", draw.random()) for r in [1] * 400 + [2] * 3 + [3] for _ in range(2)]
    rows += [(4, 7, "NEG", 1e-9)]
    df = spark.createDataFrame(rows, "run int, token_count int, sentiment string, score double")
    both = [*stats.score_aggregates(), *stats.token_aggregates()]
    parts = df.groupBy("run").agg(*both)
    nothing = df.filter("false").agg(*both)
    merged = stats.merge_statistics(parts.unionByName(nothing, allowMissingColumns=True)).first().asDict()
    assert merged == pytest.approx(df.agg(*both).first().asDict(), rel=1e-12)
    per_run = {r["run"]: r.asDict() for r in stats.merge_statistics(parts, ["run"]).collect()}
    for part in parts.collect():
        known = {name: value for name, value in part.asDict().items() if value is not None}
        assert {name: per_run[part["run"]][name] for name in known} == pytest.approx(known, rel=1e-12)
        assert {name for name, value in per_run[part["run"]].items() if value is not None} == set(known)


def test_merged_statistics_of_nothing(spark):
    empty = scored(spark).agg(*stats.score_aggregates(), *stats.token_aggregates())
    assert stats.merge_statistics(empty).first() == empty.first()
    assert stats.merge_statistics(empty.limit(0)).first() == empty.first()


def test_statistics_of_two_jobs_from_their_files(spark, tmp_path):
    all_rows = scored(spark, *[(i, "POS", i / 50) for i in range(1, 40)])
    paths = {}
    for name, part in (("a", all_rows.filter("token_count < 9")), ("b", all_rows.filter("token_count >= 9"))):
        folder = str(tmp_path / name)
        paths[name] = (
            write_single_csv(stats.score_stats(part), folder, "scores"),
            write_single_csv(stats.token_stats(part), folder, "tokens"),
        )
    merged = stats.merge_statistics(read_run_statistics(spark, paths)).first().asDict()
    assert merged == pytest.approx(summed(all_rows), rel=1e-12)


def summed(df):
    return df.agg(*stats.score_aggregates(), *stats.token_aggregates()).first().asDict()
