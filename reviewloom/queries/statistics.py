"""Statistics, distributions and run summaries of scored reviews."""

from pyspark.sql import functions as F

from reviewloom.functions.numeric import mean_or_zero
from reviewloom.operators import statistics as stats
from reviewloom.operators.filters import prepare_reviews
from reviewloom.operators.observation import input_aggregates, observe, scored_aggregates
from reviewloom.operators.scoring import LABELS, score
from reviewloom.queries.scoring import windowed
from reviewloom.queries.tables import (
    CLEANED_SQL,
    HAS_TEXT_SQL,
    PATCHY_SQL,
    REVIEWS_SQL,
    SCORED_SQL,
    STAND_IN_SCORER,
    patchy_reviews,
    reviews,
    round_columns,
    score_sql,
    scored,
    spread_reviews,
    table,
    WINDOW_SQL,
)
from reviewloom.sources.storage import scratch_path

SECONDS, TOTAL_SECONDS, PARTITIONS = 12.5, 20.0, 8
STARTED, COMPLETED = "2025-01-01 00:00:00", "2025-01-01 00:00:20"


def distribution(spark, sf_dir):
    return stats.sentiment_distribution(scored(spark, sf_dir))


def display(spark, sf_dir):
    """Raw patchy texts, so that the colour of other labels (ERROR) occurs too."""
    result = score(patchy_reviews(spark, sf_dir), STAND_IN_SCORER, "text")
    return stats.display_series(stats.sentiment_distribution(result))


def scores(spark, sf_dir):
    return round_columns(
        stats.score_stats(scored(spark, sf_dir)),
        "mean_confidence",
        "stddev_confidence",
        "min_confidence",
        "max_confidence",
    )


def tokens(spark, sf_dir):
    return round_columns(
        stats.token_stats(scored(spark, sf_dir)), "mean_token_count", "stddev_token_count"
    )


def window_tokens(spark, sf_dir):
    """Token statistics of a model that scores texts window by window."""
    return round_columns(stats.token_stats(windowed(spark, sf_dir)), "mean_token_count", "stddev_token_count")


def merged_statistics(spark, sf_dir):
    """Statistics of each source, as of a run of its own, written and merged without a look at the scored rows."""
    parts = scratch_path(spark, "statistics")
    of_run = scored(spark, sf_dir).groupBy("user_id").agg(*stats.score_aggregates(), *stats.token_aggregates())
    of_run.write.parquet(parts)
    merged = stats.merge_statistics(spark.read.schema(of_run.schema).parquet(parts))
    names = [f"{kind}_{name}" for name in ("confidence", "token_count") for kind in ("mean", "stddev")]
    return round_columns(merged, *names, "min_confidence", "max_confidence")


def text_lengths(spark, sf_dir):
    return round_columns(stats.text_length_stats(reviews(spark, sf_dir)), "mean_text_length")


def summary(spark, sf_dir):
    row = stats.run_summary(
        stats.summary_totals(scored(spark, sf_dir)), SECONDS, TOTAL_SECONDS, PARTITIONS, STARTED, COMPLETED
    )
    return round_columns(row, "reviews_per_second", "avg_tokens_per_review", "tokens_per_second")


def mean_tokens(spark, sf_dir):
    """Mean tokens per reviewer; a reviewer whose every text was refused has 0."""
    result = score(patchy_reviews(spark, sf_dir), STAND_IN_SCORER, "text")
    per_user = result.groupBy("user_id").agg(
        F.sum(F.col("token_count").cast("bigint")).alias("total"),
        F.count_if(F.col("sentiment") != "ERROR").alias("scored"),
    )
    return round_columns(
        per_user.select("user_id", mean_or_zero("total", "scored").alias("mean_tokens")), "mean_tokens"
    )


def observed(spark, sf_dir):
    """Counts taken while the rows are scored and written; progress is their share."""
    source, seen = observe(patchy_reviews(spark, sf_dir), "input", input_aggregates())
    result, totals = observe(
        score(prepare_reviews(source), STAND_IN_SCORER), "scored", scored_aggregates(LABELS)
    )
    result.write.format("noop").mode("overwrite").save()
    before, after = seen.get, totals.get
    counts = [
        (
            before["loaded"],
            before["retained"],
            after["total_reviews"],
            after["label_NEG"],
            after["label_NEU"],
            after["label_POS"],
            after["label_ERROR"],
            after["total_tokens"],
        )
    ]
    names = "loaded retained scored negative neutral positive failed total_tokens".split()
    frame = spark.createDataFrame(counts, ", ".join(f"{name} bigint" for name in names))
    return frame.withColumn("progress", stats.progress(F.col("scored"), F.col("retained")))


def progress_by_source(spark, sf_dir):
    """Share of each source that has a usable text, in percent."""
    counts = patchy_reviews(spark, sf_dir).groupBy("user_id").agg(*input_aggregates())
    share = F.round(stats.progress(F.col("retained"), F.col("loaded")), 2)
    return counts.withColumn("progress", share)


def turn_tokens(spark, sf_dir):
    """Token statistics of a second, shorter text source."""
    result = score(table(spark, sf_dir, "conversations"), STAND_IN_SCORER, "text")
    return round_columns(stats.token_stats(result), "mean_token_count", "stddev_token_count")


QUERIES = {
    "statistics_merged": merged_statistics,
    "sentiment_distribution": distribution,
    "sentiment_display_series": display,
    "score_stats": scores,
    "token_stats": tokens,
    "token_stats_model_window": window_tokens,
    "token_stats_conversations": turn_tokens,
    "text_length_stats": text_lengths,
    "run_summary": summary,
    "mean_tokens_by_user": mean_tokens,
    "observed_counts": observed,
    "progress_by_source": progress_by_source,
}

_DISTRIBUTION = """
SELECT sentiment, count(*) AS count,
       round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100, 2) AS percentage
FROM scored GROUP BY sentiment"""

_TOKEN_STATS = """
SELECT CAST(sum(token_count) AS BIGINT) AS total_tokens,
       round(avg(token_count), 6) AS mean_token_count,
       round(stddev_samp(token_count), 6) AS stddev_token_count,
       max(token_count) AS max_token_count, min(token_count) AS min_token_count
FROM scored"""

ORACLES = {
    "statistics_merged": f"""
{SCORED_SQL},
s AS (SELECT CAST(score AS DOUBLE) AS score, token_count FROM scored)
SELECT count(*) AS total_reviews, round(avg(score), 6) AS mean_confidence, round(stddev_samp(score), 6) AS stddev_confidence,
       round(min(score), 6) AS min_confidence, round(max(score), 6) AS max_confidence,
       CAST(sum(token_count) AS BIGINT) AS total_tokens, round(avg(token_count), 6) AS mean_token_count,
       round(stddev_samp(token_count), 6) AS stddev_token_count, max(token_count) AS max_token_count,
       min(token_count) AS min_token_count
FROM s""",
    "sentiment_distribution": SCORED_SQL + _DISTRIBUTION,
    "sentiment_display_series": f"""
WITH {PATCHY_SQL}, {score_sql("reviews", "text")},
distribution AS ({_DISTRIBUTION})
SELECT *,
       CASE sentiment WHEN 'NEG' THEN 'red' WHEN 'NEU' THEN 'gray' WHEN 'POS' THEN 'green'
                      ELSE 'blue' END AS color,
       printf('%s (%.1f%%)', sentiment, percentage) AS caption
FROM distribution""",
    "score_stats": f"""
{SCORED_SQL},
s AS (SELECT CAST(score AS DOUBLE) AS score FROM scored)
SELECT count(*) AS total_reviews, round(avg(score), 6) AS mean_confidence,
       round(stddev_samp(score), 6) AS stddev_confidence,
       round(min(score), 6) AS min_confidence, round(max(score), 6) AS max_confidence
FROM s""",
    "token_stats": SCORED_SQL + _TOKEN_STATS,
    "token_stats_model_window": WINDOW_SQL + _TOKEN_STATS,
    "token_stats_conversations": f"WITH {score_sql('conversations', 'text')}" + _TOKEN_STATS,
    "text_length_stats": f"""
WITH {REVIEWS_SQL} SELECT round(avg(length(text)), 6) AS mean_text_length FROM reviews""",
    "run_summary": f"""
{SCORED_SQL},
t AS (SELECT count(*) AS n, CAST(sum(token_count) AS BIGINT) AS tokens, min(token_count) AS lo,
             max(token_count) AS hi FROM scored)
SELECT n AS total_reviews, CAST({PARTITIONS} AS INTEGER) AS partitions_count,
       n // {PARTITIONS} AS reviews_per_partition,
       {SECONDS}::DOUBLE AS processing_time_seconds, round(n / {SECONDS}::DOUBLE, 6) AS reviews_per_second,
       {TOTAL_SECONDS}::DOUBLE AS total_time_seconds,
       '{STARTED}' AS started_at, '{COMPLETED}' AS completed_at, tokens AS total_tokens,
       round(tokens / CAST(n AS DOUBLE), 6) AS avg_tokens_per_review,
       lo AS min_tokens_per_review, hi AS max_tokens_per_review,
       round(tokens / {SECONDS}::DOUBLE, 6) AS tokens_per_second
FROM t""",
    "mean_tokens_by_user": f"""
WITH {PATCHY_SQL}, {score_sql("reviews", "text")}
SELECT user_id, round(coalesce(CAST(sum(token_count) AS DOUBLE)
         / nullif(count(*) FILTER (WHERE sentiment <> 'ERROR'), 0), 0), 6) AS mean_tokens
FROM scored GROUP BY user_id""",
    "observed_counts": f"""
WITH {PATCHY_SQL}, {CLEANED_SQL}, {score_sql("cleaned", "preprocessed_text")}
SELECT (SELECT count(*) FROM reviews) AS loaded,
       (SELECT count(*) FROM reviews WHERE {HAS_TEXT_SQL}) AS retained,
       count(*) AS scored,
       count(*) FILTER (WHERE sentiment = 'NEG') AS negative,
       count(*) FILTER (WHERE sentiment = 'NEU') AS neutral,
       count(*) FILTER (WHERE sentiment = 'POS') AS positive,
       count(*) FILTER (WHERE sentiment = 'ERROR') AS failed,
       CAST(sum(token_count) AS BIGINT) AS total_tokens,
       100.0::DOUBLE AS progress
FROM scored""",
    "progress_by_source": f"""
WITH {PATCHY_SQL}
SELECT user_id, count(*) AS loaded, count(*) FILTER (WHERE {HAS_TEXT_SQL}) AS retained,
       round(count(*) FILTER (WHERE {HAS_TEXT_SQL}) / CAST(count(*) AS DOUBLE) * 100, 2) AS progress
FROM reviews GROUP BY user_id""",
}
