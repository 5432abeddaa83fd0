"""Statistics of scored reviews.

The aggregate expressions are shared by ``agg`` (the functions below) and ``observe`` (the review
job, which collects them while the results are written).
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.display import label_caption, label_color
from reviewloom.functions.numeric import mean_or_zero, percent_of, progress_percent, ratio_or_zero
from reviewloom.schemas import SUMMARY_SCHEMA


def score_aggregates() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_reviews"),
        F.avg("score").alias("mean_confidence"),
        F.stddev("score").alias("stddev_confidence"),
        F.min("score").alias("min_confidence"),
        F.max("score").alias("max_confidence"),
    ]


def token_aggregates() -> list[Column]:
    return [
        F.sum(F.col("token_count").cast("bigint")).alias("total_tokens"),
        F.avg("token_count").alias("mean_token_count"),
        F.stddev("token_count").alias("stddev_token_count"),
        F.max("token_count").alias("max_token_count"),
        F.min("token_count").alias("min_token_count"),
    ]


def score_stats(scored: DataFrame) -> DataFrame:
    """Total and mean, sample standard deviation, minimum and maximum of the confidence."""
    return scored.agg(*score_aggregates())


def token_stats(scored: DataFrame) -> DataFrame:
    return scored.agg(*token_aggregates())


def merge_statistics(runs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Statistics of all runs together, out of those of each (``score_aggregates`` and ``token_aggregates``, a row for
    each run), without a look at the scored rows; one row, or one for each value of ``by``.

    Means are weighted by rows. Squared deviations add up around the means of the runs, and those means' own around the
    common one, so nothing cancels out. Runs without rows change nothing; no runs at all give what no rows give.
    """
    keys, n = by or [], F.col("total_reviews")
    group = Window.partitionBy(*keys)  # a row for each run
    spread = {}
    for name in ("confidence", "token_count"):
        mean, deviation = F.col(f"mean_{name}"), F.col(f"stddev_{name}")
        common = F.try_divide(F.sum(n * mean).over(group), F.sum(n).over(group))
        within = F.coalesce(deviation * deviation * (n - 1), F.lit(0.0))
        spread[f"_common_{name}"] = common
        spread[f"_squares_{name}"] = within + F.coalesce(n * (mean - common) * (mean - common), F.lit(0.0))

    def merged(name: str) -> list[Column]:
        rows = F.sum(n)
        return [
            F.max(f"_common_{name}").alias(f"mean_{name}"),
            F.when(rows > 1, F.sqrt(F.try_divide(F.sum(f"_squares_{name}"), rows - 1))).alias(f"stddev_{name}"),
            F.min(f"min_{name}").alias(f"min_{name}"),
            F.max(f"max_{name}").alias(f"max_{name}"),
        ]

    return runs.withColumns(spread).groupBy(*keys).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_reviews"),
        *merged("confidence"),
        F.sum("total_tokens").alias("total_tokens"),
        *merged("token_count"),
    )


def sentiment_distribution(scored: DataFrame) -> DataFrame:
    """Rows and share in percent per label, sorted by label.

    Counts are summed per task before the shuffle, so a label that holds most rows is no hot
    spot; the share is taken over the handful of counted labels.
    """
    counts = scored.groupBy("sentiment").agg(F.count(F.lit(1)).alias("count"))
    return with_share(counts).orderBy("sentiment")


def with_share(counts: DataFrame) -> DataFrame:
    return counts.withColumn("percentage", percent_of(F.col("count"), F.sum("count").over(Window.partitionBy())))


def display_series(distribution: DataFrame) -> DataFrame:
    """The data behind a bar or pie chart: colour and caption of each label."""
    return distribution.withColumns(
        {"color": label_color("sentiment"), "caption": label_caption("sentiment", "percentage")}
    )


def text_length_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.agg(F.avg(F.length(text_col)).alias("mean_text_length"))


def run_summary(
    totals: DataFrame,
    processing_seconds: float,
    total_seconds: float,
    partitions: int,
    started_at: str,
    completed_at: str,
) -> DataFrame:
    """Job metrics (``SUMMARY_SCHEMA``) of one row of totals: aggregated (``summary_totals``) or observed."""
    seconds, n = F.lit(float(processing_seconds)), F.lit(int(partitions))
    tokens = F.coalesce("total_tokens", F.lit(0)).cast("bigint")
    values = {
        "total_reviews": F.col("total_reviews"),
        "partitions_count": n,
        "reviews_per_partition": F.when(n > 0, F.floor(F.try_divide("total_reviews", n))).otherwise(0),
        "processing_time_seconds": seconds,
        "reviews_per_second": ratio_or_zero("total_reviews", seconds),
        "total_time_seconds": F.lit(float(total_seconds)),
        "started_at": F.lit(started_at),
        "completed_at": F.lit(completed_at),
        "total_tokens": tokens,
        "avg_tokens_per_review": mean_or_zero(tokens, "total_reviews"),
        "min_tokens_per_review": F.col("min_token_count"),
        "max_tokens_per_review": F.col("max_token_count"),
        "tokens_per_second": ratio_or_zero(tokens, seconds),
    }
    return totals.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in SUMMARY_SCHEMA.fields])


def summary_totals(scored: DataFrame) -> DataFrame:
    """The totals that ``run_summary`` needs, in a single aggregate."""
    return scored.agg(F.count(F.lit(1)).alias("total_reviews"), *token_aggregates())


def progress(current: Column, total: Column) -> Column:
    """Share done in percent."""
    return progress_percent(current, total)
