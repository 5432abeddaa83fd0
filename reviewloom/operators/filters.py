"""Filtering and preparing reviews."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.numeric import percent_of
from reviewloom.functions.text import clean_text, has_text, text_length


def drop_blank(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.filter(has_text(text_col))


def rejection_report(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Original, retained and rejected rows and the rejection rate, in one pass.

    The rate is null for an empty input.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("original_count"),
        F.count_if(has_text(text_col)).alias("retained_count"),
    )
    rejected = F.col("original_count") - F.col("retained_count")
    return counts.withColumn("rejected_count", rejected).withColumn(
        "rejection_rate", percent_of("rejected_count", "original_count")
    )


def prepare_reviews(
    df: DataFrame,
    text_col: str = "text",
    output_col: str = "preprocessed_text",
    mask_codes_before_lower: bool = False,
) -> DataFrame:
    """Drop blank texts, add ``text_length`` of the raw text and the cleaned text.

    A narrow projection over the scan: no shuffle, no Python worker, and it also accepts a
    streaming DataFrame.
    """
    return drop_blank(df, text_col).withColumns(
        {
            "text_length": text_length(text_col),
            output_col: clean_text(text_col, mask_codes_before_lower),
        }
    )
