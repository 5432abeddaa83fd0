"""Counting rows while a job runs, without a job of its own.

Counts that feed results are placed below no shuffle, that is in the stage that writes: Spark adds
the metrics of a partition of that stage once, also when its task is repeated, whereas a repeated
map task of an earlier stage would be counted twice.
"""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from reviewloom.functions.text import has_text
from reviewloom.operators.scoring import ERROR_LABEL
from reviewloom.operators.statistics import score_aggregates, token_aggregates


def input_aggregates(text_col: str = "text") -> list[Column]:
    return [
        F.count(F.lit(1)).alias("loaded"),
        F.count_if(has_text(text_col)).alias("retained"),
    ]


def scored_aggregates(labels) -> list[Column]:
    """Rows per label and the score and token statistics, for one ``observe``."""
    per_label = [
        F.count_if(F.col("sentiment") == label).alias(label_metric(label))
        for label in [*labels, ERROR_LABEL]
    ]
    return per_label + score_aggregates() + token_aggregates()


def label_metric(label: str) -> str:
    return f"label_{label}"


def observe(df: DataFrame, name: str, aggregates: list[Column]) -> tuple[DataFrame, Observation]:
    observation = Observation(name)
    return df.observe(observation, *aggregates), observation

