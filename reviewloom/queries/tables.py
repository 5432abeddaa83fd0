"""The test tables, and how they stand in for reviews and for run metrics."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.lexicon import Lexicon
from reviewloom.operators.filters import prepare_reviews
from reviewloom.operators.partitioning import spread_evenly
from reviewloom.operators.scoring import PUNCTUATION, LexiconScorer, score
from reviewloom.sources.storage import input_bytes

# The test documents are made of invented words; these frequent ones play the part of opinions.
STAND_IN_LEXICON = Lexicon(
    negative=tuple("no nicht pas was les der un at not la".split()),
    neutral=tuple("is it est es ist as le".split()),
    positive=tuple("with for mit avec con que by on und el".split()),
)
STAND_IN_SCORER = LexiconScorer(STAND_IN_LEXICON)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table over enough partitions for work that takes the processor, not the disk."""
    return spread_evenly(table(spark, sf_dir, name), input_bytes(spark, f"{sf_dir}/{name}.parquet"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the shape of reviews."""
    return as_reviews(table(spark, sf_dir, "documents"))


def spread_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_reviews(spread_table(spark, sf_dir, "documents"))


def as_reviews(documents: DataFrame) -> DataFrame:
    return documents.select(
        "text",
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("asin"),
        F.col("source").alias("user_id"),
        (F.col("doc_id") % 5 + 1).cast("float").alias("rating"),
        F.col("lang").alias("title"),
    )


def patchy_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of which some have a null, an empty, a space-only or a newline-only text."""
    rows = spread_reviews(spark, sf_dir)
    number = F.substring("asin", 2, 20).cast("bigint") % 10
    text = (
        F.when(number == 0, F.lit(None))
        .when(number == 1, F.lit("   "))
        .when(number == 2, F.lit("\n"))
        .when(number == 3, F.lit(""))
        .otherwise(F.col("text"))
    )
    return rows.withColumn("text", text)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(prepare_reviews(spread_reviews(spark, sf_dir)), STAND_IN_SCORER)


def system_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw run records: return flag = system, line number = level."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("framework"),
        F.col("l_linenumber").alias("parallelism"),
        F.col("l_linestatus").alias("batch"),
        hundredths("l_extendedprice").alias("hundredths"),
        F.rint("l_quantity").cast("bigint").alias("tokens"),
    )


def hundredths(column: str) -> Column:
    """Whole hundredths of an amount with two decimals: their sum does not depend on the order."""
    return F.rint(F.col(column) * 100).cast("bigint")


def rounded(column, digits: int = 6) -> Column:
    source = F.col(column) if isinstance(column, str) else column
    return F.round(source.cast("double"), digits)


def round_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: rounded(name) for name in names})


# ---- the same in SQL ------------------------------------------------------------------------

REVIEWS_SQL = """
reviews AS (
  SELECT text, 'D' || doc_id AS asin, source AS user_id,
         CAST(1 + doc_id % 5 AS FLOAT) AS rating, lang AS title
  FROM documents)"""

PATCHY_SQL = """
reviews AS (
  SELECT CASE doc_id % 10 WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN chr(10) WHEN 3 THEN ''
              ELSE text END AS text,
         'D' || doc_id AS asin, source AS user_id,
         CAST(1 + doc_id % 5 AS FLOAT) AS rating, lang AS title
  FROM documents)"""

HAS_TEXT_SQL = "text IS NOT NULL AND length(trim(text, ' ')) > 0"


_BLANKS = (
    r"\t\n\r\f\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000} "
)


def clean_sql(text: str, lowered: bool = False) -> str:
    text = text if lowered else f"lower({text})"
    masked = f"regexp_replace({text}, 'https?://[^{_BLANKS}]+|www\\.[^{_BLANKS}]+', '[URL]', 'g')"
    masked = f"regexp_replace({masked}, '@[\\p{{L}}\\p{{N}}_]+', '[USER]', 'g')"
    # Two passes, because neighbouring codes may share the character between them.
    for _ in range(2):
        masked = (
            f"regexp_replace({masked}, '(^|[^\\p{{L}}\\p{{N}}_])[A-Z0-9]{{10,}}($|[^\\p{{L}}\\p{{N}}_])', "
            "'\\1[PRODUCT]\\2', 'g')"
        )
    return f"coalesce(trim(regexp_replace({masked}, '[{_BLANKS}]+', ' ', 'g'), ' '), '')"


CLEANED_SQL = f"""
cleaned AS (
  SELECT *, CAST(length(text) AS INTEGER) AS text_length, {clean_sql("text")} AS preprocessed_text
  FROM reviews WHERE {HAS_TEXT_SQL})"""


def _in_list(words) -> str:
    return ", ".join(f"'{word}'" for word in words)


def score_sql(source: str, text: str, name: str = "scored") -> str:
    """CTEs that add token_count, sentiment and score (not rounded, FLOAT) to ``source``."""
    words = f"string_split({text}, ' ')"
    tokens = f"CASE WHEN {text} = '' THEN 2 ELSE len({words}) + 2 END"

    def count(class_words):
        return f"len(list_filter({words}, lambda w: trim(w, '{PUNCTUATION}') IN ({_in_list(class_words)})))"

    lexicon = STAND_IN_LEXICON
    return f"""
hits AS (
  SELECT *, CAST({tokens} AS INTEGER) AS n_tokens,
         CAST({count(lexicon.negative)} AS DOUBLE) AS neg,
         {count(lexicon.neutral)} + {lexicon.neutral_prior:f}::DOUBLE AS neu,
         CAST({count(lexicon.positive)} AS DOUBLE) AS pos
  FROM {source}),
{name} AS (
  SELECT * EXCLUDE (n_tokens, neg, neu, pos),
         CASE WHEN {text} IS NULL THEN 0 ELSE n_tokens END AS token_count,
         CASE WHEN {text} IS NULL THEN 'ERROR' WHEN neg >= neu AND neg >= pos THEN 'NEG'
              WHEN neu >= pos THEN 'NEU' ELSE 'POS' END AS sentiment,
         CAST(CASE WHEN {text} IS NULL THEN 0 ELSE
              1.0::DOUBLE / (exp(neg - greatest(neg, neu, pos)) + exp(neu - greatest(neg, neu, pos))
                             + exp(pos - greatest(neg, neu, pos))) END AS FLOAT) AS score
  FROM hits)"""


SCORED_SQL = f"WITH {REVIEWS_SQL}, {CLEANED_SQL}, {score_sql('cleaned', 'preprocessed_text')}"
ROUNDED_SCORE = "round(CAST(score AS DOUBLE), 6)"

def _window_count(words) -> str:
    return f"len(list_filter(string_split(preprocessed_text, ' '), lambda w: w IN ({_in_list(words)})))"


# A model that sees 126 words at a time adds two tokens to every window; counts of words add up.
WINDOW_SQL = f"""
WITH {REVIEWS_SQL}, {CLEANED_SQL},
hits AS (
  SELECT asin, CASE WHEN preprocessed_text = '' THEN 0 ELSE len(string_split(preprocessed_text, ' ')) END AS n,
         {_window_count(STAND_IN_LEXICON.negative)} * 1.0::DOUBLE AS neg,
         {_window_count(STAND_IN_LEXICON.neutral)} * 1.0::DOUBLE AS neu,
         {_window_count(STAND_IN_LEXICON.positive)} * 1.0::DOUBLE AS pos
  FROM cleaned),
scored AS (
  SELECT asin, CAST(n + 2 * greatest(1, ceil(n / 126.0)) AS INTEGER) AS token_count,
         CASE WHEN neg >= neu AND neg >= pos THEN 'NEG'
              WHEN neu >= pos THEN 'NEU' ELSE 'POS' END AS sentiment,
         CAST(1.0::DOUBLE / (exp(neg - greatest(neg, neu, pos)) + exp(neu - greatest(neg, neu, pos))
                             + exp(pos - greatest(neg, neu, pos))) AS FLOAT) AS score
  FROM hits)"""

RUNS_SQL = """
runs AS (
  SELECT l_returnflag AS framework, l_linenumber AS parallelism, l_linestatus AS batch,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS seconds, CAST(l_quantity AS DECIMAL(18,2)) AS tokens
  FROM lineitem)"""
