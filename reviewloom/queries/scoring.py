"""Scoring with the lexicon and with a model in a pandas UDF."""

from pyspark.sql import functions as F

from reviewloom.operators.classifier import LinearModel, fit_classifier, trained_scorer
from reviewloom.operators.filters import prepare_reviews
from reviewloom.operators.scoring import (
    MODEL_WINDOW,
    LexiconScorer,
    ModelScorer,
    label_view,
    result_view,
    score,
)
from reviewloom.operators.subwords import CONTINUED, subword_counter
from reviewloom.queries.tables import (
    WINDOW_SQL,
    CLEANED_SQL,
    PATCHY_SQL,
    REVIEWS_SQL,
    ROUNDED_SCORE,
    SCORED_SQL,
    STAND_IN_LEXICON,
    STAND_IN_SCORER,
    patchy_reviews,
    reviews,
    round_columns,
    score_sql,
    scored,
    spread_reviews,
    table,
)
from reviewloom.sources.storage import scratch_path


TRAINED_BUCKETS = 1 << 14

# A small vocabulary: the stand-in lexicon, consonants and vowels to begin and to go on with, and some pairs. A word of digits
# or other letters has no pieces.
_LETTERS = "abcdefghilmnoprstuvy"
SUBWORDS = sorted(
    {*STAND_IN_LEXICON.negative, *STAND_IN_LEXICON.positive, *_LETTERS, *(f"##{letter}" for letter in _LETTERS)}
    | {pair for a in "rst" for b in "aeio" for pair in (a + b, f"##{a}{b}", f"##{b}{a}")}
)


def vowel_model():
    """A model for tests: vowel counts decide, and it refuses texts with ``aa`` in them."""

    def model(texts):
        if any("aa" in text for text in texts):
            raise ValueError("unreadable text")
        tokens = [(len(text.split(" ")) if text else 0) + 2 for text in texts]
        return tokens, [[text.count(vowel) / 10 for vowel in "aei"] for text in texts]

    return model


def make_length_builder():
    def build(moduli):
        def model(texts):
            return [2] * len(texts), [[len(text) % modulus for modulus in moduli] for text in texts]

        return model

    return build


def make_vowel_factory():
    """The factory as a nested function, which Spark ships by value."""
    model = vowel_model()

    def factory():
        return model

    return factory


def lexicon_scores(spark, sf_dir):
    columns = ["asin", "token_count", "sentiment", "score"]
    return round_columns(scored(spark, sf_dir).select(*columns), "score")


def make_word_factory():
    """A model that counts the words of the stand-in lexicon and sees ``MODEL_WINDOW`` tokens at a time."""
    classes = [set(STAND_IN_LEXICON.negative), set(STAND_IN_LEXICON.neutral), set(STAND_IN_LEXICON.positive)]
    window = MODEL_WINDOW - 2

    def factory():
        def model(texts):
            split = [text.split(" ") if text else [] for text in texts]
            if any(len(words) > window for words in split):
                raise ValueError("too long")
            counts = [[float(sum(word in known for word in words)) for known in classes] for words in split]
            return [len(words) + 2 for words in split], counts

        return model

    return factory


def subword_scores(spark, sf_dir):
    """Token counts of a small subword vocabulary in place of words."""
    scorer = LexiconScorer(STAND_IN_LEXICON, subword_counter(SUBWORDS))
    result = score(prepare_reviews(spread_reviews(spark, sf_dir)), scorer)
    return round_columns(result.select("asin", "token_count", "sentiment", "score"), "score")


def windowed(spark, sf_dir):
    """Every window of a text is scored, by a model that refuses longer ones."""
    scorer = ModelScorer(make_word_factory(), window_words=MODEL_WINDOW - 2)
    return score(prepare_reviews(spread_reviews(spark, sf_dir)), scorer)


def window_scores(spark, sf_dir):
    result = windowed(spark, sf_dir)
    return round_columns(result.select("asin", "token_count", "sentiment", "score"), "score")


def raw_scores(spark, sf_dir):
    """No cleaning and no filter."""
    turns = table(spark, sf_dir, "conversations")
    result = score(turns, STAND_IN_SCORER, "text")
    return round_columns(result.select("conv_id", "turn", "token_count", "sentiment", "score"), "score")


def raw_scores_with_nulls(spark, sf_dir):
    result = score(patchy_reviews(spark, sf_dir), STAND_IN_SCORER, "text")
    return round_columns(result.select("asin", "token_count", "sentiment", "score"), "score")


def model_scores(spark, sf_dir):
    """Unreadable and null texts end as ERROR rows; the others of their batch are scored."""
    scorer = ModelScorer(make_vowel_factory(), keep_errors=True)
    result = score(patchy_reviews(spark, sf_dir), scorer, "text")
    return round_columns(result.select("asin", "token_count", "sentiment", "score", "error"), "score")


def broadcast_model_scores(spark, sf_dir):
    scorer = ModelScorer.from_broadcast(spark, (7, 5, 3), make_length_builder())
    result = score(reviews(spark, sf_dir), scorer, "text")
    return round_columns(result.select("asin", "token_count", "sentiment", "score"), "score")


def results(spark, sf_dir):
    return round_columns(result_view(scored(spark, sf_dir)), "score")


def labels_only(spark, sf_dir):
    return label_view(scored(spark, sf_dir))


def scored_table(spark, sf_dir):
    return round_columns(scored(spark, sf_dir), "score")


def errors_by_label(spark, sf_dir):
    result = score(patchy_reviews(spark, sf_dir), ModelScorer(make_vowel_factory()), "text")
    return result.groupBy("sentiment").agg(F.count(F.lit(1)).alias("count"))


def labelled_reviews(spark, sf_dir):
    """Cleaned texts of labelled documents: toxic ones are NEG, poor ones NEU, the others POS."""
    labels = table(spark, sf_dir, "labels")
    named = labels.select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("asin"),
        F.when(F.col("toxic") == 1, "NEG").when(F.col("quality") == 0, "NEU").otherwise("POS").alias("label"),
    )
    # Joined before they are cleaned, so the others are not. Both sides are dealt by key at any size, as there are labels for a share of
    # the texts; building on the labels spares sorting the texts.
    return prepare_reviews(reviews(spark, sf_dir).join(named.hint("shuffle_hash"), "asin"))


def trained_scores(spark, sf_dir):
    """A model learned from the labelled documents, saved, loaded, and put to all documents."""
    path = scratch_path(spark, "model")
    fit_classifier(labelled_reviews(spark, sf_dir), "label", buckets=TRAINED_BUCKETS).save(spark, path)
    scorer = trained_scorer(spark, LinearModel.load(spark, path))
    result = score(prepare_reviews(spread_reviews(spark, sf_dir)), scorer)
    return round_columns(result.select("asin", "token_count", "sentiment", "score"), "score")


QUERIES = {
    "score_trained": trained_scores,
    "score_lexicon": lexicon_scores,
    "score_model_window": window_scores,
    "score_raw_text": raw_scores,
    "score_raw_text_nulls": raw_scores_with_nulls,
    "score_udf_errors": model_scores,
    "score_udf_labels": errors_by_label,
    "score_udf_broadcast": broadcast_model_scores,
    "result_view": results,
    "label_view": labels_only,
    "scored_table": scored_table,
    "score_subword_tokens": subword_scores,
}

_SCORE_COLUMNS = f"token_count, sentiment, {ROUNDED_SCORE} AS score"


def _vowels(letter):
    return f"(length(text) - length(replace(text, '{letter}', ''))) / 10.0::DOUBLE"


_MODEL_SQL = f"""
WITH {PATCHY_SQL},
logits AS (
  SELECT *, {_vowels("a")} AS l0, {_vowels("e")} AS l1, {_vowels("i")} AS l2,
         text IS NULL OR contains(text, 'aa') AS failed
  FROM reviews),
scored AS (
  SELECT asin,
         CAST(CASE WHEN failed THEN 0 WHEN text = '' THEN 2
                   ELSE len(string_split(text, ' ')) + 2 END AS INTEGER) AS token_count,
         CASE WHEN contains(text, 'aa') THEN 'ValueError: unreadable text' END AS error,
         CASE WHEN failed THEN 'ERROR' WHEN l0 >= l1 AND l0 >= l2 THEN 'NEG'
              WHEN l1 >= l2 THEN 'NEU' ELSE 'POS' END AS sentiment,
         CAST(CASE WHEN failed THEN 0 ELSE 1.0::DOUBLE / (
              exp(l0 - greatest(l0, l1, l2)) + exp(l1 - greatest(l0, l1, l2))
              + exp(l2 - greatest(l0, l1, l2))) END AS FLOAT) AS score
  FROM logits)"""

_TRAINED_SQL = f"""
WITH {REVIEWS_SQL}, {CLEANED_SQL},
split AS (SELECT asin, CASE WHEN preprocessed_text = '' THEN [] ELSE string_split(preprocessed_text, ' ') END AS words FROM cleaned),
grams AS (
  SELECT asin, unnest(words) AS gram FROM split
  UNION ALL
  SELECT asin, words[i] || ' ' || words[i + 1] FROM (SELECT *, unnest(range(1, len(words))) AS i FROM split)),
counted AS (
  SELECT asin, ('0x' || substr(md5(gram), 1, 8))::BIGINT % {TRAINED_BUCKETS} AS bucket, count(*)::DOUBLE AS n
  FROM grams GROUP BY ALL),
marked AS (
  SELECT 'D' || doc_id AS asin, CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 ELSE 2 END AS class FROM labels),
learned AS (SELECT class, asin FROM marked JOIN cleaned USING (asin)),
classes AS (SELECT class, ln(count(*) + 1.0::DOUBLE) - ln((SELECT count(*) FROM learned) + 3.0::DOUBLE) AS pi FROM learned GROUP BY class),
sums AS (SELECT class, bucket, sum(n) AS n FROM learned JOIN counted USING (asin) GROUP BY class, bucket),
totals AS (SELECT class, ln(sum(n) + {TRAINED_BUCKETS}.0::DOUBLE) AS t FROM sums GROUP BY class),
weights AS (
  SELECT class, bucket, ln(coalesce(n, 0) + 1.0::DOUBLE) - t AS theta
  FROM totals CROSS JOIN (SELECT unnest(range({TRAINED_BUCKETS})) AS bucket) LEFT JOIN sums USING (class, bucket)),
sized AS (SELECT asin, len(words) + 2 AS token_count FROM split),
found AS (SELECT asin, class, sum(n * theta) AS evidence FROM counted JOIN weights USING (bucket) GROUP BY asin, class),
logits AS (
  SELECT asin, token_count, class, pi + coalesce(evidence, 0) AS logit
  FROM sized CROSS JOIN classes LEFT JOIN found USING (asin, class)),
best AS (
  SELECT asin, token_count, max(logit) AS top, arg_max(class, logit) AS class, list(logit) AS logits FROM logits GROUP BY ALL)
SELECT asin, token_count::INTEGER AS token_count, (['NEG', 'NEU', 'POS'])[class + 1] AS sentiment,
       round(CAST(CAST(1.0::DOUBLE / list_sum([exp(x - top) FOR x IN logits]) AS FLOAT) AS DOUBLE), 6) AS score
FROM best"""

_PIECES = ", ".join(f"'{piece}'" for piece in SUBWORDS)
_FITTING = f"""list_max(list_filter(range(1, {max(map(len, SUBWORDS)) + 1}),
  lambda n: n <= length(word) - done AND (CASE WHEN done > 0 THEN '{CONTINUED}' ELSE '' END || substr(word, done + 1, n)) IN ({_PIECES})))"""

# Every step takes the longest piece that fits; a word with a place where none fits is one token.
_SUBWORD_SQL = f"""
WITH RECURSIVE {SCORED_SQL.strip().removeprefix("WITH")},
split AS (
  SELECT asin, unnest(regexp_extract_all(preprocessed_text, '[\\p{{P}}\\p{{S}}]|[^\\p{{P}}\\p{{S}}\\s]+')) AS word FROM scored),
walk(word, done, n) AS (
  SELECT DISTINCT word, 0::BIGINT, 0::BIGINT FROM split
  UNION ALL
  SELECT word, coalesce(done + {_FITTING}, -1), n + 1 FROM walk WHERE done >= 0 AND done < length(word)),
counted AS (
  SELECT word, CASE WHEN bool_or(done < 0) OR length(word) > 100 THEN 1 ELSE max(n) END AS n FROM walk GROUP BY word),
tokens AS (SELECT asin, sum(n) AS n FROM split JOIN counted USING (word) GROUP BY asin)
SELECT asin, CAST(coalesce(n, 0) + 2 AS INTEGER) AS token_count, sentiment, {ROUNDED_SCORE} AS score
FROM scored LEFT JOIN tokens USING (asin)"""

ORACLES = {
    "score_subword_tokens": _SUBWORD_SQL,
    "score_trained": _TRAINED_SQL,
    "score_lexicon": f"{SCORED_SQL} SELECT asin, {_SCORE_COLUMNS} FROM scored",
    "score_model_window": f"{WINDOW_SQL} SELECT asin, {_SCORE_COLUMNS} FROM scored",
    "score_raw_text": f"""
WITH {score_sql("conversations", "text")} SELECT conv_id, turn, {_SCORE_COLUMNS} FROM scored""",
    "score_raw_text_nulls": f"""
WITH {PATCHY_SQL}, {score_sql("reviews", "text")} SELECT asin, {_SCORE_COLUMNS} FROM scored""",
    "score_udf_errors": f"{_MODEL_SQL} SELECT asin, {_SCORE_COLUMNS}, error FROM scored",
    "score_udf_labels": f"{_MODEL_SQL} SELECT sentiment, count(*) AS count FROM scored GROUP BY sentiment",
    "score_udf_broadcast": f"""
WITH {REVIEWS_SQL},
logits AS (
  SELECT asin, CAST(length(text) % 7 AS DOUBLE) AS l0, CAST(length(text) % 5 AS DOUBLE) AS l1,
         CAST(length(text) % 3 AS DOUBLE) AS l2
  FROM reviews)
SELECT asin, CAST(2 AS INTEGER) AS token_count,
       CASE WHEN l0 >= l1 AND l0 >= l2 THEN 'NEG' WHEN l1 >= l2 THEN 'NEU' ELSE 'POS' END AS sentiment,
       round(CAST(CAST(1.0::DOUBLE / (exp(l0 - greatest(l0, l1, l2)) + exp(l1 - greatest(l0, l1, l2))
             + exp(l2 - greatest(l0, l1, l2))) AS FLOAT) AS DOUBLE), 6) AS score
FROM logits""",
    "result_view": f"""
{SCORED_SQL} SELECT asin, user_id, text AS review_text, sentiment, {ROUNDED_SCORE} AS score FROM scored""",
    "label_view": f"{SCORED_SQL} SELECT text AS review_text, sentiment FROM scored",
    "scored_table": f"""
{SCORED_SQL} SELECT text, asin, user_id, rating, title, text_length, preprocessed_text, {_SCORE_COLUMNS}
FROM scored""",
}
