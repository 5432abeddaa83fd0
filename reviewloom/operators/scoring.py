"""Classifying reviews: label, confidence and token count per row.

A scorer has ``labels`` and ``apply(df, text_col)``, which adds one struct column ``result``
(``SCORE_SCHEMA``). ``score`` flattens it. Two scorers are built in: ``LexiconScorer`` is made of
native expressions; ``ModelScorer`` runs a user-supplied model in a pandas UDF.
"""

import pickle
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reviewloom.functions.lexicon import OPINION_WORDS, Lexicon
from reviewloom.schemas import SCORE_SCHEMA

# Class order of the labels (ties go to the first), label and values of rows that
# could not be scored, tokens added around each text, longest token sequence of the model.
LABELS = ("NEG", "NEU", "POS")
ERROR_LABEL = "ERROR"
ERROR_TOKENS = 0
ERROR_SCORE = 0.0
SPECIAL_TOKENS = 2
MODEL_WINDOW = 128

RESULT = "result"
PUNCTUATION = '.,;:!?"()'
OUTER_PUNCTUATION = rf"[{PUNCTUATION}](?:(?<=^.| .)[{PUNCTUATION}]*+|[{PUNCTUATION}]*+(?= |\z))"
MAX_BROADCAST_BYTES = 1 << 30


def score(df: DataFrame, scorer, text_col: str = "preprocessed_text") -> DataFrame:
    """Add ``token_count``, ``sentiment`` and ``score``. Every input row gives one output row.

    Other columns stay whatever their names are; an input that has one of the three already is refused.
    """
    result_col = free_name(df, RESULT)
    scored = scorer.apply(df, text_col, result_col)
    clash = sorted(set(df.columns) & set(scored.schema[result_col].dataType.names))
    if clash:
        raise ValueError(f"the input has columns that scoring adds: {', '.join(clash)}")
    return flatten_result(scored, result_col)


def flatten_result(df: DataFrame, result_col: str = RESULT) -> DataFrame:
    return df.select("*", f"{result_col}.*").drop(result_col)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column has it."""
    while name in df.columns:
        name += "_"
    return name


def result_view(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns a reader of the results needs."""
    return df.select("asin", "user_id", F.col(text_col).alias("review_text"), "sentiment", "score")


def label_view(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.select(F.col(text_col).alias("review_text"), "sentiment")


def decide(logits: dict[str, Column]) -> Column:
    """Label with the largest logit; the first one wins a tie."""
    top = F.greatest(*logits.values())
    decision = None
    for label, logit in logits.items():
        decision = (F if decision is None else decision).when(logit == top, F.lit(label))
    return decision


def confidence(logits: dict[str, Column]) -> Column:
    """Softmax probability of the largest logit."""
    top = F.greatest(*logits.values())
    total = None
    for logit in logits.values():
        term = F.exp(logit - top)
        total = term if total is None else total + term
    return (F.lit(1.0) / total).cast("float")


class LexiconScorer:
    """Counts the words of each class in the whole text; the counts are the logits.

    ``tokens`` turns the text column into the number of its tokens (``operators.subwords``); without it, words count.
    """

    labels = LABELS

    def __init__(self, lexicon: Lexicon = OPINION_WORDS, tokens: Callable[[Column], Column] | None = None):
        self.lexicon = lexicon
        self.tokens = tokens

    def apply(self, df: DataFrame, text_col: str, result_col: str = RESULT) -> DataFrame:
        text, lexicon = F.col(text_col), self.lexicon
        # Punctuation around words goes from the text at once; words of nothing else stay, as empty ones.
        words = F.split(F.regexp_replace(text, F.lit(OUTER_PUNCTUATION), F.lit("")), " ")
        counted = self.tokens(text) if self.tokens else F.when(text == "", F.lit(0)).otherwise(F.size(words))
        tokens = counted + SPECIAL_TOKENS
        known = lexicon.negative + lexicon.neutral + lexicon.positive
        # One pass over the words keeps the few of the lexicon; the classes count those.
        found = F.filter(words, lambda word: word.isin(*known))
        seen = free_name(df, "_seen")
        hits, counts = F.col(f"{seen}.hits"), free_name(df, "_counts")

        def count_of(class_words):
            return F.size(F.filter(hits, lambda word: word.isin(*class_words))).cast("double")

        per_class = F.struct(
            count_of(lexicon.negative).alias("NEG"),
            (count_of(lexicon.neutral) + F.lit(float(lexicon.neutral_prior))).alias("NEU"),
            count_of(lexicon.positive).alias("POS"),
        )
        logits = {label: F.col(f"{counts}.{label}") for label in LABELS}
        result = F.when(
            text.isNotNull(),
            F.struct(
                F.col(f"{seen}.tokens").alias("token_count"),
                decide(logits).alias("sentiment"),
                confidence(logits).alias("score"),
            ),
        ).otherwise(_error_result())
        return (
            df.withColumn(seen, F.struct(tokens.alias("tokens"), found.alias("hits")))
            .withColumn(counts, per_class)
            .withColumn(result_col, result)
            .drop(seen, counts)
        )


class ModelScorer:
    """Runs a model in a pandas UDF, on Arrow batches.

    ``factory()`` is called once per Python worker, which keeps what it made for later tasks (the three models used last;
    ``spark.python.worker.reuse`` must not be turned off). It returns a callable: a list of texts goes in, a pair
    ``(token_counts, logits)`` comes out, ``logits`` being rows x labels. It gets ``batch_rows``
    texts at a time. A batch the callable rejects is halved and scored again, down to the texts
    that cannot be scored: these become ``(0, 'ERROR', 0.0)``, and null texts too, without the
    model being asked. Failures of memory or imports are not a text's fault and end the task.

    ``keep_errors`` adds a column ``error`` with the reason. ``max_error_share`` ends a task in which a larger
    share of the texts was refused. ``window_words`` is for models that see so many words at a time: a longer text
    is scored in windows one after the other, whose token counts and logits are added up.

    Each scorer builds its own UDF, so two scorers with different factories can be used side by
    side in one session.
    """

    def __init__(
        self,
        factory: Callable[[], Callable],
        labels: tuple[str, ...] = LABELS,
        batch_rows: int = 256,
        keep_errors: bool = False,
        max_error_share: float = 1.0,
        window_words: int | None = None,
    ):
        self.factory = factory
        self.labels = tuple(labels)
        self.batch_rows = batch_rows
        self.keep_errors = keep_errors
        self.max_error_share = max_error_share
        self.window_words = window_words
        self.name = uuid.uuid4()  # under which workers keep the model

    @classmethod
    def from_broadcast(cls, spark: SparkSession, payload, build: Callable, **options):
        """Ship the parts of a model (weights, tokenizer) to the executors once.

        ``build(payload)`` makes the callable out of them, once in each worker.
        """
        size = len(pickle.dumps(payload))
        if size > MAX_BROADCAST_BYTES:
            raise ValueError(
                f"the model takes {size} bytes, more than {MAX_BROADCAST_BYTES}: "
                "pass a factory that loads it from shared storage"
            )
        shared = spark.sparkContext.broadcast(payload)
        return cls(lambda: build(shared.value), **options)

    @classmethod
    def from_array_file(cls, spark: SparkSession, path: str, build: Callable, **options):
        """Weights in a ``.npy`` file, for models too large to hold once per worker.

        Spark fetches the file to each executor once; its workers map it into memory, so they share one copy.
        ``build(weights)`` makes the callable, once in each worker. The file's name must be one of its own in the session.
        """
        spark.sparkContext.addFile(path)
        name = path.rstrip("/").rsplit("/", 1)[-1]

        def factory():
            import numpy as np
            from pyspark import SparkFiles

            return build(np.load(SparkFiles.get(name), mmap_mode="r"))

        return cls(factory, **options)

    def apply(self, df: DataFrame, text_col: str, result_col: str = RESULT) -> DataFrame:
        return df.withColumn(result_col, _model_udf(self)(F.col(text_col)))


def _error_result() -> Column:
    return F.struct(
        F.lit(ERROR_TOKENS).alias("token_count"),
        F.lit(ERROR_LABEL).alias("sentiment"),
        F.lit(ERROR_SCORE).cast("float").alias("score"),
    )


def _model_udf(scorer: ModelScorer):
    """The functions are nested, and the values local, so that the UDF is shipped by value and
    the workers need not have this package installed."""
    factory, labels, batch_rows = scorer.factory, list(scorer.labels), scorer.batch_rows
    keep_errors, max_share, window = scorer.keep_errors, scorer.max_error_share, scorer.window_words
    name = scorer.name
    error = (ERROR_TOKENS, ERROR_LABEL, ERROR_SCORE)
    schema = StructType(SCORE_SCHEMA.fields + ([StructField("error", StringType())] if keep_errors else []))
    columns = [*SCORE_SCHEMA.names, "error"]

    def windows(text):
        words = text.split(" ")
        return [" ".join(words[i : i + window]) for i in range(0, len(words), window)]

    def ask(model, texts):
        import numpy as np

        token_counts, logits = model(texts)
        logits = np.asarray(logits, dtype="float64").reshape(len(texts), len(labels))
        if len(token_counts) != len(texts):
            raise ValueError(f"{len(token_counts)} token counts for {len(texts)} texts")
        return np.asarray(token_counts), logits

    def ask_in_windows(model, texts):
        import numpy as np

        parts = [windows(text) for text in texts]
        flat = [part for of_text in parts for part in of_text]
        asked = [ask(model, flat[i : i + batch_rows]) for i in range(0, len(flat), batch_rows)]
        counts, logits = (np.concatenate(column) for column in zip(*asked, strict=True))
        starts = np.cumsum([0] + [len(of_text) for of_text in parts[:-1]])
        return np.add.reduceat(counts, starts), np.add.reduceat(logits, starts, axis=0)

    def predict(model, texts):
        import numpy as np

        token_counts, logits = (ask if window is None else ask_in_windows)(model, texts)
        best = logits.argmax(axis=1)
        shifted = np.exp(logits - logits.max(axis=1, keepdims=True))
        chosen = shifted[np.arange(len(texts)), best] / shifted.sum(axis=1)
        return [
            (int(count), labels[index], float(probability), None)
            for count, index, probability in zip(token_counts, best, chosen, strict=True)
        ]

    def contained(model, texts):
        try:
            return predict(model, texts)
        except (MemoryError, ImportError):
            raise
        except Exception as problem:
            if len(texts) == 1:
                return [(*error, f"{type(problem).__name__}: {problem}")]
        half = len(texts) // 2
        return contained(model, texts[:half]) + contained(model, texts[half:])

    def kept_model():
        from pyspark.ml.model_cache import ModelCache

        model = ModelCache.get(name)
        if model is None:
            model = factory()
            ModelCache.add(name, model)
        return model

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = kept_model()
        asked, refused = 0, []
        for batch in batches:
            known = batch.notna()
            texts = batch[known].tolist()
            rows = pd.Series([(*error, None)] * len(batch), dtype=object)
            scored = []
            for start in range(0, len(texts), batch_rows):
                scored += contained(model, texts[start : start + batch_rows])
            asked += len(scored)
            refused += [row[3] for row in scored if row[3]]
            rows[known.to_numpy().nonzero()[0]] = pd.Series(scored, dtype=object).to_numpy()
            result = pd.DataFrame(rows.tolist(), columns=columns)
            result = result.astype({"token_count": "int32", "score": "float32"})
            yield result if keep_errors else result.drop(columns="error")
        if len(refused) > max_share * asked:
            raise RuntimeError(f"{len(refused)} of {asked} texts were refused, first: {refused[0]}")

    return run
