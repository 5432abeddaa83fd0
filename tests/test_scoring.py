import math

import pytest
from pyspark.sql import functions as F

from reviewloom.functions.lexicon import OPINION_WORDS, Lexicon
from reviewloom.operators.scoring import (
    LexiconScorer,
    ModelScorer,
    label_view,
    result_view,
    score,
)
from reviewloom.schemas import SCORE_SCHEMA

WORDS = Lexicon(("bad",), ("fine",), ("good",), neutral_prior=1.0)


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id int, text string")


def scores(df, scorer):
    return [tuple(r) for r in score(df, scorer, "text").orderBy("id").select(*SCORE_SCHEMA.names).collect()]


def softmax(*logits):
    return max(math.exp(x) for x in logits) / sum(math.exp(x) for x in logits)


def test_lexicon_scores(spark):
    df = texts(spark, "good good day", "bad, (bad) \"bad\"!", "", "nothing here", "good bad", None, "bad good good.")
    expected = [
        (5, "POS", softmax(0, 1, 2)),
        (5, "NEG", softmax(3, 1, 0)),
        (2, "NEU", softmax(0, 1, 0)),
        (4, "NEU", softmax(0, 1, 0)),
        (4, "NEG", softmax(1, 1, 1)),  # a tie goes to the first class
        (0, "ERROR", 0.0),
        (5, "POS", softmax(1, 1, 2)),
    ]
    for (tokens, label, probability), result in zip(expected, scores(df, LexiconScorer(WORDS)), strict=True):
        assert result[:2] == (tokens, label)
        assert result[2] == pytest.approx(probability, rel=1e-6)


def test_the_whole_text_counts(spark):
    df = texts(spark, " ".join(["x"] * 200 + ["good"] * 3), " ".join(["good"] * 126), " ".join(["x"] * 127))
    assert [r[:2] for r in scores(df, LexiconScorer(WORDS))] == [(205, "POS"), (128, "POS"), (129, "NEU")]


def test_a_model_with_a_window_sees_the_whole_text(spark):
    def factory():
        def model(batch):
            if any(len(text.split(" ")) > 5 for text in batch):
                raise ValueError("too long")
            return [len(text.split(" ")) for text in batch], [[float(text.count("n")), 0.5, float(text.count("p"))] for text in batch]

        return model

    df = texts(spark, "n " * 3 + "x " * 20 + "p p p p p p", "p", "", None, "x x n x x n")
    result = scores(df, ModelScorer(factory, window_words=5, batch_rows=2))
    assert [r[:2] for r in result] == [(29, "POS"), (1, "POS"), (1, "NEU"), (0, "ERROR"), (6, "NEG")]
    assert result[0][2] == pytest.approx(softmax(3, 0.5 * 6, 6), rel=1e-6)


def test_columns_of_the_user_stay(spark):
    df = texts(spark, "good", None).selectExpr("id", "text", "1 as result", "2 as _seen", "3 as _counts", "4 as _tokens")
    for scorer in (LexiconScorer(WORDS), ModelScorer(make_factory())):
        got = score(df, scorer, "text")
        assert got.columns == [*df.columns, *SCORE_SCHEMA.names]
        assert [(r["result"], r["_seen"], r["_counts"]) for r in got.collect()] == [(1, 2, 3)] * 2
    with pytest.raises(ValueError, match="sentiment"):
        score(df.withColumn("sentiment", F.lit("x")), LexiconScorer(WORDS), "text")


def test_result_schema(spark):
    df = score(texts(spark, "good"), LexiconScorer(WORDS), "text")
    assert df.columns == ["id", "text", "token_count", "sentiment", "score"]
    assert [f.dataType for f in df.schema.fields[2:]] == [f.dataType for f in SCORE_SCHEMA.fields]
    assert "EvalPython" not in df._jdf.queryExecution().executedPlan().toString()


def test_opinion_words(spark):
    df = texts(
        spark,
        "the kettle boils fast, looks gorgeous and i love it!",
        "arrived damaged, and the refund was a nasty struggle",
        "an ordinary mug, nothing more",
    )
    assert [r[1] for r in scores(df, LexiconScorer(OPINION_WORDS))] == ["POS", "NEG", "NEU"]


def test_lexicon_is_checked():
    for words in ((("a",), ("a",), ()), (("A",), (), ()), (("a b",), (), ()), (("",), (), ())):
        with pytest.raises(ValueError):
            Lexicon(*words)
    assert len(Lexicon(tuple(f"w{i}" for i in range(6000)), (), ()).negative) == 6000


def make_factory(sign=1.0, log=None):
    def factory():
        def model(batch):
            if any("boom" in text for text in batch):
                raise RuntimeError("cannot read this")
            return [len(text.split()) + 2 for text in batch], [
                [sign * text.count("n"), 0.5, sign * text.count("p")] for text in batch
            ]

        return model

    return factory


def test_model_scores(spark):
    df = texts(spark, "n n", "p", "", None, "xx", "boom p")
    result = scores(df, ModelScorer(make_factory()))
    assert [r[:2] for r in result] == [
        (4, "NEG"),
        (3, "POS"),
        (2, "NEU"),
        (0, "ERROR"),
        (3, "NEU"),
        (0, "ERROR"),
    ]
    assert result[0][2] == pytest.approx(softmax(2, 0.5, 0), rel=1e-6)
    assert result[3][2] == result[5][2] == 0.0


@pytest.mark.parametrize("batch_rows", [1, 7, 1000])
def test_bad_texts_spoil_only_themselves(spark, batch_rows):
    df = spark.range(500).select(
        F.col("id").cast("int"),
        F.when(F.col("id") % 13 == 0, F.lit("boom"))
        .when(F.col("id") % 13 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("p "), F.col("id").cast("string")))
        .alias("text"),
    )
    result = scores(df.repartition(3), ModelScorer(make_factory(), batch_rows=batch_rows))
    for row_id, (tokens, label, _) in enumerate(result):
        assert (tokens, label) == ((0, "ERROR") if row_id % 13 in (0, 1) else (4, "POS"))


def test_two_models_side_by_side(spark):
    df = texts(spark, "p p p")
    first, second = ModelScorer(make_factory(1.0)), ModelScorer(make_factory(-1.0))
    assert scores(df, first)[0][1] == "POS"
    assert scores(df, second)[0][1] == "NEU"
    assert scores(df, first)[0][1] == "POS"


def test_no_rows_and_empty_partitions(spark):
    empty = spark.createDataFrame([], "id int, text string")
    assert scores(empty, ModelScorer(make_factory())) == []
    assert scores(empty, LexiconScorer(WORDS)) == []
    assert len(scores(texts(spark, "p").repartition(8), ModelScorer(make_factory()))) == 1


def test_own_labels(spark):
    def factory():
        return lambda batch: ([1] * len(batch), [[0.0, 1.0] for _ in batch])

    assert scores(texts(spark, "x"), ModelScorer(factory, labels=("no", "yes")))[0][:2] == (1, "yes")


def test_model_with_wrong_output_gives_error_rows(spark):
    def factory():
        return lambda batch: ([1], [[0.0, 1.0]])

    assert [r[1] for r in scores(texts(spark, "x", "y"), ModelScorer(factory))] == ["ERROR", "ERROR"]


def test_reasons_and_shares_of_errors(spark):
    df = texts(spark, "p", "boom", None).coalesce(1)
    reasons = score(df, ModelScorer(make_factory(), keep_errors=True), "text").orderBy("id").collect()
    assert [r["error"] for r in reasons] == [None, "RuntimeError: cannot read this", None]
    assert len(scores(df, ModelScorer(make_factory(), max_error_share=0.5))) == 3
    with pytest.raises(Exception, match="1 of 2 texts were refused, first: RuntimeError: cannot read this"):
        scores(df, ModelScorer(make_factory(), max_error_share=0.4))


@pytest.mark.parametrize("kind", [MemoryError, ImportError])
def test_failures_that_are_no_texts_fault_end_the_task(spark, kind):
    def factory():
        def model(batch):
            raise kind("not the text")

        return model

    with pytest.raises(Exception, match="not the text"):
        scores(texts(spark, "x"), ModelScorer(factory))


def test_broadcast_model_is_size_checked(spark, monkeypatch):
    def build(weights):
        return lambda batch: ([1] * len(batch), [weights for _ in batch])

    scorer = ModelScorer.from_broadcast(spark, [0.0, 0.0, 1.0], build)
    assert scores(texts(spark, "x"), scorer)[0][1] == "POS"
    monkeypatch.setattr("reviewloom.operators.scoring.MAX_BROADCAST_BYTES", 10)
    with pytest.raises(ValueError, match="shared storage"):
        ModelScorer.from_broadcast(spark, list(range(100)), build)


def test_views(spark):
    df = spark.createDataFrame([("good", "a", "u", 5.0, "t")], "text string, asin string, user_id string, rating float, title string")
    scored = score(df, LexiconScorer(WORDS), "text")
    assert result_view(scored).columns == ["asin", "user_id", "review_text", "sentiment", "score"]
    assert [tuple(r) for r in label_view(scored).collect()] == [("good", "NEU")]
