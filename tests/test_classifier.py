"""The trained scorer and the model store of the workers."""

import collections
import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewloom.operators.classifier import LinearModel, _counter, _predictor, bucket_of, fit_classifier, ngrams, trained_scorer
from reviewloom.operators.scoring import ModelScorer, score
from reviewloom.queries.scoring import labelled_reviews

LABELS = ("NEG", "NEU", "POS")


@pytest.fixture(scope="module")
def opinions(spark):
    rng = np.random.default_rng(4)
    mood = {"NEG": ["bad", "broken", "sad"], "NEU": ["fine", "usual"], "POS": ["good", "great"]}
    rows = []
    for i in range(300):
        label = LABELS[i % 3]
        words = rng.choice(["the", "a", "box", "came", "today"], 8).tolist() + rng.choice(mood[label], 2).tolist()
        rng.shuffle(words)
        rows.append((i, " ".join(words), label))
    return spark.createDataFrame(rows, "id long, text string, label string").repartition(4)


@pytest.mark.parametrize("algorithm", ["bayes", "logistic"])
def test_learns_and_survives_a_round_trip(spark, opinions, tmp_path, algorithm):
    train, rest = opinions.filter("id < 200"), opinions.filter("id >= 200")
    model = fit_classifier(train, "label", "text", buckets=4096, algorithm=algorithm, ridge=1e-3)
    again = LinearModel.load(spark, model.save(spark, str(tmp_path / "model")))
    assert again.labels == LABELS and again.buckets == 4096
    assert np.array_equal(again.weights, model.weights) and np.array_equal(again.intercepts, model.intercepts)
    scored = score(rest.withColumnRenamed("label", "expected"), trained_scorer(spark, again), "text").collect()
    assert np.mean([r["sentiment"] == r["expected"] for r in scored]) > 0.95
    assert all(1 / 3 <= r["score"] <= 1 and r["token_count"] == 12 for r in scored)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        model.save(spark, str(tmp_path / "model"))


def test_weights_are_those_of_naive_bayes(spark, opinions):
    model = fit_classifier(opinions, "label", "text", ngram_words=1, buckets=64, smoothing=0.5)
    rows = opinions.select("label", F.explode(ngrams(F.col("text"), 1)).alias("gram")).select("label", bucket_of(F.col("gram"), 64).alias("b"))
    counts = np.zeros((64, 3))
    for r in rows.groupBy("label", "b").count().collect():
        counts[r["b"], LABELS.index(r["label"])] = r["count"]
    assert model.weights == pytest.approx(np.log((counts + 0.5) / (counts.sum(axis=0) + 32)))
    assert model.intercepts == pytest.approx(np.log([100.5 / 301.5] * 3))


def test_ngrams(spark):
    df = spark.createDataFrame([("a b c",), ("a",), ("",), (None,), ("a  b",)], "t string")
    found = [r[0] for r in df.select(ngrams(F.col("t"), 3)).collect()]
    assert found == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], [], [], ["a", "", "b", "a ", " b", "a  b"]]


def test_ngrams_split_a_text_once(spark):
    plan = spark.range(1).select(ngrams(F.col("id").cast("string"), 3))._jdf.queryExecution().analyzed().toString()
    bodies = plan.split("lambdafunction(")[1:]
    assert bodies
    for body in bodies:  # up to the bracket that closes it
        depth, end = 1, 0
        while depth:
            depth += {"(": 1, ")": -1}.get(body[end], 0)
            end += 1
        assert "split" not in body[:end]


def test_scorer_equals_plain_hashing():
    texts = ["", "a", " ", "a  b", "\u00e9 \U0001f600 " + "x" * 200, " outer ", " ".join("z" * n for n in range(53, 66)), "a", ""]
    rng = np.random.default_rng(5)
    weights, intercepts = rng.normal(size=(512, 3)), np.array([0.1, 0.2, 0.3])
    for longest in (1, 2, 3):
        tokens, logits = _predictor()({"weights": weights, "intercepts": intercepts, "ngram_words": longest})(texts)
        for text, n, row in zip(texts, tokens, logits, strict=True):
            words = text.split(" ") if text else []
            grams = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
            places = [int(hashlib.md5(gram.encode()).hexdigest()[:8], 16) % 512 for gram in grams]
            assert n == len(words) + 2 and row == pytest.approx(intercepts + weights[places].sum(axis=0))


def test_counter_equals_plain_counting():
    texts = ["", "a", "", " a  b", " ".join(f"w{n % 977}" for n in range(70000)), "a", "z" * 300 + " \u00e9"]
    labels = [0, 2, 1, 2, 1, 0, 1]
    batches = [pa.record_batch({"label": pa.array(labels, pa.int32()), "text": pa.array(texts)})]
    counts = collections.Counter()
    for text, label in zip(texts, labels, strict=True):
        words = text.split(" ") if text else []
        counts[label, -1] += 1
        for n in (1, 2, 3):
            for i in range(len(words) - n + 1):
                counts[label, int(hashlib.md5(" ".join(words[i : i + n]).encode()).hexdigest()[:8], 16) % 64] += 1
    (found,) = _counter(3, 3, 64)(iter(batches))
    assert {(r["label"], r["bucket"]): r["n"] for r in found.to_pylist()} == counts
    weights = np.random.default_rng(6).normal(size=(64, 3))
    tokens, logits = _predictor()({"weights": weights, "intercepts": np.zeros(3), "ngram_words": 3})([texts[4]])
    of_text = np.array([counts[1, b] for b in range(64)], float)
    for gram in ["z" * 300, "\u00e9", "z" * 300 + " \u00e9"]:
        of_text[int(hashlib.md5(gram.encode()).hexdigest()[:8], 16) % 64] -= 1
    assert tokens == [70002] and logits[0] == pytest.approx(of_text @ weights)
    assert [r.num_rows for r in _counter(3, 2, 64)(iter([]))] == [0]


def test_a_fit_reads_its_rows_once(spark, opinions):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    fit_classifier(opinions.mapInArrow(counted, opinions.schema), "label", "text", buckets=64)
    assert read.value == 300


def test_texts_without_a_label_are_not_cleaned(spark, tmp_path, plan_of):
    texts = [(1, "A  HTTP://x.y z"), (2, "b"), (3, " "), (4, None), (5, "E @me"), (5, "E again"), (None, "lost")]
    documents = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "'s' AS source", "'en' AS lang")
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(1, 1, 1), (3, 0, 0), (4, 0, 0), (5, 0, 0), (6, 1, 0), (None, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    found = labelled_reviews(spark, str(tmp_path))
    rows = [tuple(r) for r in found.select("asin", "preprocessed_text", "label").collect()]
    assert sorted(rows) == [("D1", "a [URL] z", "NEG"), ("D5", "e [USER]", "NEU"), ("D5", "e again", "NEU")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" in plan and "regexp_replace" not in plan[plan.index("Join Inner") :]
    assert "ShuffledHashJoin" in plan_of(found)  # texts are not sorted


def test_rows_and_labels_that_teach_nothing(spark, opinions):
    odd = spark.createDataFrame([(1, None, "POS"), (2, "x", None), (3, "y", "OTHER")], opinions.schema)
    with pytest.raises(ValueError, match="no row"):
        fit_classifier(odd, "label", "text", buckets=16)
    with pytest.raises(ValueError, match="algorithm"):
        fit_classifier(opinions, "label", "text", buckets=16, algorithm="magic")
    with pytest.raises(ValueError, match="weights"):
        fit_classifier(opinions, "label", "text", buckets=1 << 25)
    two = fit_classifier(opinions.filter("label <> 'NEU'").unionByName(odd), "label", "text", buckets=256)
    texts = spark.createDataFrame([("good great",), ("",), (None,), ("bad " * 50000,)], "text string")
    scored = [r["sentiment"] for r in score(texts, trained_scorer(spark, two), "text").collect()]
    assert scored[0] == "POS" and scored[1] in ("NEG", "POS") and scored[2:] == ["ERROR", "NEG"]


def make_counting_factory(folder):
    def factory():
        import os
        import uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        return lambda texts: ([2] * len(texts), [[float(len(text)), 1.0, 0.0] for text in texts])

    return factory


def test_a_worker_loads_a_model_once(spark, tmp_path):
    folder = tmp_path / "loads"
    folder.mkdir()
    texts = spark.range(640).selectExpr("repeat('x', cast(id % 5 as int)) as text").repartition(64)
    scorer = ModelScorer(make_counting_factory(str(folder)))
    first = score(texts, scorer, "text").collect()
    second = score(texts, scorer, "text").collect()
    assert sorted(first) == sorted(second) and len(first) == 640
    loads = len(list(folder.iterdir()))
    assert 1 <= loads <= 24  # of 128 tasks: a load for each of the workers, of which there are eight or few more
    other = ModelScorer(lambda: lambda texts: ([2] * len(texts), [[0.0, 0.0, 1.0]] * len(texts)))
    assert {r["sentiment"] for r in score(texts, other, "text").collect()} == {"POS"}  # not the model kept before


def make_mapped_builder():
    def build(weights):
        import numpy as np

        assert isinstance(weights, np.memmap)
        return lambda texts: ([2] * len(texts), [weights[len(text) % len(weights)].tolist() for text in texts])

    return build


def test_weights_from_a_mapped_file(spark, tmp_path):
    path = str(tmp_path / "weights-of-test.npy")
    np.save(path, np.eye(3))
    scorer = ModelScorer.from_array_file(spark, path, make_mapped_builder())
    texts = spark.createDataFrame([("",), ("a",), ("ab",)], "text string")
    assert [r["sentiment"] for r in score(texts, scorer, "text").collect()] == list(LABELS)


def test_fit_and_analyze_from_the_command_line(spark, tmp_path, capsys):
    from reviewloom.__main__ import main

    rows = [(["awful broken", "so so", "lovely great"][i % 3], f"B{i}", "u", [1.0, 3.0, 5.0][i % 3], "t") for i in range(90)]
    spark.createDataFrame(rows, "text string, asin string, user_id string, rating float, title string").write.json(str(tmp_path / "shop.jsonl"))
    model = str(tmp_path / "model")
    assert main(["fit", "--data", str(tmp_path / "shop.jsonl"), "--model", model, "--buckets", "1024"]) == 0
    out = ["--output-dir", str(tmp_path / "out"), "--summary-dir", str(tmp_path / "sum")]
    assert main(["analyze", "--dataset", "shop", "--input-root", str(tmp_path), "--model", model, *out]) == 0
    scored = spark.read.option("header", True).csv(str(tmp_path / "out" / "shop"))
    assert {tuple(r) for r in scored.select("rating", "sentiment").distinct().collect()} == {("1.0", "NEG"), ("3.0", "NEU"), ("5.0", "POS")}
