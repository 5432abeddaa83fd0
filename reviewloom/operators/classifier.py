"""A classifier that is learned: hashed word n-grams, a multinomial model, weights that can be saved.

Words are what lies between single spaces of a (cleaned) text. Each n-gram of 1 to ``ngram_words`` words counts in one of ``buckets``
buckets, chosen by its MD5, which any system can compute. The model is linear in these counts: naive Bayes (closed form, one
pass over the training rows, which tasks count and Spark adds up) or multinomial logistic regression of ``pyspark.ml`` (some tens of
passes). All training rows are used; only the weights, whose number does not depend on the data, come to the driver.
"""

import hashlib
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.operators.scoring import LABELS, SPECIAL_TOKENS, ModelScorer

BUCKETS = 1 << 16
MAX_WEIGHTS = 1 << 26  # fixed value: half a gigabyte of doubles
_FORMAT = 1  # fixed value: version of the saved form


class LinearModel(NamedTuple):
    """``logits = intercepts + counts @ weights``; ``weights`` is buckets x labels."""

    labels: tuple[str, ...]
    ngram_words: int
    weights: np.ndarray
    intercepts: np.ndarray

    @property
    def buckets(self) -> int:
        return len(self.weights)

    def save(self, spark: SparkSession, path: str) -> str:
        """One Parquet row for each label, on any storage the cluster reaches. An existing path is refused."""
        rows = [
            (_FORMAT, position, label, self.ngram_words, float(self.intercepts[position]), self.weights[:, position].tolist())
            for position, label in enumerate(self.labels)
        ]
        spark.createDataFrame(rows, _SAVED).coalesce(1).write.parquet(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "LinearModel":
        rows = spark.read.schema(_SAVED).parquet(path).orderBy("position").collect()
        if not rows or {r["format"] for r in rows} != {_FORMAT} or [r["position"] for r in rows] != list(range(len(rows))):
            raise ValueError(f"{path} does not hold a model of this version")
        return cls(
            tuple(r["label"] for r in rows),
            rows[0]["ngram_words"],
            np.array([r["weights"] for r in rows]).T.copy(),
            np.array([r["intercept"] for r in rows]),
        )


_SAVED = "format int, position int, label string, ngram_words int, intercept double, weights array<double>"


def label_of_rating(rating: str) -> Column:
    """Up to two stars are NEG, up to three NEU, more POS; null stays null."""
    stars = F.col(rating)
    return F.when(stars <= 2, "NEG").when(stars <= 3, "NEU").when(stars > 3, "POS")


def ngrams(text: Column, ngram_words: int) -> Column:
    """All n-grams of 1 to ``ngram_words`` words, with repeats; none of a null or empty text."""
    words = F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))
    grams = [words]
    for n in range(2, ngram_words + 1):
        # Each gets its next word. A function that names ``words`` itself would split the text anew for every element.
        longer = F.zip_with(grams[-1], F.slice(words, F.lit(n), F.greatest(F.size(words) - (n - 1), F.lit(0))), lambda gram, word: F.concat(gram, F.lit(" "), word))
        grams.append(F.filter(longer, lambda gram: gram.isNotNull()))
    return F.concat(*grams)


def bucket_of(gram: Column, buckets: int) -> Column:
    return F.conv(F.substring(F.md5(gram), 1, 8), 16, 10).cast("bigint") % buckets


def fit_classifier(
    df: DataFrame,
    label: str,
    text_col: str = "preprocessed_text",
    labels: tuple[str, ...] = LABELS,
    ngram_words: int = 2,
    buckets: int = BUCKETS,
    algorithm: str = "bayes",
    smoothing: float = 1.0,
    ridge: float = 1e-4,
    iterations: int = 50,
) -> LinearModel:
    """Learns which of ``labels`` the column ``label`` names; rows with a null or another label, or a null text, are passed over.

    A label that no row has is never chosen; with one label only, it always is. Without any training row this raises.
    """
    if buckets * len(labels) > MAX_WEIGHTS:
        raise ValueError(f"{buckets} buckets for {len(labels)} labels are more than {MAX_WEIGHTS} weights")
    if algorithm not in ("bayes", "logistic"):
        raise ValueError(f"unknown algorithm {algorithm}: bayes or logistic")
    if smoothing < 0 and algorithm == "bayes":
        raise ValueError(f"smoothing is {smoothing}, below 0")
    rows = df.select(F.col(label).alias("name"), F.col(text_col).alias("text")).filter(F.col("name").isin(*labels) & F.col("text").isNotNull())
    number = F.array_position(F.array(*[F.lit(name) for name in labels]), F.col("name")).cast("int") - 1
    rows = rows.select(number.alias("label"), "text")
    if algorithm == "bayes":
        places, weights, intercepts = _bayes(rows, len(labels), ngram_words, buckets, smoothing)
    else:
        places, weights, intercepts = _logistic(rows, ngram_words, buckets, ridge, iterations)
    full_weights, full_intercepts = np.zeros((len(labels), buckets)), np.full(len(labels), -np.inf)
    full_weights[places], full_intercepts[places] = weights, intercepts
    return LinearModel(tuple(labels), ngram_words, full_weights.T.copy(), full_intercepts)


_NOTHING_TO_LEARN = "there is no row to learn from"


def _bayes(rows: DataFrame, labels: int, ngram_words: int, buckets: int, smoothing: float):
    """(labels that rows have, their weights, their intercepts). Each task counts its n-grams, Spark adds the counts up."""
    counted = rows.mapInArrow(_counter(labels, ngram_words, buckets), "label int, bucket int, n bigint")
    sums = counted.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()
    label, bucket, n = (sums.column(name).to_numpy() for name in ("label", "bucket", "n"))
    docs = np.zeros(labels)
    docs[label[bucket < 0]] = n[bucket < 0]
    places = np.flatnonzero(docs)
    if not len(places):
        raise ValueError(_NOTHING_TO_LEARN)
    if len(places) == 1:
        return places, np.zeros((1, buckets)), np.zeros(1)
    counts = np.zeros((labels, buckets))
    counts[label[bucket >= 0], bucket[bucket >= 0]] = n[bucket >= 0]
    counts, docs = counts[places], docs[places]
    with np.errstate(divide="ignore", invalid="ignore"):  # without smoothing, what was not seen has probability 0
        weights = np.log(counts + smoothing) - np.log(counts.sum(axis=1, keepdims=True) + smoothing * buckets)
        return places, weights, np.log(docs + smoothing) - np.log(docs.sum() + smoothing * len(places))


def _logistic(rows: DataFrame, ngram_words: int, buckets: int, ridge: float, iterations: int):
    """The same by multinomial regression, over the classes that rows have."""
    places = sorted(r["label"] for r in rows.select("label").distinct().collect())  # a row for each label
    if not places:
        raise ValueError(_NOTHING_TO_LEARN)
    if len(places) == 1:
        return places, np.zeros((1, buckets)), np.zeros(1)
    number = F.array_position(F.array(*[F.lit(i) for i in places]), F.col("label")) - 1
    grams = F.transform(ngrams(F.col("text"), ngram_words), lambda gram: bucket_of(gram, buckets).cast("string"))
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(buckets)], "grams", "features")
    counted = counter.transform(rows.select(number.cast("double").alias("label"), grams.alias("grams"))).select("label", "features")
    fitted = LogisticRegression(family="multinomial", regParam=ridge, maxIter=iterations, standardization=False).fit(counted)
    return places, fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()


def trained_scorer(spark: SparkSession, model: LinearModel, **options) -> ModelScorer:
    """A scorer for ``score``: whole texts, tokens are words + 2. The weights are broadcast, and a worker unpacks them once."""
    return ModelScorer.from_broadcast(spark, model._asdict(), _predictor(), labels=model.labels, **options)


def _bucketer():
    """Finds the buckets of all n-grams of a batch of texts. As nested functions, which Spark ships by value."""
    # Constants of MD5, and how far and over which word of the block each of its 64 steps turns.
    sines = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
    turns = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
    places = [(1, 0), (5, 1), (3, 5), (7, 0)]
    one_block, at_once = 55, 16384  # bytes that fit one block of MD5, spans hashed together
    words_at_once = 1 << 16  # words of a step

    def md5_heads(data, eights, starts, ends):
        """The first 32 bits of the MD5 of each ``data[start:end]``; ``eights`` has the eight bytes from each place on."""
        import numpy as np

        sizes = ends - starts
        out = np.empty(len(starts), np.uint32)
        masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
        closing = np.array([0x80 << 8 * n for n in range(8)], np.uint64)
        short = np.flatnonzero(sizes <= one_block)
        scratch = np.empty((6, at_once), np.uint32)
        for begin in range(0, len(short), at_once):
            which = short[begin : begin + at_once]
            first, size = starts[which], sizes[which]
            block = [None] * 16
            for step in range(int(size.max()) // 8 + 1):
                taken = eights[np.minimum(first + 8 * step, len(data))] & masks[np.clip(size - 8 * step, 0, 8)]
                closes = np.flatnonzero(size >> 3 == step)
                taken[closes] |= closing[size[closes] & 7]
                block[2 * step], block[2 * step + 1] = taken.astype(np.uint32), (taken >> np.uint64(32)).astype(np.uint32)
            block[14] = (8 * size).astype(np.uint32)
            a, b, c, d, f, turned = scratch[:, : len(which)]
            for state, value in ((a, 0x67452301), (b, 0xEFCDAB89), (c, 0x98BADCFE), (d, 0x10325476)):
                state.fill(value)
            for i in range(64):
                turn, (times, plus) = i // 16, places[i // 16]
                if turn == 3:  # c ^ (b | ~d)
                    np.invert(d, out=f)
                    f |= b
                    f ^= c
                else:  # d ^ (b & (c ^ d)), c ^ (d & (b ^ c)), d ^ (b ^ c)
                    np.bitwise_xor(*((c, d), (b, c), (b, c))[turn], out=f)
                    if turn < 2:
                        f &= (b, d)[turn]
                    f ^= (d, c, d)[turn]
                f += a
                f += np.uint32(sines[i])
                if (word := block[(times * i + plus) % 16]) is not None:
                    f += word
                by = turns[turn][i % 4]
                np.left_shift(f, np.uint32(by), out=turned)
                f >>= np.uint32(32 - by)
                f |= turned
                f += b
                a, b, c, d, f = d, f, b, c, a
            out[which] = (a + np.uint32(0x67452301)).byteswap()
        for i in np.flatnonzero(sizes > one_block).tolist():
            out[i] = int(hashlib.md5(data[starts[i] : ends[i]].tobytes()).hexdigest()[:8], 16)
        return out

    def make(longest, buckets):
        import numpy as np

        def steps(data, stops):
            """``(row, bucket)`` of all n-grams, in steps of bounded size, rows ascending in each.

            Texts lie one blank apart in ``data`` and end at ``stops``. Words lie between single blanks, so every n-gram is a run of bytes.
            """
            lengths = np.diff(stops, prepend=-1) - 1
            eights = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
            all_ends = np.append(np.flatnonzero(data == 0x20), len(data))
            for begin in range(0, len(all_ends), words_at_once):
                size = min(words_at_once, len(all_ends) - begin)
                ends = all_ends[begin : begin + size + longest - 1]
                starts = np.concatenate([[all_ends[begin - 1] + 1 if begin else 0], ends[:-1] + 1])
                row = np.searchsorted(stops, ends)
                for n in range(1, longest + 1):
                    # The first and last word are of one text. An empty text has no word.
                    there = np.flatnonzero((row[n - 1 :][:size] == row[: max(len(row) - n + 1, 0)][:size]) & (lengths[row[n - 1 :][:size]] > 0))
                    if len(there):
                        yield row[there], md5_heads(data, eights, starts[there], ends[there + n - 1]).astype(np.int64) % buckets

        return steps

    return make


def _counter(labels: int, ngram_words: int, buckets: int):
    """A function for ``mapInArrow``: from (label, text) to each label's count of every bucket, and of its rows as bucket -1."""
    make, bytes_at_once = _bucketer(), 1 << 20

    def run(batches):
        import numpy as np

        steps = make(ngram_words, buckets)
        rows, counts = np.zeros(labels, np.int64), np.zeros(labels * buckets, np.int64)

        def count(label, texts):
            stops = np.cumsum(np.array([len(text) for text in texts], np.int64) + 1) - 1
            for row, bucket in steps(np.frombuffer(b" ".join(texts), np.uint8), stops):
                np.add.at(counts, label[row] * buckets + bucket, 1)

        for batch in batches:
            label = batch.column(0).to_numpy().astype(np.int64)
            rows += np.bincount(label, minlength=labels)
            texts, size, begin = [], 0, 0
            for end, text in enumerate(batch.column(1).cast("binary"), 1):
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= bytes_at_once or end == len(label):
                    count(label[begin:end], texts)
                    texts, size, begin = [], 0, end
        seen, known = np.flatnonzero(counts), np.flatnonzero(rows)
        label, bucket = np.concatenate([known, seen // buckets]), np.concatenate([np.full(len(known), -1), seen % buckets])
        columns = [label.astype(np.int32), bucket.astype(np.int32), np.concatenate([rows[known], counts[seen]])]
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names=["label", "bucket", "n"])

    return run


def _predictor():
    """As a nested function, which Spark ships by value."""
    special, make = SPECIAL_TOKENS, _bucketer()

    def build(parts):
        import numpy as np

        by_label, intercepts = np.ascontiguousarray(parts["weights"].T), parts["intercepts"]
        steps = make(parts["ngram_words"], len(parts["weights"]))

        def predict(texts):
            raw = [text.encode() for text in texts]
            lengths = np.array([len(x) for x in raw], np.int64)
            words = np.array([x.count(b" ") + 1 if x else 0 for x in raw])
            logits = np.tile(np.asarray(intercepts, np.float64), (len(texts), 1))
            for row, bucket in steps(np.frombuffer(b" ".join(raw), np.uint8), np.cumsum(lengths + 1) - 1):
                firsts = np.flatnonzero(np.diff(row, prepend=-1))
                for label, weights in enumerate(by_label):
                    if len(firsts):
                        logits[row[firsts], label] += np.add.reduceat(weights[bucket], firsts)
            return (words + special).tolist(), logits

        return predict

    return build
