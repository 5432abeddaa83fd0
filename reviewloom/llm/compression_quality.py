"""Quality by compression: a text is like the labelled texts whose dictionary makes it smaller.

One zstandard dictionary is built from good labelled text and one from bad. A whole text is compressed in
windows of 512 bytes (so that a dictionary counts as much at the end of a long text as at its
beginning) with the good dictionary, the bad one and none. The normalised difference of the sizes, with the normalised
sizes themselves, becomes a probability by logistic calibration on labelled texts that are in neither dictionary.

Labels are learned from a bounded sample: at most ``sample_rows`` labelled rows of each class by the hash of
their id, of which at most ``dictionary_windows`` windows make a dictionary. Every text is scored.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_BYTES = 512
DICTIONARY_BYTES = 32768
_NAMES = ["difference", "good_ratio", "bad_ratio", "own_ratio"]


class QualityModel(NamedTuple):
    """Dictionaries (None where a class has no text) and the calibration."""

    good: bytes | None
    bad: bytes | None
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the first is the intercept

    def score(self, sizes: np.ndarray) -> np.ndarray:
        logit = self.weights[0] + (sizes - self.mean) / self.scale @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


class _Sizes:
    """Normalised compressed sizes of texts."""

    def __init__(self, good: bytes | None, bad: bytes | None):
        def compressor(dictionary):
            options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
            return zstandard.ZstdCompressor(level=3, write_content_size=False, write_dict_id=False, **options).compress

        self._all = [compressor(d) for d in (good, bad, None)]

    def __call__(self, text: str | None) -> tuple[float, float, float, float]:
        data = (text or "").encode()
        windows = [data[i : i + WINDOW_BYTES] for i in range(0, max(len(data), 1), WINDOW_BYTES)]
        good, bad, own = (sum(len(compress(w)) for w in windows) for compress in self._all)
        n = max(len(data), 1)
        return (bad - good) / own, good / n, bad / n, own / n


def _dictionary(windows: list[bytes]) -> bytes | None:
    """Trained on windows, or their plain content where they are too few to train on."""
    if not any(windows):
        return None
    size = min(DICTIONARY_BYTES, max(256, sum(map(len, windows)) // 8))
    try:
        return zstandard.train_dictionary(size, windows).as_bytes()
    except zstandard.ZstdError:
        return b"".join(windows)[-DICTIONARY_BYTES:]


def _calibration(sizes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and weights of a ridge logistic regression, by damped Newton steps."""
    if not len(labels):
        return np.zeros(4), np.ones(4), np.zeros(5)
    mean, scale = sizes.mean(axis=0), sizes.std(axis=0) + 1e-9
    x = np.column_stack([np.ones(len(sizes)), (sizes - mean) / scale])
    weights = np.zeros(x.shape[1])
    ridge = 0.1 * np.eye(len(weights))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - labels) + ridge @ weights)
        weights -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
    return mean, scale, weights


def _measured(text: Column, good: bytes | None, bad: bytes | None) -> Column:
    """The normalised sizes, as a struct."""
    made = []

    @F.arrow_udf("struct<difference:double,good_ratio:double,bad_ratio:double,own_ratio:double>")
    def measure(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(_Sizes(good, bad))
        rows = np.array([made[0](str(x) if x.is_valid else None) for x in texts]).reshape(-1, 4)
        return pa.StructArray.from_arrays([pa.array(c) for c in rows.T], names=_NAMES)

    return measure(text)


def _first(df: DataFrame, n: int, order: Column) -> DataFrame:
    """At most ``n`` rows of each class: each task keeps its own first ``n``, so no task gets a whole class."""
    return df.filter("label = 0").orderBy(order).limit(n).unionByName(df.filter("label = 1").orderBy(order).limit(n))


def fit(
    df: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample_rows: int = 4000,
    dictionary_windows: int = 5000,
) -> QualityModel:
    """Learns from the rows of ``labels`` (id and 0/1) that have a text in ``df``.

    Half of the sampled rows make the dictionaries, the others calibrate. Rows with null id or label are passed over. With
    one class only, or none, scores stay near the share of good rows (0.5 for none).
    """
    known = labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").alias("label"))
    known = known.filter("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    sample = _first(known, sample_rows, F.xxhash64("id", F.lit(11))).withColumn(
        "builds", F.pmod(F.xxhash64("id", F.lit(12)), F.lit(2)) == 0
    )
    texts = df.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    # at most 2 * sample_rows ids are broadcast
    learned = texts.join(F.broadcast(sample), "id")

    bounds = f"sequence(0, octet_length(text) - 1, {WINDOW_BYTES})"
    cut = f"posexplode(transform({bounds}, i -> substring(encode(text, 'UTF-8'), i + 1, {WINDOW_BYTES})))"
    windows = learned.filter("builds AND text <> ''").select("id", "label", F.expr(cut).alias("at", "part"))
    chosen = _first(windows, dictionary_windows, F.xxhash64("id", "at", F.lit(13))).orderBy("label", "id", "at")
    by_class = {0: [], 1: []}
    for row in chosen.select("label", "part").collect():  # 2 * dictionary_windows * 512 bytes at most
        by_class[row["label"]].append(bytes(row["part"]))
    good, bad = _dictionary(by_class[1]), _dictionary(by_class[0])

    sizes = _measured(F.col("text"), good, bad)
    rows = learned.filter("NOT builds").select("label", "id", sizes.alias("s")).select("label", "id", "s.*")
    rows = rows.orderBy("id", *_NAMES).limit(4 * sample_rows).collect()
    x = np.array([[row[name] for name in _NAMES] for row in rows]).reshape(-1, 4)
    return QualityModel(good, bad, *_calibration(x, np.array([row["label"] for row in rows], float)))


def quality_scores(df: DataFrame, model: QualityModel, text_column: str = "text", name: str = "score") -> DataFrame:
    """``df`` with the probability of label 1 of every whole text (null and empty texts too)."""
    made = []

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(_Sizes(model.good, model.bad))
        rows = np.array([made[0](str(x) if x.is_valid else None) for x in texts]).reshape(-1, 4)
        return pa.array(model.score(rows))

    return df.withColumn(name, scored(F.col(f"`{text_column}`")))
