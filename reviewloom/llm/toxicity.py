"""Toxicity by character n-grams whose presence is scaled by naive Bayes log-count ratios.

A text is lower-cased (A-Z), every ASCII blank is a space, and a space stands before and after it. Its character
n-grams of three to six characters are hashed to buckets; what counts is whether a text has a bucket, not how often. Each
bucket has the naive Bayes ratio ``r = log((p / |p|) / (q / |q|))`` of its smoothed document counts in toxic (p) and other (q)
labelled texts. The buckets that tell the classes apart best (by the G statistic of their counts) are kept, and a ridge
logistic regression is fitted on the vectors ``r * present``.

Labels are learned from a bounded sample: at most ``sample_rows`` labelled rows of each class by the hash of their id; weights
give the classes their true shares again. Every text is scored whole.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.textbytes import lower_ascii, mix, slices, utf8

ORDERS = (3, 4, 5, 6)
BUCKET_BITS = 20
_SLICE_BYTES = 1_000_000
_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[0x09:0x0E] = 0x20
_STEP = np.uint64(0x9E3779B97F4A7C15)


class ToxicityModel(NamedTuple):
    """Sorted buckets, the weight that the presence of each adds to the logit, and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float
    bits: int

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1 of each text."""
        logits = np.full(len(texts), self.intercept)
        place = np.full(1 << self.bits, -1, np.int32)
        place[self.buckets] = np.arange(len(self.buckets))
        at = 0
        for part in slices(texts, _SLICE_BYTES):
            text, feature = present(part, self.bits, place)
            logits[at : at + len(part)] += np.bincount(text, self.weights[feature], minlength=len(part))
            at += len(part)
        return 1 / (1 + np.exp(-np.clip(logits, -50, 50)))


def characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each between two spaces, and the number of the text of each."""
    data, offsets = utf8(texts)
    data = _BLANK[lower_ascii(data)]
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    counts = np.diff(lead[offsets]) + 2
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), counts)
    out = np.full(len(owner), 0x20, np.uint32)
    edges = np.zeros(len(owner), bool)
    ends = np.cumsum(counts)
    edges[ends - 1] = edges[ends - counts] = True
    out[~edges] = points
    return out, owner


def present(texts: pa.Array, bits: int, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs, as two arrays. With ``place`` buckets are mapped to features, and those with -1 left out."""
    points, owner = characters(texts)
    found_text, found = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    hashes = points.astype(np.uint64) + np.uint64(1)
    for n in range(2, max(ORDERS) + 1):
        if len(points) < n:
            break
        hashes = hashes[:-1] * _STEP + points[n - 1 :] + np.uint64(1)
        if n not in ORDERS:
            continue
        buckets = (mix(hashes) >> np.uint64(64 - bits)).astype(np.int64)
        if place is not None:
            buckets = place[buckets]
        good = owner[: len(buckets)] == owner[n - 1 :]
        if place is not None:
            good &= buckets >= 0
        at = np.flatnonzero(good)
        found_text.append(owner[at])
        found.append(buckets[at].astype(np.int64))
    text, bucket = np.concatenate(found_text).astype(np.int64), np.concatenate(found)
    pairs = np.unique((text << bits) | bucket)
    return pairs >> bits, pairs & ((1 << bits) - 1)


def ratios(counts: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """Naive Bayes log-count ratios of document counts (2 x buckets: other, toxic)."""
    smoothed = counts + alpha
    shares = smoothed / smoothed.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def most_telling(counts: np.ndarray, rows: np.ndarray, features: int, least: int = 3) -> np.ndarray:
    """Sorted buckets with the highest G statistic, of those that ``least`` rows have; ties to the smaller bucket."""
    total = counts.sum(axis=0)
    expected = total * (rows / max(rows.sum(), 1))[:, None]
    missing = rows[:, None] - counts
    expected_missing = rows[:, None] - expected

    def term(seen, wanted):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(wanted, 1e-9)), 0.0)

    g = (term(counts, expected) + term(missing, expected_missing)).sum(axis=0)
    g[total < least] = 0
    order = np.argsort(-g, kind="stable")[:features]
    return np.sort(order[g[order] > 0])


def logistic(row: np.ndarray, feature: np.ndarray, value: np.ndarray, labels: np.ndarray, weights: np.ndarray, features: int, ridge: float):
    """Intercept and coefficients of a weighted ridge logistic regression on sparse rows: Newton steps, each solved by
    conjugate gradients. The intercept is not shrunk."""
    n = len(labels)

    def forward(b):
        return b[0] + np.bincount(row, value * b[1:][feature], minlength=n)

    def backward(g):
        return np.concatenate([[g.sum()], np.bincount(feature, value * g[row], minlength=features)])

    shrink = np.full(features + 1, ridge)
    shrink[0] = 1e-6
    b = np.zeros(features + 1)
    share = np.clip((weights * labels).sum() / max(weights.sum(), 1e-9), 0.01, 0.99) if n else 0.5
    b[0] = np.log(share / (1 - share))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(forward(b), -30, 30)))
        gradient = backward(weights * (p - labels)) + shrink * b
        curve = np.maximum(weights * p * (1 - p), 1e-9)
        step, rest = np.zeros_like(b), gradient.copy()
        way, size = rest.copy(), rest @ rest
        for _ in range(60):
            if size < 1e-10:
                break
            bent = backward(curve * (forward(way))) + shrink * way
            pace = size / (way @ bent)
            step += pace * way
            rest -= pace * bent
            new = rest @ rest
            way, size = rest + new / size * way, new
        b -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return b[0], b[1:]


def _sample(df: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, sample_rows: int):
    """``label``, ``text`` of the sampled rows in the order of their ids' hash, and the true rows of each class."""
    known = labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").alias("label"))
    known = known.filter("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").cast("int").alias("label"))
    rows = np.zeros(2)
    for r in known.groupBy("label").count().collect():
        rows[r["label"]] = r["count"]
    order = F.xxhash64("id", F.lit(12)), F.col("id")
    chosen = known.filter("label = 0").orderBy(*order).limit(sample_rows)
    chosen = chosen.unionByName(known.filter("label = 1").orderBy(*order).limit(sample_rows))
    texts = df.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    # at most 2 * sample_rows ids are broadcast
    return texts.join(F.broadcast(chosen), "id").select("id", "label", "text"), rows


def fit(
    df: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_rows: int = 3000,
    features: int = 2000,
    ridge: float = 0.3,
    bits: int = BUCKET_BITS,
) -> ToxicityModel:
    """Learns from the rows of ``labels`` (id and 0/1) that have a text in ``df``.

    Rows with null id or label are passed over; of contradicting labels of one id 1 counts; null texts are empty. With one class only, or no
    labelled row, no bucket tells anything apart and every score is near the share of label 1 (0.5 for none). To the driver come at
    most 2 x 2**``bits`` counts and, for each sampled row, at most ``features`` numbers.
    """
    sample, rows = _sample(df, labels, id_column, text_column, label_column, sample_rows)

    def count(batches):
        counts = np.zeros((2, 1 << bits), np.int64)
        seen = np.zeros(2, np.int64)
        for batch in batches:
            at = 0
            classes = batch.column(0).to_numpy()
            for part in slices(batch.column(1), _SLICE_BYTES):
                own = classes[at : at + len(part)]
                text, bucket = present(part, bits)
                for label in (0, 1):
                    counts[label] += np.bincount(bucket[own[text] == label], minlength=1 << bits)
                    seen[label] += (own == label).sum()
                at += len(part)
        for label in (0, 1):
            used = np.flatnonzero(counts[label])
            yield pa.RecordBatch.from_pydict(
                {
                    "label": np.full(len(used) + 1, label, np.int32),
                    "bucket": np.append(used, -1).astype(np.int32),
                    "n": np.append(counts[label][used], seen[label]),
                }
            )

    totals = sample.select("label", "text").mapInArrow(count, "label int, bucket int, n long")
    counted = totals.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()
    label, bucket, n = (counted[c].to_numpy() for c in ("label", "bucket", "n"))
    counts, sampled = np.zeros((2, 1 << bits)), np.zeros(2)
    used = bucket >= 0
    counts[label[used], bucket[used]] = n[used]
    sampled[label[~used]] = n[~used]
    buckets = most_telling(counts, sampled, features) if sampled.all() else np.zeros(0, np.int64)
    r = ratios(counts)[buckets]

    def described(batches):
        place = np.full(1 << bits, -1, np.int32)
        place[buckets] = np.arange(len(buckets))
        for batch in batches:
            at = 0
            for part in slices(batch.column(2), _SLICE_BYTES):
                n = len(part)
                text, feature = present(part, bits, place)
                cuts = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(feature.astype(np.int32)))
                columns = [batch.column(0).slice(at, n), batch.column(1).slice(at, n), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "present"])
                at += n

    schema = f"id {sample.schema['id'].dataType.simpleString()}, label int, present array<int>"
    table = sample.mapInArrow(described, schema).orderBy("id", "present").toArrow()
    labels_found = table["label"].to_numpy().astype(float)
    lists = table["present"].combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(labels_found)), lengths)
    feature = lists.flatten().to_numpy() if len(lists) else np.zeros(0, np.int64)
    true_weight = np.where(sampled > 0, rows / np.maximum(sampled, 1), 0)
    true_weight *= sampled.sum() / max((true_weight * sampled).sum(), 1e-9)
    weights = true_weight[labels_found.astype(int)]
    intercept, coefficients = logistic(row, feature, r[feature], labels_found, weights, len(buckets), ridge)
    return ToxicityModel(buckets, coefficients * r, float(intercept), bits)


def toxicity_scores(df: DataFrame, model: ToxicityModel, text_column: str = "text", name: str = "score") -> DataFrame:
    """``df`` with the probability of label 1 of every whole text, as column ``name``.

    Null and empty texts have the score of a text without characters. Texts of any length are scored whole, repeated rows each by
    themselves and alike; an empty table gives no rows. All columns of ``df`` stay; one already called ``name`` is refused.
    """
    if name in df.columns:
        raise ValueError(f"the input has a column {name}; choose another name for the score")

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(texts))

    return df.withColumn(name, scored(F.col(f"`{text_column}`")))
